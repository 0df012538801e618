"""Sampled SentencePiece segmentations by forward filtering and backward sampling; lossless decoding.

The pieces come from a public ``.model`` file; a piece of rank r (the negative
of its score) weighs ``(r + 2) ** -theta``, a character without a piece is
spelled in byte pieces.  A segmentation's probability is the product of its
pieces' weights.  Forward filtering sums these over all prefixes of the text;
backward sampling then draws the last piece, the one before it, and so on, which
gives an exact draw from the whole lattice.

The text is taken as it is (no normalisation): a space becomes the piece mark,
a mark that stands in the text itself is spelled in bytes, so that decoding
gives back every byte.  As no piece has a mark after another character, the
lattice falls apart before each run of marks (and around a spelled character) into
words.  The different words of a block of texts that have the same length are
filtered side by side in numpy, then all their occurrences are sampled side by side.

The draws depend on ``seed``, the row's key and the word's place alone: the same
row gets the same segmentation on any partitioning, in any run.  A null key is
a key like any other; a null text gives null pieces (lossless) and is decoded to null, an
empty text no pieces.  Every input row gives one row.  A column that has the name of an
output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, StructType

from .common import free, in_batches
from .rolling import mix

MARK = "▁"
STEP, ADD, FULL = 6364136223846793005, 1442695040888963407, (1 << 64) - 1


class Pieces:
    """Piece table of a model file, and the lattice over it."""

    #: longer words go one by one; words of each length up to this are worked in blocks of about so many sums
    LONGEST, CELLS = 32, 1 << 18

    def __init__(self, model_path: str, theta: float = 1.0):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        self.byte_id, raw, self.piece = [0] * 256, [b""] * size, {}
        for i in range(size):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(name[3:5], 16)
                self.byte_id[value], raw[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                raw[i] = name.replace(MARK, " ").encode()
                rank = min(max(-model.get_score(i), 0.0), float(size))
                self.piece[name] = (i, (rank + 2.0) ** -theta)
        self.blob, self.width = np.frombuffer(b"".join(raw), np.uint8), np.array([len(b) for b in raw])
        self.offset = np.cumsum(self.width) - self.width
        self.longest = max(map(len, self.piece))
        if any(MARK in name.lstrip(MARK) for name in self.piece):
            raise ValueError("a piece has a mark after another character: words can't be taken apart")
        if any(c not in self.piece for name in self.piece for c in name):
            raise ValueError("a character of a piece has no piece of its own")
        #: 2 for the mark, 1 for other characters with a piece, 0 for those spelled in bytes
        self.kind = np.zeros(0x110000, np.uint8)
        self.kind[[ord(c) for c in self.piece if len(c) == 1]] = 1
        self.kind[ord(MARK)] = 2
        names = list(self.piece)
        lengths, hashes = np.array([len(n) for n in names]), np.zeros(len(names), np.uint64)
        for n in np.unique(lengths):
            own = np.flatnonzero(lengths == n)
            codes = "".join(names[i] for i in own).encode("utf-32-le")
            hashes[own] = self._hash(np.frombuffer(codes, "<u4").reshape(-1, n).astype(np.uint64))
        order = np.argsort(hashes)
        # one more than there are, at which a search may end
        self.hashes = np.append(hashes[order], np.uint64(FULL))
        self.ids = np.append(np.array([self.piece[n][0] for n in names], np.int32)[order], np.int32(0))
        self.weights = np.append(np.array([self.piece[n][1] for n in names])[order], 0.0)
        self.seen = np.zeros(1 << 19, bool)
        self.seen[hashes >> np.uint64(45)] = True
        buckets = np.bincount((hashes >> np.uint64(46)).astype(np.int64), minlength=1 << 18)
        self.deepest, self.bucket = int(buckets.max()), (np.cumsum(buckets) - buckets).astype(np.int32)

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        """Hash of each row of character codes."""
        h = np.zeros(len(codes), np.uint64)
        for k in range(codes.shape[1]):
            h = (h + codes[:, k] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def filter(self, word: str) -> list:
        """For each end in ``word``: running sums, starts and ids of the pieces that end there."""
        n, longest, get = len(word), self.longest, self.piece.get
        alpha, ends = [1.0] + [0.0] * n, [None]
        for end in range(1, n + 1):
            total, sums, starts, ids = 0.0, [], [], []
            for start in range(end - 1, max(end - longest, 0) - 1, -1):
                if found := get(word[start:end]):
                    total += alpha[start] * found[1]
                    sums.append(total)
                    starts.append(start)
                    ids.append(found[0])
            alpha[end] = total
            ends.append((sums, starts, ids))
            if total < 1e-200:  # only ratios within a piece's reach matter
                low = max(0, end - longest)
                scale = max(alpha[low:end + 1])
                alpha[low:end + 1] = [a / scale for a in alpha[low:end + 1]]
        return ends

    def sample(self, word: str, x: int) -> list[int]:
        """Ids of a draw, the last piece first; ``x`` is the state of the word's random numbers."""
        ends, at, out = self.filter(word), len(word), []
        while at:
            sums, starts, ids = ends[at]
            draw = ((x >> 11) + 1) * 2.0 ** -53 * sums[-1]
            k = 0
            while sums[k] < draw:
                k += 1
            x = (x * STEP + ADD) & FULL
            out.append(ids[k])
            at = starts[k]
        return out

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are a piece's, and the piece's place in the table."""
        which = np.flatnonzero(self.seen.take((h >> np.uint64(45)).view(np.int64)))
        value = h.take(which)
        place = self.bucket.take((value >> np.uint64(46)).view(np.int64))
        for _ in range(self.deepest):
            place += self.hashes.take(place) < value
        hit = self.hashes.take(place) == value
        return which[hit], place[hit]

    def _sums(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward filtering of words of ``n`` characters at once: for word, end and piece length, the
        running sum and the piece's id."""
        words, n = codes.shape
        reach = min(n, self.longest)
        chars = np.ascontiguousarray(codes.T) + np.uint64(1)
        # the words side by side in memory: every step below runs along them
        sums, ids = np.zeros((reach + 1, n + 1, words)), np.zeros((reach + 1, n + 1, words), np.int32)
        h = np.zeros((n, words), np.uint64)
        for size in range(1, reach + 1):
            h = (h[:n - size + 1] + chars[size - 1:]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            which, place = self._find(h.reshape(-1))
            sums[size, size:].reshape(-1)[which] = self.weights[place]
            ids[size, size:].reshape(-1)[which] = self.ids[place]
        alpha = np.ones((n + 1, words))
        for end in range(1, n + 1):
            far = min(end, reach)
            for size in range(1, far + 1):
                sums[size, end] *= alpha[end - size]
                sums[size, end] += sums[size - 1, end]
            sums[far + 1:, end] = alpha[end] = sums[far, end]
        return np.ascontiguousarray(sums.transpose(2, 1, 0)), np.ascontiguousarray(ids.transpose(2, 1, 0))

    def _draw(self, sums, ids, word, x) -> tuple[list, np.ndarray]:
        """Backward sampling of many words at once: per step (which, id), and the number of pieces."""
        ends, sizes = sums.shape[1:]
        rows, flat = sums.reshape(-1, sizes), ids.reshape(-1)
        which, at = np.arange(len(word)), np.full(len(word), ends - 1)
        steps, count = [], np.zeros(len(word), np.int64)
        while len(which):
            row = word[which] * ends + at
            mine = rows.take(row, axis=0)
            draw = ((x >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0 ** -53 * mine[:, -1]
            size = np.argmax(mine >= draw[:, None], axis=1)
            steps.append((which, flat.take(row * sizes + size)))
            count[which] += 1
            at = at - size
            x = x * np.uint64(STEP) + np.uint64(ADD)
            on = at > 0
            which, at, x = which[on], at[on], x[on]
        return steps, count

    def encode(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """Piece ids of one sampled segmentation of each text; its key seeds the draws."""
        if not texts:
            return []
        code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        ends = np.cumsum([len(t) for t in texts])
        if not len(code):
            return [np.zeros(0, np.int32) for _ in texts]
        kind = self.kind[code]
        kind[code == ord(MARK)] = 0
        space = code == 32
        kind[space], code[space] = 2, ord(MARK)
        start = np.empty(len(code), bool)
        start[0] = True
        start[1:] = (kind[1:] == 0) | (kind[:-1] == 0) | ((kind[1:] == 2) & (kind[:-1] != 2))
        start[ends[:-1][ends[:-1] < len(code)]] = True
        first = np.flatnonzero(start)
        length = np.diff(np.append(first, len(code)))
        text = np.searchsorted(ends, first, side="right")
        number = np.arange(len(first)) - np.searchsorted(text, text)
        state = mix(mix(number.astype(np.uint64) + np.array(keys, np.uint64)[text]))
        count, filled = np.ones(len(first), np.int64), []
        spelled = np.flatnonzero(kind[first] == 0)
        plain = kind[first] != 0
        for n in np.unique(length[plain & (length <= self.LONGEST)]).tolist():
            own = np.flatnonzero(plain & (length == n))
            codes = code[first[own][:, None] + np.arange(n)].astype(np.uint64)
            hashes = self._hash(codes)
            order = np.argsort(hashes, kind="stable")
            new = np.append(True, np.diff(hashes[order]) != 0)
            word, example = np.cumsum(new) - 1, np.flatnonzero(new)
            block = max(1, self.CELLS // ((n + 1) * (min(n, self.longest) + 1)))
            for lo in range(0, len(example), block):
                some = slice(example[lo], example[lo + block] if lo + block < len(example) else len(order))
                which = own[order[some]]
                sums, ids = self._sums(codes[order[example[lo:lo + block]]])
                steps, count[which] = self._draw(sums, ids, word[some] - lo, state[which])
                filled.append((which, steps))
        for i in np.flatnonzero(plain & (length > self.LONGEST)):
            found = self.sample("".join(map(chr, code[first[i]:first[i] + length[i]])), int(state[i]))
            count[i] = len(found)
            filled.append((np.array([i]), [(np.array([0]), np.array([x])) for x in found]))
        bytes_of = {int(c): chr(c).encode("utf-8", "surrogatepass") for c in np.unique(code[first[spelled]])}
        count[spelled] = [len(bytes_of[c]) for c in code[first[spelled]].tolist()]
        stop = np.cumsum(count)
        out = np.zeros(stop[-1], np.int32)
        for own, steps in filled:
            for k, (which, ids) in enumerate(steps):
                out[stop[own[which]] - 1 - k] = ids
        for i, c in zip(spelled.tolist(), code[first[spelled]].tolist(), strict=True):
            out[stop[i] - count[i]:stop[i]] = [self.byte_id[b] for b in bytes_of[c]]
        last = np.searchsorted(text, np.arange(len(texts)), side="right")
        edges = np.append(0, stop)[last]
        return np.split(out, edges[:-1])

    def decode(self, ids: np.ndarray) -> bytes:
        width = self.width[ids]
        stop = np.cumsum(width)
        at = np.repeat(self.offset[ids] - stop + width, width)
        at += np.arange(len(at))
        return self.blob[at].tobytes()


def by_size(texts: list, limit: int = 1 << 20) -> Iterator[slice]:
    """Slices of ``texts`` of about ``limit`` characters."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t or "") > limit:
            yield slice(lo, i)
            lo, size = i, 0
        size += len(t or "")
    if lo < len(texts):
        yield slice(lo, len(texts))


def sampled_pieces(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", seed: int = 0,
                   theta: float = 1.0, out: str = "pieces", lossless: str = "lossless") -> DataFrame:
    """All columns of ``docs``, ``out`` (array of int): one sampled segmentation of each text, and
    ``lossless``: whether it decodes to every byte of the text, as each task checks."""
    rows = docs.drop(out, lossless)
    state_name = free("__state", out, lossless, *rows.columns)
    rows = rows.withColumn(state_name, F.xxhash64(F.lit(seed), F.col(key).cast("string")))
    schema = StructType([*rows.schema.fields]).add(out, ArrayType(IntegerType())).add(lossless, BooleanType())
    where, state = rows.columns.index(text), len(rows.columns) - 1

    def run(batches) -> Iterator:
        import pyarrow as pa

        pieces = Pieces(model_path, theta)
        for batch in batches:
            texts, states = batch.column(where).to_pylist(), batch.column(state).to_pylist()
            for part in by_size(texts):
                found = pieces.encode([t or "" for t in texts[part]], [x & FULL for x in states[part]])
                ids = [None if t is None else x for t, x in zip(texts[part], found, strict=True)]
                same = [t is None or pieces.decode(x) == t.encode() for t, x in zip(texts[part], ids, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(part.start, part.stop - part.start).columns, pa.array(ids, pa.list_(pa.int32())),
                     pa.array(same, pa.bool_())], names=schema.names)

    return rows.transform(in_batches, run, schema).drop(state_name)


def decoded(rows: DataFrame, model_path: str, ids: str = "pieces", out: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and ``out`` (binary): the bytes that the pieces stand for."""
    rows = rows.drop(out)
    schema = StructType([*rows.schema.fields]).add(out, BinaryType())
    where = rows.columns.index(ids)

    def run(batches) -> Iterator:
        import pyarrow as pa

        pieces = Pieces(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                column = part.column(where)
                raw = [pieces.decode(x.values.to_numpy()) if x.is_valid else None for x in column]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], names=schema.names)

    return rows.transform(in_batches, run, schema)
