"""Token ids packed into rows of fixed length, for training without padding between documents.

1. texts are encoded piece by piece with a public tokenizer (``token_counts``); a
   document of more than ``length`` tokens is split into parts, losslessly, of
   which all but the last are full;
2. segments (a document, or a part) are dealt to shards by hash, each of about
   ``shard_bytes`` of text, so that no key or source gathers in one of them;
3. a shard is packed by best-fit decreasing: from the longest to the shortest, each
   segment goes to the row with the least room that still holds it.  A segment
   tree over the room left (0 to ``length``) finds that row in log2(length) steps.

A packed row has its ids as little-endian binary of ``length`` numbers (padded with
``pad``), n_tokens, the cumulative segment lengths (from 0), the places where
positions start anew at 0, and per segment its doc_id and part.  ``write_matrices``
writes each shard as one raw matrix file with its segment table beside it.

A null or empty text has no tokens and so no segment.  Rows that repeat a document
are documents of their own; a null doc_id is kept as null.  Further columns are
ignored.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches
from .token_counts import PieceTable


class RoomTree:
    """Segment tree over the room left in rows: the rows of each room, and which rooms have any."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.some = [False] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def _set(self, room: int, some: bool) -> None:
        at = self.size + room
        self.some[at] = some
        while at > 1:
            at >>= 1
            now = self.some[2 * at] or self.some[2 * at + 1]
            if self.some[at] == now:
                break
            self.some[at] = now

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        if len(self.rows[room]) == 1:
            self._set(room, True)

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, row) of a row with the least room of at least ``least``, taken out; None if there is none."""
        at = self.size + least
        if not self.some[at]:
            while at > 1 and (at & 1 or not self.some[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.some[2 * at] else 2 * at + 1
        room = at - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            self._set(room, False)
        return room, row


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of indexes of ``sizes`` (1 to ``length``), in the order they were put."""
    tree, rows = RoomTree(length), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if found:
            room, row = found
        else:
            room, row = length, len(rows)
            rows.append([])
        rows[row].append(i)
        if room > sizes[i]:
            tree.put(room - sizes[i], row)
    return rows


def load_ids(path: str, pattern: str | None = None):
    """Number type and encoder of a batch to little-endian binary ids: a ``tokenizers`` file, or with its
    splitting ``pattern`` a ``tiktoken`` file of ranks (no special tokens)."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        size = max(ranks.values()) + 1
    else:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        size = tokenizer.get_vocab_size()
    code = "H" if size <= 1 << 16 else "I"

    def packed_ids(texts):
        if path.endswith(".tiktoken"):
            found = map(encode, texts)
        else:
            found = (e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False))
        return [array(code, ids).tobytes() for ids in found]

    return np.dtype("<u2" if code == "H" else "<u4"), packed_ids


def segments(docs: DataFrame, tokenizer_path: str, length: int, pattern: str | None = None,
             cache_pieces: int = 600_000) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, part, ids)``: binary ids of at most ``length`` tokens each."""

    def run(batches) -> Iterator:
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        kind, encode = load_ids(tokenizer_path, pattern)
        table, step = PieceTable(encode, 1 << 20, cache_pieces), length * kind.itemsize
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = []
                for doc, text in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True):
                    raw = b"".join(table.values(text or ""))
                    rows += [(doc, k, raw[lo:lo + step]) for k, lo in enumerate(range(0, len(raw), step))]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary()),
                                                        strict=True)], ["doc_id", "part", "ids"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .transform(in_batches, run, "doc_id long, part int, ids binary"))


def packed(docs: DataFrame, tokenizer_path: str, length: int = 2048, pad: int = 0,
           shard_bytes: int = 16 << 20, pattern: str | None = None) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(shard, row, n_tokens, ids, cu_seqlens, position_resets, doc_ids, parts)``."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    dealt = segments(docs, tokenizer_path, length, pattern).withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "part", F.crc32("ids")), F.lit(shards)).cast("int"))

    def run(batches) -> Iterator:
        import pyarrow as pa

        kind, _ = load_ids(tokenizer_path, pattern)
        names = ["shard", "row", "n_tokens", "ids", "cu_seqlens", "position_resets", "doc_ids", "parts"]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()),
                 pa.list_(pa.int64()), pa.list_(pa.int32())]
        shard, own = None, []

        def rows():
            sizes = [len(x[2]) // kind.itemsize for x in own]
            out = []
            for n, members in enumerate(best_fit_decreasing(sizes, length)):
                edges = np.cumsum([0, *(sizes[i] for i in members)]).tolist()
                ids = b"".join(own[i][2] for i in members)
                ids += np.full(length - edges[-1], pad, kind).tobytes()
                out.append((shard, n, edges[-1], ids, edges, edges[:-1], [own[i][0] for i in members],
                            [own[i][1] for i in members]))
            for at in range(0, len(out), 500):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out[at:at + 500], strict=True), types, strict=True)], names)

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for s, doc, part, ids in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True):
                    if s != shard:
                        if own:
                            yield from rows()
                        shard, own = s, []
                    own.append((doc, part, ids))
        if own:
            yield from rows()

    return (dealt.select("shard", "doc_id", "part", "ids").repartition("shard")
            .sortWithinPartitions("shard", "doc_id", "part", "ids")
            .transform(in_batches, run, "shard int, row int, n_tokens int, ids binary, cu_seqlens array<int>, "
                             "position_resets array<int>, doc_ids array<long>, parts array<int>"))


def write_matrices(rows: DataFrame, folder: str) -> DataFrame:
    """Write each shard of ``packed`` rows under ``folder``: ``<name>.bin`` (rows x length ids) and
    ``<name>.json`` (a line per row: cu_seqlens, doc_ids, parts).  Returns ``(shard, name, rows)``; a repeated
    task writes under a new name."""

    def run(batches) -> Iterator:
        import json
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(folder)
        system.create_dir(inner, recursive=True)
        shard, files, done, name = None, (), 0, ""

        def ended():
            for f in files:
                f.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([name]), pa.array([done], pa.int32())], ["shard", "name", "rows"])

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for s, _, ids, edges, docs, parts in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True):
                    if s != shard:
                        if files:
                            yield ended()
                        shard, done, name = s, 0, f"shard-{s:06d}-{uuid.uuid4().hex[:12]}"
                        files = [system.open_output_stream(f"{inner}/{name}.{x}") for x in ("bin", "json")]
                    files[0].write(ids)
                    files[1].write((json.dumps({"cu_seqlens": edges, "doc_ids": docs, "parts": parts}) + "\n").encode())
                    done += 1
        if files:
            yield ended()

    return (rows.select("shard", "row", "ids", "cu_seqlens", "doc_ids", "parts").repartition("shard")
            .sortWithinPartitions("shard", "row").transform(in_batches, run, "shard int, name string, rows int"))
