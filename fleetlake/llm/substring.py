"""Removal of repeated word passages by level-wise doubling.

A window is ``length`` consecutive words of one document.  A word goes when a
window that covers it also starts in a document with a smaller doc_id; windows
are judged on the input.

Level-wise doubling over packed entries (document, place, hash), at every start:

1. the first level has windows of ``(length + 1) // 2`` words of every text.
   Each task hashes them, keeps per distinct window only its smallest document,
   and notes the others as repeated at once: a passage found in a third of all
   documents leaves a task once;
2. what is left goes to hash buckets as packed byte planes (about seven bytes a
   window).  A bucket sees all documents of its windows; those that several
   documents hold are marked, and the marks go to their document's group;
3. a group makes the next level from its marks alone: a window of the greater
   length is looked at where its first and its last part (which may overlap)
   were both marked, and its hash comes from theirs.  Every repeat is made of
   repeated parts, so none is lost.  These windows go through 1 and 2 again.

The level of ``length`` words decides what goes: its marks and the texts meet by
document group, where the words are removed.  ``remove_repeats`` doubles on, to
twice the length, four times, and so on, until no window is left.  Each level
notes its documents in a small table of their own, which meets the texts in the
same way; the last level that holds a mark of a document gives its
``longest_repeat`` (0: none), exactly.  A level's marks are removed from the
shared folder when the next level is written, its shuffle files when it is.

Numbers of buckets and groups follow the bytes of the texts, and of the marks of
a longer level, within one to four a shuffle partition; so do the rows moved.

A first-level window is known by all 64 bits of one polynomial hash and, in its
bucket number, log2(buckets) bits of a second; a longer one by 64 bits of a hash
of its two parts' hashes.  Words are not compared: two different windows whose
hashes agree at every level would count as equal.

Null and empty texts have no words and keep the hash of the empty string.  Rows
with a null doc_id are left out.  A doc_id names one text: rows that repeat it
with an equal text get equal results.  Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import compress

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from fleetlake.session import hadoop_path

from .common import blobs, in_batches, run_folder, width
from .rolling import WordHasher, mix

#: bytes of text hashed, and packed for moving, at a time
UNIT_BYTES, PACK_BYTES = 3 << 20, 8 << 20
#: bytes of a batch taken in, and sent on, at a time; bytes of text for a hash bucket and for a document group, and of a level's marks
BATCH_BYTES, SENT_BYTES = 8 << 20, 4 << 20
BUCKET_TEXT, GROUP_TEXT, BUCKET_MARKS, GROUP_MARKS = 4 << 20, 8 << 20, 2 << 20, 4 << 20
MARKS_AT_ONCE = 1 << 19
FLAG_REPEAT, FLAG_SOURCE = 0, 1
#: what a mark says of its window: the flag, and its hash where a further level follows
FLAG, HASHED = [("flag", "u1")], [("flag", "u1"), ("value", "<u8")]
#: bytes of a window's hash that go to its bucket
HASH_BYTES = 8
SPREAD = 0x9E3779B97F4A7C15


def pack(doc, pos, extra) -> bytes:
    """Entries in (doc, pos) order as byte planes, which compress well: gaps of doc, pos, extra."""
    import numpy as np

    gap = np.diff(doc, prepend=np.int64(0)).astype(np.int64)
    planes = [a.view(np.uint8).reshape(len(a), -1).T.tobytes() for a in (gap, pos.astype(np.uint32), extra)]
    return len(doc).to_bytes(4, "little") + b"".join(planes)


def unpack(blob: bytes, kind):
    import numpy as np

    n, at, out = int.from_bytes(blob[:4], "little"), 4, []
    for dtype in ("<i8", "<u4", kind):
        size = np.dtype(dtype).itemsize
        plane = np.frombuffer(blob, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(plane.T).view(dtype).reshape(n))
        at += n * size
    return np.cumsum(out[0]), out[1], out[2]


def pack_by(key, doc, pos, extra) -> list[tuple[int, bytes]]:
    """(key, packed entries) for every key; entries come in (doc, pos) order."""
    import numpy as np

    if not len(key):
        return []
    order = np.argsort(key, kind="stable")
    key, doc, pos, extra = key[order], doc[order], pos[order], extra[order]
    cuts = np.flatnonzero(np.diff(key)) + 1
    return [(int(key[lo]), pack(doc[lo:hi], pos[lo:hi], extra[lo:hi]))
            for lo, hi in zip([0, *cuts], [*cuts, len(key)], strict=True)]


def group_of(doc, groups: int):
    """Document group of each doc_id."""
    import numpy as np

    return (mix(np.asarray(doc).astype(np.int64).view(np.uint64)) % np.uint64(groups)).astype(np.int64)


def _units(batches, limit: int) -> Iterator[list[tuple[int, bytes]]]:
    """Documents of a task in units of about ``limit`` bytes, each sorted by doc_id."""
    unit, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            for doc, text in zip(part.column(0).to_pylist(), blobs(part.column(1)), strict=True):
                unit.append((doc, text or b""))
                size += len(text or b"") + 64
                if size >= limit:
                    yield sorted(unit)
                    unit, size = [], 0
    if unit:
        yield sorted(unit)


def _rows(rows: list[tuple[int, int, bytes]]):
    """Batches of (key, kind, blob) rows, of ``SENT_BYTES`` or little more."""
    import pyarrow as pa

    at, held = 0, 0
    for i, row in enumerate(rows):
        held += len(row[2]) + 64
        if held < SENT_BYTES and i + 1 < len(rows):
            continue
        key, kind, blob = zip(*rows[at:i + 1], strict=True)
        at, held = i + 1, 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(kind, pa.int8()), pa.array(blob, pa.binary())], ["key", "kind", "blob"])


ROW = "key long, kind byte, blob binary"
LOCAL, WINDOWS = 0, 1
MARKS, DOCS, TEXTS = 0, 1, 2


def _identity(value, bucket, size: int):
    """The hash that a window is known by from its bucket on: ``size`` bytes of ``value``, and the bucket."""
    import numpy as np

    return mix((value & np.uint64((1 << 8 * size) - 1)) + np.asarray(bucket).astype(np.uint64) * np.uint64(SPREAD))


def _bucket(value, buckets: int):
    import numpy as np

    return (((value >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _mark(flag, value, kind):
    import numpy as np

    out = np.zeros(len(flag), kind)
    out["flag"] = flag
    if kind == HASHED:
        out["value"] = value
    return out


def _dealt(doc, pos, value, bucket, groups: int, kind, size: int) -> list[tuple[int, int, bytes]]:
    """Rows of a task's windows, which come in (doc, pos) order: each distinct one with its smallest document
    for the buckets, and marks of those that several documents here hold."""
    import numpy as np

    if not len(doc):
        return []
    order = np.argsort(value, kind="stable")  # equal windows stay in doc_id order
    new = np.ones(len(order), bool)
    new[1:] = value[order][1:] != value[order][:-1]
    least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    is_first = np.empty(len(order), bool)
    is_first[order] = doc[order] == least
    many = np.empty(len(order), bool)
    later = np.add.reduceat(doc[order] != least, np.flatnonzero(new))
    many[order] = (later > 0)[np.cumsum(new) - 1]
    at = np.flatnonzero(many)
    flag = np.where(is_first[at], FLAG_SOURCE, FLAG_REPEAT)
    mark = _mark(flag, _identity(value[at], bucket[at], size), kind)
    rows = [(k, LOCAL, b) for k, b in pack_by(group_of(doc[at], groups), doc[at], pos[at], mark)]
    at = np.flatnonzero(is_first)
    low = value[at].view(np.uint8).reshape(-1, 8)[:, :size].copy().reshape(-1).view(f"V{size}")
    return rows + [(k, WINDOWS, b) for k, b in pack_by(bucket[at], doc[at], pos[at], low)]


def _first_level(docs: DataFrame, length: int, buckets: int, groups: int) -> DataFrame:
    """Rows of packed windows for the hash buckets, and of marks already certain inside a task."""

    def run(batches):
        import numpy as np

        hasher = WordHasher()
        for unit in _units(batches, UNIT_BYTES):
            ids = np.array([d for d, _ in unit], np.int64)
            words, owner = hasher.words([t for _, t in unit])
            n = len(words) - length + 1
            if n <= 0:
                continue
            start = np.flatnonzero(owner[:n] == owner[length - 1:])
            first = np.searchsorted(owner, np.arange(len(ids)))
            value = hasher.window(hasher.prefix(words), start, length)
            other = hasher.window(hasher.prefix(words, 1), start, length, 1)
            yield from _rows(_dealt(ids[owner[start]], start - first[owner[start]], value, _bucket(other, buckets),
                                    groups, HASHED, HASH_BYTES))

    return docs.transform(in_batches, run, ROW, BATCH_BYTES)


def _next_level(marks: DataFrame, step: int, buckets: int, groups: int, kind) -> DataFrame:
    """Like ``_first_level``, of the windows made of two marked ones ``step`` words apart."""

    def run(batches):
        import numpy as np

        def dealt(parts):
            doc, pos, mark = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((pos, doc))
            doc, pos, value = doc[order], pos[order].astype(np.int64), mark["value"][order]
            place = (np.cumsum(np.diff(doc, prepend=doc[:1]) != 0) << 32) + pos
            once = np.flatnonzero(np.diff(place, prepend=np.int64(-1)))
            doc, pos, value, place = doc[once], pos[once], value[once], place[once]
            last = np.minimum(np.searchsorted(place, place + step), len(place) - 1)
            at = np.flatnonzero(place[last] == place + step)
            value = mix(value[at] + mix(value[last[at]]) * np.uint64(SPREAD))
            yield from _rows(_dealt(doc[at], pos[at], value, _bucket(value, buckets), groups, kind, HASH_BYTES))

        # whole document groups, many of them while they are small: the rows sent follow the marks, not the groups
        group, parts, held = None, [], 0
        for batch in batches:
            for key, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != group and held >= MARKS_AT_ONCE:
                    yield from dealt(parts)
                    parts, held = [], 0
                group = key
                parts.append(unpack(blob, HASHED))
                held += len(parts[-1][0])
        if parts:
            yield from dealt(parts)

    return (marks.select("key", "blob").repartition("key").sortWithinPartitions("key")
            .transform(in_batches, run, ROW, BATCH_BYTES))


def _noted(doc, length: int, groups: int) -> list[tuple[int, int, bytes]]:
    """Rows that say, by document group, which documents hold a mark of the level of ``length`` words."""
    import numpy as np

    if not len(doc):
        return []
    doc = np.unique(doc)
    group = group_of(doc, groups)
    order = np.argsort(group, kind="stable")
    keys, cuts = np.unique(group[order], return_index=True)
    return [(int(g), DOCS, length.to_bytes(8, "little") + own.astype("<i8").tobytes())
            for g, own in zip(keys, np.split(doc[order], cuts[1:]), strict=True)]


def _marks(packed: DataFrame, groups: int, kind, note: int = 0, note_groups: int | None = None, size: int = HASH_BYTES) -> DataFrame:
    """Marks of the windows that several documents share, packed by document group; with ``note``, the length of
    the level's windows, also rows of the documents that hold them, by ``note_groups``."""
    note_groups = note_groups or groups

    def run(batches):
        import numpy as np

        bucket, parts, found, waiting, local = None, [], [], 0, [np.zeros(0, np.int64)]

        def settle():
            """Marks of the bucket's windows that several documents share."""
            doc, pos, low = (np.concatenate(x) for x in zip(*parts, strict=True))
            value = np.zeros((len(low), 8), np.uint8)
            value[:, :size] = low.view(np.uint8).reshape(-1, size)
            value = value.reshape(-1).view(np.uint64)
            order = np.lexsort((doc, value))
            doc, pos, value = doc[order], pos[order], value[order]
            new = np.ones(len(value), bool)
            new[1:] = value[1:] != value[:-1]
            least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
            later = np.add.reduceat(doc != least, np.flatnonzero(new))
            at = np.flatnonzero((later > 0)[np.cumsum(new) - 1])
            flag = np.where(doc[at] == least[at], FLAG_SOURCE, FLAG_REPEAT)
            return doc[at], pos[at], _mark(flag, _identity(value[at], bucket, size), kind)

        def sent():
            """The marks of many buckets, by document group."""
            doc, pos, mark = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((pos, doc))
            doc, pos, mark = doc[order], pos[order], mark[order]
            yield from _rows([(k, MARKS, b) for k, b in pack_by(group_of(doc, groups), doc, pos, mark)])
            if note:
                yield from _rows(_noted(doc, note, note_groups))

        for batch in batches:
            for key, own, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own == LOCAL:
                    if note:  # the same documents come in blob after blob
                        local.append(np.unique(unpack(blob, kind)[0]))
                        if len(local) > 256:
                            local = [np.unique(np.concatenate(local))]
                    yield from _rows([(key, MARKS, blob)])
                    continue
                if key != bucket and parts:
                    found.append(settle())
                    waiting, parts = waiting + len(found[-1][0]), []
                    if waiting >= MARKS_AT_ONCE:
                        yield from sent()
                        found, waiting = [], 0
                bucket = key
                parts.append(unpack(blob, f"V{size}"))
        if parts:
            found.append(settle())
        if found:
            yield from sent()
        if note and len(local := np.concatenate(local)):
            yield from _rows(_noted(local, note, note_groups))

    return packed.repartition("key").sortWithinPartitions("kind", "key").transform(in_batches, run, ROW, BATCH_BYTES)


def _texts(docs: DataFrame, groups: int) -> DataFrame:
    """Whole rows, compressed by document group, so that they are moved once and small."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import zstandard

        press, waiting, size = zstandard.ZstdCompressor(3), [], 0

        def packed():
            rows = pa.Table.from_batches(waiting).combine_chunks()
            group = group_of(rows.column(0).to_numpy(), groups)
            order = np.argsort(group, kind="stable")
            keys, cuts = np.unique(group[order], return_index=True)
            for g, own in zip(keys, np.split(order, cuts[1:]), strict=True):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema) as stream:
                    stream.write_table(rows.take(own))
                yield int(g), TEXTS, press.compress(sink.getvalue())

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                waiting.append(batch.slice(at, 500))
                size += sum(len(t or b"") + 64 for t in blobs(waiting[-1].column(1)))
                if size >= PACK_BYTES:
                    yield from _rows(list(packed()))
                    waiting, size = [], 0
        if waiting:
            yield from _rows(list(packed()))

    return docs.transform(in_batches, run, ROW, BATCH_BYTES)


def without(text: bytes, keep: list[bool]) -> bytes:
    """``text`` without the words not in ``keep`` and the white space before them."""
    words = re.findall(rb"[\t-\r ]*[^\t-\r ]+", text)
    end = text[len(b"".join(words)):]
    left = b"".join(compress(words, keep))
    return (left if keep[0] else left.lstrip()) + end


def _apply(marks: DataFrame, texts: DataFrame, row: StructType, length: int, keep_text: bool, prefix: str,
           noted: bool = False) -> DataFrame:
    """Marks and rows (``row``: doc_id, text, more) meet by document group; marks, and notes of documents, come first."""
    schema = StructType([f for f in row.fields if keep_text or f.name == "doc_id"])
    added = [("n_words", LongType()), ("n_removed", LongType()), ("kept_sha256", StringType()), ("longest_repeat", LongType())]
    for name, kind in added if noted else added[:3]:
        schema = schema.add(prefix + name, kind)

    def run(batches):
        from hashlib import sha256

        import numpy as np
        import pyarrow as pa
        import zstandard

        group, parts, marked, longest = None, [], None, {}
        types = [pa.int64(), pa.int64(), pa.string(), pa.string()]

        def one(doc: int, text: bytes) -> tuple:
            words, n_removed = text.split(), 0
            total = len(words)
            kept = text
            lo, hi = np.searchsorted(marked[0], [doc, doc + 1]) if marked else (0, 0)
            if hi > lo:
                pos, flag = marked[1][lo:hi].astype(np.int64), marked[2][lo:hi]
                inside = pos <= total - length
                pos, flag = pos[inside], flag[inside]
                cover = np.zeros(total + 1, np.int64)
                gone = np.unique(pos[flag == FLAG_REPEAT])
                cover[gone] += 1
                cover[gone + length] -= 1
                keep = np.cumsum(cover)[:total] == 0
                n_removed = int(total - keep.sum())
                if n_removed:
                    keep = keep.tolist()
                    words = list(compress(words, keep))
                    kept = without(text, keep) if keep_text else b""
            return total, n_removed, sha256(b" ".join(words)).hexdigest(), kept.decode() if keep_text else None

        for batch in batches:
            for key, kind, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != group:
                    group, parts, marked, longest = key, [], None, {}
                if kind == MARKS:
                    parts.append(unpack(blob, FLAG))
                    continue
                if kind == DOCS:
                    size = int.from_bytes(blob[:8], "little")
                    longest.update((d, max(size, longest.get(d, 0))) for d in np.frombuffer(blob, "<i8", offset=8).tolist())
                    continue
                if parts:
                    doc, pos, flag = (np.concatenate(x) for x in zip(*parts, strict=True))
                    order = np.argsort(doc, kind="stable")
                    marked, parts = (doc[order], pos[order], flag["flag"][order]), []
                for rows in pa.ipc.open_stream(zstandard.ZstdDecompressor().decompressobj().decompress(blob)):
                    done = [one(d, t or b"") for d, t in zip(rows.column(0).to_pylist(), blobs(rows.column(1)), strict=True)]
                    found = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)]
                    kept = [rows.column(0), found[3], *rows.columns[2:]] if keep_text else [rows.column(0)]
                    if noted:
                        found[3] = pa.array([longest.get(d, 0) for d in rows.column(0).to_pylist()], pa.int64())
                    yield pa.RecordBatch.from_arrays([*kept, *found[:4 if noted else 3]], schema.names)

    return (marks.union(texts).repartition("key").sortWithinPartitions("key", "kind").transform(in_batches, run, schema, BATCH_BYTES))


def _flags(marks: DataFrame) -> DataFrame:
    """``HASHED`` marks without their hashes."""

    def run(batches):
        for batch in batches:
            rows = []
            for key, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc, pos, mark = unpack(blob, HASHED)
                rows.append((key, MARKS, pack(doc, pos, _mark(mark["flag"], None, FLAG))))
            yield from _rows(rows)

    return marks.select("key", "blob").transform(in_batches, run, ROW, BATCH_BYTES)


#: Spark's own setting: a finished query's shuffle files go at once, not when the driver's heap is next collected
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class _Level:
    """The marks of a level and its notes of documents, written once to the shared folder."""

    def __init__(self, found: DataFrame, length: int):
        self.spark, self.length = found.sparkSession, length
        self.path = run_folder(self.spark, f"windows{length}")
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            found.write.partitionBy("kind").parquet(self.path)
        finally:
            self.spark.conf.set(CLEANUP, before)

    def rows(self, kind: int) -> DataFrame:
        return self.spark.read.schema(ROW).parquet(self.path).where(F.col("kind") == kind).select("key", "kind", "blob")

    def _marks_folder(self):
        return hadoop_path(self.spark, f"{self.path}/kind={MARKS}")

    def marks_bytes(self) -> int:
        p, fs = self._marks_folder()
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0

    def drop_marks(self) -> None:
        """The next level is written and nothing reads these marks again."""
        p, fs = self._marks_folder()
        fs.delete(p, True)


def _doubled(level: _Level, buckets: int, groups: int) -> list[DataFrame]:
    """Notes of the documents of all longer levels: twice the length, four times, until none holds a window.

    A level is dealt to as many buckets and groups as the bytes of the marks that it comes from ask for; the notes
    keep to the document groups of the texts.
    """
    notes, first = [], level
    while not level.rows(DOCS).isEmpty():
        notes.append(level.rows(DOCS))
        size = level.marks_bytes()
        few = _between(size // BUCKET_MARKS, 1, buckets), _between(size // GROUP_MARKS, 1, groups)
        longer = _marks(_next_level(level.rows(MARKS), level.length, *few, HASHED), few[1], HASHED, 2 * level.length, groups)
        before, level = level, _Level(longer, 2 * level.length)
        if before is not first:
            before.drop_marks()
    return notes


def _between(n: int, least: int, most: int) -> int:
    return max(least, min(n, most))


def _own(docs: DataFrame, *more: str) -> DataFrame:
    return docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def _sizes(rows: DataFrame) -> tuple[int, int]:
    """Hash buckets and document groups, from the bytes of the texts: one to four, and one to two, a shuffle partition."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    w = width(rows.sparkSession)
    return _between(size // BUCKET_TEXT, w, 4 * w), _between(size // GROUP_TEXT, w, 2 * w)


def _repeated(rows: DataFrame, length: int, kind, sizes: tuple[int, int], note: int = 0) -> DataFrame:
    """Marks of the repeated windows of ``length`` words, by way of those of half the length, which are written."""
    buckets, groups = sizes
    half = (length + 1) // 2
    first = _Level(_marks(_first_level(rows.select("doc_id", "text"), half, buckets, groups), groups, HASHED), half)
    return _marks(_next_level(first.rows(MARKS), length - half, buckets, groups, kind), groups, kind, note)


def remove_repeats(docs: DataFrame, length: int = 13) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, n_words, n_removed, kept_sha256, longest_repeat)``."""
    rows = _own(docs)
    buckets, groups = sizes = _sizes(rows)
    level = _Level(_repeated(rows, length, HASHED, sizes, length), length)
    marks = _flags(level.rows(MARKS))
    for notes in _doubled(level, buckets, groups):
        marks = marks.union(notes)
    return _apply(marks, _texts(rows, groups), rows.schema, length, False, "", noted=True)


def cleaned(docs: DataFrame, length: int = 13, prefix: str = "") -> DataFrame:
    """All columns of ``docs``, ``text`` without its repeated words and the white space before them, and
    n_words, n_removed, kept_sha256 (the level of ``length`` words decides what goes), with ``prefix`` before
    these names.  A text that loses nothing stays as it is; columns of ``docs`` with these names are replaced."""
    added = [prefix + c for c in ("n_words", "n_removed", "kept_sha256")]
    rows = _own(docs, *(c for c in docs.columns if c not in ("doc_id", "text", *added)))
    sizes = _sizes(rows)
    return _apply(_repeated(rows, length, FLAG, sizes), _texts(rows, sizes[1]), rows.schema, length, True, prefix)
