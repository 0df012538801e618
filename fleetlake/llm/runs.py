"""Periodic runs in texts, from an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q, at least
``max(least, 2 * q)`` long, that no neighbouring word extends with that period.

A task takes documents in units of about ``UNIT_WORDS`` words (a longer one by
itself) and works on all documents of a unit side by side, in numpy:

1. words become numbers by exact comparison, and the suffixes of each document
   are sorted by doubling: classes of equal 2^t words, of which only those with
   several members are sorted again.  The classes of every step are kept; they
   give the LCP of neighbouring suffixes by descending powers of two;
2. every boundary between two neighbours in the suffix array separates, within
   the LCP interval of depth d that it belongs to, the suffixes before it from
   those after it.  For the smaller side it is checked whether the rank (ISA) of
   i + d or i - d lies on the other side: then i starts, or ends, a branching
   square of period d.  No tree is built, and n log n checks are made at most;
3. a branching square ends where its run ends.  Of the squares with one end, the
   shortest is primitive; rotating it to the left as far as words agree gives
   its run, and squares of a multiple of its period inside that run are merged
   into it.  The rest follow in the same way.

Every comparison is of words, none of hashes.  A document is never split.

``collapsed`` is the text's words joined by one space, without those that a run
contains after its first q words.  A null or empty text has no words, no runs and
an empty ``collapsed``.  Null ids and repeated rows are treated like any other
row; further columns are not read, but those named in ``keep`` are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import compress

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import blobs, in_batches

UNIT_WORDS = 1 << 18
#: suffixes checked at a time, and steps that all squares rotate together before each goes on by itself
CHECKS, STEPS = 1 << 21, 16
#: pointer jumps for all boundaries together; the few left are followed one by one
JUMPS = 24

RUN = ArrayType(StructType([StructField(n, LongType()) for n in ("start", "length", "period")]))


def classes(code, end):
    """(suffix array, classes of 2^t words for t = 0, 1, ...) of documents laid end to end.

    ``code``: a number per position, different in different documents; ``end``: where its document ends.
    """
    import numpy as np

    n = len(code)
    order = np.argsort(code, kind="stable")
    key = code[order]
    head = np.maximum.accumulate(np.where(np.diff(key, prepend=key[:1] - 1) != 0, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = head
    levels, h = [rank.astype(np.int32)], 1
    # places in the suffix array whose class has several members
    at = np.flatnonzero(np.bincount(head, minlength=n)[head] > 1)
    while len(at):
        i = order[at]
        j = i + h
        after = np.where(j < end[i], rank[np.minimum(j, n - 1)] + 1, 0)
        key = (rank[i] << 32) | after
        by = np.argsort(key, kind="stable")
        order[at], key = i[by], key[by]
        head = at[np.maximum.accumulate(np.where(np.diff(key, prepend=key[:1] - 1) != 0, np.arange(len(at)), 0))]
        rank[order[at]] = head
        levels.append(rank.astype(np.int32))
        size = np.bincount(np.searchsorted(at, head), minlength=len(at))
        at = at[size[np.searchsorted(at, head)] > 1]
        h *= 2
    return order, levels


def neighbour_lcp(order, levels, end):
    """LCP of each suffix with the one before it in the suffix array; 0 for the first."""
    import numpy as np

    a, b, n = order[:-1], order[1:], len(order)
    got = np.zeros(len(a), np.int64)
    for t in range(len(levels) - 1, -1, -1):
        i, j, c = a + got, b + got, levels[t]
        # a class of 2^t words that two suffixes share lies inside the document
        same = (i < end[a]) & (j < end[b])
        same &= c[np.minimum(i, n - 1)] == c[np.minimum(j, n - 1)]
        got += same.astype(np.int64) << t
    return np.concatenate([np.zeros(1, np.int64), got]) if n else got


def nearest(value):
    """Index of the nearest earlier smaller element, of every element greater than ``value[0]``, the least."""
    import numpy as np

    near = np.maximum(np.arange(len(value)) - 1, 0)
    left = np.flatnonzero(value > value[0])
    for _ in range(JUMPS):
        left = left[value[near[left]] >= value[left]]
        if not len(left):
            return near
        near[left] = near[near[left]]
    found, values = near.tolist(), value.tolist()
    for k in left.tolist():  # in order, so that an earlier one's answer is there when it is needed
        j, v = found[k], values[k]
        while values[j] >= v:
            j = found[j]
        found[k] = j
    return np.array(found)


def branching_squares(order, lcp):
    """(start, period) of every branching square: equal stretches side by side, continued by different words."""
    import numpy as np

    n = len(order)
    if n < 2:
        return np.zeros((2, 0), np.int64)
    isa = np.empty(n, np.int64)
    isa[order] = np.arange(n)
    low = np.concatenate([[0], lcp[1:], [0]])  # at k: between the suffixes k - 1 and k
    k = np.flatnonzero(low > 0)
    first, beyond, depth = nearest(low)[k], n - nearest(low[::-1])[::-1][k], low[k]
    # boundaries of one interval take its suffixes apart from the left: each looks on to the next one only
    by = np.argsort((first << 32) | depth, kind="stable")
    again = np.flatnonzero((np.diff(first[by]) == 0) & (np.diff(depth[by]) == 0))
    beyond[by[again]] = k[by[again + 1]]
    left_less = k - first <= beyond - k
    lo, hi = np.where(left_less, first, k), np.where(left_less, k, beyond)
    other_lo, other_hi = np.where(left_less, k, first), np.where(left_less, beyond, k)
    ends = np.cumsum(hi - lo)
    found, at = [], 0
    while at < len(k):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + CHECKS, side="right")))
        size = (hi - lo)[at:to]
        node = np.repeat(np.arange(at, to), size)
        i = order[np.arange(len(node)) - np.repeat(np.cumsum(size) - size, size) + lo[node]]
        for sign in (1, -1):
            j = i + sign * depth[node]
            ok = np.flatnonzero((j >= 0) & (j < n))
            r, own = isa[j[ok]], node[ok]
            ok = ok[(r >= other_lo[own]) & (r < other_hi[own])]
            found.append((np.minimum(i[ok], j[ok]), depth[node[ok]]))
        at = to
    return np.concatenate([np.stack(f) for f in found], axis=1) if found else np.zeros((2, 0), np.int64)


def rotated(code, begin, start, period):
    """Leftmost starts that the squares reach while the word before agrees with the one a period on."""
    import numpy as np

    start, left = start.copy(), np.arange(len(start))
    for _ in range(STEPS):
        s = start[left] - 1
        left = left[(s >= begin[left]) & (code[np.maximum(s, 0)] == code[np.maximum(s, 0) + period[left]])]
        if not len(left):
            return start
        start[left] -= 1
    for k in left.tolist():  # long runs: stretches of growing length at a time
        s, p, b, size = int(start[k]), int(period[k]), int(begin[k]), 64
        while s > b:
            lo = max(b, s - size)
            differ = np.flatnonzero(code[lo:s] != code[lo + p:s + p])
            if len(differ):
                s = lo + int(differ[-1]) + 1
                break
            s, size = lo, min(2 * size, 1 << 16)
        start[k] = s
    return start


def find_runs(code, begin, end, least: int = 12):
    """(start, length, period) of all runs of at least ``least`` words, by start, then period."""
    import numpy as np

    order, levels = classes(code, end)
    start, period = branching_squares(order, neighbour_lcp(order, levels, end))
    stop = start + 2 * period
    by = np.lexsort((period, stop))
    start, period, stop = start[by], period[by], stop[by]
    runs = []
    while len(start):
        shortest = np.flatnonzero(np.diff(stop, prepend=stop[:1] - 1) != 0)
        s = rotated(code, begin[start[shortest]], start[shortest], period[shortest])
        runs.append((s, stop[shortest] - s, period[shortest]))
        own = np.cumsum(np.diff(stop, prepend=stop[:1] - 1) != 0) - 1
        inside = (period % period[shortest][own] == 0) & (start >= s[own])
        start, period, stop = start[~inside], period[~inside], stop[~inside]
    if not runs:
        return np.zeros((3, 0), np.int64)
    s, length, p = (np.concatenate(x) for x in zip(*runs, strict=True))
    keep = length >= least
    by = np.lexsort((p[keep], s[keep]))
    return np.stack([s[keep][by], length[keep][by], p[keep][by]])


def of_texts(texts: list[bytes], least: int) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(number of words, runs, collapsed text) of each text."""
    import numpy as np

    words = [t.split() for t in texts]
    size = np.array([len(w) for w in words], np.int64)
    stop = np.cumsum(size)
    begin = stop - size
    numbers: dict[bytes, int] = {}
    number = np.array([numbers.setdefault(w, len(numbers)) for own in words for w in own], np.int64)
    doc = np.repeat(np.arange(len(texts)), size)
    # different documents share no class, so no suffix is compared with another document's
    found = find_runs(doc * (len(numbers) + 1) + number, begin[doc], stop[doc], least) if len(doc) else np.zeros((3, 0), np.int64)
    s, length, p = found
    cover = np.zeros(len(doc) + 1, np.int64)
    np.add.at(cover, s + p, 1)
    np.add.at(cover, s + length, -1)
    kept = (np.cumsum(cover)[:len(doc)] == 0)
    cut = np.searchsorted(s, np.append(begin, len(doc)))
    out = []
    for d, own in enumerate(words):
        lo, hi = cut[d], cut[d + 1]
        if lo == hi:
            out.append((len(own), [], b" ".join(own)))
            continue
        runs = list(zip((s[lo:hi] - begin[d]).tolist(), length[lo:hi].tolist(), p[lo:hi].tolist(), strict=True))
        out.append((len(own), runs, b" ".join(compress(own, kept[begin[d]:stop[d]].tolist()))))
    return out


def periodic_runs(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), least: int = 12) -> DataFrame:
    """Every row of ``docs`` -> ``keep``, ``n_words``, ``runs`` (array of start, length, period) and ``collapsed``."""
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("t"), *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)])
    schema = StructType([*rows.schema.fields[1:], StructField("n_words", LongType()), StructField("runs", RUN),
                         StructField("collapsed", StringType())])

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN.elementType.fields]))
        names = [f.name for f in RUN.elementType.fields]

        def done(part, texts):
            found = of_texts(texts, least)
            return pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.array([f[0] for f in found], pa.int64()),
                 pa.array([[dict(zip(names, r, strict=True)) for r in f[1]] for f in found], kind),
                 pa.array([f[2].decode() for f in found], pa.string())], schema.names)

        for batch in batches:
            texts = [t or b"" for t in blobs(batch.column(0))]
            lo, held = 0, 0
            for i, t in enumerate(texts):
                held += len(t) // 6 + 1
                if held >= UNIT_WORDS:
                    yield done(batch.slice(lo, i + 1 - lo), texts[lo:i + 1])
                    lo, held = i + 1, 0
            if lo < len(texts):
                yield done(batch.slice(lo), texts[lo:])

    out = rows.transform(in_batches, run, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "n_words", "runs", "collapsed")
