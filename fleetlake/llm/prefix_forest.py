"""Approximate nearest neighbours by cosine: a forest of sorted hash strings with prefix search.

Each tree gives every vector a string of ``bits`` signs of random projections and
keeps the strings sorted, so the vectors that share a prefix with a query stand
side by side.  A query descends in every tree to its longest matching prefix, then
all trees ascend together, one bit at a time, until the matches of all trees hold
``max(least, fraction * rows)`` vectors.  These candidates are scored exactly, in
double precision on the original vectors.

In Spark the index is cut into shards of about ``shard_rows`` vectors by hash,
every vector indexed; a shard's forest is built in the task that holds the
shard, and the query set is sent to all shards.  A shard returns its best k of
each query; the best k over all shards are the answer.

Equal vectors are indexed once, with the ``k + 1`` smallest ids among them: a
query can use no more, as ties go to the smaller id.  So a vector that a
third of all rows repeat is one entry.

``fraction`` sets recall against work.  On isotropic 64-dimensional vectors, where
the nearest neighbours are hardly nearer than the rest, 0.4 gives a recall of about
0.95; clustered vectors need far less.

Vectors that are null, zero, or hold null or non-finite components take no part.
Vectors of another dimension than the query's are no candidates.  Rows that
repeat an id and its vector count once; null ids are left out.  An empty table
gives no rows.  Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_batches, written


class Forest:
    """Sorted strings of every tree over the rows of a matrix."""

    def __init__(self, vectors: np.ndarray, trees: int, bits: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.bits, self.vectors = bits, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.planes = [rng.normal(size=(vectors.shape[1], bits)) for _ in range(trees)]
        self.powers = 1 << np.arange(bits - 1, -1, -1)
        strings = [self._strings(vectors, p) for p in self.planes]
        self.order = [np.argsort(s, kind="stable") for s in strings]
        self.sorted = [s[o] for s, o in zip(strings, self.order, strict=True)]

    def _strings(self, x: np.ndarray, planes: np.ndarray) -> np.ndarray:
        return (x @ planes > 0) @ self.powers

    def search(self, queries: np.ndarray, wanted: int) -> list[np.ndarray]:
        """For each query, at least ``wanted`` rows (all, if fewer), by prefix."""
        own = [self._strings(queries, p) for p in self.planes]
        drop = np.arange(self.bits + 1)
        low = np.array([np.searchsorted(s, (q[:, None] >> drop) << drop) for s, q in zip(self.sorted, own, strict=True)])
        high = np.array([np.searchsorted(s, ((q[:, None] >> drop) + 1) << drop)
                         for s, q in zip(self.sorted, own, strict=True)])
        matches = (high - low).sum(axis=0)
        wanted, out = min(wanted, len(self.vectors)), []
        for i in range(len(queries)):
            found = np.zeros(len(self.vectors), bool)
            d = int(np.argmax(matches[i] >= wanted))  # with fewer matches even all trees together are too few
            while True:
                for t, order in enumerate(self.order):
                    found[order[low[t, i, d]:high[t, i, d]]] = True
                if d == self.bits or np.count_nonzero(found) >= wanted:
                    break
                d += 1
            out.append(np.flatnonzero(found))
        return out

    def nearest(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Cosine of ``query`` and each of ``rows``; equal vectors get equal scores."""
        dots = (self.vectors[rows] * query).sum(axis=1)
        return dots / (self.norms[rows] * np.sqrt((query * query).sum()))


def sound(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, v)`` of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(F.col(key).isNotNull() & fine & F.exists(v, lambda x: x != 0))
            .select(F.col(key).cast("long").alias("id"), v.alias("v")))


def neighbours(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
               trees: int = 48, bits: int = 24, fraction: float = 0.4, least: int = 64,
               shard_rows: int = 4096) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: up to ``k`` nearest rows of each query (rows where ``is_query``)."""
    own = sound(vectors, key, vector).withColumn("h", F.xxhash64("v"))
    alike = Window.partitionBy("h", "v").orderBy("id")
    firsts = (own.dropDuplicates(["id", "h", "v"]).withColumn("n", F.row_number().over(alike)).where(F.col("n") <= k + 1))
    index = written(firsts.groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "forest")
    shards = max(1, -(-index.count() // shard_rows))
    members = index.select(F.pmod("h", F.lit(shards)).cast("int").alias("shard"), F.size("v").alias("dim"),
                           F.lit(0).alias("kind"), "ids", "v")
    asked = sound(vectors.where(is_query), key, vector).dropDuplicates(["id", "v"]).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.size("v").alias("dim"),
        F.lit(1).alias("kind"), F.array("id").alias("ids"), "v")

    def run(batches):
        import pyarrow as pa

        place, ids, rows, forest, waiting = None, [], [], None, []

        def answers():
            queries = np.array([v for _, v in waiting])
            wanted = max(least, int(np.ceil(fraction * len(ids))))
            out = []
            for (q, _), x, near in zip(waiting, queries, forest.search(queries, wanted), strict=True):
                score = forest.nearest(x, near)
                keep = np.lexsort((near, -score))
                cut = score[keep[min(k, len(keep) - 1)]]  # k + 1 distinct vectors hold k other rows, ties besides
                best = sorted((-s, i) for s, r in zip(score[score >= cut], near[score >= cut], strict=True)
                              for i in ids[r] if i != q)[:k]
                out += [(q, i, -s) for s, i in best]
            waiting.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)],
                                                 ["query_id", "vec_id", "score"])

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for shard, dim, kind, own_ids, v in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True):
                    if (shard, dim) != place:
                        if waiting:
                            yield from answers()
                        place, ids, rows, forest = (shard, dim), [], [], None
                    if kind == 0:
                        ids.append(own_ids)
                        rows.append(v)
                    elif ids:
                        forest = forest or Forest(np.array(rows), trees, bits)
                        waiting.append((own_ids[0], v))
                        if len(waiting) >= 64:
                            yield from answers()
        if waiting:
            yield from answers()

    found = (members.union(asked).repartition("shard", "dim").sortWithinPartitions("shard", "dim", "kind")
             .transform(in_batches, run, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
