"""Embedding whitening from exact cross-products, by bit-sliced scatter.

A vector's entry c becomes the whole number ``floor(scale * c) + offset``.

1. A task lays blocks of ``ROWS`` vectors out as bit planes: the entries of a
   dimension, less the block's least one, give one plane per bit, a bit a row,
   packed into 64-bit words.  The cross-product of two dimensions is the sum of
   ``2**(a + b) * popcount(plane_a & plane_b)`` over their planes, and the
   block's shift is undone in whole numbers.  Tasks send one row per pair of
   dimensions, which Spark adds up as decimals: the totals are exact.
2. The covariance is ``(n * sum(x_j * x_k) - S_j * S_k) / n**2``, centred in whole
   numbers and rounded once.  ``eigh`` of that matrix runs on the driver; it holds
   dimensions squared numbers, however many rows there are.
3. Every row is projected on the first components and divided by the root of
   their eigenvalues, and written once; the covariance of what was written is
   then measured, in two passes (means, then centred products).

Rows whose vector is null, empty, or holds null or non-finite entries are left out,
and so are those with an entry beyond ``2**52 / scale``, whose whole number would
not fit, and those that are not of the commonest length (the greater of two
equally common ones).  Null and repeated ids stay, each row by itself; further
columns are ignored.  A component without spread (eigenvalue zero up to rounding,
as with fewer rows than dimensions) has null ``whitened`` and takes no part in
``identity_error``, which is null if none has spread.  ``deviation`` is null where
it exceeds a long.  No row left: an empty result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, written

#: vectors that become bit planes at a time
ROWS = 8192
LIMIT = 1 << 52
PAIR = "j int, k int, total decimal(38,0)"


def whole_numbers(column, dims: int, scale: int, offset: int):
    """(rows taken part, their entries as an int64 matrix) of an Arrow list column."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), dims), False).to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(at)).flatten()
    values = pc.cast(flat, pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), dims)
    # a product beyond the limit is as good as infinite; null entries are NaN here
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = values * float(scale)
        fits = (np.abs(scaled) < LIMIT).all(axis=1)
    return at[fits], np.floor(scaled[fits]).astype(np.int64) + offset


def scatter(x):
    """Exact ``x.T @ x`` of an int64 matrix as an array of Python ints, through bit planes."""
    import numpy as np

    rows, dims = x.shape
    least = x.min(axis=0)
    u = (x - least).astype(np.uint64)
    bits = max(1, int(u.max()).bit_length())
    planes = np.zeros((dims, bits, -(-rows // 64) * 8), np.uint8)
    for b in range(bits):
        packed = np.packbits(((u >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=0)
        planes[:, b, :packed.shape[0]] = packed.T
    planes = planes.reshape(dims * bits, -1).view(np.uint64)
    counts = np.zeros((dims * bits, dims * bits), np.int64)
    for p in range(dims * bits):
        counts[p, p:] = np.bitwise_count(planes[p] & planes[p:]).sum(axis=1, dtype=np.int64)
    counts = np.triu(counts) + np.triu(counts, 1).T
    # 2**(a + b) times a count, over bits**2 pairs of planes, stays under rows * 4**bits
    kind = np.int64 if 2 * bits + rows.bit_length() < 62 else object
    weight = np.array([1 << b for b in range(bits)], dtype=kind)
    counts = counts.astype(kind).reshape(dims, bits, dims, bits)
    shifted = (counts * weight[None, :, None, None] * weight[None, None, None, :]).sum(axis=(1, 3)).astype(object)
    least, sums = least.astype(object), u.astype(object).sum(axis=0)
    return shifted + np.outer(least, sums) + np.outer(sums, least) + rows * np.outer(least, least)


def cross_products(vectors: DataFrame, dims: int, scale: int, offset: int) -> DataFrame:
    """``vectors(vector)`` -> ``(j, k, total)``, j <= k: cross-products; k = -1: sums; j = k = -1: the number of rows."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total, sums, n, waiting, held = None, None, 0, [], 0

        def add():
            nonlocal total, sums, n, waiting, held
            x = np.concatenate(waiting)
            own, s = scatter(x), x.astype(object).sum(axis=0)
            total, sums = (own, s) if total is None else (total + own, sums + s)
            n, waiting, held = n + len(x), [], 0

        for batch in batches:
            x = whole_numbers(batch.column(0), dims, scale, offset)[1]
            for lo in range(0, len(x), ROWS):
                waiting.append(x[lo:lo + ROWS])
                held += len(waiting[-1])
                if held >= ROWS:
                    add()
        if held:
            add()
        if not n:
            return
        rows = [(-1, -1, n), *((j, -1, int(sums[j])) for j in range(dims)),
                *((j, k, int(total[j, k])) for j in range(dims) for k in range(j, dims))]
        for lo in range(0, len(rows), 10_000):
            j, k, v = zip(*rows[lo:lo + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(j, pa.int32()), pa.array(k, pa.int32()), pa.array([Decimal(t) for t in v], pa.decimal128(38, 0))],
                ["j", "k", "total"])

    return vectors.mapInArrow(run, PAIR).groupBy("j", "k").agg(F.sum("total").cast("decimal(38,0)").alias("total"))


class Whitening:
    """n, the sums, the components (rows, by falling eigenvalue), their eigenvalues and the trace."""

    def __init__(self, n: int, sums: list[int], scatter: dict, scale: int, offset: int, components: int):
        import numpy as np

        d = len(sums)
        self.n, self.sums, self.scale, self.offset = n, sums, scale, offset
        v = np.empty((d, d))
        for j in range(d):
            for k in range(j, d):
                # whole numbers over whole numbers: one rounding
                v[j, k] = v[k, j] = (n * scatter[j, k] - sums[j] * sums[k]) / (n * n)
        value, vector = np.linalg.eigh(v)
        order = np.argsort(-value, kind="stable")[:components]
        self.value, self.vector = value[order], vector[:, order].T
        # either sign is right; the greatest entry is made positive
        sign = np.sign(self.vector[np.arange(len(order)), np.abs(self.vector).argmax(axis=1)])
        self.vector = self.vector * sign[:, None]
        self.trace = float(np.trace(v))
        self.spread = self.value > max(self.trace, 0.0) * d * np.finfo(float).eps

    def project(self, x):
        """(deviations as Python ints or an int64 array, whitened components with NaN for those without spread)."""
        import numpy as np

        s = np.array(self.sums, dtype=object)
        # n times an entry, and the difference, must fit in 63 bits to stay in int64
        widest = int(np.abs(x).max(initial=0))
        fits = self.n * widest + max(abs(t) for t in self.sums) < 1 << 62
        centred = self.n * x - s.astype(np.int64) if fits else self.n * x.astype(object) - s
        top = int(np.abs(centred).max(initial=0))
        exact = centred if fits and top * top * len(self.sums) < 1 << 62 else centred.astype(object)
        deviation = (exact * exact).sum(axis=1)
        w = (centred.astype(float) / self.n) @ self.vector.T
        with np.errstate(divide="ignore", invalid="ignore"):
            w = np.where(self.spread, w / np.sqrt(np.where(self.spread, self.value, 1.0)), np.nan)
        return deviation, w


def dimensions(vectors: DataFrame) -> int:
    """The commonest length of the vectors, the greater of two equally common ones; 0 without vectors."""
    row = (vectors.where(F.size("vector") > 0).groupBy(F.size("vector").alias("d")).count()
           .orderBy(F.col("count").desc(), F.col("d").desc()).first())
    return row["d"] if row else 0


def fit(vectors: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100_000) -> Whitening | None:
    """``vectors(vector)`` -> the model, or None without a usable row."""
    d = dimensions(vectors)
    found = {(r["j"], r["k"]): int(r["total"]) for r in cross_products(vectors, d, scale, offset).collect()} if d else {}
    if not found:
        return None
    return Whitening(found[-1, -1], [found[j, -1] for j in range(d)], found, scale, offset, components)


def projected(rows: DataFrame, model: Whitening) -> DataFrame:
    """``rows(id, vector)`` -> ``(id, deviation, whitened array)`` of those that take part."""
    dims = len(model.sums)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            at, x = whole_numbers(batch.column(1), dims, model.scale, model.offset)
            deviation, w = model.project(x)
            top = (1 << 63) - 1
            parts = [[None if np.isnan(v) else v for v in row] for row in w.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array([int(t) if t <= top else None for t in deviation.tolist()], pa.int64()),
                 pa.array(parts, pa.list_(pa.float64()))], ["id", "deviation", "w"])

    return rows.transform(in_batches, run, "id long, deviation long, w array<double>")


def identity_error(done: DataFrame, spread: list[int]) -> float | None:
    """Largest absolute entry of the covariance of the columns ``spread`` of ``w``, minus the identity."""
    if not spread:
        return None
    w = [F.get("w", c) for c in spread]
    mean = done.agg(*[F.avg(c) for c in w]).first()
    pairs = [(a, b) for a in range(len(w)) for b in range(a, len(w))]
    cov = done.agg(*[F.avg((w[a] - mean[a]) * (w[b] - mean[b])) for a, b in pairs]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(cov, pairs, strict=True))


OUT = ("id long, component int, n long, deviation long, whitened double, eigenvalue double, explained double, identity_error double")


def whitened(rows: DataFrame, id_column: str, vector_column: str, components: int = 8, scale: int = 1024,
             offset: int = 100_000) -> DataFrame:
    """``rows`` -> a row per vector that takes part and component (from 1): ``(id, component, n, deviation,
    whitened, eigenvalue, explained, identity_error)``."""
    own = rows.select(F.col(f"`{id_column}`").cast("long").alias("id"),
                      F.col(f"`{vector_column}`").cast("array<double>").alias("vector"))
    model = fit(own.select("vector"), components, scale, offset)
    if model is None:
        return rows.sparkSession.createDataFrame([], OUT)
    done = written(projected(own, model), "whitened")
    error = identity_error(done, [i for i, s in enumerate(model.spread) if s])
    per = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.lit(float(e)).alias("eigenvalue"),
                             F.lit(float(e) / model.trace if model.trace > 0 else None).cast("double").alias("explained"))
                    for i, e in enumerate(model.value)])
    return (done.select("id", "deviation", F.explode(F.arrays_zip(F.col("w"), per.alias("per"))).alias("c"))
            .select("id", F.col("c.per.component").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                    F.col("c.w").alias("whitened"), F.col("c.per.eigenvalue").alias("eigenvalue"),
                    F.col("c.per.explained").alias("explained"), F.lit(error).cast("double").alias("identity_error")))
