"""Sinks and table lifecycle.

Tables are Parquet directories under a root (the cluster's shared folder).
A *refreshed* table is written as a new ``snapshot=<n>`` partition and a
one-row entry in its ``_snapshots`` manifest; readers take the newest
manifest entry, so a rebuild never overwrites the files it is reading and a
half-written snapshot is never visible.  A table kept *in parts* does the same
per part (a hash bucket, a day, an hour): a load rewrites the parts it touches.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from fleetlake.session import hadoop_path


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _exists(self, p: str) -> bool:
        """Asked of the path's own file system; an error is an error, not a missing table."""
        path, fs = hadoop_path(self.spark, p)
        return fs.exists(path)

    def exists(self, name: str) -> bool:
        return self._exists(self.path(name))

    # ------------------------------------------------------------ snapshot tables
    def _manifest(self, name: str) -> str:
        return f"{self.path(name)}/_snapshots"

    def current_snapshot(self, name: str) -> int | None:
        if not self._exists(self._manifest(name)):
            return None
        row = self.spark.read.parquet(self._manifest(name)).agg(F.max("snapshot").alias("m")).first()
        return row["m"]

    def read(self, name: str) -> DataFrame:
        """The newest complete snapshot of a refreshed table, or an append table as a whole."""
        snap = self.current_snapshot(name)
        if snap is None:
            return self.spark.read.parquet(self.path(name))
        # partition filter on a literal: only that snapshot's directory is listed and read
        return (self.spark.read.option("basePath", self.path(name)).parquet(f"{self.path(name)}/snapshot={snap}")
                .drop("snapshot"))

    def write_refresh(self, name: str, df: DataFrame, audit=None) -> int:
        """Full refresh without drop-first (K5): write, audit, publish.

        The snapshot's files are written once; ``audit(written_df)`` (e.g. DQ
        rules) then runs on those files instead of recomputing ``df``, and
        only if it passes is the manifest entry appended that makes the
        snapshot visible.  A failed audit leaves the previous snapshot current.
        """
        prev = self.current_snapshot(name)
        snap = 0 if prev is None else prev + 1
        path = f"{self.path(name)}/snapshot={snap}"
        df.write.mode("overwrite").parquet(path)
        if audit is not None:
            audit(self.spark.read.parquet(path))
        (self.spark.range(1).select(F.lit(snap).cast("bigint").alias("snapshot"),
                                    F.current_timestamp().alias("committed_at"))
         .write.mode("append").parquet(self._manifest(name)))
        return snap

    def vacuum(self, name: str, keep: int = 3) -> list[int]:
        """Remove the snapshots of a refreshed table older than its newest ``keep``; returns their numbers.

        A reader that opened one of the kept snapshots is not disturbed.  Also
        removes what a failed write left behind below the newest snapshot.
        """
        current = self.current_snapshot(name)
        if current is None:
            return []
        root, fs = hadoop_path(self.spark, self.path(name))
        found = [s.getPath() for s in fs.listStatus(root)]
        numbered = {int(p.getName().split("=")[1]): p for p in found if p.getName().startswith("snapshot=")}
        old = sorted(n for n in numbered if n <= current - keep)
        for n in old:
            fs.delete(numbered[n], True)
        return old

    # ------------------------------------------------------------ tables replaced part by part
    def _parts(self, name: str) -> str:
        return f"{self.path(name)}/_parts"

    def parts(self, name: str) -> dict[str, tuple[int, int]]:
        """Current ``{part: (load, rows)}`` of a table kept in parts; one entry a part, however long the history."""
        if not self._exists(self._parts(name)):
            return {}
        newest = (self.spark.read.parquet(self._parts(name)).groupBy("part")
                  .agg(F.max(F.struct("load", "rows")).alias("now")).select("part", "now.*"))
        return {r["part"]: (r["load"], r["rows"]) for r in newest.collect()}

    def read_parts(self, name: str, only: Iterable[str] | None = None) -> DataFrame | None:
        """The current rows of all parts, or of ``only`` these; NULL if none of them was ever written.

        Only the directories of the wanted parts are listed and read.
        """
        current = self.parts(name)
        wanted = current if only is None else {p: current[p] for p in only if p in current}
        paths = [f"{self.path(name)}/load={load}/part={part}" for part, (load, rows) in sorted(wanted.items()) if rows]
        if paths:
            schema = self.spark.read.parquet(paths[0]).schema
            return self.spark.read.schema(schema).parquet(*paths)
        if not current:
            return None
        first, (load, _) = max(current.items(), key=lambda x: x[1][1])
        return self.spark.read.parquet(f"{self.path(name)}/load={load}/part={first}").limit(0)

    def replace_parts(self, name: str, df: DataFrame, part, touched: Iterable[str] = ()) -> list[str]:
        """Write the rows of ``df`` as the new contents of their parts (column ``part``, as a string).

        The files go to a new ``load=<n>`` directory; one manifest row per part,
        appended when all of them are written, makes them current.  Other
        parts are neither read nor written, a reader sees the old parts until
        then, and a failed load leaves them as they were.  Parts of ``touched``
        that ``df`` has no row of become empty.  Returns the parts replaced.
        """
        current = self.parts(name)
        load = 1 + max((n for n, _ in current.values()), default=0)
        path = f"{self.path(name)}/load={load}"
        # rebalanced: a small part is one file, a large one as many as its bytes ask for
        (df.withColumn("part", F.coalesce(part.cast("string"), F.lit("none"))).hint("rebalance", "part")
         .write.mode("overwrite").partitionBy("part").parquet(path))
        # counted from the file footers: no column is read
        counts = self.spark.read.schema("part string").parquet(path).groupBy("part").count()
        written = {r["part"]: r["count"] for r in counts.collect()}
        rows = {**{str(p): 0 for p in touched}, **written}
        if rows:
            entries = [(p, load, n) for p, n in sorted(rows.items())]
            (self.spark.createDataFrame(entries, "part string, load long, rows long")
             .withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self._parts(name)))
        return sorted(rows)

    # ------------------------------------------------------------ append tables
    def write_append(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        """Plain append (K4)."""
        w = df.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(name))


def observed_write(df: DataFrame, write, name: str = "write", **metrics) -> dict:
    """Run ``write(df_observed)`` and return its counters and elapsed ms.

    Counters ride along the write via ``DataFrame.observe``: no second scan,
    unlike counting the table after writing it.  ``metrics`` adds named
    aggregate columns (e.g. ``rows_updated=F.count_if(...)``).
    """
    import time

    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows_written"), *[e.alias(k) for k, e in metrics.items()]]
    t0 = time.time()
    write(df.observe(obs, *exprs))
    out = {k: (v if v is not None else 0) for k, v in obs.get.items()}
    out["execution_ms"] = int((time.time() - t0) * 1000)
    return out


def init_tables(store: TableStore, reset: bool = False) -> list[str]:
    """Create the job log and both dimensions as empty typed tables (K8).

    Existing tables are left alone unless ``reset``; a reset writes an empty
    new snapshot, never drop-then-create.
    Returns the names created or reset.
    """
    from fleetlake.schemas import DIM_ROUTES_SCHEMA, DIM_STOPS_SCHEMA, JOB_LOG_SCHEMA

    done = []
    for name, schema in (("job_control", JOB_LOG_SCHEMA), ("dim_routes", DIM_ROUTES_SCHEMA), ("dim_stops", DIM_STOPS_SCHEMA)):
        if store.exists(name) and not reset:
            continue
        store.write_refresh(name, store.spark.createDataFrame([], schema))
        done.append(name)
    return done
