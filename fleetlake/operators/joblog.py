"""Incremental-load log.

The log is a small refreshed table ``(schema_name, table_name, max_timestamp,
rundate, insert_dt)``.  ``max_timestamp`` stores the newest
``insert_time`` of the data a run *read*, not the wall clock, so rows landing
between read and log are picked up next time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.schemas import JOB_LOG_SCHEMA

# Fixed value: the low default when a table has never been loaded.
DEFAULT_LOW = _dt.datetime(1900, 1, 1)


def normalize_rundate(rundate: str | _dt.date | None) -> _dt.date:
    """``YYYY-MM-DD`` or ``YYYYMMDD`` (scheduler ``ds_nodash``) -> date; None -> 1900-01-01 (C4)."""
    if rundate is None:
        return DEFAULT_LOW.date()
    if isinstance(rundate, _dt.date):
        return rundate
    s = str(rundate).strip()
    return _dt.datetime.strptime(s, "%Y%m%d" if len(s) == 8 and s.isdigit() else "%Y-%m-%d").date()


def log_row(spark: SparkSession, schema_name: str, table_name: str, max_timestamp: _dt.datetime | None,
            rundate: str | _dt.date | None, now: _dt.datetime) -> DataFrame:
    """One log row as a DataFrame with the fixed schema."""
    return spark.createDataFrame(
        [(schema_name, table_name, max_timestamp, normalize_rundate(rundate).isoformat(), now)], JOB_LOG_SCHEMA)


def last_loaded(job_log: DataFrame) -> DataFrame:
    """Newest logged ``max_timestamp`` per (schema, table)."""
    return job_log.groupBy("schema_name", "table_name").agg(F.max("max_timestamp").alias("max_timestamp"))


def last_loaded_value(job_log: DataFrame, schema_name: str, table_name: str,
                      default: _dt.datetime = DEFAULT_LOW) -> _dt.datetime:
    """Scalar form of ``last_loaded`` for one table (C2): a one-row aggregate, errors propagate."""
    row = (job_log.filter((F.col("schema_name") == schema_name) & (F.col("table_name") == table_name))
           .agg(F.max("max_timestamp").alias("m")).first())
    return row["m"] if row and row["m"] is not None else default


def latest_job_log(job_log: DataFrame) -> DataFrame:
    """The newest log row (by ``insert_dt``) of each table (T5)."""
    cols = job_log.columns
    return (job_log.groupBy("schema_name", "table_name")
            .agg(F.max_by(F.struct(*cols), F.col("insert_dt")).alias("r")).select("r.*"))


def delete_job_log(job_log: DataFrame, schema_name: str, table_name: str) -> DataFrame:
    """The log without the rows of one table (K9); ``chains.delete_logged`` publishes it."""
    hit = (F.col("schema_name") == schema_name) & (F.col("table_name") == table_name)
    return job_log.filter(~F.coalesce(hit, F.lit(False)))


def truncate_job_log(job_log: DataFrame) -> DataFrame:
    """An empty log with the same schema."""
    return job_log.limit(0)
