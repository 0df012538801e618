"""Dimension-file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_delimited(spark: SparkSession, path: str, *, sep: str = ",") -> DataFrame:
    """Header CSV with every column as string.

    A real CSV reader replaces split-on-comma: quoted commas and doubled
    quotes survive, and the header row is the first line, not the greatest
    string.
    """
    return (spark.read.option("header", True).option("sep", sep)
            .option("quote", '"').option("escape", '"')
            .option("inferSchema", False).option("mode", "PERMISSIVE").csv(path))


def read_csv_typed(spark: SparkSession, path: str, schema: StructType, *,
                   corrupt_col: str = "_corrupt_record") -> DataFrame:
    """Header CSV with an explicit schema; malformed lines land in ``corrupt_col``."""
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", False).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt_col)
            .schema(schema).csv(path))
