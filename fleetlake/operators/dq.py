"""Data-quality rules (D1-D6) evaluated in as few passes as possible.

``dq_report`` returns a DataFrame ``(table_name, rule, target, violations,
detail, passed)``; ``detail`` names missing columns.  All column rules share one aggregate pass; each key rule costs
one shuffle on its key.  ``dq_enforce`` raises ``ValueError("QC FAILED: ...")``
like the reference's checks, after collecting only the small report.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@dataclass(frozen=True)
class Rule:
    kind: str                      # not_empty | columns_exist | no_nulls | no_duplicates | values_in_set | active_unique
    column: str | None = None
    columns: tuple[str, ...] = ()
    values: tuple = field(default_factory=tuple)

    @property
    def target(self) -> str:
        return self.column or ",".join(self.columns)


def not_empty() -> Rule:
    return Rule("not_empty")


def columns_exist(columns: Sequence[str]) -> Rule:
    return Rule("columns_exist", columns=tuple(columns))


def no_nulls(column: str) -> Rule:
    """NULL, or the empty string for string columns, is a violation (D3)."""
    return Rule("no_nulls", column=column)


def no_duplicates(keys: Sequence[str]) -> Rule:
    """Keys held by more than one row; NULL keys group together."""
    return Rule("no_duplicates", columns=tuple(keys))


def values_in_set(column: str, values: Sequence) -> Rule:
    """Values outside the set; NULL passes, as ``NOT (NULL IN (...))`` is unknown."""
    return Rule("values_in_set", column=column, values=tuple(values))


def active_unique(keys: Sequence[str]) -> Rule:
    """Keys with more than one ``active_flg = 1`` row."""
    return Rule("active_unique", columns=tuple(keys))


def _dup_keys(df: DataFrame, keys: Sequence[str]):
    return df.groupBy(*keys).count().agg(F.count_if(F.col("count") > 1).alias("v"))


def dq_report(df: DataFrame, rules: Sequence[Rule], table_name: str = "") -> DataFrame:
    spark = df.sparkSession
    types = dict((f.name, f.dataType) for f in df.schema.fields)

    def row(r: Rule, v, detail: str = "") -> list:
        return [F.lit(table_name).alias("table_name"), F.lit(r.kind).alias("rule"), F.lit(r.target).alias("target"),
                v.cast("bigint").alias("violations"), F.lit(detail).alias("detail")]

    col_aggs, parts = [], []
    for i, r in enumerate(rules):
        needed = [*([r.column] if r.column else []), *r.columns, *(["active_flg"] if r.kind == "active_unique" else [])]
        missing = [c for c in needed if c not in df.columns]
        if missing:  # named for every rule that needs them, so one lost column never hides the others
            parts.append(spark.range(1).select(*row(r, F.lit(len(missing)), "missing: " + ", ".join(missing))))
        elif r.kind == "not_empty":
            col_aggs.append((i, r, F.count(F.lit(1)) == 0))
        elif r.kind == "no_nulls":
            bad = F.col(r.column).isNull()
            if isinstance(types.get(r.column), StringType):
                bad = bad | (F.col(r.column) == "")
            col_aggs.append((i, r, F.count_if(bad)))
        elif r.kind == "values_in_set":
            col_aggs.append((i, r, F.count_if(~F.col(r.column).isin(list(r.values)))))
        elif r.kind == "columns_exist":
            parts.append(spark.range(1).select(*row(r, F.lit(0))))
        elif r.kind == "no_duplicates":
            parts.append(_dup_keys(df, r.columns).select(*row(r, F.col("v"))))
        elif r.kind == "active_unique":
            parts.append(_dup_keys(df.filter(F.col("active_flg") == 1), r.columns).select(*row(r, F.col("v"))))
        else:
            raise ValueError(f"unknown rule {r.kind}")
    if col_aggs:
        # one scan computes every column rule; the single result row is then unpacked
        one = df.agg(*[a.cast("bigint").alias(f"r{i}") for i, _, a in col_aggs])
        parts.append(one.select(F.explode(F.array(*[F.struct(*row(r, F.col(f"r{i}"))) for i, r, _ in col_aggs]))
                                .alias("x")).select("x.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("violations") == 0)


def dq_enforce(report: DataFrame) -> None:
    """Raise on the first failed rule; the report has one row per rule."""
    failed = report.filter(~F.col("passed")).orderBy("rule", "target").collect()
    if failed:
        f = failed[0]
        raise ValueError(f"QC FAILED: {f['table_name']} {f['rule']} on {f['target']}: {f['violations']} violations"
                         + (f" ({f['detail']})" if f["detail"] else ""))


def check(df: DataFrame, rules: Sequence[Rule], table_name: str) -> None:
    dq_enforce(dq_report(df, rules, table_name))


# ---------------------------------------------------------------- rules judged inside the write
#: rules that a row breaks by itself, and rules on keys
ROW_RULES, KEY_RULES = ("no_nulls", "values_in_set"), ("no_duplicates", "active_unique")


def broken_by_row(df: DataFrame, rules: Sequence[Rule]):
    """``{rule: condition}`` of the rules that a single row can break."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    out = {}
    for r in rules:
        if r.kind in ROW_RULES and r.column in df.columns:
            c = F.col(r.column)
            bad = ~c.isin(list(r.values)) if r.kind == "values_in_set" else c.isNull() | (c == "") if r.column in text else c.isNull()
            out[r] = F.coalesce(bad, F.lit(False))
    return out


def violations(df: DataFrame, rules: Sequence[Rule]):
    """The names of the rules that a row breaks, as an array (``kind:column``)."""
    bad = [F.when(c, F.lit(f"{r.kind}:{r.target}")) for r, c in broken_by_row(df, rules).items()]
    return F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")


def write_checked(store, name: str, df: DataFrame, rules: Sequence[Rule], load: str) -> DataFrame:
    """Write a load of ``name``, rows that break a rule apart from the others, and return its ``dq_report``, all
    from one pass over ``df`` (D1-D6).

    One write deals the rows by ``quarantined``; the counters of all row rules
    ride on it (``observe``).  Key rules then read the key columns of the
    written rows, good and bad, aggregated to (key, count).  ``load`` names the
    write's directory, so writing the same load again replaces it.
    """
    from pyspark.sql.observation import Observation

    bad, seen = broken_by_row(df, rules), Observation(f"dq-{name}-{load}")
    counters = [F.count_if(c).alias(f"r{i}") for i, c in enumerate(bad.values())]
    path = f"{store.path(name + '_checked')}/load={load}"
    marked = df.withColumn("violations", violations(df, rules)).withColumn("quarantined", F.size("violations") > 0)
    marked.observe(seen, F.count(F.lit(1)).alias("n"), *counters).write.mode("overwrite").partitionBy("quarantined").parquet(path)
    found = seen.get
    written = df.sparkSession.read.schema(marked.schema).parquet(path)
    counted = {r: found[f"r{i}"] for i, r in enumerate(bad)}
    rest = [r for r in rules if r not in counted and r.kind != "not_empty"]
    report = dq_report(written, rest, name) if rest else None
    known = [(name, r.kind, r.target, int(v), "") for r, v in counted.items()]
    known += [(name, r.kind, r.target, int(found["n"] == 0), "") for r in rules if r.kind == "not_empty"]
    own = df.sparkSession.createDataFrame(
        known, "table_name string, rule string, target string, violations long, detail string").withColumn("passed", F.col("violations") == 0)
    return own if report is None else own.unionByName(report)


def checked_rows(store, name: str, load: str, quarantined: bool = False) -> DataFrame:
    """The good rows of a load written by ``write_checked``, or the quarantined ones with their ``violations``."""
    rows = store.spark.read.parquet(f"{store.path(name + '_checked')}/load={load}").filter(F.col("quarantined") == quarantined)
    return rows.drop("quarantined") if quarantined else rows.drop("quarantined", "violations")
