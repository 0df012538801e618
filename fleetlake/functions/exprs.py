"""Scalar helpers: ANSI-safe casts, UTC timestamps, keys, change tests.

Spark 4 runs with ANSI mode on, so a bad ``cast`` raises.  The reference was
written for non-ANSI Spark where malformed input became NULL; ``safe_cast``
and ``parse_utc_ts`` keep that outcome without turning ANSI off.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_ntz(value: str | _dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal from a datetime or 'yyyy-MM-dd HH:mm:ss' string."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp_ntz(F.lit(str(value)))


def safe_cast(c: str | Column, dtype: str) -> Column:
    """``try_cast``: malformed values become NULL instead of failing the job."""
    return _col(c).try_cast(dtype)


def utc_ntz(instant: str | Column) -> Column:
    """Instant (``timestamp``) -> UTC wall clock as ``timestamp_ntz``.

    Computed from epoch microseconds, so the session time zone and its DST
    rules play no part.
    """
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(instant)), lit_ntz(_EPOCH))


def parse_utc_ts(c: str | Column) -> Column:
    """ISO-8601 string with zone (e.g. ``...Z``) -> UTC ``timestamp_ntz``; bad input -> NULL."""
    return utc_ntz(F.try_to_timestamp(_col(c)))


def epoch_seconds(ntz: str | Column) -> Column:
    """Whole seconds since the epoch of a UTC ``timestamp_ntz``."""
    return F.timestamp_diff("SECOND", lit_ntz(_EPOCH), _col(ntz))


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(_col(c), F.lit(""))


def surrogate_key(*cols: str | Column) -> Column:
    """Deterministic row id (replaces ``uuid()``): sha-256 of the '|'-joined values."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.sha2(F.concat_ws("|", *parts), 256)


def null_safe_changed(left: str, right: str, attrs: Iterable[str], null_safe: bool = True) -> Column:
    """OR of per-attribute change tests between two aliased sides.

    ``null_safe=False`` reproduces a plain ``<>`` test, under which a change
    to or from NULL is not seen.
    """
    tests = []
    for a in attrs:
        lc, rc = F.col(f"{left}.{a}"), F.col(f"{right}.{a}")
        tests.append(~lc.eqNullSafe(rc) if null_safe else F.coalesce(lc != rc, F.lit(False)))
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out
