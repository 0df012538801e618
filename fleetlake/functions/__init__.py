"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from fleetlake.functions.exprs import (  # noqa: F401
    blank_to_null,
    epoch_seconds,
    lit_ntz,
    null_safe_changed,
    parse_utc_ts,
    safe_cast,
    surrogate_key,
    utc_ntz,
)
