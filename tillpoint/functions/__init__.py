"""Column-expression helpers (all JVM-side built-ins; no Python UDFs)."""

from tillpoint.functions.numeric import (  # noqa: F401
    cents,
    from_cents,
    is_missing,
    money,
    round_to,
    safe_div,
    to_double,
)
