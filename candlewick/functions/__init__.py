"""Column-level helpers (JVM-side expressions only)."""

from candlewick.functions.exprs import (  # noqa: F401
    millis_to_ts, trade_date, safe_ratio, trunc_ts, strip_frame, frame_fault, epoch_millis, to_ntz,
)
