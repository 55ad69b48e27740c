"""Scalar expressions used across operators.  All are built-in Spark functions, so
they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def millis_to_ts(col) -> Column:
    """Epoch milliseconds -> TIMESTAMP (fraction kept, no double round trip)."""
    return F.timestamp_millis(_c(col))


def epoch_millis(col, ntz: bool = True) -> Column:
    """TIMESTAMP / TIMESTAMP_NTZ -> epoch milliseconds (floored, like unix_millis)."""
    c = _c(col)
    if ntz:
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MILLISECOND", epoch, c)
    return F.unix_millis(c)


def trade_date(col) -> Column:
    """Timestamp -> DATE partition key (session zone, pinned to UTC)."""
    return F.to_date(_c(col))


def to_ntz(col) -> Column:
    return _c(col).cast("timestamp_ntz")


def trunc_ts(unit: str, col, ntz: bool = True) -> Column:
    """``date_trunc`` that keeps TIMESTAMP_NTZ input as NTZ (Spark returns LTZ)."""
    out = F.date_trunc(unit, _c(col))
    return out.cast("timestamp_ntz") if ntz else out


def safe_ratio(num, den, digits: int | None = None, scale: float = 1.0) -> Column:
    """``round(num / nullif(den, 0) * scale, digits)``: null instead of a /0 error."""
    den_c = _c(den)
    r = _c(num) / F.when(den_c != 0, den_c)
    if scale != 1.0:
        r = r * F.lit(scale)
    return F.round(r, digits) if digits is not None else r


def strip_frame(col, header_bytes: int = 5) -> Column:
    """Drop the framing header (magic byte + 4-byte schema id) of a binary value."""
    c = _c(col)
    return F.substring(c, F.lit(header_bytes + 1), F.length(c) - F.lit(header_bytes))


def frame_fault(col, header_bytes: int = 5) -> Column:
    """Why a framed value's header is invalid: ``too_short`` or ``bad_magic``; null if it is valid.
    (A null value is too short.)"""
    c = _c(col)
    return (F.when(F.coalesce(F.length(c), F.lit(0)) < header_bytes, "too_short")
             .when(F.substring(c, 1, 1) != F.lit(bytes([0])), "bad_magic"))
