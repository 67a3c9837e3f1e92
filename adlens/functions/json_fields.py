"""JSON text fields with fallbacks (SC12, SC13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLATFORMS = ("google", "kakao")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def json_field(col, field: str, default: str | None = None) -> Column:
    """SC12: one string field of a JSON object text. Text that is not a JSON
    object, or lacks the field, gives ``default``."""
    parsed = F.from_json(_c(col), f"`{field}` STRING", {"mode": "PERMISSIVE"})
    v = parsed[field]
    return v if default is None else F.coalesce(v, F.lit(default))


def message_platform(body) -> Column:
    """SC12 for dead letters: the platform the message names, as given
    (any value), or 'unknown' when the body is not a JSON object or has
    none."""
    return json_field(body, "platform", "unknown")


def platform_of(body) -> Column:
    """SC12 + PF15: the message platform, or 'unknown' when the body is not
    JSON, has no platform, or names one that is not served."""
    p = json_field(body, "platform")
    return F.when(p.isin(*PLATFORMS), p).otherwise(F.lit("unknown"))
