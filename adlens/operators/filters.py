"""Row filters and routing (PF12-PF17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import in_range
from ..functions.json_fields import message_platform, platform_of


def filter_report(df: DataFrame, media=None, start=None, end=None) -> DataFrame:
    """PF16: report filters by media and by period (either may be absent)."""
    out = df
    if media:
        out = out.filter(F.col("media").isin(*([media] if isinstance(media, str) else media)))
    if start is not None or end is not None:
        out = in_range(out, start or "0001-01-01", end or "9999-12-31")
    return out


def search(df: DataFrame, column: str, text: str) -> DataFrame:
    """PF17 / LK3: case-insensitive substring search on the whole text."""
    return df.filter(F.contains(F.lower(F.col(column)), F.lower(F.lit(text))))


def split_valid(df: DataFrame, key: str = "report_date") -> tuple[DataFrame, DataFrame]:
    """PF14: rows with a usable partition key, and the rest (quarantine).
    The reference drops the rest silently (Q6)."""
    return df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())


def dead_letter_platform(messages: DataFrame, body: str = "body") -> DataFrame:
    """AG14 input: the platform each failed message names (any value), or
    'unknown' for a body that is not a JSON object or names none."""
    return messages.withColumn("platform", message_platform(body))


def route(messages: DataFrame, body: str = "body") -> DataFrame:
    """PF15 + SC12: the platform of each message: google, kakao or unknown
    (body not JSON, no platform, or a platform that is not served)."""
    return messages.withColumn("platform", platform_of(body))
