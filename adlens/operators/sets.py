"""Set operations (SO1, SO2): concatenation of extracts and of media."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ratios import MONEY, micros_to_currency

UNIFIED_COLUMNS = ["media", "report_date", "campaign", "keyword", "impressions",
                   "clicks", "cost", "conversions", "conv_value"]


def concat_accounts(dfs: list[DataFrame]) -> DataFrame:
    """SO1: rows of all accounts / extracts; columns matched by name, absent
    ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _opt(df: DataFrame, name: str, typ: str = "string"):
    return F.col(name) if name in df.columns else F.lit(None).cast(typ)


def google_unified(google: DataFrame) -> DataFrame:
    return google.select(
        F.lit("google").alias("media"), "report_date",
        _opt(google, "camp_name").alias("campaign"),
        _opt(google, "keyword_text").alias("keyword"),
        F.col("impressions").cast("bigint").alias("impressions"),
        F.col("clicks").cast("bigint").alias("clicks"),
        micros_to_currency("cost_micros").cast(MONEY).alias("cost"),
        F.col("conversions").cast("bigint").alias("conversions"),
        F.col("conversions_value").cast(MONEY).alias("conv_value"))


def kakao_unified(kakao: DataFrame, conversions: str = "conv_purchase_7d") -> DataFrame:
    return kakao.select(
        F.lit("kakao").alias("media"), "report_date",
        _opt(kakao, "camp_name").alias("campaign"),
        _opt(kakao, "kwd_name").alias("keyword"),
        F.col("imp").cast("bigint").alias("impressions"),
        F.col("click").cast("bigint").alias("clicks"),
        F.col("spending").cast(MONEY).alias("cost"),
        F.col(conversions).cast("bigint").alias("conversions"),
        F.lit(None).cast(MONEY).alias("conv_value"))


def unify_media(google: DataFrame, kakao: DataFrame,
                kakao_conversions: str = "conv_purchase_7d") -> DataFrame:
    """SO2: one fact with ``media, report_date, campaign, keyword,
    impressions, clicks, cost, conversions, conv_value`` (cost and value as
    exact decimals). A plain UNION ALL: no shuffle."""
    return google_unified(google).unionByName(kakao_unified(kakao, kakao_conversions))
