"""Report documents to datasets and texts (AG12, AG13, SC13) and dataset
rows to typed tables (the inputs of RB5-RB8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import safe_float

CHART_TYPES = ("pie", "line", "bar", "table")

from ..labels import (BAR_KEYS, DEFAULT_MEDIA_PREFIX, KEY_CAMPAIGN, KEY_COST, KEY_DATE, KEY_MEDIA, LINE_KEYS,
                      MEDIA_IDS, TABLE_KEYS, UNNAMED_CAMPAIGN)


def datasets(docs: DataFrame) -> DataFrame:
    """AG12: per report and chart type (pie, line, bar, table) the last
    message with a non-empty dataset; other chart types are ignored.
    ``max_by`` over the message position: one partial aggregate."""
    m = docs.select("report_id", F.posexplode("messages").alias("pos", "m"))
    m = m.filter(F.col("m.chartType").isin(*CHART_TYPES) & (F.size(F.col("m.structuredData")) > 0))
    # an empty chart type counts as none (falsy in the reference)
    return (m.groupBy("report_id", F.col("m.chartType").alias("chart_type"))
             .agg(F.max_by(F.col("m.structuredData"), F.col("pos")).alias("rows"),
                  F.max("pos").alias("message_pos")))


def texts(docs: DataFrame) -> DataFrame:
    """AG13: assistant texts without a chart type, in message order.
    Ordering uses the position inside each document's own array (no
    shuffle): ``filter`` then ``transform`` on the messages array."""
    kept = F.filter(F.col("messages"), lambda x: (F.coalesce(x["role"], F.lit("")) == "assistant")
                    & (F.coalesce(x["chartType"], F.lit("")) == "")
                    & (F.coalesce(x["content"], F.lit("")) != ""))
    return docs.select("report_id", F.transform(kept, lambda x: x["content"]).alias("texts"))


def dataset_rows(sets: DataFrame, chart_type: str) -> DataFrame:
    """The rows of one chart type's dataset, with their position."""
    return (sets.filter(F.col("chart_type") == chart_type)
                .select("report_id", F.posexplode("rows").alias("pos", "row")))


def pie_rows(sets: DataFrame) -> DataFrame:
    """Pie dataset rows: media (mapped to its id, else the given name),
    cost as a lenient number (PF7), position."""
    r = dataset_rows(sets, "pie")
    name = F.col("row")[KEY_MEDIA]
    mapped = F.coalesce(*[F.when(name == k, F.lit(v)) for k, v in MEDIA_IDS.items()], name)
    return r.select("report_id", "pos", mapped.alias("media"), safe_float(F.col("row")[KEY_COST]).alias("cost"))


def table_rows(sets: DataFrame) -> DataFrame:
    """Table dataset rows as a typed daily table: the date text parsed
    (``report_date`` NULL when unreadable, the text kept in ``date_text``),
    every measure a lenient number (PF7), and the row position."""
    r = dataset_rows(sets, "table")
    row = F.col("row")
    return r.select("report_id", "pos", row[KEY_DATE].alias("date_text"),
                    F.try_to_date(row[KEY_DATE], "yyyy-M-d").alias("report_date"),
                    *[safe_float(row[v]).alias(k) for k, v in TABLE_KEYS.items()])


def line_rows(sets: DataFrame) -> DataFrame:
    """Line dataset rows: date text, per-media cost (PF7), position."""
    r = dataset_rows(sets, "line")
    row = F.col("row")
    return r.select("report_id", "pos", row[KEY_DATE].alias("date_text"),
                    *[safe_float(row[v]).alias(k) for k, v in LINE_KEYS.items()])


def bar_rows(sets: DataFrame) -> DataFrame:
    """Bar dataset rows: campaign (default ``(미분류)``), the five measures as
    lenient numbers (PF7), and the row position."""
    r = dataset_rows(sets, "bar")
    row = F.col("row")
    return r.select("report_id", "pos",
                    F.coalesce(row[KEY_CAMPAIGN], F.lit(UNNAMED_CAMPAIGN)).alias("campaign"),
                    *[safe_float(row[v]).alias(k) for k, v in BAR_KEYS.items()])


def pie_listing(sets: DataFrame) -> DataFrame:
    """Pie rows as listed in the kakao sheet: the name as written (a row
    without one is ``매체N``, N its 1-based position) and the cost."""
    r = dataset_rows(sets, "pie")
    row = F.col("row")
    name = F.coalesce(row[KEY_MEDIA], F.concat(F.lit(DEFAULT_MEDIA_PREFIX), (F.col("pos") + 1).cast("string")))
    return r.select("report_id", "pos", name.alias("media_name"), safe_float(row[KEY_COST]).alias("cost"))
