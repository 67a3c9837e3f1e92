"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each one reads the driver tables through the projections in
``adlens.sources.fixtures`` and runs one or more operators over the whole
tables.
"""

from __future__ import annotations

import uuid as _uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as _F

from .functions.casts import all_as_text
from .functions.dates import (display_date, epoch_ms_text_to_time, find_date, in_range, on_day,
                              partition_keys)
from .functions.ratios import count_sum, money_sum, round_half_up
from .operators import aggregates as agg
from .operators import documents, ingest, lookups
from .operators.filters import dead_letter_platform, filter_report, route, search, split_valid
from .operators.joins import enrich_with_master, latest_master
from .operators.sets import unify_media
from .operators.topk import order_by
from .plans import dashboard as dash
from .plans import sheets, weekly
from .plans import partials
from .plans.loads import batch_load, bulk_load, read_master
from .session import isolated, scratch_path
from .sinks import grams, ordered
from .sinks import tables as sinks
from .sources import fixtures as fx
from .sources import landed, readers
from .streaming import deliveries
from .streaming import jobs as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@register("google_campaign_top10")
def google_campaign_top10(spark, sf_dir):
    return weekly.google_top(fx.google_ads(spark, sf_dir))


# ---- shared inputs ------------------------------------------------------


W0, W1 = weekly.WEEK_START, weekly.WEEK_END
MONTH = ("1998-03-01", "1998-03-31")
AS_OF = "1998-03-10 00:00:00"          # UTC instant; Tuesday in Asia/Seoul


def _unified(spark, sf_dir):
    return unify_media(fx.google_ads(spark, sf_dir), fx.kakao_facts(spark, sf_dir))


@register("kakao_campaign_top10")
def kakao_campaign_top10(spark, sf_dir):
    return weekly.kakao_top(fx.kakao_facts(spark, sf_dir), fx.kakao_master(spark, sf_dir))


@register("overall_by_media")
def overall_by_media(spark, sf_dir):
    return agg.overall_by_media(fx.google_ads(spark, sf_dir), fx.kakao_facts(spark, sf_dir), W0, W1)


@register("unified_daily")
def unified_daily(spark, sf_dir):
    return sheets.daily_table(_unified(spark, sf_dir), W0, W1)


@register("daily_with_totals")
def daily_with_totals(spark, sf_dir):
    return sheets.daily_sheet(_unified(spark, sf_dir), W0, W1)


@register("media_share")
def media_share(spark, sf_dir):
    return sheets.media_spend(_unified(spark, sf_dir), W0, W1)


@register("kpi_totals")
def kpi_totals(spark, sf_dir):
    return sheets.kpi_of_range(_unified(spark, sf_dir), W0, W1)


@register("week_of_month")
def week_of_month(spark, sf_dir):
    return sheets.week_of_month(sheets.daily_table(_unified(spark, sf_dir), *MONTH))


@register("week_over_week")
def week_over_week(spark, sf_dir):
    return sheets.week_over_week_as_of(_unified(spark, sf_dir), AS_OF)


@register("campaign_detail")
def campaign_detail(spark, sf_dir):
    return sheets.campaign_detail(fx.google_ads(spark, sf_dir), W0, W1)


@register("google_sheet")
def google_sheet(spark, sf_dir):
    return sheets.google_sheet(fx.google_ads(spark, sf_dir), W0, W1)


@register("kakao_sheet")
def kakao_sheet(spark, sf_dir):
    return sheets.kakao_sheet(fx.kakao_facts(spark, sf_dir), fx.kakao_master(spark, sf_dir), W0, W1)


@register("dashboard")
def dashboard(spark, sf_dir):
    return dash.dashboard_media(_unified(spark, sf_dir), AS_OF)


@register("dashboard_trend")
def dashboard_trend(spark, sf_dir):
    return dash.conversion_trend(_unified(spark, sf_dir), AS_OF)


@register("report_filter")
def report_filter(spark, sf_dir):
    f = filter_report(_unified(spark, sf_dir), media=["google"], start=W0, end=W1)
    return f.select("media", "report_date", "campaign", "keyword", "impressions", "clicks",
                    _F.col("cost").cast("double").alias("cost"), "conversions")


@register("detail_search")
def detail_search(spark, sf_dir):
    g = search(in_range(fx.google_ads(spark, sf_dir), W0, W1), "keyword_text", "Red")
    return g.groupBy(_F.col("keyword_text").alias("keyword")).agg(
        count_sum("impressions").alias("impressions"), count_sum("clicks").alias("clicks"),
        round_half_up(_F.sum(_F.col("cost_micros").cast("decimal(38,0)")) / _F.lit(1000000), 0).alias("cost"))


# ---- ingest typing, quarantine, routing, dead letters --------------------


TYPED_COLUMNS = ["kwd_id", "adv_id", "imp", "click", "spending", "basic_date", "report_date",
                 "year", "month_p", "day"]


@register("typed_bulk")
def typed_bulk(spark, sf_dir):
    return ingest.type_bulk(fx.raw_extract(spark, sf_dir), "kakao").select(*TYPED_COLUMNS)


@register("typed_batch")
def typed_batch(spark, sf_dir):
    return ingest.type_batch(fx.raw_extract(spark, sf_dir), "kakao").select(*TYPED_COLUMNS)


@register("valid_rows")
def valid_rows(spark, sf_dir):
    good, _ = split_valid(ingest.type_bulk(fx.raw_extract(spark, sf_dir), "kakao"))
    return good.select("kwd_id", "report_date", "year", "month_p", "day")


@register("quarantine_rows")
def quarantine_rows(spark, sf_dir):
    _, bad = split_valid(ingest.type_bulk(fx.raw_extract(spark, sf_dir), "kakao"))
    return bad.select("kwd_id", "imp", "click", "spending")


@register("routed")
def routed(spark, sf_dir):
    return route(fx.queue_messages(spark, sf_dir)).select("event_id", "platform")


@register("failed_counts")
def failed_counts(spark, sf_dir):
    return agg.failed_counts(dead_letter_platform(fx.queue_messages(spark, sf_dir)))


@register("dead_letters")
def dead_letters(spark, sf_dir):
    m = dead_letter_platform(fx.queue_messages(spark, sf_dir))
    return m.select("event_id", "platform",
                    epoch_ms_text_to_time("sent_ms").alias("sent_time"),
                    _F.coalesce(_F.col("receive_count"), _F.lit("unknown")).alias("receive_count"))


# ---- conversations, messages, reports -----------------------------------

def _items(spark, sf_dir):
    return lookups.conversation_items(fx.chat_messages(spark, sf_dir), fx.user_of_conversation())


def _reports(spark, sf_dir):
    """Report items saved with SNK4 (append, expiry = created + 90 days),
    then read back from the saved table."""
    path = scratch_path(spark, "reports_table")
    sinks.append_report(lookups.report_row(fx.report_items(spark, sf_dir)), path)
    return spark.read.parquet(path)


@register("messages_in_order")
def messages_in_order(spark, sf_dir):
    return lookups.messages_of(fx.chat_messages(spark, sf_dir)).select(
        "message_id", "conversation_id", "seq", "role", "position")


@register("latest_message")
def latest_message(spark, sf_dir):
    return lookups.latest_message(fx.chat_messages(spark, sf_dir))


@register("conversations_by_user")
def conversations_by_user(spark, sf_dir):
    return lookups.conversations_of(_items(spark, sf_dir)).select(
        "conversation_id", "user_id", "n_messages", "last_seq", "position")


@register("title_search")
def title_search(spark, sf_dir):
    return lookups.title_search(_items(spark, sf_dir), "Pour").select("conversation_id", "title")


@register("conversations_with_report")
def conversations_with_report(spark, sf_dir):
    items = _items(spark, sf_dir).withColumn(
        "report_key", _F.when(_F.col("conversation_id").cast("bigint") % 3 == 0,
                              _F.concat(_F.lit("r"), _F.col("conversation_id"))))
    return lookups.with_report_key(items, _reports(spark, sf_dir)).select(
        "conversation_id", "report_key", "period_start", "period_end", "created_at")


@register("reports_by_month")
def reports_by_month(spark, sf_dir):
    r = lookups.reports_by_month(_reports(spark, sf_dir))
    return r.withColumn("year", _F.col("year").cast("bigint")).withColumn("month", _F.col("month").cast("bigint"))


@register("active_reports")
def active_reports(spark, sf_dir):
    return lookups.active_reports(_reports(spark, sf_dir), "1999-06-01 00:00:00").select(
        "user_id", "report_id", "expires_at", "position")


# ---- sources and sinks: write, then read back ----------------------------


KAKAO_TABLE_COLUMNS = ["kwd_id", "agroup_id", "adv_id", "basic_date", "imp", "click", "spending",
                       "conv_purchase_1d", "conv_purchase_7d"]
REWRITE_DAY = "1998-03-05"


def _kakao_rows(spark, sf_dir):
    f = fx.kakao_facts(spark, sf_dir)
    return f.select(*KAKAO_TABLE_COLUMNS, "report_date", *partition_keys("report_date"))


def _read_back(spark, path):
    return readers.scan_table(spark, path, "kakao").select(*KAKAO_TABLE_COLUMNS, "report_date",
                                                           "year", "month_p", "day")


@register("parquet_roundtrip")
def parquet_roundtrip(spark, sf_dir):
    rows = _kakao_rows(spark, sf_dir)
    path = scratch_path(spark, "kakao_ad_performance")
    sinks.write_partitions(rows, path)
    sinks.write_partitions(rows.filter(_F.lit(False)), path)   # empty extract: no change
    return _read_back(spark, path)


@register("rewrite_day")
def rewrite_day(spark, sf_dir):
    rows = _kakao_rows(spark, sf_dir)
    path = scratch_path(spark, "kakao_ad_performance")
    sinks.write_partitions(rows, path)
    day = rows.filter(_F.col("basic_date") == REWRITE_DAY.replace("-", "")).withColumn("imp", _F.col("imp") * 2)
    sinks.write_partitions(day, path)     # rerun of one day replaces that day only
    sinks.write_partitions(day, path)     # and is idempotent
    return _read_back(spark, path)


@register("catalog_scan")
def catalog_scan(spark, sf_dir):
    root = scratch_path(spark, "tables")
    sinks.write_partitions(_kakao_rows(spark, sf_dir), f"{root}/kakao")
    db = f"ad_report_{_uuid.uuid4().hex}"
    (name,) = sinks.create_tables(spark, root, db, drop_first=True, platforms=("kakao",))
    sinks.register_partitions(spark, name, _kakao_rows(spark, sf_dir))
    t = readers.sql(spark, f"SELECT * FROM {name}")
    return (t.groupBy("year", "month_p")
             .agg(_F.count(_F.lit(1)).alias("n"), _F.sum("imp").alias("imp"),
                  round_half_up(money_sum("spending"), 0).alias("spending")))


def _write_ms949(spark, rows_of, path):
    """A CSV in the Korean code page, written in a session that admits it."""
    own = isolated(spark, {"spark.sql.legacy.javaCharsets": "true"})
    rows_of(own).write.option("header", True).option("encoding", "MS949").option("escape", '"').csv(path)


@register("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "kakao_master_csv")
    _write_ms949(spark, lambda own: landed.master_rows(own, sf_dir), path)
    text = readers.read_csv_text(spark, path)
    m = latest_master(text.withColumn("seq", _F.col("seq").cast("int")), "seq")
    return m.select("kwd_id", "kwd_name", "camp_name", "label")


@register("json_flatten")
def json_flatten(spark, sf_dir):
    path = scratch_path(spark, "google_responses")
    landed.land_google(spark, sf_dir, path)
    flat = readers.flatten_google(readers.read_responses(spark, path, "google"), landed.CUSTOMER_ID)
    return flat.select("camp_name", "keyword_id", "keyword_text", "device", "network_type", "date",
                       "basic_date", "adv_id", "impressions", "clicks", "cost_micros", "conversions",
                       "conversions_value", "ctr", "video_views")


@register("accounts")
def accounts(spark, sf_dir):
    docs_path = scratch_path(spark, "kakao_responses")
    list_path = scratch_path(spark, "kakao_accounts")
    landed.kakao_documents(spark, sf_dir).write.json(docs_path)
    landed.account_list(spark, sf_dir).write.json(list_path)
    acc = readers.explode_accounts(readers.read_responses(spark, list_path, "accounts"))
    flat = readers.flatten_kakao(readers.read_responses(spark, docs_path, "kakao"), accounts=acc)
    return flat.select("kwd_id", "agroup_id", "adv_id", "basic_date", "imp", "click", "spending",
                       "conv_purchase_1d", "conv_purchase_7d", "rank", "ctr")


# ---- streaming: run to completion (availableNow), read the sink ---------


@register("stream_failed_counts")
def stream_failed_counts(spark, sf_dir):
    landing = scratch_path(spark, "queue")
    landed.queue_documents(spark, sf_dir).write.json(landing)
    sink, ckpt = scratch_path(spark, "dlq_counts"), scratch_path(spark, "dlq_ckpt")
    q = streams.run_update_stream(streams.dead_letter_counts(streams.queue_stream(spark, landing)), sink, ckpt)
    q.awaitTermination()
    return streams.read_latest(spark, sink, ["window_start_ms", "window_end_ms", "platform"])


@register("stream_routes")
def stream_routes(spark, sf_dir):
    landing = scratch_path(spark, "queue")
    landed.queue_documents(spark, sf_dir).write.json(landing)
    routed, ckpt = (scratch_path(spark, n) for n in ("routed", "routes_ckpt"))
    streams.route_stream(streams.queue_stream(spark, landing), routed, ckpt).awaitTermination()
    return spark.read.parquet(routed).select("message_id", "platform", "receive_count", "route")


def _ingested(spark, sf_dir):
    """ST1: landing runs out of order, one manifest per micro-batch. Run 10 (a
    rerun of one day, lands first) is newer than run 9 (every day, in two
    parts); run 9 must not undo it."""
    landing = scratch_path(spark, "google_landing")
    every = landed.google_day_documents(spark, sf_dir)
    half = _F.dayofmonth(_F.col("date").cast("date")) <= 15
    every.filter(half).drop("date").write.options(**landed.LANDED).json(f"{landing}/run=9/part=1")
    every.filter(~half).drop("date").write.options(**landed.LANDED).json(f"{landing}/run=9/part=2")
    landed.google_day_documents(spark, sf_dir, REWRITE_DAY).drop("date").write.options(**landed.LANDED).json(f"{landing}/run=10")
    for run in (10, 9):
        streams.finish_run(spark, f"{landing}/manifests", run, f"{landing}/run={run}/*" if run == 9 else f"{landing}/run=10")
    table, state, bad = (scratch_path(spark, n) for n in ("google_ad_performance", "ingest_state", "ingest_quarantine"))
    streams.ingest_stream(spark, f"{landing}/manifests", "google", table, state, bad,
                          customer_id=landed.CUSTOMER_ID, max_files=1).awaitTermination()
    return table, state


@register("stream_ingest")
def stream_ingest(spark, sf_dir):
    """ST1: the table that two landing runs, out of order, leave."""
    table, _ = _ingested(spark, sf_dir)
    t = readers.scan_table(spark, table, "google")
    return t.select("camp_name", "keyword_id", "keyword_text", "basic_date", "report_date", "adv_id",
                    "impressions", "clicks", "cost_micros", "conversions_value", "year", "month_p", "day")


# ---- report documents ----------------------------------------------------


def _report_docs(spark, sf_dir):
    path = scratch_path(spark, "reports")
    sinks.write_partitions(landed.report_documents(spark, sf_dir), path, keys=("report_id",),
                           fmt="json", dynamic=False)
    return readers.read_report_docs(spark, path)


@register("report_datasets")
def report_datasets(spark, sf_dir):
    d = documents.datasets(_report_docs(spark, sf_dir))
    return d.select("report_id", "chart_type", _F.size("rows").cast("bigint").alias("n_rows"),
                    _F.col("message_pos").cast("bigint").alias("message_pos"))


@register("report_texts")
def report_texts(spark, sf_dir):
    t = documents.texts(_report_docs(spark, sf_dir))
    return t.select("report_id", _F.size("texts").cast("bigint").alias("n_texts"),
                    _F.array_join("texts", " | ").alias("texts"))


@register("report_pie")
def report_pie(spark, sf_dir):
    p = documents.pie_rows(documents.datasets(_report_docs(spark, sf_dir)))
    return p.select("report_id", _F.col("pos").cast("bigint").alias("pos"), "media", "cost")


@register("report_titles")
def report_titles(spark, sf_dir):
    d = _report_docs(spark, sf_dir)
    return d.select("report_id", "title", display_date("created_at").alias("created"))


@register("sheets_roundtrip")
def sheets_roundtrip(spark, sf_dir):
    u = _unified(spark, sf_dir)
    path = scratch_path(spark, "sheets")
    sinks.write_sheets({"daily": sheets.daily_sheet(u, W0, W1), "google": sheets.google_sheet(
        fx.google_ads(spark, sf_dir), W0, W1), "kakao": sheets.kakao_sheet(
        fx.kakao_facts(spark, sf_dir), fx.kakao_master(spark, sf_dir), W0, W1)}, path)
    parts = {"daily": _F.col("report_date").cast("string"), "google": _F.col("campaign"), "kakao": _F.col("campaign")}
    cost = {"daily": "total_cost", "google": "cost", "kakao": "cost"}
    out = None
    for name, label in parts.items():
        t = spark.read.parquet(f"{path}/{name}").select(_F.lit(name).alias("sheet"), label.alias("label"),
                                                        _F.col(cost[name]).alias("cost"), "row_type")
        out = t if out is None else out.unionByName(t)
    return out


@register("weekly_report")
def weekly_report(spark, sf_dir):
    return weekly.weekly_report(fx.google_ads(spark, sf_dir), fx.kakao_facts(spark, sf_dir),
                                fx.kakao_master(spark, sf_dir), AS_OF)


@register("row_counts")
def row_counts(spark, sf_dir):
    """AG15: rows per ingest stage (read, valid, quarantined, enriched): one
    pass over the extract and one over the enriched facts."""
    typed = ingest.type_bulk(fx.raw_extract(spark, sf_dir), "kakao")
    n = typed.agg(_F.count(_F.lit(1)).alias("read"), _F.count("report_date").alias("valid"))
    stages = n.select(_F.inline(_F.array(*[
        _F.struct(_F.lit(k).alias("stage"), v.alias("rows")) for k, v in (
            ("read", _F.col("read")), ("valid", _F.col("valid")), ("quarantined", _F.col("read") - _F.col("valid")))])))
    enriched = enrich_with_master(fx.kakao_facts(spark, sf_dir), fx.kakao_master(spark, sf_dir), seq="seq")
    return stages.unionByName(enriched.agg(_F.count(_F.lit(1)).alias("rows"))
                              .select(_F.lit("enriched").alias("stage"), "rows"))


@register("doc_kpi")
def doc_kpi(spark, sf_dir):
    """RB5 KPI block of every report document, from its pie and table
    datasets (AG12 -> AG6)."""
    docs = _report_docs(spark, sf_dir)
    sets = documents.datasets(docs)
    return sheets.kpi(documents.pie_rows(sets), documents.table_rows(sets), ("report_id",), docs.select("report_id"))


@register("doc_week_of_month")
def doc_week_of_month(spark, sf_dir):
    """RB5 week block of every report document, from its table dataset in
    dataset order (AG12 -> AG7, WN2)."""
    docs = _report_docs(spark, sf_dir)
    rows = documents.table_rows(documents.datasets(docs))
    return sheets.week_of_month(rows, by=("report_id",), pos="pos", reports=docs.select("report_id"))


@register("doc_daily_sheet")
def doc_daily_sheet(spark, sf_dir):
    """RB6 of every report document, from its line and table datasets."""
    sets = documents.datasets(_report_docs(spark, sf_dir))
    return sheets.daily_sheet_from_documents(documents.line_rows(sets), documents.table_rows(sets))


@register("google_top10_from_table")
def google_top10_from_table(spark, sf_dir):
    """The production path: facts stored as the partitioned table, then the
    weekly top-10 read back with the week as a partition filter (only the
    seven day folders are listed and read)."""
    g = fx.google_ads(spark, sf_dir)
    cols = ["camp_name", "agroup_name", "keyword_id", "keyword_text", "device", "network_type", "basic_date",
            "impressions", "clicks", "cost_micros", "conversions", "conversions_value"]
    path = scratch_path(spark, "google_ad_performance")
    sinks.write_partitions(g.select(*cols, "report_date", *partition_keys("report_date")), path)
    return weekly.google_top(readers.scan_table(spark, path, "google", W0, W1))


@register("bulk_load_kakao")
def bulk_load_kakao(spark, sf_dir):
    """The bulk path end to end: keyword CSV (UTF-8) and master CSV (MS949)
    -> typing (half-even integers, dashed dates) -> latest master per
    keyword (left join) -> table by day; undated rows quarantined."""
    kw_path, m_path = scratch_path(spark, "kakao_keyword_csv"), scratch_path(spark, "kakao_master_csv")
    landed.keyword_extract(spark, sf_dir).write.option("header", True).csv(kw_path)
    _write_ms949(spark, lambda own: landed.master_rows(own, sf_dir).drop("label"), m_path)
    table, quarantine = scratch_path(spark, "kakao_ad_performance"), scratch_path(spark, "kakao_quarantine")
    bulk_load(spark, "kakao", kw_path, table, quarantine, master_path=m_path, master_seq="seq")
    return _bulk_columns(readers.scan_table(spark, table, "kakao"))


def _bulk_columns(t):
    return t.select("kwd_id", "adv_id", "imp", "click", "spending", "basic_date", "kwd_name", "camp_name",
                    "report_date", "year", "month_p", "day")


@register("doc_google_sheet")
def doc_google_sheet(spark, sf_dir):
    """RB7 of every report document, from its bar dataset."""
    sets = documents.datasets(_report_docs(spark, sf_dir))
    return sheets.google_sheet_from_documents(documents.bar_rows(sets)).withColumn(
        "pos", _F.col("pos").cast("bigint"))


@register("doc_kakao_sheet")
def doc_kakao_sheet(spark, sf_dir):
    """RB8 of every report document, from its pie dataset."""
    docs = _report_docs(spark, sf_dir)
    sets = documents.datasets(docs)
    out = sheets.kakao_sheet_from_documents(documents.pie_rows(sets), documents.pie_listing(sets), docs)
    return out.withColumn("pos", _F.col("pos").cast("bigint"))


@register("doc_media_share")
def doc_media_share(spark, sf_dir):
    """RB5 media block of every report document (pie, with the table as
    fallback, then shares)."""
    docs = _report_docs(spark, sf_dir)
    sets = documents.datasets(docs)
    k = sheets.kpi(documents.pie_rows(sets), documents.table_rows(sets), ("report_id",), docs.select("report_id"))
    return sheets.media_share_block(k)


@register("stream_untimed_counts")
def stream_untimed_counts(spark, sf_dir):
    """ST2, second output: dead letters without a sent time cannot be
    windowed; they are counted per platform (state: one row per platform)."""
    landing = scratch_path(spark, "queue")
    landed.queue_documents(spark, sf_dir).write.json(landing)
    sink, ckpt = scratch_path(spark, "dlq_untimed"), scratch_path(spark, "dlq_untimed_ckpt")
    streams.run_update_stream(streams.untimed_counts(streams.queue_stream(spark, landing)), sink, ckpt) \
        .awaitTermination()
    return streams.read_latest(spark, sink, ["platform"])


@register("dashboard_cached")
def dashboard_cached(spark, sf_dir):
    """RB10 with result caching: materialised per as-of hour in the shared
    folder, then served from the saved table (second call reads only)."""
    root = scratch_path(spark, "dashboard_cache")
    dash.cached_dashboard(spark, lambda: _unified(spark, sf_dir), AS_OF, root, source=sf_dir)
    return dash.cached_dashboard(spark, lambda: _unified(spark, sf_dir), AS_OF, root, source=sf_dir)


# ---- loads and tables ------------------------------------------------------


@register("bulk_load_kakao_file_order")
def bulk_load_kakao_file_order(spark, sf_dir):
    """The bulk path with a master that has no sequence column: of a repeated
    keyword the last row in file order stays (AG11), and the master's own
    adv_id, basic_date and agroup_id are dropped (PF10)."""
    kw_path, m_path = scratch_path(spark, "kakao_keyword_csv"), scratch_path(spark, "kakao_master_csv")
    landed.keyword_extract(spark, sf_dir).write.option("header", True).csv(kw_path)
    landed.master_in_file_order(spark, sf_dir).write.option("header", True).csv(m_path)
    table, quarantine = scratch_path(spark, "kakao_ad_performance"), scratch_path(spark, "kakao_quarantine")
    bulk_load(spark, "kakao", kw_path, table, quarantine, master_path=m_path)
    return _bulk_columns(readers.scan_table(spark, table, "kakao"))


@register("bulk_load_google")
def bulk_load_google(spark, sf_dir):
    """Google extract CSV -> table by ``basic_date`` (its segment ``date``
    differs), then one week read back."""
    path, table = scratch_path(spark, "google_csv"), scratch_path(spark, "google_ad_performance")
    landed.google_extract(spark, sf_dir).write.option("header", True).csv(path)
    bulk_load(spark, "google", path, table, scratch_path(spark, "google_quarantine"))
    return readers.scan_table(spark, table, "google", W0, W1).select(
        "camp_name", "keyword_id", "basic_date", "report_date", "date", "impressions", "clicks", "cost_micros",
        "year", "month_p", "day")


def _loaded_kakao(spark, sf_dir):
    """Landed kakao responses and the master -> enriched rows in the table."""
    docs, m_path = scratch_path(spark, "kakao_responses"), scratch_path(spark, "kakao_master_csv")
    landed.kakao_padded_documents(spark, sf_dir).write.json(docs)
    landed.master_in_file_order(spark, sf_dir).write.option("header", True).csv(m_path)
    table = scratch_path(spark, "kakao_ad_performance")
    batch_load(spark, "kakao", docs, table, master=read_master(spark, m_path),
               quarantine=scratch_path(spark, "kakao_quarantine"))
    return table


@register("batch_load_kakao")
def batch_load_kakao(spark, sf_dir):
    """The daily batch for kakao, with master enrichment (Q5)."""
    return readers.scan_table(spark, _loaded_kakao(spark, sf_dir), "kakao").select(
        "kwd_id", "adv_id", "basic_date", "imp", "click", "spending", "camp_name", "report_date", "year",
        "month_p", "day")


@register("batch_load_google")
def batch_load_google(spark, sf_dir):
    docs, table = scratch_path(spark, "google_responses"), scratch_path(spark, "google_ad_performance")
    landed.land_google(spark, sf_dir, docs)
    batch_load(spark, "google", docs, table, customer_id=landed.CUSTOMER_ID,
               quarantine=scratch_path(spark, "google_quarantine"))
    return readers.scan_table(spark, table, "google").select(
        "camp_name", "keyword_id", "adv_id", "basic_date", "report_date", "impressions", "clicks")


@register("kakao_top10_from_table")
def kakao_top10_from_table(spark, sf_dir):
    """AG2 from the stored, enriched table and its stored campaign names."""
    f = enrich_with_master(fx.kakao_facts(spark, sf_dir), fx.kakao_master(spark, sf_dir), seq="seq")
    path = scratch_path(spark, "kakao_ad_performance")
    sinks.write_partitions(f.select(*KAKAO_TABLE_COLUMNS, "kwd_name", "camp_name", "report_date",
                                    *partition_keys("report_date")), path)
    return agg.kakao_campaign_summary(readers.scan_table(spark, path, "kakao", W0, W1), W0, W1)


# ---- small operators -------------------------------------------------------


@register("day_rows")
def day_rows(spark, sf_dir):
    """PF13: one day."""
    return on_day(fx.google_ads(spark, sf_dir), REWRITE_DAY).groupBy("camp_name").agg(
        _F.count(_F.lit(1)).alias("n"), count_sum("clicks").alias("clicks"))


@register("detail_by_date")
def detail_by_date(spark, sf_dir):
    """TK3: the daily table in date order."""
    return order_by(sheets.daily_table(_unified(spark, sf_dir), *MONTH), "report_date").select(
        "report_date", "google_cost", "kakao_cost")


@register("detail_sorted")
def detail_sorted(spark, sf_dir):
    """TK5: a detail table sorted by any column."""
    return order_by(sheets.campaign_detail(fx.google_ads(spark, sf_dir), W0, W1), "clicks", descending=True).select(
        "campaign", "clicks", "cost")


@register("found_dates")
def found_dates(spark, sf_dir):
    """SC6: the date in a row map."""
    r = fx.raw_extract(spark, sf_dir)
    return r.select("kwd_id", find_date(_F.create_map(
        _F.lit("a"), _F.lit("x"), _F.lit("basic_date"), _F.col("basic_date"))).alias("found"))


@register("media_totals_named")
def media_totals_named(spark, sf_dir):
    """AG10: cost per media over all weeks; rows without a name get the default one."""
    p = documents.pie_rows(documents.datasets(_report_docs(spark, sf_dir)))
    named = p.withColumn("media", _F.when(_F.col("media") != "google", _F.col("media")))
    return agg.media_totals(named).withColumn("pos", _F.col("pos").cast("bigint"))


@register("result_texts")
def result_texts(spark, sf_dir):
    """SC10: a result with every value as text."""
    typed = ingest.type_bulk(fx.raw_extract(spark, sf_dir), "kakao")
    return all_as_text(typed.select("kwd_id", "imp", "click", "report_date"))


def _counted(spark, sf_dir, days: int):
    """Received queue messages, all delivered again in a later micro-batch, counted by ``count_stream``."""
    landing = scratch_path(spark, "queue")
    docs = landed.received_documents(spark, sf_dir, days)
    later = _F.col("message_id").cast("bigint") % 2
    for part in (docs.filter(later == 1), docs.filter(later == 0), docs):
        part.write.mode("append").json(landing)
    sink, ckpt = scratch_path(spark, "dlq_counts"), scratch_path(spark, "dlq_ckpt")
    deliveries.count_stream(streams.queue_stream(spark, landing, max_files=8), sink, ckpt).awaitTermination()
    return sink


@register("stream_redelivered_counts")
def stream_redelivered_counts(spark, sf_dir):
    """ST2 + ST4: every message delivered twice, in another file, and sent times in no order: each counts once, with
    the default retention."""
    return deliveries.read_counts(spark, _counted(spark, sf_dir, 18)).where("window_start_ms IS NOT NULL")


@register("stream_all_counts")
def stream_all_counts(spark, sf_dir):
    """ST2: timed and untimed messages from one stream; late ones are in an output of their own."""
    return deliveries.read_counts(spark, _counted(spark, sf_dir, 30))


@register("stream_late_messages")
def stream_late_messages(spark, sf_dir):
    """ST2: the messages received later than the retention after they were sent, each once."""
    late = deliveries.read_late(spark, _counted(spark, sf_dir, 30))
    return late.select("message_id", "platform", _F.unix_millis("sent").alias("sent_ms"), _F.unix_millis("received").alias("received_ms"))


@register("stream_outcomes")
def stream_outcomes(spark, sf_dir):
    """ST4: deliveries of the queue, a third of them twice: what succeeds goes on once, what fails three times goes to
    the dead letters once."""
    landing = scratch_path(spark, "deliveries")
    docs = landed.deliveries(spark, sf_dir)
    for part in (docs.where("receive = 1"), docs.where("receive = 2"), docs.where("receive = 1"), docs.where("receive = 3")):
        part.drop("receive").write.mode("append").json(landing)
    sink, ckpt = scratch_path(spark, "outcomes"), scratch_path(spark, "outcomes_ckpt")
    own = isolated(spark, streams.STATE_STORE)
    deliveries.retry_stream(deliveries.delivery_stream(own, landing, max_files=8), sink, ckpt).awaitTermination()
    return deliveries.read_outcomes(spark, sink).select("message_id", "platform", "route", _F.col("receives").cast("bigint").alias("receives"))


# ---- CSV files that differ ---------------------------------------------------


@register("csv_dialects")
def csv_dialects(spark, sf_dir):
    """SRC1: extracts with four separators and their columns in other orders, read by name without ``sep``."""
    path = scratch_path(spark, "dialect_csv")
    rows = landed.keyword_extract(spark, sf_dir)
    part = _F.pmod(_F.xxhash64("adv_id"), _F.lit(4))
    for i, sep in enumerate((",", ";", "\t", "|")):
        cols = rows.columns[i:] + rows.columns[:i]
        w = rows.where(part == i).select(*cols).write.mode("append").option("header", True).option("sep", sep)
        w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_csv_text(spark, path).select(*rows.columns)


@register("csv_line_breaks")
def csv_line_breaks(spark, sf_dir):
    """SRC1: chat texts with line breaks, quotes and separators in quoted fields."""
    path = scratch_path(spark, "messages_csv")
    text = _F.concat(_F.col("content"), _F.lit('\n"'), _F.col("role"), _F.lit('"\n\n, ; end'))
    fx.chat_messages(spark, sf_dir).select("message_id", "role", text.alias("content")).write.option("header", True).option(
        "quoteAll", True).option("escape", '"').csv(path)
    return readers.read_csv_text(spark, path, encodings=("UTF-8",), multi_line=True)


# ---- stored daily sums ---------------------------------------------------------


def _partials(spark, sf_dir):
    """Daily sums of both media, first with one day's rows doubled, then with that day refreshed."""
    root = scratch_path(spark, "daily_sums")
    for media, facts in (("google", fx.google_ads(spark, sf_dir)), ("kakao", fx.kakao_facts(spark, sf_dir))):
        day = facts.where(_F.col("report_date") == _F.lit(REWRITE_DAY).cast("date"))
        partials.refresh(facts.unionByName(day), media, f"{root}/{media}")
        partials.refresh(day, media, f"{root}/{media}")
    return root


@register("weekly_report_from_partials")
def weekly_report_from_partials(spark, sf_dir):
    """RB9 from seven days of stored sums."""
    return partials.weekly_report(spark, _partials(spark, sf_dir), fx.kakao_master(spark, sf_dir), AS_OF)


@register("overall_from_partials")
def overall_from_partials(spark, sf_dir):
    """AG3-AG5 from stored sums."""
    return partials.overall_by_media(spark, _partials(spark, sf_dir), W0, W1)


@register("dashboard_from_partials")
def dashboard_from_partials(spark, sf_dir):
    """RB10 from two days of stored sums."""
    return partials.dashboard_media(spark, _partials(spark, sf_dir), AS_OF)


@register("trend_from_partials")
def trend_from_partials(spark, sf_dir):
    """RB10's trend from seven days of stored sums."""
    return partials.conversion_trend(spark, _partials(spark, sf_dir), AS_OF)


@register("daily_from_partials")
def daily_from_partials(spark, sf_dir):
    """RB2 + RB4 with totals from stored sums."""
    return partials.daily_sheet(spark, _partials(spark, sf_dir), W0, W1)


@register("week_over_week_from_partials")
def week_over_week_from_partials(spark, sf_dir):
    """WN4 from fourteen days of stored sums."""
    return partials.week_over_week(spark, _partials(spark, sf_dir), AS_OF)


@register("bound_sql")
def bound_sql(spark, sf_dir):
    """SRC6 with bound values, one of them a text with quotes."""
    view = f"ads_{_uuid.uuid4().hex}"
    fx.google_ads(spark, sf_dir).createOrReplaceTempView(view)
    return readers.sql(spark, f"""SELECT camp_name, CAST(SUM(clicks) AS BIGINT) AS clicks FROM {view}
        WHERE report_date BETWEEN CAST(:first AS DATE) AND CAST(:last AS DATE) AND camp_name <> :odd GROUP BY camp_name""",
                       first=W0, last=W1, odd="Brand' OR '1'='1")


# ---- lookups by stored order ---------------------------------------------------


def _ordered(rows, name, key, order):
    table = f"{name}_{_uuid.uuid4().hex}"
    ordered.store_ordered(rows, table, scratch_path(rows.sparkSession, name), key, order)
    return table


@register("stored_conversations")
def stored_conversations(spark, sf_dir):
    """LK1 of one user from the table stored by user."""
    table = _ordered(_items(spark, sf_dir), "conversations", "user_id", ["last_seq", "conversation_id"])
    return ordered.conversations_of(spark, table, "u5").select(
        "conversation_id", "user_id", "n_messages", "last_seq", _F.col("position").cast("bigint").alias("position"))


@register("stored_messages")
def stored_messages(spark, sf_dir):
    """LK2 of one conversation from the table stored by conversation."""
    table = _ordered(fx.chat_messages(spark, sf_dir), "messages", "conversation_id", ["seq", "message_id"])
    return ordered.messages_of(spark, table, "7").select(
        "message_id", "conversation_id", "seq", "role", _F.col("position").cast("bigint").alias("position"))


@register("stored_reports")
def stored_reports(spark, sf_dir):
    """LK6 of one user from the table stored by user."""
    table = _ordered(lookups.report_row(fx.report_items(spark, sf_dir)), "reports", "user_id", ["expires_at", "report_id"])
    return ordered.active_reports_of(spark, table, "u5", "1999-06-01 00:00:00").select(
        "user_id", "report_id", "expires_at", _F.col("position").cast("bigint").alias("position"))


@register("dashboard_from_table")
def dashboard_from_table(spark, sf_dir):
    """RB10 cached by the version of the stored days: a rewritten day is seen at the next call."""
    root, table = scratch_path(spark, "dashboard_cache"), scratch_path(spark, "unified")
    u = _unified(spark, sf_dir).where(_F.col("report_date").between("1998-03-01", "1998-03-15"))
    u = u.select("media", "report_date", "cost", "conv_value", "impressions", "clicks", *partition_keys("report_date"))
    day = _F.col("report_date") == _F.lit("1998-03-10").cast("date")

    def cached():
        return dash.cached_by_version(spark, table, AS_OF, root)

    sinks.write_partitions(u.withColumn("clicks", _F.when(day, 1).otherwise(_F.col("clicks"))), table)
    cached()
    sinks.write_partitions(u.where(day), table)
    return cached()


# ---- search by stored trigrams ---------------------------------------------------


@register("title_search_stored")
def title_search_stored(spark, sf_dir):
    """LK3 by the postings of stored titles."""
    path = scratch_path(spark, "titles")
    grams.store_searchable(_items(spark, sf_dir).select("conversation_id", "title"), path, "title", blocks=32)
    return grams.find(spark, path, "title", "Pour").select("conversation_id", "title")


@register("detail_search_stored")
def detail_search_stored(spark, sf_dir):
    """PF17 by the postings of stored keyword texts: the week's sums of the keywords found."""
    path = scratch_path(spark, "keywords")
    sums = in_range(fx.google_ads(spark, sf_dir), W0, W1).groupBy(_F.col("keyword_text").alias("keyword")).agg(
        count_sum("impressions").alias("impressions"), count_sum("clicks").alias("clicks"),
        round_half_up(_F.sum(_F.col("cost_micros").cast("decimal(38,0)")) / _F.lit(1000000), 0).alias("cost"))
    grams.store_searchable(sums, path, "keyword", blocks=32)
    return grams.find(spark, path, "keyword", "Red")


# ---- observed row counts ------------------------------------------------------------


@register("stream_ingest_counts")
def stream_ingest_counts(spark, sf_dir):
    """AG15 on a stream: rows read, written, superseded and quarantined by landing run."""
    _, state = _ingested(spark, sf_dir)
    return streams.read_run_counts(spark, state).select("run", "read", "written", "superseded", "quarantined")


@register("bulk_load_counts")
def bulk_load_counts(spark, sf_dir):
    """AG15 on the bulk load: the counts that its own writes observed."""
    kw_path, m_path = scratch_path(spark, "kakao_keyword_csv"), scratch_path(spark, "kakao_master_csv")
    landed.keyword_extract(spark, sf_dir).write.option("header", True).csv(kw_path)
    landed.master_in_file_order(spark, sf_dir).write.option("header", True).csv(m_path)
    done = bulk_load(spark, "kakao", kw_path, scratch_path(spark, "kakao_ad_performance"),
                     scratch_path(spark, "kakao_quarantine"), master_path=m_path)
    return spark.createDataFrame(list(done["counts"]().items()), "stage string, rows bigint")
