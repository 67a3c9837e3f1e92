"""Report tables (RB1-RB8): the datasets of a weekly report and the sheet
tables built from them, as DataFrames. Ratios and totals that the workbook
computed with formulas are columns and a ``row_type='total'`` row here.

Rounding follows the reference: SQL ROUND (half-up) in the weekly query
tables, Python ``round`` (half-even) in the sheets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import dashed_date_text, in_range, week_of_month_label
from ..functions.ratios import (count_sum, div_or_zero, money_sum, ratio_half_up,
                                round_half_even, safe_div)
from ..operators.aggregates import kakao_keyword_totals, with_totals
from ..operators.joins import by_date_and_media, daily_lookup, latest_master
from ..operators.topk import first_groups
from ..operators.windows import with_share

from ..labels import EMPTY_WEEK_LABELS, MEDIA_KAKAO, UNNAMED_CAMPAIGN

MEDIA = ("google", "kakao")


def media_spend(unified: DataFrame, start, end) -> DataFrame:
    """RB1 (pie) + WN1: cost per media over the range and its share."""
    f = in_range(unified, start, end)
    pie = f.groupBy("media").agg(round_half_even(money_sum("cost"), 0).alias("cost"))
    return with_share(pie, "cost", "share")


def daily_raw(unified: DataFrame, start, end) -> DataFrame:
    """Exact per-date sums of cost, impressions and clicks of each media (one
    aggregate keyed by date; JN4 as conditional sums, no join)."""
    return by_date_and_media(in_range(unified, start, end), ["cost", "impressions", "clicks"], MEDIA)


def daily_from_raw(raw: DataFrame) -> DataFrame:
    """RB2 + RB4 / AG8 from the exact per-date sums: costs rounded half-even,
    row totals added."""
    g_cost = round_half_even("google_cost", 0)
    k_cost = round_half_even("kakao_cost", 0)
    cnt = {c: F.col(c).cast("bigint")
           for c in ["google_impressions", "google_clicks", "kakao_impressions", "kakao_clicks"]}
    return raw.select(
        "report_date",
        g_cost.alias("google_cost"), k_cost.alias("kakao_cost"),
        (g_cost + k_cost).alias("total_cost"),
        *[v.alias(k) for k, v in cnt.items()],
        (cnt["google_impressions"] + cnt["kakao_impressions"]).alias("total_impressions"),
        (cnt["google_clicks"] + cnt["kakao_clicks"]).alias("total_clicks"))


def daily_table(unified: DataFrame, start, end) -> DataFrame:
    """RB2 + RB4 (line + table datasets) and AG8: one row per date with the
    cost, impressions and clicks of each media and the row totals."""
    return daily_from_raw(daily_raw(unified, start, end))


def pie_from_raw(raw: DataFrame) -> DataFrame:
    """RB1 pie from the exact per-date sums (sum of exact sums, then
    rounding): one row per media, with its share."""
    t = raw.agg(F.sum("google_cost").alias("g"), F.sum("kakao_cost").alias("k"))
    pie = t.selectExpr("stack(2, 'google', g, 'kakao', k) AS (media, cost)")
    return with_share(pie.select("media", round_half_even(F.coalesce(F.col("cost"), F.lit(0)), 0).alias("cost")),
                      "cost", "share")


def summary_sheet(unified: DataFrame, start, end, month_start=None, month_end=None) -> dict[str, DataFrame]:
    """RB5: KPI block, media share and the week block. The pie and the daily
    table are sums of the same per-date aggregate; a block that needs both
    reads it twice unless Spark reuses its shuffle (``kpi_of_range`` takes
    the KPI block from it in one pass)."""
    raw = daily_raw(unified, start, end)
    table = daily_from_raw(raw)
    pie = pie_from_raw(raw)
    weeks_table = table if month_start is None else daily_table(unified, month_start, month_end)
    return {"kpi": kpi(pie, table), "media_share": pie, "weeks": week_of_month(weeks_table)}


DAILY_SUMS = ["google_cost", "kakao_cost", "total_cost", "google_impressions", "google_clicks",
              "kakao_impressions", "kakao_clicks", "total_impressions", "total_clicks"]


def daily_sheet(unified: DataFrame, start, end) -> DataFrame:
    """RB6: the daily table with its totals row (AG9)."""
    return with_totals(daily_table(unified, start, end), ["report_date"], DAILY_SUMS)


def kpi(pie: DataFrame, table: DataFrame, by: tuple[str, ...] = (), reports: DataFrame | None = None) -> DataFrame:
    """AG6 / RB5 KPI block: metric, value (per ``by`` keys, e.g. a report).

    Media costs come from the first pie row of each media (by ``pos``, where
    the pie has one); when both are 0 they come from the table sums. Built as
    one aggregate over the union of the inputs (no join). ``reports`` lists
    the keys that get a block even without any dataset (zeros)."""
    keys = [F.col(k) for k in by]
    pos = F.col("pos").cast("bigint") if "pos" in pie.columns else F.lit(0).cast("bigint")
    pie_part = pie.select(
        *keys, F.col("cost").alias("pie_cost"),
        F.when(F.col("media") == "google", pos).alias("g_pos"), F.when(F.col("media") == "kakao", pos).alias("k_pos"))
    tab_part = table.select(
        *keys,
        F.col("google_cost").cast("double").alias("g_tab"), F.col("kakao_cost").cast("double").alias("k_tab"),
        F.col("google_impressions").alias("g_imp"), F.col("google_clicks").alias("g_click"),
        F.col("kakao_impressions").alias("k_imp"), F.col("kakao_clicks").alias("k_click"))
    both = pie_part.unionByName(tab_part, allowMissingColumns=True)
    if reports is not None:
        both = both.unionByName(reports.select(*keys), allowMissingColumns=True)
    exact = lambda c: F.coalesce(money_sum(c).cast("double"), F.lit(0.0)).alias(c)
    s = both.groupBy(*by).agg(
        F.coalesce(F.min_by("pie_cost", "g_pos"), F.lit(0.0)).alias("g_pie"),
        F.coalesce(F.min_by("pie_cost", "k_pos"), F.lit(0.0)).alias("k_pie"), exact("g_tab"), exact("k_tab"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ["g_imp", "g_click", "k_imp", "k_click"]])
    return _kpi_rows(s, by)


def _kpi_rows(s: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Metric rows from the pie costs (``g_pie``, ``k_pie``) and table sums."""
    keys = [F.col(k) for k in by]
    use_tab = (F.col("g_pie") == 0) & (F.col("k_pie") == 0)
    g_cost = F.when(use_tab, F.col("g_tab")).otherwise(F.col("g_pie"))
    k_cost = F.when(use_tab, F.col("k_tab")).otherwise(F.col("k_pie"))
    imp = F.col("g_imp") + F.col("k_imp")
    clk = F.col("g_click") + F.col("k_click")
    wide = s.select(*keys, (g_cost + k_cost).alias("total_cost"), imp.cast("double").alias("total_impressions"),
                    clk.cast("double").alias("total_clicks"), ratio_half_up(clk, imp, 4).alias("avg_ctr"),
                    g_cost.alias("google_cost"), k_cost.alias("kakao_cost"))
    names = [c for c in wide.columns if c not in by]
    stack = "stack({}, {}) AS (metric, value)".format(
        len(names), ", ".join(f"'{n}', {n}" for n in names))
    return wide.selectExpr(*[f"`{k}`" for k in by], stack)


def kpi_of_range(unified: DataFrame, start, end) -> DataFrame:
    """RB5 KPI block of the fact tables in one scan: the per-date sums give the
    pie (rounded sums) and the table (sums of rounded days) in one aggregate."""
    day = daily_raw(unified, start, end)
    even = lambda c: round_half_even(F.coalesce(F.col(c), F.lit(0)), 0)
    s = day.agg(
        round_half_even(F.coalesce(F.sum("google_cost"), F.lit(0)), 0).alias("g_pie"),
        round_half_even(F.coalesce(F.sum("kakao_cost"), F.lit(0)), 0).alias("k_pie"),
        F.coalesce(F.sum(even("google_cost")), F.lit(0.0)).alias("g_tab"),
        F.coalesce(F.sum(even("kakao_cost")), F.lit(0.0)).alias("k_tab"),
        *[F.coalesce(F.sum(F.col(c).cast("bigint")), F.lit(0)).alias(n) for c, n in
          (("google_impressions", "g_imp"), ("google_clicks", "g_click"),
           ("kakao_impressions", "k_imp"), ("kakao_clicks", "k_click"))])
    return _kpi_rows(s)


def week_of_month(table: DataFrame, n: int = 5, by: tuple[str, ...] = (),
                  pos: str = "report_date", reports: DataFrame | None = None) -> DataFrame:
    """AG7 + TK4 + WN2: weekly totals by ``M월 N주차`` label (no year, as in
    the reference, Q15); the first ``n`` labels in first-seen order (``pos``);
    share of total cost over the shown weeks. Five zero rows W1..W5 when
    there are no rows. Per ``by`` keys (e.g. one report) when given: then
    the first-n cut ranks labels within a key, a handful of rows each;
    ``reports`` lists the keys that get the five zero rows when they have
    none. Labels come from ``date_text`` where the table has it (a document's
    own text), else from ``report_date``."""
    text = F.col("date_text") if "date_text" in table.columns else dashed_date_text("report_date")
    t = table.select(*by, week_of_month_label(text).alias("week_label"),
                     F.col(pos).alias("_pos"), "report_date",
                     "google_cost", "kakao_cost", "google_clicks", "kakao_clicks")
    g = t.groupBy(*by, "week_label").agg(
        money_sum("google_cost").cast("double").alias("google_cost"),
        money_sum("kakao_cost").cast("double").alias("kakao_cost"),
        F.sum("google_clicks").cast("double").alias("google_clicks"),
        F.sum("kakao_clicks").cast("double").alias("kakao_clicks"),
        F.min("_pos").alias("first_pos"), F.min("report_date").alias("first_date"))
    if by:
        w = Window.partitionBy(*by).orderBy(F.col("first_pos").asc_nulls_last(), F.col("week_label"))
        shown = g.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")
        rows = shown
        if reports is not None:
            none = reports.select(*by).distinct().join(table.select(*by).distinct(), list(by), "left_anti")
            zero = none.select(*by, F.explode(F.array(*[F.lit(w) for w in EMPTY_WEEK_LABELS])).alias("week_label"),
                               *[F.lit(0.0).alias(c) for c in ["google_cost", "kakao_cost", "google_clicks",
                                                               "kakao_clicks"]])
            rows = rows.unionByName(zero, allowMissingColumns=True)
    else:
        shown = first_groups(g, "first_pos", n)
        spark = table.sparkSession
        labels = F.array(*[F.lit(w) for w in EMPTY_WEEK_LABELS])
        empty = spark.range(1).select(F.explode(labels).alias("week_label")).select(
            "week_label", *[F.lit(0.0).alias(c) for c in ["google_cost", "kakao_cost", "google_clicks",
                                                          "kakao_clicks"]],
            F.lit(None).cast(g.schema["first_pos"].dataType).alias("first_pos"),
            F.lit(None).cast("date").alias("first_date"))
        # Defaults are kept only when there is no real row (a bounded frame:
        # at most n + 5 rows).
        marked = shown.withColumn("_real", F.lit(1)).unionByName(empty.withColumn("_real", F.lit(0)))
        rows = (marked.withColumn("_any", F.max("_real").over(Window.partitionBy()))
                      .filter(F.col("_real") == F.col("_any")).drop("_real", "_any"))
    rows = rows.select(*by, "week_label", "google_cost", "kakao_cost",
                       (F.col("google_cost") + F.col("kakao_cost")).alias("total_cost"),
                       "google_clicks", "kakao_clicks",
                       (F.col("google_clicks") + F.col("kakao_clicks")).alias("total_clicks"),
                       "first_date").drop("first_pos")
    return with_share(rows, "total_cost", "share", within=tuple(by))


def week_over_week(unified: DataFrame, this_start, this_end, prev_start, prev_end) -> DataFrame:
    """WN4: this week, the week before, change and change rate per metric.
    One scan of both weeks with conditional sums (no self-join)."""
    s = this_start if not isinstance(this_start, str) else F.lit(this_start).cast("date")
    f = in_range(unified, prev_start, this_end)
    is_this = F.col("report_date") >= s
    out = []
    for wk, cond in (("this", is_this), ("prev", ~is_this)):
        for media in MEDIA:
            m = cond & (F.col("media") == media)
            out.append(F.sum(F.when(m, F.col("cost"))).alias(f"{wk}_{media}_cost"))
        out.append(F.sum(F.when(cond, F.col("impressions"))).alias(f"{wk}_impressions"))
        out.append(F.sum(F.when(cond, F.col("clicks"))).alias(f"{wk}_clicks"))
    a = f.agg(*out)
    cols = []
    for wk in ("this", "prev"):
        g = round_half_even(F.coalesce(F.col(f"{wk}_google_cost"), F.lit(0)), 0)
        k = round_half_even(F.coalesce(F.col(f"{wk}_kakao_cost"), F.lit(0)), 0)
        cols += [(g + k).alias(f"{wk}_total_cost"), g.alias(f"{wk}_google_cost"), k.alias(f"{wk}_kakao_cost"),
                 F.coalesce(F.col(f"{wk}_impressions"), F.lit(0)).cast("double").alias(f"{wk}_total_impressions"),
                 F.coalesce(F.col(f"{wk}_clicks"), F.lit(0)).cast("double").alias(f"{wk}_total_clicks")]
    w = a.select(*cols)
    metrics = ["total_cost", "google_cost", "kakao_cost", "total_impressions", "total_clicks"]
    stack = "stack({}, {}) AS (metric, this_week, prev_week)".format(
        len(metrics), ", ".join(f"'{m}', this_{m}, prev_{m}" for m in metrics))
    return (w.selectExpr(stack)
             .withColumn("change", F.col("this_week") - F.col("prev_week"))
             .withColumn("change_rate", safe_div(F.col("change"), F.col("prev_week"))))


def campaign_detail(google: DataFrame, start, end) -> DataFrame:
    """RB3 (bar dataset) with the sheet ratios (SC4): CTR 0 when no
    impressions; CPC and ROAS NULL (shown '-') when the divisor is 0."""
    f = in_range(google, start, end)
    g = f.groupBy("camp_name").agg(
        count_sum("impressions").alias("impressions"), count_sum("clicks").alias("clicks"),
        round_half_even(F.sum(F.col("cost_micros").cast("decimal(38,0)")) / F.lit(1000000), 0).alias("cost"),
        count_sum("conversions").alias("conversions"),
        round_half_even(money_sum("conversions_value"), 0).alias("conv_value"))
    return g.select(
        F.coalesce(F.col("camp_name"), F.lit(UNNAMED_CAMPAIGN)).alias("campaign"),
        "impressions", "clicks", div_or_zero("clicks", "impressions").alias("ctr"),
        "cost", safe_div("cost", "clicks").alias("cpc"),
        "conversions", "conv_value", safe_div("conv_value", "cost").alias("roas"))


def google_sheet(google: DataFrame, start, end) -> DataFrame:
    """RB7: campaign rows plus a totals row summing counts and money only."""
    d = campaign_detail(google, start, end)
    return with_totals(d, ["campaign"], ["impressions", "clicks", "cost", "conversions", "conv_value"],
                       keep=["ctr", "cpc", "roas"])


def kakao_campaigns(facts: DataFrame, master: DataFrame, start, end, seq: str = "seq") -> DataFrame:
    """Kakao per-campaign sums for the range: keyword totals joined to the
    de-duplicated master, then summed per campaign."""
    per_kwd = kakao_keyword_totals(facts, start, end)
    m = latest_master(master, seq).select("kwd_id", "camp_name")
    return (per_kwd.join(m, on="kwd_id", how="left").groupBy("camp_name")
                   .agg(count_sum("imp").alias("impressions"), count_sum("click").alias("clicks"),
                        round_half_even(money_sum("spending"), 0).alias("cost")))


def kakao_sheet(facts: DataFrame, master: DataFrame, start, end) -> DataFrame:
    """RB8: campaign rows with CTR, CPC, CPM and a totals row. (The reach
    column has no source and is left out.)"""
    c = kakao_campaigns(facts, master, start, end)
    d = c.select(F.coalesce(F.col("camp_name"), F.lit(UNNAMED_CAMPAIGN)).alias("campaign"),
                 "impressions", "clicks", div_or_zero("clicks", "impressions").alias("ctr"),
                 "cost", safe_div("cost", "clicks").alias("cpc"),
                 safe_div(F.col("cost") * 1000, F.col("impressions")).alias("cpm"))
    return with_totals(d, ["campaign"], ["impressions", "clicks", "cost"], keep=["ctr", "cpc", "cpm"])


def daily_totals(line: DataFrame, table: DataFrame, by: tuple[str, ...] = ("report_id",)) -> DataFrame:
    """JN2 + AG8 (RB6 from a document): costs per date summed from the line
    rows (rows without a date skipped), impressions and clicks from the table
    row of the same date (the last one wins; none gives 0), values rounded
    half-even, row totals added, dates ascending."""
    costs = (line.filter(F.coalesce(F.col("date_text"), F.lit("")) != "")
                 .groupBy(*by, "date_text")
                 .agg(money_sum("google_cost").cast("double").alias("google_cost"),
                      money_sum("kakao_cost").cast("double").alias("kakao_cost")))
    counts = ["google_impressions", "google_clicks", "kakao_impressions", "kakao_clicks"]
    t = table.filter(F.coalesce(F.col("date_text"), F.lit("")) != "").select(*by, "date_text", "pos", *counts)
    j = daily_lookup(costs, t, key=[*by, "date_text"] if by else "date_text", seq="pos",
                     fill={c: 0.0 for c in counts})
    r = {c: round_half_even(c, 0) for c in ["google_cost", "kakao_cost", *counts]}
    return j.select(*by, F.col("date_text").alias("date"), *[v.alias(k) for k, v in r.items()],
                    (r["google_cost"] + r["kakao_cost"]).alias("total_cost"),
                    (r["google_impressions"] + r["kakao_impressions"]).alias("total_impressions"),
                    (r["google_clicks"] + r["kakao_clicks"]).alias("total_clicks"))


def daily_sheet_from_documents(line: DataFrame, table: DataFrame, by: tuple[str, ...] = ("report_id",)) -> DataFrame:
    """RB6 from report documents: the daily table of each report with that
    report's totals row."""
    return with_totals(daily_totals(line, table, by), ["date"], DAILY_SUMS, within=by)


def google_sheet_from_documents(bar: DataFrame, by: tuple[str, ...] = ("report_id",)) -> DataFrame:
    """RB7 from report documents: one row per bar dataset row (campaign names
    may repeat), cost and value rounded half-even, CTR 0 without
    impressions, CPC / ROAS NULL ('-') without clicks / cost, and a totals
    row per report summing counts and money only."""
    d = bar.select(*by, "pos", "campaign", "impressions", "clicks",
                   round_half_even("cost", 0).alias("cost"), "conversions",
                   round_half_even("conv_value", 0).alias("conv_value"))
    d = d.select("*", div_or_zero("clicks", "impressions").alias("ctr"), safe_div("cost", "clicks").alias("cpc"),
                 safe_div("conv_value", "cost").alias("roas"))
    return with_totals(d, ["pos"], ["impressions", "clicks", "cost", "conversions", "conv_value"],
                       keep=["campaign", "ctr", "cpc", "roas"], within=by)


def kakao_sheet_from_documents(pie: DataFrame, listing: DataFrame, all_reports: DataFrame | None = None) -> DataFrame:
    """RB8 from report documents (what the reference fills): the kakao total
    taken from the first kakao pie row (JN3; 0 when there is none) and, when
    the pie has at least two rows, every pie row with its name (AG10 default
    ``매체N``) and rounded cost. ``all_reports`` adds reports without a pie."""
    kakao = (pie.filter(F.col("media") == "kakao").groupBy("report_id")
                .agg(F.min_by(F.col("cost"), F.col("pos")).alias("cost")))
    reports = pie.groupBy("report_id").agg(F.count(F.lit(1)).alias("n_rows"))
    every = reports.select("report_id") if all_reports is None else all_reports.select("report_id").distinct()
    total = (every.join(kakao, "report_id", "left")
                    .select("report_id", F.lit("kakao_total").alias("row_type"), F.lit(MEDIA_KAKAO).alias("media_name"),
                            round_half_even(F.coalesce(F.col("cost"), F.lit(0.0)), 0).alias("cost"),
                            F.lit(None).cast("int").alias("pos")))
    listed = (listing.join(reports.filter(F.col("n_rows") >= 2).select("report_id"), "report_id", "left_semi")
                     .select("report_id", F.lit("media").alias("row_type"), "media_name",
                             round_half_even("cost", 0).alias("cost"), "pos"))
    return total.unionByName(listed)


def media_share_block(kpi_rows: DataFrame, by: tuple[str, ...] = ("report_id",)) -> DataFrame:
    """RB5 media block: google and kakao cost of the week (after the KPI
    fallback), rounded half-even, and each one's share (WN1)."""
    m = kpi_rows.filter(F.col("metric").isin("google_cost", "kakao_cost")).select(
        *by, F.regexp_replace("metric", "_cost$", "").alias("media"),
        round_half_even("value", 0).alias("cost"))
    return with_share(m, "cost", "share", within=by)


def week_over_week_as_of(unified: DataFrame, as_of, tz: str = "Asia/Seoul") -> DataFrame:
    """WN4 with the SURVEY signature: the week before ``as_of`` (in ``tz``)
    against the week before that."""
    from ..functions.dates import last_week
    s, e = last_week(as_of, tz)
    return week_over_week(unified, s, e, F.date_sub(s, 7), F.date_sub(s, 1))
