"""Column helpers: the edge rows of FIXTURES.md section 5."""

import datetime as dt

from pyspark.sql import functions as F

from adlens.functions import casts, dates, json_fields, ratios


def col_values(spark, values, typ, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_mixed_date_text(spark):
    got = col_values(spark, ["20240305", "2024-03-05", "2024-3-5", "20221399", "", None], "string",
                     dates.parse_report_date)
    d = dt.date(2024, 3, 5)
    assert got == [d, d, d, None, None, None]


def test_new_year_week_does_not_select_later_rows(spark):
    df = spark.createDataFrame([(dt.date(2024, 11, 5),), (dt.date(2024, 1, 1),)], "report_date date")
    got = [r[0] for r in dates.in_range(df, "2023-12-25", "2024-01-02").collect()]
    assert got == [dt.date(2024, 1, 1)]


def test_last_week_depends_on_time_zone(spark):
    as_of = "2024-03-10 23:00:00"
    kst = dates.last_week(as_of, "Asia/Seoul")
    utc = dates.last_week(as_of, "UTC")
    r = spark.range(1).select(kst[0], kst[1], utc[0], utc[1]).first()
    assert r[0] == dt.date(2024, 3, 4) and r[1] == dt.date(2024, 3, 10)
    assert r[2] == dt.date(2024, 2, 26) and r[3] == dt.date(2024, 3, 3)


def test_last_week_ignores_session_time_zone(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        s, _ = dates.last_week("2024-03-10 23:00:00", "Asia/Seoul")
        assert spark.range(1).select(s).first()[0] == dt.date(2024, 3, 4)
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_yesterday(spark):
    assert spark.range(1).select(dates.yesterday("2024-03-10 23:00:00")).first()[0] == dt.date(2024, 3, 10)


def test_bulk_integer_text_half_even(spark):
    got = col_values(spark, ["2.5", "3.5", "x", "1,234", " 12 ", "", "NaN"], "string", casts.long_half_even)
    assert got == [2, 4, None, None, 12, None, None]


def test_batch_integer_truncates_missing_zero(spark):
    assert col_values(spark, ["2.7", None], "string", casts.long_trunc_or_zero) == [2, 0]


def test_lenient_number(spark):
    assert col_values(spark, [None, "", "-", "abc", "7"], "string", casts.safe_float) == [0.0, 0.0, 0.0, 0.0, 7.0]


def test_double_or_null_nan(spark):
    assert col_values(spark, ["1.5", "NaN", "x"], "string", casts.double_or_null) == [1.5, None, None]


def test_text_or_empty_and_as_text(spark):
    assert col_values(spark, [None, 5], "bigint", casts.text_or_empty) == ["", "5"]
    df = spark.createDataFrame([(None, 1.5)], "a string, b double")
    assert casts.all_as_text(df).first() == ("", "1.5")


def test_pct_half_up_exact(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (5, 0), (1, 200)], "c long, i long")
    got = [r[0] for r in df.select(ratios.pct_half_up("c", "i")).collect()]
    assert got == [12.5, 33.33, None, 0.5]


def test_safe_div_and_div_or_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(ratios.safe_div("a", "b")).collect()] == [None, 1.5]
    assert [r[0] for r in df.select(ratios.div_or_zero("a", "b")).collect()] == [0.0, 1.5]


def test_half_up_vs_half_even(spark):
    df = spark.createDataFrame([("2.5",), ("3.5",)], "x string").select(F.col("x").cast("decimal(10,2)").alias("x"))
    assert [r[0] for r in df.select(ratios.round_half_up("x")).collect()] == [3.0, 4.0]
    assert [r[0] for r in df.select(ratios.round_half_even("x")).collect()] == [2.0, 4.0]


def test_week_of_month_label(spark):
    got = col_values(spark, ["2024-03-15", "2024-03-01", "abc", "", None], "string", dates.week_of_month_label)
    assert got == ["3월 3주차", "3월 1주차", "abc", "기타", "기타"]


def test_epoch_ms_text(spark):
    got = col_values(spark, ["1704067207179", "x", None], "string", dates.epoch_ms_text_to_time)
    assert got == ["2024-01-01 00:00:07", "unknown", "unknown"]


def test_platform_of(spark):
    got = col_values(spark, ['{"platform": "google"}', "not json", '{"k": 1}', '{"platform": "naver"}', None],
                     "string", json_fields.platform_of)
    assert got == ["google", "unknown", "unknown", "unknown", "unknown"]


def test_find_date(spark):
    df = spark.createDataFrame([({"a": "x", "b": "2024-03-05"},), ({"date": "d1"},), ({"basic_date": "b"},), ({},)],
                               "m map<string,string>")
    assert [r[0] for r in df.select(dates.find_date("m")).collect()] == ["2024-03-05", "d1", "b", "unknown"]


def test_display_date_and_expiry(spark):
    df = spark.createDataFrame([("2024-03-05T10:00:00",), ("bad text here",)], "t string")
    assert [r[0] for r in df.select(dates.display_date("t")).collect()] == ["2024년 03월 05일", "bad text h"]
    e = spark.range(1).select(dates.plus_days(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))).first()[0]
    assert e == dt.datetime(2024, 3, 31)


def test_message_platform_keeps_any_named_platform(spark):
    got = col_values(spark, ['{"platform": "naver"}', "not json", '{"k": 1}', '"text"', None], "string",
                     json_fields.message_platform)
    assert got == ["naver", "unknown", "unknown", "unknown", "unknown"]


def test_long_half_even_is_bround(spark):
    rows = ["0.5", "1.5", "2.5", "-0.5", "-1.5", "0.49999999999999994", "4503599627370497.5", "1e17", "9.3e18", "1e300", "NaN",
            "Infinity", "-0.2", "", "x", None]
    d = spark.createDataFrame([(r,) for r in rows], "t string")
    both = d.select(casts.long_half_even("t").alias("got"), F.bround(F.col("t").try_cast("double"), 0).try_cast("bigint").alias("want"))
    assert all(r.got == r.want for r in both.collect()) and both.first().got == 0
