"""Report documents: dataset choice, texts, dataset rows; remaining helpers."""

import datetime as dt

from pyspark.sql import functions as F

from adlens.operators import aggregates as agg
from adlens.operators import documents
from adlens.operators.sets import concat_accounts
from adlens.operators.topk import order_by
from adlens.schemas import REPORT_DOCUMENT
from adlens.sinks import tables as sinks
from adlens.sources import readers


def _doc(spark, messages):
    return spark.createDataFrame([("r1", "t", "2024-03-05T10:00:00", messages)],
                                 "report_id string, " + REPORT_DOCUMENT.simpleString()[7:-1])


def test_last_non_empty_dataset_per_chart_type(spark):
    msgs = [
        ("user", "q", None, None),
        ("assistant", "first text", None, None),
        ("assistant", "", "pie", [{"매체": "구글", "광고비(원)": "1"}]),
        ("assistant", "", "pie", [{"매체": "구글", "광고비(원)": "5"}, {"매체": "카카오", "광고비(원)": "-"}]),
        ("assistant", "", "pie", []),
        ("assistant", "", "map", [{"x": "y"}]),
        ("assistant", "second text", None, None),
        ("assistant", "", None, None),
    ]
    docs = _doc(spark, msgs)
    sets = {r.chart_type: (r.message_pos, len(r.rows)) for r in documents.datasets(docs).collect()}
    assert sets == {"pie": (3, 2)}
    assert documents.texts(docs).first().texts == ["first text", "second text"]
    pie = sorted((r.media, r.cost) for r in documents.pie_rows(documents.datasets(docs)).collect())
    assert pie == [("google", 5.0), ("kakao", 0.0)]


def test_table_rows_lenient(spark):
    msgs = [("assistant", "", "table", [{"날짜": "2024-03-05", "구글 클릭": "3", "카카오 클릭": ""},
                                       {"날짜": "bad", "구글 클릭": "x"}])]
    rows = documents.table_rows(documents.datasets(_doc(spark, msgs))).orderBy("pos").collect()
    assert [(r.report_date, r.google_clicks, r.kakao_clicks) for r in rows] == \
        [(dt.date(2024, 3, 5), 3.0, 0.0), (None, 0.0, 0.0)]


def test_read_report_docs_id_from_file_name(spark, tmp_dir):
    import json
    import os
    os.makedirs(tmp_dir, exist_ok=True)
    with open(f"{tmp_dir}/abc-123.json", "w") as f:
        json.dump({"title": "t", "createdAt": "2024-03-05T10:00:00", "messages": [
            {"role": "assistant", "content": "hi"}]}, f, indent=2)
    d = readers.read_report_docs(spark, tmp_dir).first()
    assert d.report_id == "abc-123" and d.messages[0].content == "hi"


def test_observed_counts_without_extra_job(spark):
    df, obs = agg.observed(spark.range(10), "stage")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 10


def test_concat_accounts_and_order_by(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 5)], "id int, b int")
    out = concat_accounts([a, b])
    assert sorted(out.columns) == ["a", "b", "id"] and out.count() == 2
    assert [r.id for r in order_by(out, "id", descending=True).collect()] == [2, 1]


def test_append_report(spark, tmp_dir):
    from adlens.operators.lookups import report_row
    r = spark.createDataFrame([("r1", dt.datetime(2024, 1, 1))], "report_id string, created_at timestamp_ntz")
    sinks.append_report(report_row(r), tmp_dir)
    sinks.append_report(report_row(r.withColumn("report_id", F.lit("r2"))), tmp_dir)
    got = sorted((x.report_id, x.expires_at) for x in spark.read.parquet(tmp_dir).collect())
    assert got == [("r1", dt.datetime(2024, 3, 31)), ("r2", dt.datetime(2024, 3, 31))]


def test_saved_report_gets_an_id_and_a_rerun_adds_nothing(spark, tmp_dir):
    from adlens.operators.lookups import report_row
    r = spark.createDataFrame([("u1", "weekly", dt.date(2024, 3, 4), dt.date(2024, 3, 10)),
                               ("u2", "weekly", dt.date(2024, 3, 4), dt.date(2024, 3, 10))],
                              "user_id string, type string, period_start date, period_end date")
    for as_of in ("2024-03-11 00:00:00", "2024-03-11 06:00:00"):
        sinks.append_report(report_row(r, as_of=as_of), tmp_dir)
    got = spark.read.parquet(tmp_dir).collect()
    assert len(got) == 2 and len({x.report_id for x in got}) == 2
    assert {x.created_at for x in got} == {dt.datetime(2024, 3, 11)}
    assert {x.expires_at for x in got} == {dt.datetime(2024, 6, 9)}


def test_daily_totals_from_documents(spark):
    from adlens.plans import sheets
    msgs = [
        ("assistant", "", "line", [{"날짜": "2024-03-05", "구글 광고비(원)": "10.4", "카카오 광고비(원)": "1"},
                                   {"날짜": "2024-03-05", "구글 광고비(원)": "0.2"},
                                   {"날짜": "2024-03-06", "카카오 광고비(원)": "2.5"},
                                   {"날짜": "", "구글 광고비(원)": "99"}]),
        ("assistant", "", "table", [{"날짜": "2024-03-05", "구글 클릭": "1"}, {"날짜": "2024-03-05", "구글 클릭": "4"}]),
    ]
    sets = documents.datasets(_doc(spark, msgs))
    out = sheets.daily_sheet_from_documents(documents.line_rows(sets), documents.table_rows(sets)).collect()
    rows = {r.date: (r.google_cost, r.kakao_cost, r.total_cost, r.google_clicks, r.row_type) for r in out}
    assert rows == {"2024-03-05": (11.0, 1.0, 12.0, 4.0, "detail"),
                    "2024-03-06": (0.0, 2.0, 2.0, 0.0, "detail"),
                    None: (11.0, 3.0, 14.0, 4.0, "total")}


def test_kakao_sheet_from_documents(spark):
    from adlens.plans import sheets
    one = [("assistant", "", "pie", [{"매체": "구글", "광고비(원)": "10"}])]
    sets = documents.datasets(_doc(spark, one))
    rows = [tuple(r) for r in sheets.kakao_sheet_from_documents(documents.pie_rows(sets),
                                                                documents.pie_listing(sets)).collect()]
    assert rows == [("r1", "kakao_total", "카카오", 0.0, None)]
    two = [("assistant", "", "pie", [{"광고비(원)": "2.5"}, {"매체": "카카오", "광고비(원)": "7.5"}])]
    sets = documents.datasets(_doc(spark, two))
    rows = sorted(tuple(r) for r in sheets.kakao_sheet_from_documents(
        documents.pie_rows(sets), documents.pie_listing(sets)).collect())
    assert rows == [("r1", "kakao_total", "카카오", 8.0, None), ("r1", "media", "매체1", 2.0, 0),
                    ("r1", "media", "카카오", 8.0, 1)]
