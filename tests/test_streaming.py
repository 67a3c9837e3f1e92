"""Streams give the batch result; duplicates and untimed rows."""

import json
import os

from adlens.session import scratch_path
from adlens.sources.readers import scan_table
from adlens.streaming import jobs


def _land(path, messages):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/m.json", "w") as f:
        for m in messages:
            f.write(json.dumps(m) + "\n")


def test_dead_letter_counts_stream(spark):
    landing = scratch_path(spark, "t_queue")
    base = 1704067200000
    msgs = [
        {"message_id": "1", "body": '{"platform": "google"}', "attributes": {"SentTimestamp": str(base + 1000)}},
        {"message_id": "1", "body": '{"platform": "google"}', "attributes": {"SentTimestamp": str(base + 1000)}},
        {"message_id": "2", "body": "not json", "attributes": {"SentTimestamp": str(base + 2000),
                                                              "ApproximateReceiveCount": "3"}},
        {"message_id": "3", "body": '{"k": 1}', "attributes": {"SentTimestamp": str(base + 400000)}},
        {"message_id": "4", "body": '{"platform": "kakao"}', "attributes": {}},
    ]
    _land(landing, msgs)
    sink, ckpt = scratch_path(spark, "t_sink"), scratch_path(spark, "t_ckpt")
    jobs.run_update_stream(jobs.dead_letter_counts(jobs.queue_stream(spark, landing)), sink, ckpt).awaitTermination()
    got = sorted(tuple(r) for r in jobs.read_latest(spark, sink, ["window_start_ms", "window_end_ms", "platform"])
                 .select("window_start_ms", "platform", "n").collect())
    assert got == [(base, "google", 1), (base, "unknown", 1), (base + 300000, "unknown", 1)]
    untimed = jobs.untimed_counts(spark.read.schema(jobs.QUEUE_MESSAGE).json(landing)).collect()
    assert [tuple(r) for r in untimed] == [("kakao", 1)]


def test_late_and_redelivered_messages_over_several_batches(spark):
    """A message days older than the newest one, in a later micro-batch, is
    still counted; one delivered again is not counted twice, timed or not."""
    landing = scratch_path(spark, "t_queue")
    base = 1704067200000
    one = {"message_id": "1", "body": '{"platform": "google"}', "attributes": {"SentTimestamp": str(base)}}
    new = {"message_id": "2", "body": '{"platform": "google"}', "attributes": {"SentTimestamp": str(base + 4 * 86400000)}}
    bare = {"message_id": "3", "body": '{"platform": "kakao"}', "attributes": {}}
    for n, msgs in enumerate(([new, bare], [one], [one, new, bare])):
        _land(f"{landing}/{n}", msgs)
    stream = lambda: jobs.queue_stream(spark, f"{landing}/*", max_files=1)
    sink, ckpt = scratch_path(spark, "t_sink"), scratch_path(spark, "t_ckpt")
    jobs.run_update_stream(jobs.dead_letter_counts(stream()), sink, ckpt).awaitTermination()
    keys = ["window_start_ms", "window_end_ms", "platform"]
    got = sorted((r.window_start_ms, r.n) for r in jobs.read_latest(spark, sink, keys).collect())
    assert got == [(base, 1), (base + 4 * 86400000, 1)]
    small = scratch_path(spark, "t_small")
    jobs.compact_sink(spark, sink, keys, small)
    assert sorted((r.window_start_ms, r.n) for r in jobs.read_latest(spark, small, keys).collect()) == got
    sink, ckpt = scratch_path(spark, "t_sink"), scratch_path(spark, "t_ckpt")
    jobs.run_update_stream(jobs.untimed_counts(stream()), sink, ckpt).awaitTermination()
    assert [(r.platform, r.n) for r in jobs.read_latest(spark, sink, ["platform"]).collect()] == [("kakao", 1)]


def test_route_stream_quarantines(spark):
    landing = scratch_path(spark, "t_queue")
    _land(landing, [{"message_id": "1", "body": '{"platform": "kakao"}'},
                    {"message_id": "2", "body": "oops"}])
    routed, ckpt = (scratch_path(spark, n) for n in ("r", "c"))
    jobs.route_stream(jobs.queue_stream(spark, landing), routed, ckpt).awaitTermination()
    got = sorted((r.message_id, r.receive_count, r.route) for r in spark.read.parquet(routed).collect())
    assert got == [("1", "unknown", "good"), ("2", "unknown", "quarantine")]


def _google(day, imp):
    return {"results": [{"campaign": {"name": "c"}, "adGroupCriterion": {"criterionId": "k"},
                         "segments": {"date": day}, "metrics": {"impressions": str(imp)}}]}


def test_ingest_stream_newest_run_stays_whatever_the_order(spark):
    landing = scratch_path(spark, "t_landing")
    table, state, bad = (scratch_path(spark, n) for n in ("t_table", "t_state", "t_bad"))

    def finish(run):
        jobs.finish_run(spark, f"{landing}/manifests", run, f"{landing}/run={run}/*")

    def ingest():
        jobs.ingest_stream(spark, f"{landing}/manifests", "google", table, state, bad, max_files=1).awaitTermination()
        return sorted((r.day, r.impressions) for r in scan_table(spark, table, "google").collect())

    _land(f"{landing}/run=10/date=2024-03-05", [_google("2024-03-05", 7)])
    finish(10)
    assert ingest() == [("05", 7)]
    # an older run of two days, in two files, arrives later; one row has no date
    _land(f"{landing}/run=9/date=2024-03-04", [_google("2024-03-04", 1)])
    _land(f"{landing}/run=9/date=2024-03-05", [_google("2024-03-05", 2), _google("junk", 3)])
    assert ingest() == [("05", 7)]                       # not complete: nothing happens
    finish(9)
    assert ingest() == [("04", 1), ("05", 7)]
    assert [r.impressions for r in spark.read.parquet(f"{bad}/run=9").collect()] == [3]
    _land(f"{landing}/run=11/date=2024-03-04", [_google("2024-03-04", 5)])
    finish(11)
    assert ingest() == [("04", 5), ("05", 7)]
    # a run replayed after a failure changes nothing
    jobs.ingest_run(spark, "google", 9, f"{landing}/run=9/*", table, f"{state}/days", bad)
    assert sorted((r.day, r.impressions) for r in scan_table(spark, table, "google").collect()) == [("04", 5), ("05", 7)]


def test_ingest_stream_kakao_skips_failed_accounts_and_enriches(spark):
    landing = scratch_path(spark, "t_landing_k")
    table, state, bad = (scratch_path(spark, n) for n in ("t_table_k", "t_state_k", "t_bad_k"))
    ok = {"account_id": "A", "date": "2024-03-05", "ok": True,
          "data": [{"keywordId": " k1 ", "adGroupId": "g", "metrics": {"imp": "3.9", "spending": "2.5"}}]}
    failed = {"account_id": "B", "date": "2024-03-05", "ok": False,
              "data": [{"keywordId": "k2", "metrics": {"imp": "4"}}]}
    _land(f"{landing}/run=1", [ok, failed])
    jobs.finish_run(spark, f"{landing}/manifests", 1, f"{landing}/run=1")
    master = spark.createDataFrame([("k1", "camp")], "kwd_id string, camp_name string")
    jobs.ingest_stream(spark, f"{landing}/manifests", "kakao", table, state, bad, master=master).awaitTermination()
    rows = scan_table(spark, table, "kakao").collect()
    assert [(r.kwd_id, r.adv_id, r.imp, r.spending, r.basic_date, r.day, r.camp_name) for r in rows] == \
        [("k1", "A", 3, 2.5, "20240305", "05", "camp")]
