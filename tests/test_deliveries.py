"""ST2 and ST4: no message is lost or counted twice, and state ends."""

import json
import os
import time

from adlens.session import existing, scratch_path
from adlens.streaming import deliveries as dl
from adlens.streaming import jobs

DAY = 86_400_000
BASE = 1704067200000


def land(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)


def message(i, platform, sent=None, received=None):
    at = {k: str(v) for k, v in (("SentTimestamp", sent), ("ApproximateFirstReceiveTimestamp", received)) if v is not None}
    return {"message_id": i, "body": json.dumps({"platform": platform}), "attributes": at}


def test_late_untimed_and_repeated_messages_over_batches(spark):
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("t_in", "t_out", "t_ckpt"))
    old, new = message("1", "google", BASE, BASE + 5), message("2", "google", BASE + 40 * DAY, BASE + 40 * DAY)
    late, bare = message("3", "kakao", BASE, BASE + 19 * DAY), message("4", "kakao")

    def run():
        q = dl.count_stream(jobs.queue_stream(spark, landing), sink, ckpt)
        q.awaitTermination()
        return q

    land(landing, "a", [new, bare, new])
    run()
    land(landing, "b", [old, late, bare, message(None, "google", BASE), message(None, "google", BASE + 1)])
    run()                                                 # a restart; 40 days behind the newest message
    land(landing, "c", [old, new, late, bare])
    q = run()
    got = sorted((r.window_start_ms or 0, r.platform, r.n) for r in dl.read_counts(spark, sink).collect())
    assert got == [(0, "kakao", 1), (BASE, "google", 1), (BASE + 40 * DAY, "google", 1)]
    told = dl.read_late(spark, sink).collect()   # without a time of receipt the arrival counts: years later
    assert sorted((r.message_id or "", r.platform) for r in told) == [("", "google"), ("", "google"), ("3", "kakao")]
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 6
    small = scratch_path(spark, "t_small")
    dl.compact_counts(spark, sink, small)
    assert sorted((r.window_start_ms or 0, r.platform, r.n) for r in dl.read_counts(spark, small).collect()) == got


def test_state_ends_by_arrival(spark):
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("t_in", "t_out", "t_ckpt"))
    sizes = []
    for n in range(4):
        land(landing, str(n), [message(f"{n}-{i}", "google", None if i % 2 else BASE) for i in range(50)])
        q = dl.count_stream(jobs.queue_stream(spark, landing), sink, ckpt, retention="1 second")
        q.awaitTermination()
        sizes.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(1.5)
    assert max(sizes) <= 100                              # of 200 messages
    counted = sum(r.n for r in dl.read_counts(spark, sink).collect())
    assert counted + dl.read_late(spark, sink).count() == 200


def delivery(i, receipt, at, ok, body="x"):
    return {"message_id": i, "body": body, "receipt": receipt, "received_ms": at, "ok": ok}


def test_three_receives_then_dead_letter(spark):
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("t_in", "t_out", "t_ckpt"))

    def run(**kw):
        q = dl.retry_stream(dl.delivery_stream(spark, landing), sink, ckpt, **kw)
        q.awaitTermination()
        return q

    def out():
        return sorted((r.message_id, r.route, r.receives) for r in dl.read_outcomes(spark, sink).collect())

    land(landing, "a", [delivery("bad", "r1", 1, False), delivery("slow", "s1", 1, False), delivery("good", "g1", 1, True),
                        delivery(None, "n", 1, True), delivery("none", None, 1, True)])
    run()
    assert out() == [("good", "good", 1)]
    land(landing, "b", [delivery("bad", "r1", 1, False), delivery("bad", "r2", 2, False), delivery("slow", "s2", 2, True),
                        delivery("good", "g1", 1, True), delivery("good", "g2", 9, False)])
    run()
    assert out() == [("good", "good", 1), ("slow", "good", 2)]
    land(landing, "c", [delivery("bad", "r3", 3, False), delivery("bad", "r2", 2, False)])
    run()
    land(landing, "d", [delivery("bad", "r4", 4, False), delivery("bad", "r5", 5, True), delivery("slow", "s3", 3, False)])
    run()
    assert out() == [("bad", "dead-letter", 3), ("good", "good", 1), ("slow", "good", 2)]


def test_all_receives_in_one_batch_count_in_their_order(spark):
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("t_in", "t_out", "t_ckpt"))
    land(landing, "a", [delivery("m", "3", 3, True), delivery("m", "1", 1, False), delivery("m", "2", 2, False),
                        *[delivery("k", str(i), i, i == 4) for i in (4, 2, 3, 1)]])
    dl.retry_stream(dl.delivery_stream(spark, landing), sink, ckpt).awaitTermination()
    assert sorted((r.message_id, r.route, r.receives) for r in dl.read_outcomes(spark, sink).collect()) == [
        ("k", "dead-letter", 3), ("m", "good", 3)]


def test_messages_nothing_is_heard_of_expire_once(spark):
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("t_in", "t_out", "t_ckpt"))
    state = []
    for n in range(4):
        land(landing, str(n), [delivery(f"m{n}", "1", n, False), delivery(f"ok{n}", "1", n, True)])
        q = dl.retry_stream(dl.delivery_stream(spark, landing), sink, ckpt, keep_ms=1000, slack="0 seconds")
        q.awaitTermination()
        state.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(1.5)
    got = sorted((r.message_id, r.route) for r in dl.read_outcomes(spark, sink).collect())
    assert got[:2] == [("m0", "expired"), ("m1", "expired")] and max(state) <= 6
    assert len({g[0] for g in got}) == len(got) and [g for g in got if g[1] == "good"] == [(f"ok{n}", "good") for n in range(4)]


def test_messages_known_are_a_table_of_bounded_versions(spark):
    """The outcomes of retries come from joins, not from a Python call for each message."""
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("t_in", "t_out", "t_ckpt"))
    for n in range(4):
        copies = [delivery("hot", f"r{n}", n, False)] * 50
        land(landing, str(n), [*copies, delivery(f"m{n}", "1", n, True), delivery(f"m{n}", "1", n + 1, False, "later copy")])
        dl.retry_stream(dl.delivery_stream(spark, landing), sink, ckpt).awaitTermination()
    kept = existing(spark, f"{ckpt}/messages/batch_id=*")
    assert len(kept) == 2
    now = spark.read.schema(dl.MESSAGES).parquet(max(kept, key=lambda v: int(v.rsplit("=", 1)[1])))
    assert sorted(r.message_id for r in now.collect()) == ["hot", "m0", "m1", "m2", "m3"]
    got = sorted((r.message_id, r.route, r.receives) for r in dl.read_outcomes(spark, sink).collect())
    assert got[0] == ("hot", "dead-letter", 3) and len(got) == 5
    assert "Python" not in dl.retried(spark.createDataFrame([], "message_id string, body string, receipt string, received_ms long, ok boolean, arrived_ms long"),
                                      spark.createDataFrame([], dl.MESSAGES), 3, 1)._jdf.queryExecution().toString()
