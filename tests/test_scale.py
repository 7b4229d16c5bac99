"""Steps that must not grow faster than their input: what one task or the driver takes."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowtide.operators import relations as rel
from rowtide.streaming import changes, deliver, progress
from rowtide.streaming.deliver import SLICE_ROWS, deliver_changes, pack_lanes, unpacked
from rowtide.streaming.epochs import deliver_epochs

OUTBOX = ["'kafka' AS sink", "'x' AS msg_key", "map('a', cast(id AS string), 'b', NULL) AS headers", "'é' AS body"]


def outbox(spark, sessions, numbers=6_000):
    rows = spark.range(numbers).selectExpr(f"explode(array({sessions})) AS session_id", "id AS frame_no", *OUTBOX)
    return rows.orderBy(F.rand(5)).withColumn("position", F.col("frame_no").cast("decimal(20,0)"))


def test_ranges_are_never_broadcast(spark):
    rows = spark.range(100).selectExpr("concat('s', id) AS session_id", "id AS frame_no")
    ends = rows.selectExpr("session_id", "5L AS valid_from", "CAST(NULL AS BIGINT) AS valid_to")
    cut = rel.interval_join(rows, ends, ["session_id"], "left_anti", 1, 0)
    assert sorted(r["frame_no"] for r in cut.collect()) == [0, 1, 2, 3, 4]
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_a_lane_reaches_its_task_packed(spark):
    rows = outbox(spark, "'s', 't', NULL")
    packed = pack_lanes(rows, ["session_id", "msg_key"]).collect()
    assert len(packed) <= 3 * (6_000 // SLICE_ROWS + 6)
    for session in ("s", "t", None):
        parts = sorted((p for p in packed if p["session_id"] == session), key=lambda p: (p["_first"], p["_last"]))
        messages = [message for part in parts for message in unpacked(part["_slice"])]
        assert [m["frame_no"] for m in messages] == list(range(6_000))
        want = rows.filter(F.col("session_id").eqNullSafe(F.lit(session))).orderBy("frame_no").collect()
        assert messages == [r.asDict() for r in want]


def test_packed_lanes_keep_order_and_stop(spark):
    def deliver(message, last={}):
        session, number = message["session_id"], message["frame_no"]
        if number < last.get(session, -1):
            raise ValueError("out of order")
        last[session] = number
        if session == "t" and number == 4_000:
            raise ValueError("refused")

    rows = outbox(spark, "'s', 't', 't', NULL")  # the frames of one session come twice
    log = deliver_changes(rows, deliver).collect()
    assert len(log) == 24_000 and all(r["ok"] for r in log if r["session_id"] != "t")
    assert sum(r["ok"] for r in log if r["session_id"] == "t") == 8_000
    errors = sorted(r["error"] for r in log if r["error"] and r["session_id"] == "t")
    assert errors[-1] == "refused" and len(errors) == 4_000 and "out of order" not in errors


def test_epochs_take_packed_lanes(spark):
    def deliver(message, last={}):
        session = message["session_id"]
        if message["step"] < last.get(session, 0):
            raise ValueError("out of order")
        last[session] = message["step"]

    rows = outbox(spark, "'s', 't'")
    plan = rows.selectExpr("session_id", "frame_no", "frame_no div 3000 AS epoch", "frame_no div 3000 AS step", "frame_no % 5 AS lane")
    log = deliver_epochs(rows, plan, deliver, tasks=4).collect()
    assert len(log) == 12_000 and all(r["ok"] for r in log)


def test_maps_reach_the_packer_without_null(spark):
    maps = "CASE id % 3 WHEN 0 THEN map('a', CAST(NULL AS STRING), 'b', 'x') WHEN 1 THEN map() END"
    pairs = "CASE id % 3 WHEN 0 THEN array(named_struct('key', 'k', 'value', X'FF')) WHEN 1 THEN array() END"
    numbers = "CAST(CASE id WHEN 5 THEN 18446744073709551615 ELSE id END AS DECIMAL(20,0))"
    rows = spark.range(30).selectExpr(
        "'s' AS session_id", "id AS frame_no", "'k' AS sink", f"{maps} AS headers", f"{pairs} AS pairs",
        "CAST(NULL AS MAP<STRING,STRING>) AS env", f"{numbers} AS position", "CAST(id AS DECIMAL(9,2)) AS part",
        "nullif(CAST(id AS DECIMAL(5,0)), 3) AS some", "nullif(id % 2, 0) = 1 AS odd",
    )
    marked = deliver._with_marks(rows)
    assert marked.filter("headers IS NULL OR pairs IS NULL OR env IS NULL").isEmpty()
    messages = [m for part in pack_lanes(rows, ["session_id"]).collect() for m in unpacked(part["_slice"])]
    want = [r.asDict(recursive=True) for r in rows.orderBy("frame_no").collect()]
    assert messages == want and [str(m["position"]) for m in messages] == [str(r["position"]) for r in want]
    assert messages[3]["some"] is None and messages[5]["position"] == Decimal(2**64 - 1)
    assert messages[0]["headers"] is not messages[3]["headers"]


def test_held_slices_are_not_unpacked(spark):
    def refuse(message):
        raise ValueError("refused")

    packed = pack_lanes(outbox(spark, "'s'"), ["session_id"]).orderBy("_first").collect()
    lanes = deliver.Lanes(refuse, True, None, "")
    first = lanes.send_slice(packed[0]["_slice"], "s").to_pylist()
    assert [r["error"] for r in first] == ["refused"] + [deliver.NOT_SENT] * (len(first) - 1)
    data = bytes(packed[1]["_slice"])
    _, end = deliver._part(data, 0)
    held = lanes.send_slice(data[:end], "s").to_pylist()  # its bodies are missing
    assert [r["frame_no"] for r in held] == list(range(packed[1]["_first"], packed[1]["_last"] + 1))
    assert {(r["session_id"], r["sink"], r["ok"], r["error"]) for r in held} == {("s", "kafka", False, deliver.NOT_SENT)}


@pytest.mark.parametrize("on_error", ["fail", "continue"])
def test_the_log_of_a_busy_lane_is_many_files(spark, tmp_path, monkeypatch, on_error):
    from tests import wire

    monkeypatch.setattr(changes, "LOG_FILE_ROWS", 10)
    frames = wire.frames(spark, {"s": [wire.xlog(wire.insert(1, b"x"), n) for n in range(1, 41)]})
    consumer = progress.open_consumer(spark, str(tmp_path / "root"), "c")
    changes.process_batch(changes.ChangeStream(consumer, deliver=lambda message: None, on_error=on_error), frames, 0)
    log = progress.delivery_log(spark, consumer)
    assert log.count() == log.filter("ok").count() == 40
    assert log.groupBy(F.input_file_name()).count().count() == 4
    assert progress.session_positions(spark, consumer).collect()[0]["position"] == 40
