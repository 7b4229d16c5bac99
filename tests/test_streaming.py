import pytest
from pyspark.sql import functions as F

from rowtide.operators import filters, outbox
from rowtide.plans import changes
from rowtide.sources.notify import stream_frames, stream_notify
from rowtide.streaming import changes as stream_changes
from rowtide.streaming import notifications, progress
from rowtide.streaming.changes import ChangeStream
from tests import wire


def capture(spark):
    """Two sessions; one ends at a fatal frame, one is described twice."""
    described = wire.xlog(wire.relation(1, b"s", b"t", [b"a"]))
    wider = wire.xlog(wire.relation(1, b"s", b"t", [b"a", b"b"]))

    def row(position, *cells):
        return wire.xlog(wire.insert(1, *cells), position)

    one = [described] + [row(10 + i, str(i).encode()) for i in range(10)]
    one += [wider] + [row(30 + i, str(i).encode(), b"x") for i in range(10)] + [wire.xlog(b"Z", 50)]
    two = [row(5, b"early"), described, row(6, b"late"), b"", row(7, b"never"), row(8, b"never")]
    return wire.frames(spark, {"one": one, "two": two})


def write_parts(frames, path, parts):
    last = frames.agg(F.max("frame_no")).first()[0]
    step = -(-last // parts)
    for part in range(parts):
        inside = (F.col("frame_no") > part * step) & (F.col("frame_no") <= (part + 1) * step)
        frames.filter(inside).coalesce(1).write.mode("append").parquet(path)


def expected(frames):
    condition = filters.should_forward()
    events = changes.decode_changes(frames)
    rows = outbox.to_stdout(filters.forwardable(events, condition))
    return sorted((r["session_id"], r["frame_no"], r["body"]) for r in rows.collect())


def run(spark, path, stream, files=1):
    query = stream_changes.start(stream_frames(spark, path, files), stream)
    query.awaitTermination()


def test_outbox_keeps_no_whole_events(spark, tmp_path, monkeypatch):
    frames = capture(spark)
    path, root = str(tmp_path / "frames"), str(tmp_path / "root")
    write_parts(frames, path, 1)
    kept, decode = [], changes.decode_changes
    frame = type(frames)
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *level: kept.append(self.columns) or persist(self, *level))
    consumer = progress.open_consumer(spark, root, "lean")
    run(spark, path, ChangeStream(consumer))
    assert len(kept) == 1 and not {"old", "new", "columns", "tables"} & set(kept[0])
    out = stream_changes.read_outbox(spark, consumer).collect()
    assert sorted((r["session_id"], r["frame_no"], r["body"]) for r in out) == expected(frames)
    letters = spark.read.parquet(consumer.folder("dead_letters")).drop("batch_id").collect()
    assert letters and sorted(letters) == sorted(changes.dead_letters(decode(frames)).collect())
    reached = progress.session_positions(spark, consumer).collect()
    assert sorted(reached) == sorted(progress.confirmed_positions(decode(frames)).collect())


@pytest.mark.parametrize("parts", [1, 5])
def test_stream_equals_batch(spark, tmp_path, parts):
    frames = capture(spark)
    path, root = str(tmp_path / "frames"), str(tmp_path / "root")
    write_parts(frames, path, parts)
    consumer = progress.open_consumer(spark, root, "c")
    run(spark, path, ChangeStream(consumer))
    out = stream_changes.read_outbox(spark, consumer)
    assert out.select("batch_id").distinct().count() == parts
    assert sorted((r["session_id"], r["frame_no"], r["body"]) for r in out.collect()) == expected(frames)
    reached = {r["session_id"]: int(r["position"]) for r in progress.session_positions(spark, consumer).collect()}
    assert reached == {"one": 100, "two": 100}
    letters = spark.read.parquet(consumer.folder("dead_letters"))
    assert [r["frame_no"] for r in letters.collect()] == [23]


def test_restart_continues(spark, tmp_path):
    frames = capture(spark)
    path, root = str(tmp_path / "frames"), str(tmp_path / "root")
    consumer = progress.open_consumer(spark, root, "c")
    write_parts(frames.filter("frame_no <= 8"), path, 2)
    run(spark, path, ChangeStream(consumer))
    write_parts(frames.filter("frame_no > 8"), path, 3)
    again = progress.open_consumer(spark, root, "c")
    assert again == consumer
    run(spark, path, ChangeStream(again))
    out = stream_changes.read_outbox(spark, again).collect()
    assert sorted((r["session_id"], r["frame_no"], r["body"]) for r in out) == expected(frames)


def test_consumer_rules(spark, tmp_path):
    root = str(tmp_path / "root")
    first = progress.open_consumer(spark, root, "b")
    progress.open_consumer(spark, root, "a")
    assert progress.open_consumer(spark, root, "b") == first
    reset = progress.open_consumer(spark, root, "b", reset=True)
    assert reset.generation == 1 and reset.checkpoint != first.checkpoint
    passing = progress.open_consumer(spark, root, "c", temporary=True)
    assert not passing.checkpoint.startswith(root)
    listed = [tuple(r) for r in progress.list_consumers(spark, root).collect()]
    assert listed == [("a", "pgoutput", None, False), ("b", "pgoutput", None, False)]
    with pytest.raises(ValueError):
        progress.open_consumer(spark, root, "Bad Name")
    (tmp_path / "in").mkdir()
    running = stream_changes.start(
        stream_frames(spark, str(tmp_path / "in")), ChangeStream(reset), {"processingTime": "1 second"}
    )
    try:
        with pytest.raises(RuntimeError):
            progress.open_consumer(spark, root, "b")
        assert [r["active"] for r in progress.list_consumers(spark, root).collect()] == [False, True]
    finally:
        running.stop()


def test_confirmed_position_never_falls(spark):
    frames = wire.frames(spark, {"s": [wire.xlog(b"O", 50), wire.xlog(b"O", 20), wire.xlog(b"Z", 90)], "t": [wire.xlog(b"Z", 9)]})
    events = changes.decode_changes(frames)

    def reached(**options):
        return {r["session_id"]: int(r["position"]) for r in progress.confirmed_positions(events, **options).collect()}

    assert reached() == {"s": 50, "t": 0}
    assert reached(start=60) == {"s": 60, "t": 60}
    failures = spark.createDataFrame([("s", 1), ("s", 1)], "session_id STRING, frame_no BIGINT")
    assert reached(failures=failures) == {"s": 20, "t": 0}


def test_failed_delivery_is_retried_without_repeats(spark, tmp_path):
    path, root = str(tmp_path / "frames"), str(tmp_path / "root")
    rows = [wire.xlog(wire.insert(1, str(i).encode()), i) for i in range(1, 6)]
    write_parts(wire.frames(spark, {"s": rows, "t": rows[:2]}), path, 1)
    sent = tmp_path / "sent"
    sent.mkdir()

    def deliver_until(limit, folder=str(sent)):
        def deliver(message):
            if message["session_id"] == "s" and message["frame_no"] > limit:
                raise ValueError("full")
            with open(f"{folder}/{message['session_id']}", "a") as out:
                out.write(f"{message['frame_no']}\n")

        return deliver

    consumer = progress.open_consumer(spark, root, "c")
    with pytest.raises(Exception, match="were not delivered"):
        run(spark, path, ChangeStream(consumer, "kafka", deliver=deliver_until(3)))
    assert (sent / "s").read_text().split() == ["1", "2", "3"]
    assert progress.session_positions(spark, consumer).count() == 0
    run(spark, path, ChangeStream(consumer, "kafka", deliver=deliver_until(9)))
    assert (sent / "s").read_text().split() == ["1", "2", "3", "4", "5"]
    assert (sent / "t").read_text().split() == ["1", "2"]
    log = progress.delivery_log(spark, consumer)
    assert log.filter("NOT ok").count() == 2 and log.filter("ok").count() == 7


def test_lanes_and_publications(spark, tmp_path):
    path, root = str(tmp_path / "frames"), str(tmp_path / "root")
    messages = [wire.relation(1, b"s", b"t", [b"a"]), wire.relation(2, b"s", b"u", [b"a"]), wire.relation(3, b"s", b"v", [b"a"])]
    messages += [wire.insert(rel, b"x") for rel in (1, 2, 3, 1, 2, 3)]
    write_parts(wire.frames(spark, {"s": [wire.xlog(m, n) for n, m in enumerate(messages)]}), path, 1)
    schema = "publication STRING, schema STRING, table STRING, all_tables BOOLEAN"
    members = spark.createDataFrame([("p", "s", "t", False), ("p", "s", "u", False)], schema)

    def deliver(message):
        if message["msg_key"] == "t":
            raise ValueError("full")

    consumer = progress.open_consumer(spark, root, "c")
    stream = ChangeStream(
        consumer, "kafka", deliver=deliver, lanes=("session_id", "msg_key"), publications=["p"], members=members
    )
    with pytest.raises(Exception, match="were not delivered"):
        run(spark, path, stream)
    # A failure stops the lane of table t, not the one of table u.
    log = {r["frame_no"]: r["ok"] for r in progress.delivery_log(spark, consumer).collect()}
    assert log == {4: False, 5: True, 7: False, 8: True}
    with pytest.raises(ValueError):
        ChangeStream(consumer, lanes=["table"])
    with pytest.raises(ValueError):
        ChangeStream(consumer, publications=["p"])


def test_notifications_of_a_replayed_batch_are_not_sent_again(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 7, "x")], "frame_no BIGINT, channel STRING, pid INT, payload STRING")
    sent = str(tmp_path / "sent")

    def deliver(message):
        with open(sent, "a") as out:
            out.write("x")

    consumer = progress.open_consumer(spark, str(tmp_path / "root"), "n")
    stream = notifications.NotifyStream(consumer, ["a"], "kafka", deliver=deliver)
    for _ in range(2):
        notifications.process_batch(stream, df, 0)
    assert open(sent).read() == "x"
    assert progress.delivery_log(spark, consumer).count() == 1


def test_continue_drops_failures(spark, tmp_path):
    path, root = str(tmp_path / "frames"), str(tmp_path / "root")
    rows = [wire.xlog(wire.insert(1, b"x"), i) for i in (1, 2, 3)]
    write_parts(wire.frames(spark, {"s": rows}), path, 1)

    def deliver(message):
        if message["frame_no"] == 3:
            raise ValueError("full")

    consumer = progress.open_consumer(spark, root, "c")
    run(spark, path, ChangeStream(consumer, "webhook", {"url": "http://x"}, deliver=deliver, on_error="continue"))
    log = {r["frame_no"]: (r["sink"], r["ok"], r["error"]) for r in progress.delivery_log(spark, consumer).collect()}
    assert log == {1: ("webhook", True, None), 2: ("webhook", True, None), 3: ("webhook", False, "full")}
    assert int(progress.session_positions(spark, consumer).first()["position"]) == 2


def test_start_position(spark, tmp_path):
    frames = wire.frames(spark, {"s": [wire.xlog(wire.insert(1, b"x"), i) for i in (1, 2, 3)]})
    events = changes.decode_changes(frames)
    assert [r["frame_no"] for r in filters.from_position(events, "0/2").orderBy("frame_no").collect()] == [2, 3]
    assert filters.from_position(events, "0/0").count() == 3 and filters.from_position(events, None).count() == 3


def test_notify_stream(spark, tmp_path):
    rows = [(1, "a", 7, "x"), (2, "b", 7, "y"), (3, "a", 7, '{"meta":{"routing":{"kafka_topic":"t"}},"data":1}')]
    df = spark.createDataFrame(rows, "frame_no BIGINT, channel STRING, pid INT, payload STRING")
    df.write.parquet(str(tmp_path / "in"))
    source = stream_notify(spark, str(tmp_path / "in"))
    consumer = progress.open_consumer(spark, str(tmp_path / "root"), "n")
    stream = notifications.NotifyStream(consumer, ["a"], "kafka", "contract")
    notifications.start(source, stream).awaitTermination()
    out = spark.read.parquet(consumer.folder("outbox")).orderBy("frame_no").collect()
    assert [(r["frame_no"], r["destination"], r["body"]) for r in out] == [
        (1, "pgx-notify", '{"channel":"a","payload":"x","pid":7}'),
        (3, "t", "1"),
    ]

    def deliver(message):
        if message["frame_no"] == 1:
            raise ValueError("lost")

    other = progress.open_consumer(spark, str(tmp_path / "root"), "d")
    stream = notifications.NotifyStream(other, ["a"], "kafka", "contract", deliver=deliver)
    notifications.start(source, stream).awaitTermination()
    log = {r["frame_no"]: (r["ok"], r["error"]) for r in progress.delivery_log(spark, other).collect()}
    assert log == {1: (False, "lost"), 3: (True, None)}
