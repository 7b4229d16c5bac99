"""Order between barriers, attempts that end, state, leases."""

import glob
import os
import signal
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from rowtide.operators import filters, outbox
from rowtide.plans import changes
from rowtide.plans import export as ex
from rowtide.sources.notify import stream_frames
from rowtide.streaming import changes as stream_changes
from rowtide.streaming import epochs, lease, notifications, progress, state
from rowtide.streaming.changes import ChangeStream
from rowtide.streaming import journal as journals
from rowtide.streaming.deliver import deliver_slices, journaled, sliced_notifications
from rowtide.streaming.journal import Journal
from tests import wire


def keyed(rel_id, names, key, table=b"t"):
    """A description with one key column."""
    plain = wire.relation(rel_id, b"s", table, names)
    head, body = plain[: plain.index(b"d") + 3], b""
    for name in names:
        body += bytes([int(name == key)]) + name + b"\0" + plain[-8:]
    return head + body


def update(rel_id, new, old=None, flag=b"K"):
    before = flag + wire.image(*old) if old else b""
    return b"U" + rel_id.to_bytes(4, "big") + before + b"N" + wire.image(*new)


def truncate(rel_id):
    return b"T" + (1).to_bytes(4, "big") + b"\0" + rel_id.to_bytes(4, "big")


def log_of_one_session(rows=60):
    """Described, rows of ten keys, a truncate, rows, a row that moves to another key, rows, described anew, rows."""

    def some(n):
        return [wire.insert(1, str(i % 10).encode(), b"v") for i in range(n)]

    messages = [keyed(1, [b"id", b"v"], b"id"), *some(rows), truncate(1), truncate(1), *some(rows)]
    messages += [update(1, (b"3", b"v"), (b"2", None)), update(1, (b"3", b"w")), *some(rows)]
    messages += [keyed(1, [b"id", b"v"], b"v"), *some(rows)]
    return [wire.xlog(m, n) for n, m in enumerate(messages)]


def write(frames, path):
    frames.coalesce(1).write.mode("append").parquet(path)


def run(spark, path, stream, files=1):
    stream_changes.start(stream_frames(spark, path, files), stream).awaitTermination()


def planned(spark, frames, slices=None, least=1):
    events = changes.decode_changes(frames).persist()
    forwarded = filters.forwardable(events, filters.should_forward())
    return events, forwarded, epochs.plan_epochs(events, forwarded, slices, least)


@pytest.mark.parametrize("slices", [1, 7])
def test_epochs_follow_barriers(spark, slices):
    frames = wire.frames(spark, {"a": log_of_one_session(), "b": [wire.xlog(wire.insert(9, b"x"), 1)]})
    _, _, plan = planned(spark, frames, slices)
    rows = plan.orderBy("frame_no").filter("session_id = 'a'").collect()
    epoch = {r["frame_no"]: r["epoch"] for r in rows}
    # Frame 1 describes, 2-61 rows, 62-63 truncates, 64-123 rows, 124 moves, 125-185 rows, 186 describes, 187- rows.
    expected = [(2, 61, 1), (62, 63, 2), (64, 123, 3), (124, 124, 4), (125, 185, 5), (187, 246, 7)]
    assert epoch == {n: e for first, last, e in expected for n in range(first, last + 1)}
    lanes = {r["frame_no"]: r["lane"] for r in rows}
    assert lanes[2] == lanes[12] == lanes[64] and len({lanes[n] for n in range(2, 12)}) == 10
    assert lanes[125] == lanes[5]  # the update without old image has the key of the insert of 3
    assert len({lanes[n] for n in range(187, 247)}) == 1  # 'v' is the key now, and all rows have one value
    other = plan.filter("session_id = 'b'").collect()
    assert [(r["frame_no"], r["epoch"]) for r in other] == [(1, 0)]
    # No frame is behind the descriptions alone, so steps leave their epochs out; small epochs share a step and a lane.
    assert {(r["epoch"], r["step"]) for r in rows} == {(1, 0), (2, 1), (3, 2), (4, 3), (5, 4), (7, 5)}
    _, _, joined = planned(spark, frames, slices, least=60)
    step = {(r["epoch"], r["step"]) for r in joined.filter("session_id = 'a'").collect()}
    assert step == {(1, 0), (2, 1), (3, 2), (4, 3), (5, 4), (7, 5)}
    _, _, joined = planned(spark, frames, slices, least=61)
    rows = joined.filter("session_id = 'a'").collect()
    assert {(r["epoch"], r["step"]) for r in rows} == {(1, 0), (2, 0), (3, 0), (4, 0), (5, 1), (7, 2)}
    assert len({r["lane"] for r in rows if r["step"] != 1}) == 1


def test_one_session_spreads_and_keeps_order(spark, tmp_path):
    rows = [wire.insert(1, str(i % 10).encode(), b"v") for i in range(30)]
    messages = [keyed(1, [b"id", b"v"], b"id"), *rows, truncate(1), *rows]
    frames = wire.frames(spark, {"a": [wire.xlog(m, n) for n, m in enumerate(messages)]})
    events, forwarded, plan = planned(spark, frames)
    epoch = {r["frame_no"]: r["epoch"] for r in plan.collect()}
    options = {"shell": {"command": "c"}, "webhook": {"url": "u"}}
    for sink in sorted(outbox.SINKS):
        folder = tmp_path / sink
        folder.mkdir()

        def deliver(message, folder=str(folder)):
            with open(f"{folder}/{os.getpid()}.{message['lane']}", "a") as out:
                out.write(f"{time.time_ns()} {message['frame_no']}\n")

        log = epochs.deliver_epochs(outbox.SINKS[sink](forwarded, **options.get(sink, {})), plan, deliver, tasks=4)
        assert log.filter("ok").count() == 61
        paths = glob.glob(f"{folder}/*")
        assert len({os.path.basename(p).split(".")[0] for p in paths}) > 1
        by_lane, spans = {}, {}
        for path in paths:
            for at, n in (tuple(map(int, line.split())) for line in open(path)):
                by_lane.setdefault(path.split(".")[-1], []).append((at, n))
                spans.setdefault(epoch[n], []).append(at)
        assert all([n for _, n in sorted(sent)] == sorted(n for _, n in sent) for sent in by_lane.values())
        ordered = [spans[e] for e in sorted(spans)]
        assert len(ordered) == 3 and all(max(x) < min(y) for x, y in zip(ordered, ordered[1:]))
    events.unpersist()


def test_failure_holds_later_epochs(spark):
    events, forwarded, plan = planned(spark, wire.frames(spark, {"a": log_of_one_session(20), "b": log_of_one_session(5)}))

    def deliver(message):
        if message["session_id"] == "a" and message["frame_no"] == 4:
            raise ValueError("full")

    log = epochs.deliver_epochs(outbox.to_stdout(forwarded), plan, deliver, tasks=3).join(plan, ["session_id", "frame_no"])
    a = {(r["epoch"], r["frame_no"]): r["ok"] for r in log.filter("session_id = 'a'").collect()}
    # In its epoch only the lane of the failed key stops: frames 4 and 14. No later epoch of the session is sent.
    assert sorted(n for (e, n), ok in a.items() if e == 1 and not ok) == [4, 14]
    assert not any(ok for (e, _), ok in a.items() if e > 1)
    assert log.filter("session_id = 'b' AND NOT ok").count() == 0
    events.unpersist()


def test_killed_task_of_changes_sends_nothing_twice(spark, tmp_path):
    path, sent = str(tmp_path / "frames"), str(tmp_path / "sent")
    write(wire.frames(spark, {"a": log_of_one_session(5)}), path)
    alive = str(tmp_path / "second")

    def deliver(message):
        with open(sent, "a") as out:
            out.write(f"{message['frame_no']}\n")
        if message["frame_no"] == 14 and not os.path.exists(alive):
            # The journal names a message once it is accepted; this one is not.
            os._exit(1)

    for order in ("session", "keys"):
        consumer = progress.open_consumer(spark, str(tmp_path / order), "c")
        with pytest.raises(Exception):
            run(spark, path, ChangeStream(consumer, deliver=deliver, order=order, tasks=3))
        assert progress.session_positions(spark, consumer).count() == 0
        open(alive, "w").close()
        run(spark, path, ChangeStream(consumer, deliver=deliver, order=order, tasks=3))
        numbers = [int(n) for n in open(sent).read().split()]
        assert numbers.count(14) == 2 and len(numbers) == len(set(numbers)) + 1
        log = progress.delivery_log(spark, consumer).filter("ok")
        assert log.count() == log.distinct().count() == len(set(numbers))
        os.remove(sent), os.remove(alive)


def notes(spark, n):
    return spark.range(1, n + 1).select(
        F.col("id").alias("frame_no"), F.lit("a").alias("channel"), F.lit(7).alias("pid"), F.lit("x").alias("payload")
    )


def test_killed_task_of_notifications_sends_nothing_twice(spark, tmp_path):
    sent, alive = str(tmp_path / "sent"), str(tmp_path / "second")

    def deliver(message):
        with open(sent, "a") as out:
            out.write(f"{message['frame_no']}\n")
        if message["frame_no"] == 20 and not os.path.exists(alive):
            os._exit(1)

    consumer = progress.open_consumer(spark, str(tmp_path / "root"), "n")
    stream = notifications.NotifyStream(consumer, ["a"], "kafka", deliver=deliver)
    with pytest.raises(Exception):
        notifications.process_batch(stream, notes(spark, 40), 0)
    before = open(sent).read().split()
    open(alive, "w").close()
    notifications.process_batch(stream, notes(spark, 40), 0)
    numbers = open(sent).read().split()
    assert "20" in before and len(numbers) == len(set(numbers))
    log = {str(r["frame_no"]): (r["ok"], r["error"]) for r in progress.delivery_log(spark, consumer).collect()}
    assert len(log) == 40
    # Accepted ones are known from the journal; the one cut off, and what followed it in its slice, is not.
    assert not log["20"][0] and log["20"][1].startswith("not sent again")
    assert {n for n, (ok, _) in log.items() if ok} == set(numbers) - {"20"}


def test_second_attempt_of_a_slice_sends_nothing(spark, tmp_path):
    rows = sliced_notifications(notes(spark, 5).selectExpr("'a' AS session_id", "frame_no", "'kafka' AS sink"))
    journal, sent = Journal(f"file:{tmp_path}/journal"), str(tmp_path / "sent")

    def deliver(message):
        with open(sent, "a") as out:
            out.write("x")

    first = deliver_slices(rows, deliver, journal).collect()
    assert sorted(deliver_slices(rows, deliver, journal).collect()) == sorted(first)
    assert open(sent).read() == "xxxxx" and all(r["ok"] for r in first)


def test_journal(tmp_path):
    journal = Journal(str(tmp_path / "j"))
    assert [journal.claim("a"), journal.claim("a"), journal.claim("b")] == [True, False, True]
    assert list(Journal(str(tmp_path / "none")).read("a")) == []
    attempt = journal.write("task-1")
    attempt.add("s", 1, "kafka", True, None)
    assert list(journal.read("task-1")) == [("s", 1, "kafka", True, None)]  # before it is closed
    attempt._stream.write(b'["s", 2, "ka')
    attempt.close()
    assert len(list(journal.read("task-1"))) == 1 and list(journal.read("task-10")) == []


_KILLED = """
import os, signal, sys
from rowtide.streaming import journal
journal._Mapped.ROOM = 4096
attempt = journal.Journal(sys.argv[1]).write("task-1")
for n in range(500):
    attempt.add("s", n, "kafka", n % 2 == 0, None if n % 2 == 0 else 'é"' * 9)
os.kill(os.getpid(), signal.SIGKILL)
"""


def test_journal_is_written_through_memory(tmp_path):
    journal = Journal(str(tmp_path / "j"))
    ended = subprocess.run([sys.executable, "-c", _KILLED, journal.folder], cwd=os.path.dirname(os.path.dirname(__file__)))
    assert ended.returncode == -signal.SIGKILL
    (path,) = glob.glob(f"{tmp_path}/j/*.outcomes")
    data = open(path, "rb").read()
    assert data.endswith(b"\0") and data.rstrip(b"\0").endswith(b"]\n")  # as it was mapped
    expected = [("s", n, "kafka", n % 2 == 0, None if n % 2 == 0 else 'é"' * 9) for n in range(500)]
    assert list(journal.read("task-1")) == expected
    with open(path, "r+b") as torn:  # a line of which only a part came through
        torn.seek(2)
        torn.write(bytes(3))
    assert list(journal.read("task-1")) == expected[1:]
    attempt = journal.write("task-2")
    attempt.add("s" * 9000, 1, None, True, None)
    attempt.close()
    (path,) = glob.glob(f"{tmp_path}/j/task-2.*")
    assert open(path, "rb").read() == b'["' + b"s" * 9000 + b'", 1, null, true, null]\n'


def test_journal_cut_by_a_kill_is_read_by_spark(spark, tmp_path):
    journal = Journal(str(tmp_path / "j"))
    attempt = journal.write("task-1")
    attempt.add("s", 1, "kafka", True, None)
    attempt._stream.write(b'["s", 2, "ka')
    assert [tuple(r) for r in journaled(spark, journal).collect()] == [("s", 1, "kafka", True, None)]
    attempt.close()


def test_state_is_a_log_of_changes(spark, tmp_path):
    consumer = progress.open_consumer(spark, str(tmp_path / "root"), "c")

    def records(*rows):
        data = [(s, n, rel, kind, error, False) for s, n, rel, kind, error in rows]
        schema = "session_id STRING, frame_no BIGINT, rel_id BIGINT, kind STRING, error_class STRING, carried BOOLEAN"
        return spark.createDataFrame(data, schema)

    counts = []
    for batch in range(50):
        new = records(("a", batch + 1, 1, "relation", None), (f"s{batch}", 1, 1, "relation", None), (f"s{batch}", 2, None, "error", "fatal"))
        prior = state.carried(spark, consumer, batch)
        held = new if prior is None else new.unionByName(prior.withColumn("carried", F.lit(True)))
        state.store(consumer, held, batch)
        counts.append(len(glob.glob(f"{consumer.folder('control')}/*/part-*")))
    rows = state.carried(spark, consumer, 50).collect()
    # The latest description of the living session, a tombstone for each ended one.
    assert [(r["frame_no"], r["rel_id"]) for r in rows if r["session_id"] == "a"] == [(50, 1)]
    assert len(rows) == 51 and all(r["error_class"] == "fatal" for r in rows if r["session_id"] != "a")
    assert max(counts[25:]) <= max(counts[:25])


def test_two_drivers_one_consumer(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "root")
    progress.open_consumer(spark, root, "c")
    mine = lease.Lease(spark, root, "c")
    assert [r["active"] for r in progress.list_consumers(spark, root).collect()] == [False]
    monkeypatch.setattr(lease, "OWNER", "another")
    with pytest.raises(RuntimeError, match="another driver"):
        progress.open_consumer(spark, root, "c")
    with pytest.raises(RuntimeError, match="another driver"):
        lease.Lease(spark, root, "c")
    assert [r["active"] for r in progress.list_consumers(spark, root).collect()] == [True]
    time.sleep(0.2)
    theirs = lease.Lease(spark, root, "c", seconds=0.1)  # the lease of the first went stale
    theirs.check()
    with pytest.raises(lease.LeaseLost):
        mine.check()
    consumer = progress.Consumer(root, "c", 0)
    with pytest.raises(lease.LeaseLost):
        frames = wire.frames(spark, {"s": [wire.xlog(wire.insert(1, b"x"), 1)]})
        stream_changes.process_batch(ChangeStream(consumer), frames, 0, mine.check)
    assert progress.session_positions(spark, consumer).count() == 0
    theirs.release()
    assert lease.holder(spark, root, "c") is None


@pytest.mark.parametrize("fails", [False, True])
def test_temporary_consumer_goes_with_its_query(spark, tmp_path, fails):
    path = str(tmp_path / "frames")
    write(wire.frames(spark, {"s": [wire.xlog(wire.insert(1, b"x"), 1)]}), path)

    def deliver(message):
        if fails:
            raise ValueError("full")

    consumer = progress.open_consumer(spark, str(tmp_path / "root"), "passing", temporary=True)
    if fails:
        with pytest.raises(Exception, match="were not delivered"):
            run(spark, path, ChangeStream(consumer, deliver=deliver))
    else:
        run(spark, path, ChangeStream(consumer, deliver=deliver))
    for _ in range(100):
        if not os.path.exists(consumer.root):
            break
        time.sleep(0.1)
    assert not os.path.exists(consumer.root)
    with pytest.raises(ValueError):
        progress.open_consumer(spark, str(tmp_path / "root"), "kept").remove(spark)


def test_lines(spark, tmp_path):
    path = str(tmp_path / "frames")
    write(wire.frames(spark, {"s": log_of_one_session(3)}), path)
    consumer = progress.open_consumer(spark, str(tmp_path / "root"), "c")
    run(spark, path, ChangeStream(consumer, tables=["t"], ops=["update"], lines=True))
    lines = [line for p in sorted(glob.glob(f"{consumer.folder('outbox')}/*/part-*")) for line in open(p).read().splitlines()]
    assert [line[:14] for line in lines] == ['{"op":"update"'] * 2


def test_images_of_some_rows(spark):
    frames = wire.frames(spark, {"s": [*log_of_one_session(2), wire.xlog(b"I\0\0\0\1N\0\1t", 1)]})
    whole = changes.decode_changes(frames)
    some = changes.decode_changes(frames, images=F.col("kind") == "update")
    key = ["session_id", "frame_no", "kind", "error_class", "error"]
    assert sorted(map(str, some.select(key).collect())) == sorted(map(str, whole.select(key).collect()))
    assert some.filter("kind = 'insert' AND new IS NOT NULL").isEmpty()
    updates = "kind = 'update'"
    shown = ["frame_no", "old", "new"]
    assert sorted(map(str, some.filter(updates).select(shown).collect())) == sorted(
        map(str, whole.filter(updates).select(shown).collect())
    )


@pytest.mark.parametrize("format", ex.FORMATS)
@pytest.mark.parametrize("limit", [0, 5])
def test_export_runs_its_statement_once(spark, tmp_path, format, limit):
    seen = str(tmp_path / "seen")

    @F.udf("int")
    def counted(i):
        with open(seen, "a") as out:
            out.write("x")
        return i

    # No sort: a sort by range reads its input a second time for its sample.
    spark.range(40).withColumn("n", counted(F.col("id").cast("int"))).createOrReplaceTempView("counted_rows")
    report = ex.export(spark, str(tmp_path / "out"), "SELECT id, n FROM counted_rows", format=format, limit=limit)
    assert (report.fetched, report.written) == (40, True)
    assert len(open(seen).read()) == 40
    assert not glob.glob(f"{tmp_path}/*.partial")
    with pytest.raises(FileExistsError):
        ex.export(spark, str(tmp_path / "out"), "SELECT 1 AS a", format=format)


def test_export_keeps_the_first_rows_in_order(spark, tmp_path):
    spark.range(1000).repartition(5).createOrReplaceTempView("mixed_rows")
    ex.export(spark, str(tmp_path / "out"), "SELECT id FROM mixed_rows ORDER BY id DESC", format="csv", limit=7)
    lines = [x for p in sorted(glob.glob(f"{tmp_path}/out/part-*")) for x in open(p).read().split() if x != "id"]
    assert lines == [str(n) for n in range(999, 992, -1)]
