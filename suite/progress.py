"""Positions, named consumers, delivery, and the streams that use them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rowtide.operators import filters, outbox
from rowtide.session import shared_dir
from rowtide.sources.notify import FRAMES_SCHEMA
from rowtide.streaming import changes as stream_changes
from rowtide.streaming import epochs, progress
from rowtide.streaming.changes import ChangeStream
from rowtide.streaming.deliver import deliver_changes
from suite.base import EVENTS, events, frames, over_log, query, sql_lsn

MIDDLE = 16777216 + 500 * 64


def _root(spark):
    return f"{shared_dir(spark)}/rowtide/consumers-{uuid.uuid4().hex}"


def _stored(spark, sf_dir, root, where=None):
    """Frames as files a stream can read, in frame order and about equal; a second call adds the rest."""
    rows = frames(spark, sf_dir)
    rows = rows if where is None else rows.filter(where)
    rows.repartitionByRange("session_id", "frame_no").write.mode("append").parquet(f"{root}/frames")
    return spark.readStream.schema(FRAMES_SCHEMA).parquet(f"{root}/frames")


def _run(source, stream):
    running = stream_changes.start(source, stream)
    running.awaitTermination()


@query(
    "T1_confirmed_position",
    over_log("SELECT session_id, max(position) AS position FROM log WHERE error_class IS NULL GROUP BY session_id"),
)
def confirmed_position(spark, sf_dir):
    reached = progress.confirmed_positions(events(spark, sf_dir, images=False))
    return reached.withColumn("position", F.col("position").cast("bigint"))


@query(
    "T2_handled_rule",
    over_log("SELECT session_id, frame_no, kind, error_class IS NULL AND kind <> 'delete' AS handled FROM log"),
)
def handled_rule(spark, sf_dir):
    rows = events(spark, sf_dir)
    failures = rows.filter("op = 'delete'")
    return progress.with_handled(rows, failures).select("session_id", "frame_no", "kind", "handled")


_FORWARDED = """SELECT session_id, frame_no, CASE WHEN kind IN ('insert', 'update', 'delete') THEN "table" ELSE 'pgx-wal' END
  AS msg_key FROM log WHERE error_class IS NULL AND kind IN ('insert', 'update', 'delete', 'truncate')"""


@query("T3_resume", over_log(_FORWARDED))
def resume(spark, sf_dir):
    root = _root(spark)
    first = progress.open_consumer(spark, root, "resumed")
    source = _stored(spark, sf_dir, root, F.col("frame_no") < MIDDLE)
    _run(source, ChangeStream(first, "kafka"))
    again = progress.open_consumer(spark, root, "resumed")
    source = _stored(spark, sf_dir, root, F.col("frame_no") >= MIDDLE)
    _run(source, ChangeStream(again, "kafka"))
    return stream_changes.read_outbox(spark, again).select("session_id", "frame_no", "msg_key")


@query(
    "T4_named_consumer",
    over_log(f"""SELECT 'orders_feed' AS name, 'pgoutput' AS plugin, {sql_lsn('max(position)')} AS position,
             false AS active FROM log WHERE error_class IS NULL"""),
)
def named_consumer(spark, sf_dir):
    root = _root(spark)
    consumer = progress.open_consumer(spark, root, "orders_feed")
    _run(_stored(spark, sf_dir, root), ChangeStream(consumer, "stdout"))
    return progress.list_consumers(spark, root)


@query(
    "T5_reset_and_temporary",
    over_log(f"""SELECT 'kept' AS name, 'pgoutput' AS plugin, {sql_lsn('max(position)')} AS position, false AS active
             FROM log WHERE error_class IS NULL UNION ALL SELECT 'reset', 'pgoutput', NULL, false"""),
)
def reset_and_temporary(spark, sf_dir):
    root = _root(spark)
    source = _stored(spark, sf_dir, root)
    for name, temporary in (("kept", False), ("reset", False), ("passing", True)):
        _run(source, ChangeStream(progress.open_consumer(spark, root, name, temporary=temporary), "stdout"))
    progress.open_consumer(spark, root, "reset", reset=True)
    return progress.list_consumers(spark, root)


_LOG = """SELECT session_id, frame_no, 'rabbitmq' AS sink, kind <> 'truncate' AS ok,
  CASE kind WHEN 'truncate' THEN 'refused' END AS error FROM log
  WHERE error_class IS NULL AND kind IN ('insert', 'update', 'delete', 'truncate')"""


@query("T6_delivery_log", over_log(_LOG))
def delivery_log(spark, sf_dir):
    def deliver(message):
        if '"op":"truncate"' in message["body"]:
            raise ValueError("refused")

    root = _root(spark)
    consumer = progress.open_consumer(spark, root, "logged")
    stream = ChangeStream(consumer, "rabbitmq", deliver=deliver, on_error="continue")
    _run(_stored(spark, sf_dir, root), stream)
    return progress.delivery_log(spark, consumer).select("session_id", "frame_no", "sink", "ok", "error")


@query(
    "T7_delivery_guarantee",
    over_log("""SELECT session_id, frame_no, CAST(1 AS BIGINT) AS accepted FROM log
             WHERE error_class IS NULL AND kind IN ('insert', 'update', 'delete', 'truncate')"""),
)
def delivery_guarantee(spark, sf_dir):
    def refuse(message):
        if '"op":"truncate"' in message["body"]:
            raise ValueError("refused")

    def accept(message):
        return None

    root = _root(spark)
    consumer = progress.open_consumer(spark, root, "guaranteed")
    source = _stored(spark, sf_dir, root)
    try:
        _run(source, ChangeStream(consumer, "kafka", deliver=refuse))
        raise AssertionError("a refused message must end the stream")
    except Exception as error:
        if "were not delivered" not in str(error):
            raise
    _run(source, ChangeStream(consumer, "kafka", deliver=accept))
    log = progress.delivery_log(spark, consumer)
    return log.groupBy("session_id", "frame_no").agg(F.count_if("ok").alias("accepted"))


@query(
    "T8_session_order",
    over_log("""SELECT session_id, frame_no, true AS ok FROM log
             WHERE error_class IS NULL AND kind IN ('insert', 'update', 'delete', 'truncate')"""),
)
def session_order(spark, sf_dir):
    last = {}

    def deliver(message):
        session, number = message["session_id"], message["frame_no"]
        if number <= last.get(session, -1):
            raise ValueError("out of order")
        last[session] = number

    condition = filters.should_forward()
    rows = outbox.to_stdout(filters.forwardable(events(spark, sf_dir, where=condition), condition))
    return deliver_changes(rows, deliver).select("session_id", "frame_no", "ok")


_EPOCHS = """, marked AS (
  SELECT session_id, frame_no, kind = 'relation' AS silent, kind NOT IN ('insert', 'update', 'delete') AS barrier FROM log
  WHERE error_class IS NULL AND kind IN ('insert', 'update', 'delete', 'truncate', 'relation')),
turned AS (
  SELECT *, CASE WHEN barrier <> lag(barrier) OVER (PARTITION BY session_id ORDER BY frame_no) THEN 1 ELSE 0 END AS turn
  FROM marked),
counted AS (
  SELECT *, sum(turn) OVER (PARTITION BY session_id ORDER BY frame_no) AS epoch FROM turned)"""


@query(
    "T8_epoch_order",
    f"WITH {EVENTS} {_EPOCHS} SELECT session_id, frame_no, CAST(epoch AS BIGINT) AS epoch, true AS ok FROM counted WHERE NOT silent",
)
def epoch_order(spark, sf_dir):
    """Each task checks that its lanes keep frame order and that no message of a session comes after one of a later epoch."""
    last = {}

    def deliver(message):
        session, lane = message["session_id"], (message["session_id"], message["lane"])
        if message["epoch"] < last.get(session, 0) or message["frame_no"] <= last.get(lane, -1):
            raise ValueError("out of order")
        last[session], last[lane] = message["epoch"], message["frame_no"]

    condition = filters.should_forward()
    all_events = events(spark, sf_dir, where=filters.should_forward(emit_schema=True))
    forwarded = filters.forwardable(all_events, condition)
    plan = epochs.plan_epochs(filters.forwardable(all_events, F.lit(True)), forwarded)
    log = epochs.deliver_epochs(outbox.to_webhook(forwarded, "http://hook"), plan, deliver)
    return log.join(plan, ["session_id", "frame_no"]).select("session_id", "frame_no", "epoch", "ok")
