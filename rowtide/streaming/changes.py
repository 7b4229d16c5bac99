"""Captured frames as a stream: decode, filter, address, deliver, confirm.

Each micro-batch runs the batch plan of ``rowtide.plans.changes``. What must
outlive it - relation descriptions in force and sessions that ended - is the
log of ``rowtide.streaming.state``. All writes are per batch id, so a replayed
batch replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowtide.functions.lsn import parse_position
from rowtide.operators import filters, outbox
from rowtide.plans import changes
from rowtide.session import configure, intermediates, write_shared
from rowtide.streaming import lease, progress, state
from rowtide.streaming.deliver import Deliver, DeliveryFailed, deliver_changes, journaled
from rowtide.streaming.epochs import deliver_epochs, plan_epochs
from rowtide.streaming.journal import Journal

LOG_FILE_ROWS = 500_000  # of a delivery log

# What dead letters and positions are made of.
_CONFIRMED = ["session_id", "frame_no", "wal_end", "kind", "position", "error_class", "error"]


@dataclass
class ChangeStream:
    """What to read from a change stream and where to send it.

    ``order="session"`` keeps the frames of a ``lane`` in order, ``order="keys"`` those of a row key, between
    barriers (``rowtide.streaming.epochs``), with ``tasks`` tasks that run at once. ``lines`` writes an outbox
    without ``deliver`` as text, a message a line.
    """

    consumer: progress.Consumer
    sink: str = "stdout"
    options: Mapping[str, object] = field(default_factory=dict)
    tables: Sequence[str] = ()
    ops: Sequence[str] = ()
    emit_boundaries: bool = False
    emit_schema: bool = False
    start: str | None = None
    deliver: Deliver | None = None
    on_error: str = "fail"
    lanes: Sequence[str] = ("session_id",)
    order: str = "session"
    tasks: int | None = None
    lines: bool = False
    publications: Sequence[str] = ()
    members: DataFrame | None = None

    def __post_init__(self) -> None:
        if self.sink not in outbox.SINKS:
            raise ValueError(f"unknown sink {self.sink!r}")
        if self.on_error not in ("fail", "continue"):
            raise ValueError(f"unknown error mode {self.on_error!r}")
        if self.order not in ("session", "keys"):
            raise ValueError(f"unknown order {self.order!r}")
        if not self.lanes or set(self.lanes) - set(outbox.OUTBOX_COLUMNS):
            raise ValueError(f"lanes are outbox columns, not {list(self.lanes)}")
        if self.publications and self.members is None:
            raise ValueError("publications need the table of their members")

    def condition(self) -> Column:
        return filters.should_forward(self.tables, self.ops, self.emit_boundaries, self.emit_schema)

    def forward(self, events: DataFrame) -> DataFrame:
        """Events that are to be sent."""
        if self.publications:
            events = filters.in_publications(events, self.members, self.publications)
        return filters.from_position(filters.forwardable(events, self.condition()), self.start)

    def address(self, forwarded: DataFrame) -> DataFrame:
        """Forwarded events as outbox rows."""
        return outbox.SINKS[self.sink](forwarded, **self.options)


def process_batch(
    stream: ChangeStream, batch: DataFrame, batch_id: int, fence: Callable[[], None] | None = None
) -> None:
    """Run one micro-batch to the end: outbox or delivery, then positions, then state.

    ``fence`` raises where this driver may no longer write; it is asked before messages go out and before positions move.
    """
    spark, consumer = batch.sparkSession, stream.consumer
    configure(spark)
    fence = fence or (lambda: None)
    with intermediates(spark):
        control = changes.read_control(batch, state.carried(spark, consumer, batch_id))
        # Messages are made from a reading of their own, as whole events cost more to keep than to read: what is kept for dead
        # letters and positions is checked by lengths only. A delivery by row keys reads events for its plan and its messages,
        # and keeps them. The micro-batch is bounded by its trigger and spills to disk when it must.
        images = stream.condition()
        whole = changes.decode_changes(batch, control=control, images=images)
        if stream.deliver and stream.order == "keys":
            events = whole = whole.persist()
        else:
            events = changes.decode_changes(batch, control=control, images=False).select(_CONFIRMED).persist()
        try:
            failures = None
            fence()
            forwarded = stream.forward(whole)
            rows = stream.address(forwarded)
            if stream.deliver is None:
                _write_outbox(stream, rows, consumer.batch_folder("outbox", batch_id))
            else:
                failures = _deliver(stream, whole, forwarded, rows, batch_id)
            changes.dead_letters(events).write.mode("overwrite").parquet(
                consumer.batch_folder("dead_letters", batch_id)
            )
            floor = parse_position(stream.start) if stream.start else 0
            fence()
            progress.confirmed_positions(events, failures, floor).withColumn(
                "updated", F.current_timestamp()
            ).write.mode("overwrite").parquet(consumer.batch_folder("progress", batch_id))
            state.store(consumer, control.records, batch_id)
        finally:
            events.unpersist()


def _write_outbox(stream: ChangeStream, rows: DataFrame, folder: str) -> None:
    if stream.lines:
        ordered = rows.repartitionByRange("session_id", "frame_no").sortWithinPartitions("session_id", "frame_no")
        outbox.write_lines(ordered, folder)
    else:
        rows.write.mode("overwrite").parquet(folder)


def _deliver(
    stream: ChangeStream, events: DataFrame, forwarded: DataFrame, rows: DataFrame, batch_id: int
) -> DataFrame | None:
    """Send what this batch has not sent before; return the failures, None where there can be none."""
    spark, consumer = rows.sparkSession, stream.consumer
    folder = consumer.batch_folder("delivery_log", batch_id)
    journal = Journal(consumer.batch_folder("journal", batch_id))
    # What a run of this batch sent before it was cut off is in the journal only.
    before = journaled(spark, journal)
    known = progress.read_or_empty(spark, folder, progress.LOG_SCHEMA)
    sent = write_shared(
        known.unionByName(before).filter("ok").select("session_id", "frame_no", "sink").distinct(), "sent"
    )
    unlogged = sent.join(known.filter("ok"), ["session_id", "frame_no"], "left_anti").select(
        "session_id", "frame_no", "sink", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error")
    )
    open_rows = rows.join(sent, ["session_id", "frame_no"], "left_anti")
    strict = stream.on_error == "fail"
    if stream.order == "keys":
        plan = plan_epochs(events, forwarded)
        logged = deliver_epochs(open_rows, plan, stream.deliver, strict, stream.tasks, journal)
    else:
        logged = deliver_changes(open_rows, stream.deliver, strict, lanes=stream.lanes, journal=journal)
    # Two writes: the number of a task that sends, under which its journal goes, must not depend on what was sent before. The
    # task of a busy lane writes many files, so that more than one can read them.
    unlogged.write.mode("append").parquet(folder)
    logged.write.option("maxRecordsPerFile", LOG_FILE_ROWS).mode("append").parquet(folder)
    log = progress.read_or_empty(spark, folder, progress.LOG_SCHEMA)
    outcome = log.groupBy("session_id", "frame_no").agg(F.bool_or("ok").alias("ok"))
    failures = outcome.filter(~F.col("ok"))
    if not strict:
        return failures
    if failed := failures.count():
        raise DeliveryFailed(f"{failed} messages of batch {batch_id} were not delivered")
    return None


def start(
    frames: DataFrame, stream: ChangeStream, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Start the stream under its consumer's name and checkpoint."""

    def handle(batch: DataFrame, batch_id: int, fence: Callable[[], None]) -> None:
        process_batch(stream, batch, batch_id, fence)

    return start_query(frames, stream.consumer, handle, trigger)


def start_query(
    source: DataFrame,
    consumer: progress.Consumer,
    handle: Callable[[DataFrame, int, Callable[[], None]], None],
    trigger: Mapping[str, object] | None,
) -> StreamingQuery:
    """Run a consumer's query under its lease; at its end the lease is given back, a temporary consumer removed."""
    spark = configure(source.sparkSession)
    held = lease.Lease(spark, consumer.root, consumer.name)
    held.keep()

    def fenced(batch: DataFrame, batch_id: int) -> None:
        held.check()
        handle(batch, batch_id, held.check)

    def ended() -> None:
        held.release()
        if consumer.temporary:
            consumer.remove(spark)

    writer = (
        source.writeStream.queryName(consumer.name)
        .foreachBatch(fenced)
        .option("checkpointLocation", consumer.checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    return lease.run_at_end(spark, writer.start, ended)


def read_outbox(spark: SparkSession, consumer: progress.Consumer) -> DataFrame:
    """All outbox rows a consumer has written, with their batch."""
    return spark.read.parquet(consumer.folder("outbox"))
