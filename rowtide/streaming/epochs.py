"""Order by row key and barrier: one session's messages over all tasks.

Truncates, descriptions, forwarded boundaries and rows whose key changes are *barriers*: they cut the
messages of a session into epochs, a run of barriers being an epoch of its own. Inside an epoch the
rows of one key go through one lane in frame order, and lanes run in parallel. No lane enters the next
epoch of a session before all have left the last: the tasks of one barrier stage meet after every step
and tell each other which sessions have failed.

A meeting takes about a second, so it must be worth one: epochs of few messages that follow one another
make one step, sent in frame order by one lane; an epoch of ``LEAST_ROWS`` or more is a step of its own.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import BarrierTaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.constants import DML
from rowtide.session import write_shared
from rowtide.streaming.deliver import Deliver, Lanes, pack_lanes
from rowtide.streaming.journal import Journal
from rowtide.streaming.progress import LOG_SCHEMA

LEAST_ROWS = 1_000  # messages of an epoch from which a meeting costs less than sending them one after another

# Executors need pandas and pyarrow, not this package: its functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _key_of(image: str) -> Column:
    """Values of the key columns in an image; NULL where one is absent or was not sent."""
    cells = F.transform("key_names", lambda name: F.element_at(image, name))
    known = F.forall(cells, lambda cell: F.coalesce(cell["state"] != "u", F.lit(False)))
    return F.when(known, cells)


def with_lanes(events: DataFrame) -> DataFrame:
    """Add ``lane`` and ``is_barrier``.

    A row's lane is its key, or its table where the description names no key. A row whose key
    changes, or whose key cannot be read, is a barrier, as is every event that is no row. Two keys of one hash
    share a lane, which costs nothing but speed.
    """
    old, new = _key_of("old"), _key_of("new")
    key = (
        F.when(F.col("op") == "insert", new)
        .when(F.col("op") == "delete", old)
        .when(F.col("old").isNull() | (old == new), new)
    )
    is_row = F.col("op").isin(*DML)
    by_table = F.col("key_names").isNull()
    steady = F.coalesce(is_row & (by_table | key.isNotNull()), F.lit(False))
    lane = F.when(steady & by_table, F.xxhash64("session_id", "rel_id")).when(
        steady, F.xxhash64("session_id", "rel_id", key)
    )
    return events.withColumn("lane", F.coalesce(lane, F.xxhash64("session_id"))).withColumn("is_barrier", ~steady)


def _count_changes(placed: DataFrame, mark: str, name: str) -> DataFrame:
    """Add how often ``mark`` has changed in the session up to each row, in frame order.

    Changes are counted inside the slices of a sort by (session, frame), then across slices, of which a
    session has one row each, so no session is one task.
    """
    inside = Window.partitionBy("_slice", "session_id").orderBy("frame_no")
    changed = F.coalesce(F.col(mark) != F.lag(mark).over(inside), F.lit(False)).cast("bigint")
    counted = placed.withColumn("_changed", changed).withColumn(
        "_run", F.sum("_changed").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    ends = counted.groupBy("_slice", "session_id").agg(
        F.max("_run").alias("_changes"),
        F.min_by(mark, "frame_no").alias("_first"),
        F.max_by(mark, "frame_no").alias("_last"),
    )
    across = Window.partitionBy("session_id").orderBy("_slice")
    crossed = F.coalesce(F.col("_first") != F.lag("_last").over(across), F.lit(False)).cast("bigint")
    # Changes before a slice: those inside earlier slices, and those between slices up to its own begin.
    offset = F.sum(F.col("_changes") + F.col("_crossed")).over(across) - F.col("_changes")
    offsets = ends.withColumn("_crossed", crossed).select("_slice", "session_id", offset.alias("_offset"))
    joined = counted.join(offsets, ["_slice", "session_id"])
    return joined.withColumn(name, F.col("_run") + F.col("_offset")).drop("_changed", "_run", "_offset")


def plan_epochs(
    events: DataFrame, forwarded: DataFrame, slices: int | None = None, least: int = LEAST_ROWS
) -> DataFrame:
    """``(session_id, frame_no, epoch, step, lane)`` of the forwarded events, written once.

    ``events`` adds the descriptions that are not forwarded: they change what a key is. ``step`` joins epochs of
    fewer than ``least`` messages; their lane is the session.
    """
    silent = events.filter(F.col("op") == "relation").withColumn("_sent", F.lit(False))
    marked = with_lanes(forwarded.withColumn("_sent", F.lit(True)).unionByName(silent))
    few = marked.select("session_id", "frame_no", "lane", F.col("is_barrier").cast("bigint").alias("_kind"), "_sent")
    few = write_shared(few, "epochs")  # the bounds of its slices are sampled: events are decoded once
    parts = slices or few.sparkSession.sparkContext.defaultParallelism
    sliced = few.repartitionByRange(parts, "session_id", "frame_no")
    placed = write_shared(sliced.withColumn("_slice", F.spark_partition_id()), "epochs")
    numbered = write_shared(_count_changes(placed, "_kind", "epoch").filter("_sent"), "epochs")
    large = numbered.groupBy("session_id", "epoch").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") >= least)
    sized = numbered.join(large, ["session_id", "epoch"], "left")
    is_large = F.col("_rows").isNotNull()
    grouped = sized.withColumn("_step_of", F.when(is_large, F.col("epoch")).otherwise(F.lit(-1))).withColumn(
        "lane", F.when(is_large, F.col("lane")).otherwise(F.xxhash64("session_id"))
    )
    stepped = _count_changes(grouped, "_step_of", "step")
    return write_shared(stepped.select("session_id", "frame_no", "epoch", "step", "lane"), "epochs")


def _epoch_sender(deliver: Deliver, stop_on_error: bool, rounds: int, journal: Journal | None):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        lanes = Lanes(deliver, stop_on_error, journal, f"task-{context.partitionId()}")
        failed: set = set()  # sessions that stopped in a step all tasks have left

        def meet() -> None:
            told = context.allGather(json.dumps(sorted(lanes.newly_failed())))
            failed.update(session for one in told for session in json.loads(one))

        step = 0
        try:
            for batch in batches:
                places = zip(*(batch.column(name).to_pylist() for name in ("step", "session_id", "lane")))
                for (due, session, lane), data in zip(places, batch.column("_slice")):
                    while step < due:
                        meet()
                        step += 1
                    held = session in failed
                    yield lanes.send_slice(data.as_py(), lane, held)
            while step < rounds:
                meet()
                step += 1
        finally:
            lanes.close()

    return send


def deliver_epochs(
    outbox: DataFrame,
    epochs: DataFrame,
    deliver: Deliver,
    stop_on_error: bool = True,
    tasks: int | None = None,
    journal: Journal | None = None,
) -> DataFrame:
    """Send change messages in the order of ``plan_epochs``; the log is written once.

    ``tasks`` must all run at once, as they meet after each step: as many as the cluster has slots, by
    default ``defaultParallelism``. A message that fails stops its lane for the step and its session for all later
    steps. A stage that Spark runs again sends only what ``journal`` does not name as accepted.
    """
    spark = outbox.sparkSession
    if spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false") == "true":
        raise ValueError("epochs need a fixed number of executors: Spark runs no barrier stage under dynamic allocation")
    last = epochs.agg(F.max("step")).first()[0] or 0
    lanes = (
        pack_lanes(outbox.join(epochs, ["session_id", "frame_no"]), ["step", "session_id", "lane"])
        .repartition(tasks or spark.sparkContext.defaultParallelism, "lane")
        .sortWithinPartitions("step", "session_id", "_first", "_last")
    )
    sender = _epoch_sender(deliver, stop_on_error, last, journal)
    return write_shared(lanes.mapInArrow(sender, LOG_SCHEMA, barrier=True), "delivered")
