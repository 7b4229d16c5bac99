"""Positions, named consumers and delivery logs.

Everything a consumer must remember is a small table under one root folder,
written per micro-batch so that a replayed batch overwrites its own rows.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.constants import DEFAULT_CONSUMER, PLUGIN
from rowtide.functions.lsn import lsn_text
from rowtide.session import shared_dir
from rowtide.storage import Storage
from rowtide.streaming import lease

LOG_SCHEMA = "session_id STRING, frame_no BIGINT, sink STRING, ok BOOLEAN, error STRING"
PROGRESS_SCHEMA = "session_id STRING, position DECIMAL(20,0), updated TIMESTAMP"
REGISTRY_SCHEMA = "name STRING, plugin STRING, generation INT, created TIMESTAMP"
_NAME = re.compile(r"[a-z0-9_]{1,63}")


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or no rows when nothing was stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def is_handled(failed: Column | None = None) -> Column:
    """Whether an event may move the position forward.

    Keepalives, skipped types, filtered-out and delivered events do; records
    that could not be decoded and failed deliveries do not.
    """
    decoded = F.col("error_class").isNull()
    return decoded if failed is None else decoded & ~F.coalesce(failed, F.lit(False))


def with_handled(events: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """Add ``handled``; ``failures(session_id, frame_no)`` names failed deliveries."""
    if failures is None:
        return events.withColumn("handled", is_handled())
    marked = failures.select("session_id", "frame_no").distinct().withColumn("_failed", F.lit(True))
    joined = events.join(marked, ["session_id", "frame_no"], "left")
    return joined.withColumn("handled", is_handled(F.col("_failed"))).drop("_failed")


def confirmed_positions(events: DataFrame, failures: DataFrame | None = None, start: int = 0) -> DataFrame:
    """``(session_id, position)``: highest handled position, never below ``start``.

    The maximum is taken before the shuffle, so a busy session costs one row
    per task.
    """
    floor = F.lit(start).cast("decimal(20,0)")
    position = F.coalesce(F.max(F.when(F.col("handled"), F.col("position"))), floor)
    return (
        with_handled(events, failures)
        .groupBy("session_id")
        .agg(F.greatest(position, floor).alias("position"))
    )


@dataclass(frozen=True)
class Consumer:
    """A named reader of a stream and the folders that hold its progress."""

    root: str
    name: str
    generation: int
    temporary: bool = False

    def folder(self, kind: str) -> str:
        return f"{self.root}/{kind}/consumer={self.name}/generation={self.generation}"

    @property
    def checkpoint(self) -> str:
        return self.folder("checkpoint")

    def batch_folder(self, kind: str, batch_id: int) -> str:
        return f"{self.folder(kind)}/batch_id={batch_id}"

    def remove(self, spark: SparkSession) -> None:
        """Forget a temporary consumer: everything it wrote goes."""
        if not self.temporary:
            raise ValueError(f"consumer {self.name!r} is not temporary")
        Storage(spark, self.root).remove(self.root)


def registry(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/consumers", REGISTRY_SCHEMA)


def open_consumer(
    spark: SparkSession,
    root: str,
    name: str = DEFAULT_CONSUMER,
    reset: bool = False,
    temporary: bool = False,
) -> Consumer:
    """Create a consumer, or continue one that is not in use.

    ``reset`` starts a new generation with empty progress. A temporary one
    lives in a folder of its own, is in no list and goes with its query. In use is what a query of this
    session or, by its lease, another driver runs.
    """
    if not _NAME.fullmatch(name):
        raise ValueError(f"consumer name {name!r}: lower-case letters, digits and underscores only")
    if any(query.name == name for query in spark.streams.active):
        raise RuntimeError(f"consumer {name!r} is in use by a running query")
    if temporary:
        return Consumer(f"{shared_dir(spark)}/rowtide/temporary-{uuid.uuid4().hex}", name, 0, True)
    if lease.holder(spark, root, name) not in (None, lease.OWNER):
        raise RuntimeError(f"consumer {name!r} is in use by another driver")
    last = registry(spark, root).filter(F.col("name") == name).agg(F.max("generation")).first()[0]
    if last is not None and not reset:
        return Consumer(root, name, last)
    generation = 0 if last is None else last + 1
    row = spark.range(1).select(
        F.lit(name).alias("name"),
        F.lit(PLUGIN).alias("plugin"),
        F.lit(generation).alias("generation"),
        F.current_timestamp().alias("created"),
    )
    row.coalesce(1).write.mode("append").parquet(f"{root}/consumers")
    return Consumer(root, name, generation)


def stored_positions(spark: SparkSession, root: str) -> DataFrame:
    """``(consumer, generation, batch_id, session_id, position, updated)`` of all consumers."""
    schema = PROGRESS_SCHEMA + ", consumer STRING, generation INT, batch_id BIGINT"
    return read_or_empty(spark, f"{root}/progress", schema)


def session_positions(spark: SparkSession, consumer: Consumer) -> DataFrame:
    """Confirmed position of every session one consumer has read."""
    own = (F.col("consumer") == consumer.name) & (F.col("generation") == consumer.generation)
    return (
        stored_positions(spark, consumer.root)
        .filter(own)
        .groupBy("session_id")
        .agg(F.max("position").alias("position"))
    )


def list_consumers(spark: SparkSession, root: str) -> DataFrame:
    """``(name, plugin, position, active)`` by name; the position is text or NULL."""
    current = registry(spark, root).groupBy("name", "plugin").agg(F.max("generation").alias("generation"))
    reached = (
        stored_positions(spark, root)
        .groupBy(F.col("consumer").alias("name"), "generation")
        .agg(F.max("position").alias("reached"))
    )
    running = {query.name for query in spark.streams.active if query.name}
    running |= {held for held in lease.held_names(spark, root) if lease.holder(spark, root, held) != lease.OWNER}
    return (
        current.join(reached, ["name", "generation"], "left")
        .select(
            "name",
            "plugin",
            lsn_text(F.col("reached")).alias("position"),
            F.col("name").isin(sorted(running)).alias("active") if running else F.lit(False).alias("active"),
        )
        .orderBy("name")
    )


def delivery_log(spark: SparkSession, consumer: Consumer) -> DataFrame:
    return read_or_empty(spark, consumer.folder("delivery_log"), LOG_SCHEMA + ", batch_id BIGINT")
