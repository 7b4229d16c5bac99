"""Notification and captured-frame inputs, as tables or file streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAMES_SCHEMA = "session_id STRING, frame_no BIGINT, payload BINARY"
NOTIFY_SCHEMA = "frame_no BIGINT, channel STRING, pid INT, payload STRING"

# Bounds the rows of one micro-batch, and with them the longest session slice
# that is delivered in order by one task.
FILES_PER_TRIGGER = 64


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FRAMES_SCHEMA).parquet(path)


def stream_frames(spark: SparkSession, path: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Frames as files arrive. The capture job names files in frame order."""
    reader = spark.readStream.schema(FRAMES_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_notify(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NOTIFY_SCHEMA).parquet(path)


def stream_notify(spark: SparkSession, path: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    reader = spark.readStream.schema(NOTIFY_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def subscribe(notify: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Messages of the named channels; exact and case-sensitive, at least one."""
    if not channels:
        raise ValueError("name at least one channel")
    return notify.filter(F.col("channel").isin(list(channels)))
