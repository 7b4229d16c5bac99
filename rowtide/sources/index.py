"""Captured frames with an index beside each payload, written when they are taken in.

What decides whether a frame is needed - its kind, relation and position - stands in columns of its own, so a
reader skips row groups and columns: the control pass reads the few payloads it opens and no others,
and rows of other relations or earlier positions are not read at all. Frames without these columns work as before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.constants import DML
from rowtide.operators import frames as fr
from rowtide.sources.notify import FILES_PER_TRIGGER, FRAMES_SCHEMA

# ``ix_control`` repeats the payload of descriptions, truncates and fatal frames.
INDEX_SCHEMA = """ix_kind STRING, ix_rel BIGINT, ix_position DECIMAL(20,0), ix_described BOOLEAN, ix_fatal BOOLEAN,
    ix_control BINARY"""
INDEX = [field.split()[0] for field in INDEX_SCHEMA.replace("(20,0)", "").split(",")]
# Small row groups: their minima and maxima are what is skipped by.
ROW_GROUP_BYTES = 16 << 20
# Relations named one by one in a pushed filter; for more, all are read.
MOST_IDS = 1000


def index_frames(frames: DataFrame) -> DataFrame:
    """Add the index columns to ``frames(session_id, frame_no, payload)``."""
    known = fr.classify(frames).select("session_id", "frame_no", "payload", "kind", "rel_id", "position")
    return known.select(
        "session_id",
        "frame_no",
        "payload",
        F.col("kind").alias("ix_kind"),
        F.col("rel_id").alias("ix_rel"),
        F.col("position").alias("ix_position"),
        fr.is_described().alias("ix_described"),
        F.coalesce(fr.is_fatal(), F.lit(True)).alias("ix_fatal"),
        F.when(fr.is_described() | F.coalesce(fr.is_fatal(), F.lit(True)), F.col("payload")).alias("ix_control"),
    )


def write_frames(frames: DataFrame, path: str, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Write frames with their index, rows of one relation together, in frame order within it.

    Each task sorts its own frames, so files still appear in the order of the capture.
    """
    (
        index_frames(frames)
        .sortWithinPartitions(F.desc("ix_described"), F.desc("ix_fatal"), "ix_rel", "frame_no")
        .write.option("parquet.block.size", row_group_bytes)
        .parquet(path)
    )


def read_indexed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{FRAMES_SCHEMA}, {INDEX_SCHEMA}").parquet(path)


def stream_indexed(spark: SparkSession, path: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    reader = spark.readStream.schema(f"{FRAMES_SCHEMA}, {INDEX_SCHEMA}")
    return reader.option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def is_indexed(frames: DataFrame) -> bool:
    return set(INDEX) <= set(frames.columns)


def control_frames(frames: DataFrame) -> DataFrame:
    """Descriptions, truncates and fatal frames."""
    if not is_indexed(frames):
        return frames.filter(fr.is_described() | fr.is_fatal())
    few = frames.filter(F.col("ix_described") | F.col("ix_fatal"))
    return few.select("session_id", "frame_no", F.col("ix_control").alias("payload"))


def row_frames(frames: DataFrame, rel_ids: Sequence[int] | None = None, start: int = 0) -> DataFrame:
    """All but descriptions and truncates; where indexed, without rows of other relations or before ``start``."""
    if not is_indexed(frames):
        return frames.filter(~fr.is_described())
    kept = ~F.col("ix_described")
    # What is no readable row message stays: it ends sessions, marks boundaries or is an error.
    other = ~F.col("ix_kind").isin(*DML) | F.col("ix_rel").isNull()
    if rel_ids is not None:
        kept = kept & (other | F.col("ix_rel").isin(list(rel_ids)))
    if start:
        kept = kept & (other | (F.col("ix_position") >= F.lit(start).cast("decimal(20,0)")))
    return frames.filter(kept).select("session_id", "frame_no", "payload")
