"""What a stream must remember: descriptions in force and ended sessions, as a log of changes.

A micro-batch writes only what it changed. Every ``EVERY`` batches the whole state is written anew and, one batch later,
what came before it is removed, so the number of files stays within two periods. Descriptions of an ended session go;
its tombstone, a row of its last frame, stays, as frames behind it must be told.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.storage import Storage
from rowtide.streaming.progress import Consumer

EVERY = 10
_MARK = "batch_id="


def _whole(batch_id: int) -> int:
    """The last batch before ``batch_id`` that wrote the whole state."""
    return (batch_id - 1) // EVERY * EVERY


def in_force(records: DataFrame) -> DataFrame:
    """Latest description of each relation of a living session and the end of each ended one."""
    row = F.struct(*records.columns)
    described = (
        records.filter((F.col("kind") == "relation") & F.col("error_class").isNull())
        .groupBy("session_id", "rel_id")
        .agg(F.max_by(row, "frame_no").alias("r"))
    )
    ended = (
        records.filter(F.col("error_class") == "fatal")
        .groupBy("session_id")
        .agg(F.min_by(row, "frame_no").alias("r"))
    )
    living = described.join(ended.select("session_id"), "session_id", "left_anti")
    return living.select("r.*").unionByName(ended.select("r.*"))


def carried(spark: SparkSession, consumer: Consumer, batch_id: int) -> DataFrame | None:
    """Control records in force before ``batch_id``; batch ids are consecutive, so no folder is listed."""
    if not batch_id:
        return None
    folders = [consumer.batch_folder("control", k) for k in range(_whole(batch_id), batch_id)]
    return in_force(spark.read.parquet(*folders))


def store(consumer: Consumer, records: DataFrame, batch_id: int) -> None:
    """Write what ``batch_id`` leaves behind; ``records`` are its control records, ``carried`` ones included."""
    own = records if batch_id % EVERY == 0 else records.filter(~F.col("carried"))
    in_force(own.drop("carried")).write.mode("overwrite").parquet(consumer.batch_folder("control", batch_id))
    if batch_id % EVERY == 1:  # the whole state before is committed: nothing older is read again
        _remove_before(Storage(records.sparkSession, consumer.root), consumer, batch_id - 1)


def _remove_before(storage: Storage, consumer: Consumer, batch_id: int) -> None:
    folder = consumer.folder("control")
    for name in storage.names(folder):
        if name.startswith(_MARK) and int(name[len(_MARK) :]) < batch_id:
            storage.remove(f"{folder}/{name}")
