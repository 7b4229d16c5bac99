"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from rowtide.storage import Storage

# Settings the expressions rely on. Everything else stays as the cluster has it.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated column name or header keeps its last value.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # A repeated JSON key keeps its last value instead of voiding the payload.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Wide projections compile to methods the JVM never optimises beyond this
    # many bytes of code; split projections run about twice as fast then.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on; safe to call repeatedly."""
    for key, value in REQUIRED_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local master, where driver and executors share one disk, may fall
    back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    named = tempfile.mkdtemp(prefix="rowtide-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


_SCOPES = threading.local()


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Remove, at its end, the tables ``write_shared`` writes inside it from this thread."""
    outer, _SCOPES.paths = getattr(_SCOPES, "paths", None), []
    try:
        yield
    finally:
        paths, _SCOPES.paths = _SCOPES.paths, outer
        for path in paths:
            Storage(spark, path).remove(path)


def write_shared(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    Cuts the lineage durably: a lost executor costs a re-read, never another
    run of the plan that produced the rows. The table stays, but for one written inside
    ``intermediates``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/rowtide/{name}-{uuid.uuid4().hex}"
    if getattr(_SCOPES, "paths", None) is not None:
        _SCOPES.paths.append(path)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
