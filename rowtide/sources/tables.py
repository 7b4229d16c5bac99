"""SQL over registered tables."""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from rowtide.session import configure


def register_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> None:
    """Make ``folder/<name>.parquet`` queryable as ``<name>``."""
    for name in names:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str | None = None, file: str | None = None) -> DataFrame:
    """Rows of one statement, given as text or as a ``.sql`` file - exactly one of them."""
    if (text is None) == (file is None):
        raise ValueError("give either a statement or a file")
    configure(spark)
    statement = Path(file).read_text(encoding="utf-8") if file is not None else text
    return spark.sql(statement.strip().rstrip(";"))
