"""What databases and tables there are, how big they are, who is active."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Unit names of the size report, each 1024 times the one before.
UNITS = ("bytes", "kB", "MB", "GB", "TB", "PB")
SYSTEM_SCHEMAS = ("pg_catalog", "information_schema", "sys")


def pretty_size(size: Column) -> Column:
    """Size with a unit: whole numbers, the next unit from about ten of it on.

    Bytes are shown below 10240. Each further unit keeps half units while
    scaling and is shown below 20479 halves, rounded half up. Sizes beyond
    BIGINT, which DECIMAL holds, are shown in the last unit.
    """
    fits = size.try_cast("bigint")
    text = F.when(fits < 10 * 1024, F.concat(fits.cast("string"), F.lit(" bytes")))
    for power, unit in enumerate(UNITS[1:], start=1):
        halves = F.shiftright(fits, 10 * power - 1)
        shown = F.concat(F.shiftright(halves + 1, 1).cast("string"), F.lit(f" {unit}"))
        text = text.otherwise(shown) if unit == UNITS[-1] else text.when(halves < 20 * 1024 - 1, shown)
    return F.coalesce(text, _beyond_bigint(size.cast("decimal(38,0)")))


def _beyond_bigint(size: Column) -> Column:
    """The text of a size no BIGINT holds: negative ones in bytes, as all are, others in the last unit."""
    one = F.lit(1024 ** (len(UNITS) - 1)).cast("decimal(38,0)")
    raised = size + F.lit(1024 ** (len(UNITS) - 1) // 2).cast("decimal(38,0)")
    # What is divided is a multiple, so the quotient is exact.
    whole = ((raised - raised % one) / one).cast("decimal(38,0)")
    return F.when(size < 0, F.concat(size.cast("string"), F.lit(" bytes"))).otherwise(
        F.concat(whole.cast("string"), F.lit(f" {UNITS[-1]}"))
    )


def file_sizes(spark: SparkSession, pattern: str) -> DataFrame:
    """``(path, length)`` of the files behind ``pattern``; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern).select("path", "length")
    )


def table_sizes(spark: SparkSession, folder: str, schema: str | None = None) -> DataFrame:
    """``(schema, table, bytes)`` of the parquet tables in a folder.

    A table is a file ``name.parquet`` or a folder of that name.
    """
    files = file_sizes(spark, folder)
    own = folder.rstrip("/").rsplit("/", 1)[-1]
    inside = F.regexp_extract("path", rf"{_quoted(own)}/(.*)$", 1)
    return (
        files.select(F.regexp_extract(inside, r"^([^/]+)\.parquet", 1).alias("table"), "length")
        .filter(F.col("table") != "")
        .groupBy("table")
        .agg(F.sum("length").alias("bytes"))
        .select(F.lit(schema or own).alias("schema"), "table", "bytes")
    )


def _quoted(text: str) -> str:
    return "".join(ch if ch.isalnum() or ch in "_-/" else "\\" + ch for ch in text)


def list_tables(sizes: DataFrame) -> DataFrame:
    """Tables of all but the system schemas with their size, by schema and name."""
    return (
        sizes.filter(~F.col("schema").isin(*SYSTEM_SCHEMAS))
        .select("schema", "table", pretty_size(F.col("bytes")).alias("size"))
        .orderBy("schema", "table")
    )


def list_databases(sizes: DataFrame) -> DataFrame:
    """Databases with the size of all their tables, by name."""
    return (
        sizes.groupBy(F.col("schema").alias("database"))
        .agg(F.sum("bytes").alias("bytes"))
        .select("database", pretty_size(F.col("bytes")).alias("size"))
        .orderBy("database")
    )


def registered_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables the session knows. Their names are metadata, not data."""
    names = [
        (t.namespace[0] if t.namespace else "", t.name)
        for t in spark.catalog.listTables(database)
    ]
    return spark.createDataFrame(names, "schema STRING, table STRING").orderBy("schema", "table")


def active_sessions(activity: DataFrame) -> DataFrame:
    """Sessions with a state, latest query first, unknown values as empty text."""
    empty = F.lit("")
    return (
        activity.filter(F.col("state").isNotNull())
        .orderBy(F.desc_nulls_last("query_start"))
        .select(
            "pid",
            F.coalesce("usename", empty).alias("user"),
            F.coalesce("application_name", empty).alias("app"),
            F.coalesce("state", empty).alias("state"),
        )
    )
