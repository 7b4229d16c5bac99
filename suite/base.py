"""Inputs shared by the registered queries, and the SQL of the same change log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fixtures import capture, messages
from rowtide.plans import changes
from rowtide.session import configure, write_shared
from rowtide.sources import index

Query = Callable[[SparkSession, str], DataFrame]
TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


@dataclass
class Entry:
    run: Query
    oracle: str | None


ENTRIES: dict[str, Entry] = {}
_STORED: dict[tuple[str, str, str], DataFrame] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its operator's number and name."""

    def register(run: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")

        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return run(spark, sf_dir)

        ENTRIES[name] = Entry(configured, oracle)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _stored(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Frames are recorded once per session and folder, as a capture job would."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = write_shared(make(), name)
    return _STORED[key]


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "frames", lambda: capture.change_frames(spark, sf_dir))


def indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same frames as they are taken in with an index."""
    return _stored(spark, sf_dir, "indexed", lambda: index.index_frames(frames(spark, sf_dir)))


def broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "broken", lambda: capture.broken_frames(table(spark, sf_dir, "orders")))


def events(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return changes.decode_changes(frames(spark, sf_dir), **options)


def notify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.notify_messages(spark, sf_dir)


# The same change log in SQL: one row per frame, named like the decoded events.
EVENTS = """
base AS (SELECT *, CAST(16777216 + o_orderkey * 64 AS BIGINT) AS b FROM orders),
order_rows AS (
  SELECT 's1' AS session_id, CAST(b + k AS BIGINT) AS frame_no,
    CASE k WHEN 0 THEN 'insert' WHEN 16 THEN 'update' ELSE 'delete' END AS kind,
    CAST(16391 AS BIGINT) AS rel_id, 'public' AS "schema", 'orders' AS "table", CAST(b + k AS BIGINT) AS position,
    CAST(NULL AS VARCHAR) AS error_class, o_orderkey AS k0, CAST(o_orderkey AS VARCHAR) AS id,
    CASE k WHEN 0 THEN o_orderstatus WHEN 16 THEN 'F' END AS new_status,
    CASE WHEN k = 16 AND o_orderkey % 2 = 1 THEN o_orderstatus END AS old_status
  FROM base CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 16 UNION ALL SELECT 32) v
  WHERE k = 0 OR (k = 16 AND o_orderkey % 3 = 0) OR (k = 32 AND o_orderkey % 7 = 0)),
customer_rows AS (
  SELECT 's2' AS session_id, CAST(16777216 + c_custkey * 64 AS BIGINT) AS frame_no, 'insert' AS kind,
    CAST(16500 AS BIGINT) AS rel_id, 'sales' AS "schema", 'customer' AS "table",
    CAST(16777216 + c_custkey * 64 AS BIGINT) AS position, CAST(NULL AS VARCHAR) AS error_class, c_custkey AS k0,
    CAST(c_custkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS new_status, CAST(NULL AS VARCHAR) AS old_status
  FROM customer),
boundaries AS (
  SELECT 's1' AS session_id, CAST(b + k AS BIGINT) AS frame_no, CASE k WHEN -1 THEN 'begin' ELSE 'commit' END AS kind,
    CAST(NULL AS BIGINT) AS rel_id, CAST(NULL AS VARCHAR) AS "schema", CAST(NULL AS VARCHAR) AS "table",
    CAST(CASE k WHEN -1 THEN b ELSE b + 1 END AS BIGINT) AS position, CAST(NULL AS VARCHAR) AS error_class,
    o_orderkey AS k0, CAST(NULL AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS new_status,
    CAST(NULL AS VARCHAR) AS old_status
  FROM base CROSS JOIN (SELECT -1 AS k UNION ALL SELECT 1) v WHERE o_orderkey % 5 = 0),
extras AS (
  SELECT 's1' AS session_id, CAST(b + k AS BIGINT) AS frame_no,
    CASE k WHEN 40 THEN 'truncate' WHEN 42 THEN 'skipped' WHEN 44 THEN 'keepalive' WHEN 46 THEN 'insert'
      WHEN 48 THEN 'insert' ELSE 'error' END AS kind,
    CAST(CASE k WHEN 46 THEN 16391 WHEN 48 THEN 99 END AS BIGINT) AS rel_id,
    CASE k WHEN 46 THEN 'public' WHEN 48 THEN 'unknown_99' END AS "schema",
    CASE k WHEN 46 THEN 'orders' WHEN 48 THEN 'unknown' END AS "table",
    CAST(b + k AS BIGINT) AS position, CASE WHEN k IN (46, 50) THEN 'record' END AS error_class, o_orderkey AS k0,
    CASE k WHEN 48 THEN CAST(o_orderkey AS VARCHAR) END AS id, CAST(NULL AS VARCHAR) AS new_status,
    CAST(NULL AS VARCHAR) AS old_status
  FROM base CROSS JOIN (SELECT 40 AS k UNION ALL SELECT 42 UNION ALL SELECT 44 UNION ALL SELECT 46
    UNION ALL SELECT 48 UNION ALL SELECT 50) v WHERE o_orderkey % 50 = 0),
described AS (
  SELECT * FROM (VALUES
    ('s1', CAST(1 AS BIGINT), 'relation', CAST(16391 AS BIGINT), 'public', 'orders', CAST(1 AS BIGINT)),
    ('s2', CAST(1 AS BIGINT), 'relation', CAST(16500 AS BIGINT), 'sales', 'customer', CAST(1 AS BIGINT)),
    ('s2', CAST(16822014 AS BIGINT), 'relation', CAST(16500 AS BIGINT), 'sales', 'customer', CAST(16822014 AS BIGINT)))
    AS d(session_id, frame_no, kind, rel_id, "schema", "table", position)),
log AS (
  SELECT *, CASE WHEN error_class IS NULL THEN kind ELSE 'error' END AS op FROM (
    SELECT * FROM order_rows UNION ALL SELECT * FROM customer_rows UNION ALL SELECT * FROM boundaries
    UNION ALL SELECT * FROM extras
    UNION ALL SELECT session_id, frame_no, kind, rel_id, "schema", "table", position, CAST(NULL AS VARCHAR),
      CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM described) u)
"""


def over_log(select: str) -> str:
    return f"WITH {EVENTS} {select}"


# Text of a log position in SQL.
def sql_lsn(value: str) -> str:
    return f"printf('%X/%X', ({value}) >> 32, ({value}) & 4294967295)"
