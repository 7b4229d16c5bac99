"""Notifications and session activity, derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NOTIFY_SQL = """
SELECT event_id AS frame_no, event_type AS channel, CAST(user_id AS INT) AS pid,
 CASE CAST(event_id % 6 AS INT)
 WHEN 0 THEN concat('{"meta":{"routing":{"rabbitmq_exchange":"x_', event_type, '","kafka_topic":"t_', event_type,
   '","kafka_key":"u', CAST(user_id AS VARCHAR(20)), '","rabbitmq_headers":{"x-priority":"1"},"kafka_headers":{"h":"a"},',
   '"webhook_headers":{"Authorization":"t"},"shell_env":{"EVENT_ID":"', CAST(event_id AS VARCHAR(20)),
   '"}},"schema_version":"2","event_type":"', event_type, '.created"},"data":', props, '}')
 WHEN 1 THEN concat('{"meta":{"routing":{}},"data":', props, '}')
 WHEN 2 THEN concat('{"meta":{"schema_version":"1"},"data":', props, '}')
 WHEN 3 THEN concat('{"meta":{"routing":{},"schema_version":1},"data":', props, '}')
 WHEN 4 THEN '{"meta":{"routing":{"kafka_headers":{"h":1}}},"data":null}'
 ELSE concat('plain ', event_type) END AS payload
FROM events
"""

ACTIVITY_SQL = """
SELECT CAST(event_id AS INT) AS pid, concat('user_', CAST(user_id AS VARCHAR(20))) AS usename,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS application_name,
 CAST(NULL AS VARCHAR(20)) AS client_addr,
 CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN 'idle' ELSE 'active' END AS state,
 CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END AS query_start
FROM events
"""


def _over_events(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("fixture_events")
    return spark.sql(text.replace("FROM events", "FROM fixture_events"))


def notify_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_events(spark, sf_dir, NOTIFY_SQL)


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_events(spark, sf_dir, ACTIVITY_SQL)
