"""SQL pass-through, inputs and catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures import messages
from rowtide.operators import filters
from rowtide.sources import catalog
from rowtide.sources.notify import read_frames, read_notify, subscribe
from rowtide.sources.tables import register_tables, run_sql
from rowtide.session import write_shared
from suite.base import TABLES, events, frames, notify, over_log, query, table

# One text per class of statement; both engines run the same text.
SQL_TEXTS = {
    "S1_sql_select_limit": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10",
    "S1_sql_count": "SELECT count(*) AS n FROM orders",
    "S1_sql_select_all": "SELECT * FROM orders",
    "S1_sql_filter": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        WHERE l_quantity < 10 AND l_returnflag = 'R'""",
    "S1_sql_inner_join": """SELECT o_orderkey, c_name, n_name FROM orders
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE o_orderstatus = 'F'""",
    "S1_sql_left_join": """SELECT c_custkey, count(o_orderkey) AS n_orders FROM customer
        LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
    "S1_sql_semi_join": """SELECT c_custkey, c_name FROM customer
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""",
    "S1_sql_anti_join": """SELECT c_custkey, c_name FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""",
    "S1_sql_group_having": """SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12""",
    "S1_sql_distinct": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "S1_sql_rollup": """SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem
        GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
    "S1_sql_cube": """SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
        GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
    "S1_sql_grouping_sets": """SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
        GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())""",
    "S1_sql_rank_window": """SELECT o_custkey, o_orderkey,
        CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS rn FROM orders""",
    "S1_sql_frame_window": """SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_quantity AS BIGINT)) OVER (
        PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS BIGINT) AS q
        FROM lineitem""",
    "S1_sql_union": "SELECT n_name AS name FROM nation UNION SELECT r_name AS name FROM region",
    "S1_sql_intersect": "SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey AS k FROM customer",
    "S1_sql_except": "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey AS k FROM orders",
    "S1_sql_cte": """WITH big AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
        SELECT n, count(*) AS customers FROM big GROUP BY n""",
    "S1_sql_correlated": """SELECT o_orderkey FROM orders o WHERE o_totalprice >
        (SELECT avg(i.o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)""",
    "S1_sql_top": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
    "S1_sql_functions": """SELECT event_id, upper(event_type) AS u, substring(props, 1, 4) AS p,
        CAST(extract(hour FROM ts) AS BIGINT) AS h, CAST(ts AS DATE) AS d, coalesce(event_type, '?') AS t
        FROM events""",
}


def _sql_query(text: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register_tables(spark, sf_dir, TABLES)
        return run_sql(spark, text)

    return run


for _name, _text in SQL_TEXTS.items():
    query(_name, _text)(_sql_query(_text))


@query("S1_sql_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def sql_json(spark, sf_dir):
    register_tables(spark, sf_dir, TABLES)
    return run_sql(spark, "SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM events")


@query(
    "S2_frame_source",
    over_log("""SELECT session_id, count(*) AS frames, min(frame_no) AS first_frame, max(frame_no) AS last_frame
             FROM log GROUP BY session_id"""),
)
def frame_source(spark, sf_dir):
    stored = frames(spark, sf_dir)
    read = read_frames(spark, stored.inputFiles()[0].rsplit("/", 1)[0])
    return read.groupBy("session_id").agg(
        F.count("*").alias("frames"), F.min("frame_no").alias("first_frame"), F.max("frame_no").alias("last_frame")
    )


@query("S3_notify_source", messages.NOTIFY_SQL)
def notify_source(spark, sf_dir):
    stored = write_shared(notify(spark, sf_dir), "notify")
    return read_notify(spark, stored.inputFiles()[0].rsplit("/", 1)[0]).select("frame_no", "channel", "pid", "payload")


@query(
    "S4_channel_subscription",
    f"SELECT frame_no, channel, pid FROM ({messages.NOTIFY_SQL}) n WHERE channel IN ('click', 'error')",
)
def channel_subscription(spark, sf_dir):
    return subscribe(notify(spark, sf_dir), ["click", "error", "CLICK "]).select("frame_no", "channel", "pid")


@query(
    "S5_publication_selection",
    over_log("""SELECT session_id, frame_no, kind FROM log
             WHERE kind NOT IN ('insert', 'update', 'delete', 'relation', 'truncate')
               OR (kind <> 'truncate' AND "schema" = 'sales' AND "table" = 'customer')"""),
)
def publication_selection(spark, sf_dir):
    kept = filters.in_publications(events(spark, sf_dir), _members(spark), ["crm"])
    return kept.select("session_id", "frame_no", "kind")


def _members(spark):
    return spark.sql(
        """SELECT * FROM VALUES ('crm', 'sales', 'customer', false), ('shop', 'public', 'orders', false)
           AS m(publication, schema, `table`, all_tables)"""
    )


@query(
    "S5_publication_truncates",
    # Each truncate names public.orders and a relation no publication lists.
    over_log("""SELECT session_id, frame_no, kind, CASE kind WHEN 'truncate' THEN '16391' END AS rel_ids,
             CASE kind WHEN 'truncate' THEN 'public.orders' END AS tables FROM log
             WHERE kind NOT IN ('insert', 'update', 'delete', 'relation') OR ("schema" = 'public' AND "table" = 'orders')"""),
)
def publication_truncates(spark, sf_dir):
    kept = filters.in_publications(events(spark, sf_dir), _members(spark), ["shop"])
    ids, tables = F.col("rel_ids").cast("array<string>"), F.col("tables")
    return kept.select(
        "session_id",
        "frame_no",
        "kind",
        F.when(ids.isNotNull(), F.concat_ws(",", ids)).alias("rel_ids"),
        F.when(tables.isNotNull(), F.concat_ws(",", tables)).alias("tables"),
    )


_FILES = """SELECT regexp_extract(filename, '([^/]+)/([^/]+)\\.parquet$', 1) AS "schema",
  regexp_extract(filename, '([^/]+)/([^/]+)\\.parquet$', 2) AS "table", CAST(size AS BIGINT) AS bytes
  FROM read_blob('/root/testdata/sf0.01/*.parquet')"""
_PRETTY = """CASE WHEN bytes < 10240 THEN concat(bytes, ' bytes')
  WHEN bytes // 512 < 20479 THEN concat((bytes // 512 + 1) // 2, ' kB')
  ELSE concat((bytes // 524288 + 1) // 2, ' MB') END"""


@query(
    "S6_list_databases",
    f"""SELECT "schema" AS "database", {_PRETTY} AS size FROM
        (SELECT "schema", CAST(sum(bytes) AS BIGINT) AS bytes FROM ({_FILES}) f GROUP BY "schema") d""",
)
def list_databases(spark, sf_dir):
    return catalog.list_databases(catalog.table_sizes(spark, sf_dir))


@query("S7_list_tables", f'SELECT "schema", "table", {_PRETTY} AS size FROM ({_FILES}) f')
def list_tables(spark, sf_dir):
    return catalog.list_tables(catalog.table_sizes(spark, sf_dir))


@query("S8_table_sizes", _FILES)
def table_sizes(spark, sf_dir):
    return catalog.table_sizes(spark, sf_dir)


@query(
    "S8_pretty_size",
    """SELECT o_orderkey, bytes, CASE WHEN bytes < 10240 THEN concat(bytes, ' bytes')
         WHEN bytes // 512 < 20479 THEN concat((bytes // 512 + 1) // 2, ' kB')
         WHEN bytes // 524288 < 20479 THEN concat((bytes // 524288 + 1) // 2, ' MB')
         WHEN bytes // 536870912 < 20479 THEN concat((bytes // 536870912 + 1) // 2, ' GB')
         ELSE concat((bytes // 549755813888 + 1) // 2, ' TB') END AS size
       FROM (SELECT o_orderkey, CAST(o_orderkey * o_orderkey * o_custkey AS BIGINT) AS bytes FROM orders) o""",
)
def pretty_size(spark, sf_dir):
    """Sizes are BIGINT, as in SQL. Over tables where a product is beyond it, which SQL refuses, they are exact decimals."""
    key, customer = (F.col(name).cast("decimal(19,0)") for name in ("o_orderkey", "o_custkey"))
    sized = table(spark, sf_dir, "orders").select("o_orderkey", (key * key * customer).alias("bytes"))
    least, most = sized.agg(F.min("bytes"), F.max("bytes")).first()
    if most is None or (least >= -(2**63) and most < 2**63):
        sized = sized.withColumn("bytes", F.col("bytes").cast("bigint"))
    return sized.withColumn("size", catalog.pretty_size(F.col("bytes")))


@query(
    "S9_activity_report",
    f"""SELECT pid, coalesce(usename, '') AS "user", coalesce(application_name, '') AS app, state
        FROM ({messages.ACTIVITY_SQL}) a WHERE state IS NOT NULL ORDER BY query_start DESC NULLS LAST""",
)
def activity_report(spark, sf_dir):
    return catalog.active_sessions(messages.activity(spark, sf_dir))
