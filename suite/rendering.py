"""Result sets as text cells, files and sheets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rowtide.operators import results, sheets
from rowtide.plans import export as ex
from rowtide.session import shared_dir
from suite.base import TABLES, query, table
from rowtide.sources.tables import register_tables


def _folder(spark, name):
    return f"{shared_dir(spark)}/rowtide/{name}-{uuid.uuid4().hex}"


@query(
    "R1_text_cells",
    """SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 3 = 0 THEN 'NULL' ELSE event_type END AS kind,
         CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END AS flag, CAST(user_id AS VARCHAR) AS small,
         'NULL' AS nothing FROM events""",
)
def text_cells(spark, sf_dir):
    typed = table(spark, sf_dir, "events").selectExpr(
        "event_id AS id",
        "if(event_id % 3 = 0, NULL, event_type) AS kind",
        "user_id % 2 = 0 AS flag",
        "cast(user_id AS int) AS small",
        "cast(NULL AS int) AS nothing",
    )
    return results.render(typed)


@query(
    "R2_float_cells",
    r"""SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
         regexp_replace(CAST(l_extendedprice AS VARCHAR), '\.0$', '') AS price,
         regexp_replace(CAST(l_discount AS VARCHAR), '\.0$', '') AS discount,
         regexp_replace(CAST(l_quantity AS VARCHAR), '\.0$', '') AS quantity FROM lineitem""",
)
def float_cells(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_extendedprice AS price", "l_discount AS discount", "l_quantity AS quantity"
    )
    return results.render(lines)


@query(
    "R3_numeric_cells",
    """SELECT CAST(o_orderkey AS VARCHAR) AS k, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price
       FROM orders""",
)
def numeric_cells(spark, sf_dir):
    return results.render(
        table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", "cast(o_totalprice AS decimal(18,2)) AS price")
    )


@query(
    "R4_time_cells",
    """SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS plain,
         concat(strftime(ts, '%Y-%m-%d %H:%M:%S'), ' UTC') AS zoned, strftime(ts, '%Y-%m-%d') AS day FROM events""",
)
def time_cells(spark, sf_dir):
    return results.render(
        table(spark, sf_dir, "events").selectExpr(
            "event_id AS id", "ts AS plain", "cast(ts AS timestamp) AS zoned", "cast(ts AS date) AS day"
        )
    )


@query("R5_json_cells", "SELECT CAST(event_id AS VARCHAR) AS id, replace(props, ' ', '') AS props FROM events")
def json_cells(spark, sf_dir):
    return results.render(table(spark, sf_dir, "events").selectExpr("event_id AS id", "parse_json(props) AS props"))


@query(
    "R6_other_types",
    """SELECT CAST(vec_id AS VARCHAR) AS vec_id, '<array>' AS embedding, CAST(label AS VARCHAR) AS label FROM embeddings""",
)
def other_types(spark, sf_dir):
    return results.render(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


_NATION = """concat('{"n_name":"', n_name, '","n_nationkey":"', n_nationkey, '","n_regionkey":"', n_regionkey, '"}')"""
_CUSTOMER = """concat('{"c_custkey":"', c_custkey, '","c_mktsegment":"', c_mktsegment, '","c_name":"', c_name,
  '","c_nationkey":"', c_nationkey, '"}')"""


@query("R7_json_records", f"SELECT {_CUSTOMER} AS record FROM customer")
def json_records(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_name", "c_custkey", "c_nationkey", "c_mktsegment")
    return results.json_records(results.render(customers))


@query("R8_json_file", f"SELECT {_NATION} AS record FROM nation")
def json_file(spark, sf_dir):
    register_tables(spark, sf_dir, TABLES)
    path = _folder(spark, "json")
    ex.export(spark, path, "SELECT * FROM nation", format="json")
    return spark.read.text(path).withColumnRenamed("value", "record")


@query(
    "R9_csv_file",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents",
)
def csv_file(spark, sf_dir):
    path = _folder(spark, "csv")
    register_tables(spark, sf_dir, TABLES)
    ex.export(spark, path, "SELECT doc_id, text, lang, source, n_chars FROM documents", format="csv")
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


@query(
    "R10_empty_result",
    "SELECT count(*) AS fetched, count(*) > 0 AS written FROM orders WHERE o_orderkey < 0",
)
def empty_result(spark, sf_dir):
    register_tables(spark, sf_dir, TABLES)
    report = ex.export(spark, _folder(spark, "none"), "SELECT * FROM orders WHERE o_orderkey < 0", format="csv")
    empty = table(spark, sf_dir, "orders").filter("o_orderkey < 0").agg(F.count("*").alias("fetched"))
    return empty.withColumn("written", F.lit(report.written))


@query("R11_row_count", "SELECT count(*) AS rows FROM lineitem")
def row_count(spark, sf_dir):
    return results.row_count(table(spark, sf_dir, "lineitem"))


ROWS = 1000


@query(
    "R12_sheet_split",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, rn AS row_no, CAST(rn // {ROWS} + 1 AS INTEGER) AS sheet FROM
        (SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS BIGINT) AS rn
         FROM orders) o""",
)
def sheet_split(spark, sf_dir):
    ordered = table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey")
    return sheets.split_sheets(results.render(ordered), ROWS)


_CLEAN = r"regexp_replace(p_name, '[:\\/?*\[\]]', '', 'g')"


@query(
    "R13_sheet_naming",
    f"""SELECT p_partkey, CASE WHEN length({_CLEAN}) = 0 THEN 'Sheet' ELSE left({_CLEAN}, 31) END AS first_name,
        concat(CASE WHEN length({_CLEAN}) = 0 THEN 'Sheet' ELSE left({_CLEAN}, 27) END, ' (2)') AS second_name
        FROM (SELECT p_partkey, concat('a/b:', p_name, '*[', p_type, ']') AS p_name FROM part) p""",
)
def sheet_naming(spark, sf_dir):
    named = table(spark, sf_dir, "part").selectExpr("p_partkey", "concat('a/b:', p_name, '*[', p_type, ']') AS n")
    return named.select(
        "p_partkey",
        sheets.sheet_name(F.col("n"), F.lit(1)).alias("first_name"),
        sheets.sheet_name(F.col("n"), F.lit(2)).alias("second_name"),
    )


_CELLS = """CASE CAST(event_id % 9 AS INT) WHEN 0 THEN 'NULL' WHEN 1 THEN CAST(event_id AS VARCHAR(20))
  WHEN 2 THEN concat(CAST(event_id AS VARCHAR(20)), 'e5') WHEN 3 THEN concat('.', CAST(event_id AS VARCHAR(20)))
  WHEN 4 THEN concat(' ', CAST(event_id AS VARCHAR(20))) WHEN 5 THEN concat(CAST(event_id AS VARCHAR(20)), 'd')
  WHEN 6 THEN 'true' WHEN 7 THEN 'nan' ELSE event_type END"""


@query(
    "R14_cell_kind",
    f"""SELECT event_id, {_CELLS} AS cell, CASE CAST(event_id % 9 AS INT) WHEN 0 THEN 'null' WHEN 1 THEN 'number'
        WHEN 2 THEN 'number' WHEN 3 THEN 'number' WHEN 4 THEN 'text' WHEN 5 THEN 'text' WHEN 6 THEN 'boolean'
        WHEN 7 THEN 'number' ELSE 'text' END AS kind FROM events""",
)
def cell_kind(spark, sf_dir):
    cells = table(spark, sf_dir, "events").selectExpr("event_id", f"{_CELLS} AS cell")
    return cells.withColumn("kind", sheets.cell_kind(F.col("cell")))


@query(
    "R15_column_width",
    f"""SELECT sheet, "column", CAST(greatest(6, least(60, greatest(longest, length("column")))) + 2 AS INTEGER) AS width
        FROM (SELECT CAST(rn // {ROWS} + 1 AS INTEGER) AS sheet, 'doc_id' AS "column",
                max(length(CAST(doc_id AS VARCHAR))) AS longest FROM
              (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM documents) d GROUP BY 1
              UNION ALL SELECT CAST(rn // {ROWS} + 1 AS INTEGER), 'text', max(length(text)) FROM
              (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM documents) d GROUP BY 1
              UNION ALL SELECT CAST(rn // {ROWS} + 1 AS INTEGER), 'source', max(length(source)) FROM
              (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM documents) d GROUP BY 1) w""",
)
def column_width(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").orderBy("doc_id").select("doc_id", "text", "source")
    return sheets.column_widths(sheets.split_sheets(results.render(documents), ROWS))
