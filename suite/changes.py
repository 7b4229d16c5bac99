"""Filters, event projections and outbox messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.constants import DISPLAY_LIMIT
from rowtide.operators import events as ev
from rowtide.operators import filters, outbox, results
from rowtide.plans import changes
from rowtide.streaming.deliver import deliver_changes
from suite.base import events, indexed, over_log, query, sql_lsn, table

KEY = ["session_id", "frame_no", "kind"]
_DML = "kind IN ('insert', 'update', 'delete')"
_TABLE = """("table" IN ('customer', 'public.orders') OR concat("schema", '.', "table") IN ('customer', 'public.orders'))"""


def _forwarded(spark, sf_dir, **rule):
    condition = filters.should_forward(**rule)
    return filters.forwardable(events(spark, sf_dir, where=condition), condition)


def _keys(where: str) -> str:
    return over_log(f"SELECT session_id, frame_no, kind FROM log WHERE error_class IS NULL AND {where}")


@query("F1_table_filter", _keys(f"{_DML} AND {_TABLE}"))
def table_filter(spark, sf_dir):
    return _forwarded(spark, sf_dir, tables=["customer", "public.orders", "Orders"]).filter(
        F.col("kind") != "truncate"
    ).select(*KEY)


@query("F1_table_filter_indexed", _keys(f"{_DML} AND {_TABLE}"))
def table_filter_indexed(spark, sf_dir):
    names = ["customer", "public.orders", "Orders"]
    decoded = changes.decode_changes(indexed(spark, sf_dir), tables=names)
    rows = filters.forwardable(decoded, filters.should_forward(tables=names))
    return rows.filter(F.col("kind") != "truncate").select(*KEY)


@query("F2_operation_filter", _keys("kind IN ('delete', 'truncate')"))
def operation_filter(spark, sf_dir):
    return _forwarded(spark, sf_dir, ops=["delete", "truncate"]).select(*KEY)


@query("F3_row_rule", _keys("""kind = 'update' AND "table" = 'orders'"""))
def row_rule(spark, sf_dir):
    return _forwarded(spark, sf_dir, tables=["orders"], ops=["update"]).select(*KEY)


@query("F4_truncate_rule", _keys("kind = 'truncate'"))
def truncate_rule(spark, sf_dir):
    # No table of that name: only truncates pass, the table filter is not theirs.
    return _forwarded(spark, sf_dir, tables=["nothing"]).select(*KEY)


@query("F5_boundary_toggle", _keys("kind IN ('begin', 'commit')"))
def boundary_toggle(spark, sf_dir):
    return _forwarded(spark, sf_dir, tables=["nothing"], ops=["insert"], emit_boundaries=True).select(*KEY)


@query("F6_schema_toggle", _keys("kind = 'relation'"))
def schema_toggle(spark, sf_dir):
    return _forwarded(spark, sf_dir, tables=["nothing"], ops=["insert"], emit_schema=True).select(*KEY)


@query("F7_keepalive_drop", _keys("kind NOT IN ('keepalive', 'skipped', 'error')"))
def keepalive_drop(spark, sf_dir):
    return _forwarded(spark, sf_dir, emit_boundaries=True, emit_schema=True).select(*KEY)


@query("F8_start_position", _keys(f"{_DML} AND position >= 17000000"))
def start_position(spark, sf_dir):
    rows = filters.from_position(_forwarded(spark, sf_dir), f"0/{17000000:x}")
    return rows.filter(F.col("kind") != "truncate").select(*KEY)


@query("F8_start_position_indexed", _keys(f"{_DML} AND position >= 17000000"))
def start_position_indexed(spark, sf_dir):
    decoded = changes.decode_changes(indexed(spark, sf_dir), start=f"0/{17000000:x}")
    rows = filters.forwardable(decoded, filters.should_forward())
    return rows.filter(F.col("kind") != "truncate").select(*KEY)


@query(
    "F9_row_limit",
    """SELECT l.n AS limited_to, CASE WHEN l.n = 0 THEN o.n ELSE least(o.n, l.n) END AS shown
    FROM (SELECT count(*) AS n FROM orders) o, (VALUES (0), (1), (500), (1000000000)) l(n)""",
)
def row_limit(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    counts = [
        results.display(orders, n).agg(F.lit(n).alias("limited_to"), F.count("*").alias("shown"))
        for n in (0, 1, DISPLAY_LIMIT, 1_000_000_000)
    ]
    return reduce(DataFrame.union, counts)


_HEAD = """'","rel_id":', rel_id, ',"schema":"', "schema", '","table":"', "table\""""
_INSERT_JSON = f"""concat('{{"op":"', op, {_HEAD}, '","new":{{"id":"', id, '","status":"', new_status, '"}}}}')"""


def _bodies(spark, sf_dir, ops, tables=("orders",)):
    rows = outbox.prepare(_forwarded(spark, sf_dir, tables=list(tables), ops=ops))
    return rows.filter(F.col("op").isin(ops))


@query(
    "P1_event_json",
    over_log(f"""SELECT frame_no, {_INSERT_JSON} AS body FROM log WHERE op = 'insert' AND "table" = 'orders'"""),
)
def event_json(spark, sf_dir):
    return _bodies(spark, sf_dir, ["insert"]).select("frame_no", "body")


@query(
    "P1_boundary_json",
    over_log(f"""SELECT frame_no, CASE kind WHEN 'begin' THEN concat('{{"op":"begin","lsn":"', {sql_lsn('position')},
        '","commit_time":759638400000000,"xid":', k0, '}}') WHEN 'commit' THEN concat('{{"op":"commit","lsn":"',
        {sql_lsn('position - 1')}, '","end_lsn":"', {sql_lsn('position')}, '","commit_time":759638400000000}}')
        ELSE '{{"op":"truncate","rel_ids":[16391,99],"tables":["public.orders","<rel:99>"],"cascade":true,"restart_seqs":false}}'
        END AS body FROM log WHERE kind IN ('begin', 'commit', 'truncate')"""),
)
def boundary_json(spark, sf_dir):
    rows = _forwarded(spark, sf_dir, ops=["truncate"], emit_boundaries=True)
    return outbox.prepare(rows).select("frame_no", "body")


@query(
    "P2_null_old_image",
    over_log(f"""SELECT frame_no, concat('{{"op":"update', {_HEAD}, '","old":', CASE WHEN old_status IS NULL THEN 'null'
        ELSE concat('{{"id":"', id, '","status":"', old_status, '"}}') END,
        ',"new":{{"id":"', id, '","status":"F"}}}}') AS body FROM log WHERE op = 'update'"""),
)
def null_old_image(spark, sf_dir):
    return _bodies(spark, sf_dir, ["update"]).select("frame_no", "body")


@query(
    "P3_column_value_json",
    over_log(f"""SELECT frame_no, concat('{{"op":"delete', {_HEAD}, '","old":{{"id":"', id,
        '","status":"__pgx_unchanged"}}}}') AS body FROM log WHERE op = 'delete'"""),
)
def column_value_json(spark, sf_dir):
    return _bodies(spark, sf_dir, ["delete"]).select("frame_no", "body")


@query("P4_operation_label", over_log("SELECT upper(op) AS label, count(*) AS n FROM log GROUP BY 1"))
def operation_label(spark, sf_dir):
    return events(spark, sf_dir).groupBy(ev.op_label(F.col("op")).alias("label")).agg(F.count("*").alias("n"))


@query(
    "P5_table_of_event",
    over_log(f"""SELECT session_id, frame_no, CASE WHEN {_DML} THEN "schema" END AS "schema",
             CASE WHEN {_DML} THEN "table" END AS "table" FROM log WHERE error_class IS NULL"""),
)
def table_of_event(spark, sf_dir):
    rows = events(spark, sf_dir).filter("error_class IS NULL")
    named = rows.select("session_id", "frame_no", ev.table_of_event().alias("t"))
    return named.select("session_id", "frame_no", "t.schema", "t.table")


ATTRIBUTES = ["OP", "LSN", "SCHEMA", "TABLE", "NEW", "OLD", "TABLES", "XID"]


@query(
    "P6_attribute_map",
    over_log(f"""SELECT session_id, frame_no, op AS a_op, {sql_lsn('position')} AS a_lsn,
        CASE WHEN {_DML} THEN "schema" END AS a_schema, CASE WHEN {_DML} THEN "table" END AS a_table,
        CASE WHEN op IN ('insert', 'update') THEN concat('{{"id":"', id, '","status":"', new_status, '"}}') END AS a_new,
        CASE WHEN op = 'delete' THEN concat('{{"id":"', id, '","status":"__pgx_unchanged"}}')
             WHEN old_status IS NOT NULL THEN concat('{{"id":"', id, '","status":"', old_status, '"}}') END AS a_old,
        CASE WHEN op = 'truncate' THEN 'public.orders,<rel:99>' END AS a_tables,
        CASE WHEN op = 'begin' THEN CAST(k0 AS VARCHAR) END AS a_xid
        FROM log WHERE session_id = 's1' AND error_class IS NULL AND kind NOT IN ('keepalive', 'skipped')
          AND coalesce("table", '') <> 'unknown'"""),
)
def attribute_map(spark, sf_dir):
    rows = _forwarded(spark, sf_dir, emit_boundaries=True, emit_schema=True)
    made = outbox.prepare(rows.filter("session_id = 's1' AND coalesce(`table`, '') <> 'unknown'"))
    return made.select(
        "session_id", "frame_no", *[F.col("attributes")[f"PGX_{a}"].alias(f"a_{a.lower()}") for a in ATTRIBUTES]
    )


@query("P7_event_position", over_log("SELECT session_id, frame_no, position FROM log"))
def event_position(spark, sf_dir):
    return events(spark, sf_dir).select("session_id", "frame_no", F.col("position").cast("bigint").alias("position"))


@query(
    "P8_event_summary",
    over_log(f"""SELECT session_id, frame_no, op, "schema", "table",
        CASE WHEN op = 'truncate' THEN 'public.orders, <rel:99>' END AS tables,
        CASE WHEN op NOT IN ('begin', 'relation') THEN {sql_lsn('position')} END AS lsn,
        CASE WHEN op = 'begin' THEN k0 END AS xid,
        CAST(CASE WHEN op = 'relation' THEN CASE WHEN session_id = 's2' AND frame_no > 1 THEN 3 ELSE 2 END END AS INTEGER)
          AS col_count
        FROM log WHERE op NOT IN ('error', 'keepalive', 'skipped')"""),
)
def event_summary(spark, sf_dir):
    return ev.event_log(events(spark, sf_dir))




def _outbox_rows(spark, sf_dir):
    return _forwarded(spark, sf_dir, tables=["orders"], ops=["insert", "truncate"])


def _sent(select: str) -> str:
    return over_log(
        f"""SELECT session_id, frame_no, position, {select} FROM (SELECT *, CASE op WHEN 'insert' THEN {_INSERT_JSON}
        ELSE '{{"op":"truncate","rel_ids":[16391,99],"tables":["public.orders","<rel:99>"],"cascade":true,"restart_seqs":false}}'
        END AS body FROM log WHERE (op = 'insert' AND "table" = 'orders') OR op = 'truncate') s"""
    )


def _plain(df, *columns):
    return df.select("session_id", "frame_no", F.col("position").cast("bigint").alias("position"), *columns)


@query("W1_print_lines", _sent("'stdout' AS sink, body"))
def print_lines(spark, sf_dir):
    return _plain(outbox.to_stdout(_outbox_rows(spark, sf_dir)), "sink", "body")


@query(
    "W2_command_env",
    _sent("""'run' AS destination, 'base' AS e_base, op AS e_op, body AS e_payload,
          CASE op WHEN 'insert' THEN "table" END AS e_table"""),
)
def command_env(spark, sf_dir):
    rows = outbox.to_shell(_outbox_rows(spark, sf_dir), "run", {"BASE": "base", "PGX_OP": "overridden"})
    env = F.col("env")
    return _plain(
        rows,
        "destination",
        env["BASE"].alias("e_base"),
        env["PGX_OP"].alias("e_op"),
        env["PGX_PAYLOAD"].alias("e_payload"),
        env["PGX_TABLE"].alias("e_table"),
    )


@query(
    "W3_webhook_message",
    _sent("""'http://hook' AS destination, body, 'application/json' AS content_type, 'Bearer t' AS auth,
          CAST(2 AS INTEGER) AS n_headers"""),
)
def webhook_message(spark, sf_dir):
    headers = {"Authorization": "Bearer t", "bad name": "x", "X-Bad": "line\nbreak"}
    rows = outbox.to_webhook(_outbox_rows(spark, sf_dir), "http://hook", headers)
    h = F.col("headers")
    return _plain(
        rows,
        "destination",
        "body",
        h["content-type"].alias("content_type"),
        h["authorization"].alias("auth"),
        F.size(h).alias("n_headers"),
    )


@query(
    "W4_rabbitmq_message",
    _sent(f"""'pgx' AS destination, 'pgx.wal' AS routing_key, body, op AS h_op, {sql_lsn('position')} AS h_lsn,
          CASE op WHEN 'insert' THEN "schema" END AS h_schema, CASE op WHEN 'insert' THEN "table" END AS h_table"""),
)
def rabbitmq_message(spark, sf_dir):
    rows = outbox.to_rabbitmq(_outbox_rows(spark, sf_dir))
    h = F.col("headers")
    names = ["op", "lsn", "schema", "table"]
    return _plain(rows, "destination", "routing_key", "body", *[h[f"pgx-{n}"].alias(f"h_{n}") for n in names])


@query(
    "W5_kafka_message",
    _sent("""'pgx-wal' AS topic, CASE op WHEN 'insert' THEN "table" ELSE 'pgx-wal' END AS msg_key, body"""),
)
def kafka_message(spark, sf_dir):
    rows = outbox.to_kafka(_outbox_rows(spark, sf_dir))
    return _plain(rows, F.col("destination").alias("topic"), "msg_key", "body")


@query(
    "W6_delivery_hook",
    over_log("""SELECT session_id, frame_no, 'kafka' AS sink, op = 'insert' AS ok,
             CASE op WHEN 'insert' THEN NULL ELSE 'refused' END AS error FROM log
             WHERE (op = 'insert' AND "table" = 'orders') OR op = 'truncate'"""),
)
def delivery_hook(spark, sf_dir):
    def deliver(message):
        if message["msg_key"] == "pgx-wal":
            raise ValueError("refused")

    return deliver_changes(outbox.to_kafka(_outbox_rows(spark, sf_dir)), deliver, stop_on_error=False)
