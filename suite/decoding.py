"""Frames, messages, row images and relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import capture
from rowtide.functions import lsn
from rowtide.operators import frames as fr
from rowtide.operators import images as im
from rowtide.plans import changes
from suite.base import broken, events, frames, over_log, query, sql_lsn, table

NOT_DATA = "('keepalive')"
TIME = 759638400000000
BIGINT = "bigint"


@query(
    "D1_data_frame_split",
    over_log(f"""SELECT session_id, frame_no, frame_no AS wal_start, frame_no AS wal_end,
             CAST({TIME} + 946684800000000 AS BIGINT) AS server_micros FROM log WHERE kind NOT IN {NOT_DATA}"""),
)
def data_frame_split(spark, sf_dir):
    return (
        fr.split_frames(frames(spark, sf_dir))
        .filter("frame_kind = 'data'")
        .selectExpr(
            "session_id",
            "frame_no",
            "CAST(wal_start AS BIGINT) AS wal_start",
            "CAST(wal_end AS BIGINT) AS wal_end",
            "unix_micros(server_time) AS server_micros",
        )
    )


@query(
    "D2_keepalive_split",
    over_log("SELECT session_id, frame_no, position AS wal_end, true AS reply_requested FROM log WHERE kind = 'keepalive'"),
)
def keepalive_split(spark, sf_dir):
    return (
        fr.split_frames(frames(spark, sf_dir))
        .filter("frame_kind = 'keepalive'")
        .selectExpr("session_id", "frame_no", "CAST(wal_end AS BIGINT) AS wal_end", "reply_requested")
    )


_FATAL = """CASE o_orderkey % 5 WHEN 0 THEN 'empty frame' WHEN 1 THEN 'unknown frame kind 0x7a'
  WHEN 2 THEN 'data frame too short: 20 bytes' WHEN 3 THEN 'keepalive frame too short: 9 bytes'
  ELSE 'transaction boundary cut short' END"""


@query(
    "D3_frame_error_class",
    f"""SELECT concat('b', o_orderkey) AS session_id, CAST(3 AS BIGINT) AS frame_no, 'fatal' AS error_class,
        {_FATAL} AS error FROM orders WHERE o_orderkey % 5 <> 4""",
)
def frame_error_class(spark, sf_dir):
    return fr.split_frames(broken(spark, sf_dir)).filter("error_class IS NOT NULL").select(
        "session_id", "frame_no", "error_class", "error"
    )


@query(
    "D3_session_ends_at_fatal",
    f"""SELECT concat('b', o_orderkey) AS session_id, f AS frame_no,
        CASE f WHEN 1 THEN 'insert' ELSE 'error' END AS op, CASE f WHEN 3 THEN {_FATAL} END AS error
        FROM orders CROSS JOIN (SELECT CAST(1 AS BIGINT) AS f UNION ALL SELECT 3) v""",
)
def session_ends_at_fatal(spark, sf_dir):
    return changes.decode_changes(broken(spark, sf_dir)).select("session_id", "frame_no", "op", "error")


@query("D4_message_dispatch", over_log("SELECT session_id, kind, count(*) AS n FROM log GROUP BY session_id, kind"))
def message_dispatch(spark, sf_dir):
    return fr.classify(frames(spark, sf_dir)).groupBy("session_id", "kind").agg(F.count("*").alias("n"))


@query(
    "D5_boundary_detection",
    over_log("SELECT session_id, frame_no, kind FROM log WHERE kind IN ('begin', 'commit')"),
)
def boundary_detection(spark, sf_dir):
    return (
        fr.classify(frames(spark, sf_dir))
        .filter("kind IN ('begin', 'commit') AND error_class IS NULL")
        .select("session_id", "frame_no", "kind")
    )


@query(
    "D6_begin",
    over_log(f"""SELECT frame_no, {sql_lsn('position')} AS lsn, CAST({TIME} AS BIGINT) AS commit_time, k0 AS xid
             FROM log WHERE kind = 'begin'"""),
)
def begin(spark, sf_dir):
    return events(spark, sf_dir).filter("op = 'begin'").select("frame_no", "lsn", "commit_time", "xid")


@query(
    "D7_commit",
    over_log(f"""SELECT frame_no, {sql_lsn('position - 1')} AS lsn, {sql_lsn('position')} AS end_lsn,
             CAST({TIME} AS BIGINT) AS commit_time FROM log WHERE kind = 'commit'"""),
)
def commit(spark, sf_dir):
    return events(spark, sf_dir).filter("op = 'commit'").select("frame_no", "lsn", "end_lsn", "commit_time")


@query(
    "D8_relation",
    """SELECT CAST(p_partkey + 20000 AS BIGINT) AS rel_id, concat('cat_', p_size) AS "schema",
         concat('t', p_partkey) AS "table", CASE i WHEN 0 THEN 'id' ELSE p_type END AS name, i = 0 AS is_key,
         CAST(CASE i WHEN 0 THEN 20 ELSE 25 END AS BIGINT) AS type_id,
         CAST(CASE i WHEN 0 THEN -1 ELSE p_size END AS INTEGER) AS type_modifier
       FROM part CROSS JOIN (SELECT 0 AS i UNION ALL SELECT 1) v""",
)
def relation(spark, sf_dir):
    described = changes.decode_changes(capture.part_relations(table(spark, sf_dir, "part")))
    return described.filter("op = 'relation'").selectExpr("rel_id", "schema", "`table`", "inline(columns)")


def _images(spark, sf_dir, op):
    return (
        events(spark, sf_dir, where=F.col("kind") == op)
        .filter((F.col("op") == op) & (F.col("table") == "orders"))
        .selectExpr(
            "frame_no",
            "rel_id",
            "new.id.value AS new_id",
            "new.status.value AS new_status",
            "old.id.value AS old_id",
            "old.status.value AS old_status",
            "old.status.state AS old_state",
        )
    )


_IMAGES = """SELECT frame_no, rel_id, {new_id} AS new_id, new_status, {old_id} AS old_id, old_status,
  {old_state} AS old_state FROM log WHERE op = '{op}' AND "table" = 'orders'"""


@query("D9_insert", over_log(_IMAGES.format(new_id="id", old_id="NULL", old_state="NULL", op="insert")))
def insert(spark, sf_dir):
    return _images(spark, sf_dir, "insert")


_FULL = "CASE WHEN k0 % 2 = 1 THEN {} END"


@query(
    "D10_update",
    over_log(_IMAGES.format(new_id="id", old_id=_FULL.format("id"), old_state=_FULL.format("'t'"), op="update")),
)
def update(spark, sf_dir):
    return _images(spark, sf_dir, "update")


@query("D11_delete", over_log(_IMAGES.format(new_id="NULL", old_id="id", old_state="'u'", op="delete")))
def delete(spark, sf_dir):
    return _images(spark, sf_dir, "delete")


_CASTS = [
    (n, f"CAST(CAST({n} AS BIGINT) AS VARCHAR)" if n == "l_quantity" else f"CAST({n} AS VARCHAR)")
    for n in capture.LINEITEM_COLUMNS
]


@query(
    "D12_tuple_decode",
    f"""SELECT CAST(l_orderkey * 8 + l_linenumber + 16 AS BIGINT) AS frame_no,
        {', '.join(f'{cast} AS {n}' for n, cast in _CASTS)} FROM lineitem""",
)
def tuple_decode(spark, sf_dir):
    decoded = changes.decode_changes(capture.lineitem_rows(table(spark, sf_dir, "lineitem")))
    return decoded.filter("op = 'insert'").selectExpr(
        "frame_no", *[f"new.{n}.value AS {n}" for n in capture.LINEITEM_COLUMNS]
    )


@query(
    "D13_column_state",
    over_log("""SELECT kind, 't' AS id_state, CASE kind WHEN 'delete' THEN 'u' ELSE 't' END AS status_state,
             kind = 'delete' AS unchanged, CASE kind WHEN 'delete' THEN NULL ELSE new_status END AS status,
             count(*) AS n FROM log WHERE error_class IS NULL AND "table" = 'orders' AND kind <> 'relation'
             GROUP BY 1, 2, 3, 4, 5"""),
)
def column_state(spark, sf_dir):
    image = F.coalesce(F.col("new"), F.col("old"))
    rows = events(spark, sf_dir).filter("op IN ('insert', 'update', 'delete') AND `table` = 'orders'")
    return (
        rows.select("kind", image["id"].alias("id"), image["status"].alias("status"))
        .groupBy(
            "kind",
            F.col("id.state").alias("id_state"),
            F.col("status.state").alias("status_state"),
            im.is_unchanged(F.col("status")).alias("unchanged"),
            im.text_of(F.col("status")).alias("status"),
        )
        .agg(F.count("*").alias("n"))
    )


@query(
    "D14_text_decoding",
    """SELECT doc_id, md5(concat(text, chr(65533), 'B')) AS digest, length(text) + 2 AS chars FROM documents""",
)
def text_decoding(spark, sf_dir):
    decoded = changes.decode_changes(capture.document_rows(table(spark, sf_dir, "documents")))
    value = "new['?'].value"
    return decoded.selectExpr(
        "frame_no - 1 AS doc_id", f"md5(cast({value} AS binary)) AS digest", f"CAST(length({value}) AS BIGINT) AS chars"
    )


@query("D15_binary_value", r"SELECT event_id, concat('\x', lower(hex(props))) AS shown FROM events")
def binary_value(spark, sf_dir):
    decoded = changes.decode_changes(capture.binary_rows(table(spark, sf_dir, "events")))
    return decoded.selectExpr("frame_no - 1 AS event_id", "new['?'].value AS shown")


@query(
    "D16_truncate",
    over_log("""SELECT frame_no, '16391,99' AS rel_ids, 'public.orders,<rel:99>' AS tables, true AS cascade,
             false AS restart_seqs FROM log WHERE kind = 'truncate'"""),
)
def truncate(spark, sf_dir):
    return events(spark, sf_dir).filter("op = 'truncate'").selectExpr(
        "frame_no",
        "array_join(transform(rel_ids, i -> cast(i AS string)), ',') AS rel_ids",
        "array_join(tables, ',') AS tables",
        "cascade",
        "restart_seqs",
    )


_CUSTOMER = """SELECT CAST(16777216 + c_custkey * 64 AS BIGINT) AS frame_no, 'sales' AS "schema", 'customer' AS "table",
  CAST(CASE WHEN c_custkey < 700 THEN 2 ELSE 3 END AS INTEGER) AS n_columns, CAST(c_custkey AS VARCHAR) AS custkey,
  c_name AS name, CASE WHEN c_custkey >= 700 THEN c_mktsegment END AS segment FROM customer"""


def _customer_rows(decoded):
    return decoded.filter("session_id = 's2' AND op = 'insert'").selectExpr(
        "frame_no",
        "schema",
        "`table`",
        "size(new) AS n_columns",
        "new.custkey.value AS custkey",
        "new.name.value AS name",
        "new.segment.value AS segment",
    )


@query("D17_relation_resolution", _CUSTOMER)
def relation_resolution(spark, sf_dir):
    return _customer_rows(events(spark, sf_dir))


@query("D17_relation_resolution_by_range", _CUSTOMER)
def relation_resolution_by_range(spark, sf_dir):
    # The path taken when the descriptions are too large to broadcast.
    return _customer_rows(events(spark, sf_dir, broadcast_limit=0, range_width=1 << 14))


@query("D17_relation_resolution_by_position", _CUSTOMER)
def relation_resolution_by_position(spark, sf_dir):
    # Frames numbered by log position: far apart, in very many ranges.
    spaced = frames(spark, sf_dir).withColumn("frame_no", F.col("frame_no") * (1 << 24))
    decoded = changes.decode_changes(spaced, broadcast_limit=0)
    return _customer_rows(decoded.withColumn("frame_no", F.expr("frame_no div 16777216")))


@query(
    "D18_unknown_relation",
    over_log("""SELECT frame_no, "schema", "table", '?' AS names, 'x' AS last_value FROM log WHERE "table" = 'unknown'"""),
)
def unknown_relation(spark, sf_dir):
    return events(spark, sf_dir).filter("`table` = 'unknown'").selectExpr(
        "frame_no", "schema", "`table`", "array_join(map_keys(new), ',') AS names", "new['?'].value AS last_value"
    )


@query("D19_skipped_messages", over_log("SELECT frame_no, op, position FROM log WHERE kind = 'skipped'"))
def skipped_messages(spark, sf_dir):
    return events(spark, sf_dir).filter("op = 'skipped'").selectExpr("frame_no", "op", "CAST(position AS BIGINT) AS position")


@query(
    "D20_malformed_records",
    over_log("""SELECT session_id, frame_no, position AS wal_end, kind,
             CASE kind WHEN 'error' THEN 'unknown message type 0x5A' ELSE 'row image malformed' END AS error
             FROM log WHERE error_class = 'record'"""),
)
def malformed_records(spark, sf_dir):
    letters = changes.dead_letters(events(spark, sf_dir, images=False))
    return letters.withColumn("wal_end", F.col("wal_end").cast(BIGINT))


@query(
    "D21_lsn_parse",
    """SELECT o_orderkey, CAST(CAST(o_orderkey AS HUGEINT) * 4294967296 + o_custkey * 1000 AS VARCHAR) AS position
       FROM orders""",
)
def lsn_parse(spark, sf_dir):
    low = F.hex(F.col("o_custkey") * 1000)
    low = F.when(F.col("o_orderkey") % 2 == 0, F.lower(low)).otherwise(low)
    text = F.concat(F.hex("o_orderkey"), F.lit("/"), low)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", lsn.parse_lsn(text).cast("string").alias("position")
    )


@query("D22_lsn_format", f"SELECT o_orderkey, {sql_lsn('o_orderkey * 4294967296 + o_custkey * 1000')} AS lsn FROM orders")
def lsn_format(spark, sf_dir):
    position = (F.col("o_orderkey") * F.lit(2**32) + F.col("o_custkey") * 1000).cast("decimal(20,0)")
    return table(spark, sf_dir, "orders").select("o_orderkey", lsn.lsn_text(position).alias("lsn"))


@query(
    "D23_lsn_order",
    """SELECT o_orderkey, o_orderkey * 4294967296 + o_custkey >= 9 * 4294967296 + 10 AS later,
         o_orderkey = 0 AND o_custkey = 0 AS is_zero FROM orders""",
)
def lsn_order(spark, sf_dir):
    position = lsn.parse_lsn(F.concat(F.hex("o_orderkey"), F.lit("/"), F.hex("o_custkey")))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (position >= lsn.parse_lsn(F.lit("9/A"))).alias("later"),
        lsn.is_zero(position).alias("is_zero"),
    )


@query(
    "D24_server_time",
    """SELECT o_orderkey, CAST(epoch_us(o_orderdate) - 946684800000000 AS BIGINT) AS micros,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS shown FROM orders""",
)
def server_time(spark, sf_dir):
    stamped = table(spark, sf_dir, "orders").select(
        "o_orderkey", lsn.server_micros(F.col("o_orderdate").cast("timestamp")).alias("micros")
    )
    return stamped.selectExpr(
        "o_orderkey", "micros", f"date_format({lsn.server_time('micros')}, 'yyyy-MM-dd HH:mm:ss') AS shown"
    )
