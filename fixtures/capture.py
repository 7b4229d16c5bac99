"""Captured frames for change rows, built by Spark from any table.

There is no server to record, so queries, tests and the benchmark encode the
frames a server would have sent for the rows of the given tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERS_REL = 16391
CUSTOMER_REL = 16500
SERVER_MICROS = 759638400000000

_EMPTY = "X''"


def int_bytes(value: Column, width: int) -> Column:
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), width * 2, "0"))


def text_bytes(value: Column) -> Column:
    return value.cast("binary")


def blob(data: bytes) -> Column:
    return F.lit(bytearray(data))


def cell(value: Column) -> Column:
    """A text column, or the null mark."""
    body = text_bytes(value)
    sent = F.concat(blob(b"t"), int_bytes(F.octet_length(body), 4), body)
    return F.when(value.isNull(), blob(b"n")).otherwise(sent)


def unsent() -> Column:
    return blob(b"u")


def image(*cells: Column) -> Column:
    return F.concat(blob(len(cells).to_bytes(2, "big")), *cells)


def row_head(tag: str, rel_id: int, flag: str) -> Column:
    return blob(tag.encode() + rel_id.to_bytes(4, "big") + flag.encode())


def relation(rel_id: int, schema: str, table: str, columns: list[tuple[str, bool, int, int]]) -> bytes:
    parts = [b"R", rel_id.to_bytes(4, "big"), schema.encode(), b"\0", table.encode(), b"\0d"]
    parts.append(len(columns).to_bytes(2, "big"))
    for name, key, type_id, modifier in columns:
        parts += [bytes([int(key)]), name.encode(), b"\0", type_id.to_bytes(4, "big")]
        parts.append(modifier.to_bytes(4, "big", signed=True))
    return b"".join(parts)


def data_frame(position: Column, message: Column) -> Column:
    at = int_bytes(position, 8)
    return F.concat(blob(b"w"), at, at, blob(SERVER_MICROS.to_bytes(8, "big")), message)


def begin(position: Column, xid: Column) -> Column:
    return F.concat(blob(b"B"), int_bytes(position, 8), blob(SERVER_MICROS.to_bytes(8, "big")), int_bytes(xid, 4))


def commit(position: Column, end: Column) -> Column:
    return F.concat(
        blob(b"C\0"), int_bytes(position, 8), int_bytes(end, 8), blob(SERVER_MICROS.to_bytes(8, "big"))
    )


def keepalive(position: Column, reply: int) -> Column:
    return F.concat(
        blob(b"k"), int_bytes(position, 8), blob(SERVER_MICROS.to_bytes(8, "big") + bytes([reply]))
    )


def _frames(df: DataFrame, session: str, position: Column, payload: Column) -> DataFrame:
    return df.select(
        F.lit(session).alias("session_id"), position.cast("bigint").alias("frame_no"), payload.alias("payload")
    )


def _position(key: Column, step: int) -> Column:
    return F.lit(16777216) + key * 64 + step


def orders_changes(orders: DataFrame) -> DataFrame:
    """The change rows of one table: inserts, updates of every third, deletes of every seventh."""
    key = F.col("o_orderkey")
    steps = F.filter(
        F.array(
            F.when(key >= 0, F.lit(0)),
            F.when(key % 3 == 0, F.lit(16)),
            F.when(key % 7 == 0, F.lit(32)),
        ),
        lambda s: s.isNotNull(),
    )
    return orders.select("o_orderkey", "o_orderstatus", F.explode(steps).alias("step")).select(
        "o_orderkey", "o_orderstatus", "step", _position(key, 0).alias("base")
    )


def orders_rows(orders: DataFrame) -> DataFrame:
    """Row frames of session ``s1``: every order inserted, some updated or deleted."""
    key = F.col("o_orderkey").cast("string")
    status = F.col("o_orderstatus")
    first = image(cell(key), cell(status))
    second = image(cell(key), cell(F.lit("F")))
    full_old = F.concat(row_head("U", ORDERS_REL, "O"), first, blob(b"N"), second)
    no_old = F.concat(row_head("U", ORDERS_REL, "N"), second)
    message = (
        F.when(F.col("step") == 0, F.concat(row_head("I", ORDERS_REL, "N"), first))
        .when(F.col("step") == 16, F.when(F.col("o_orderkey") % 2 == 1, full_old).otherwise(no_old))
        .otherwise(F.concat(row_head("D", ORDERS_REL, "K"), image(cell(key), unsent())))
    )
    position = F.col("base") + F.col("step")
    return _frames(orders_changes(orders), "s1", position, data_frame(position, message))


def _one(spark: SparkSession) -> DataFrame:
    return spark.range(1)


def orders_described(spark: SparkSession) -> DataFrame:
    described = relation(ORDERS_REL, "public", "orders", [("id", True, 20, -1), ("status", False, 25, -1)])
    position = F.lit(1)
    return _frames(_one(spark), "s1", position, data_frame(position, blob(described)))


def orders_boundaries(orders: DataFrame) -> DataFrame:
    """A begin before and a commit after each insert of every fifth order."""
    fifth = orders.filter(F.col("o_orderkey") % 5 == 0)
    key = F.col("o_orderkey")
    start, end = _position(key, -1), _position(key, 1)
    begins = _frames(fifth, "s1", start, data_frame(start, begin(_position(key, 0), key)))
    commits = _frames(fifth, "s1", end, data_frame(end, commit(_position(key, 0), end)))
    return begins.unionByName(commits)


def orders_extras(orders: DataFrame) -> DataFrame:
    """Rarer frames keyed by order: truncates, skipped types, keepalives, malformed records."""
    key = F.col("o_orderkey")
    rare = orders.filter(key % 50 == 0)
    truncate = blob(
        b"T" + (2).to_bytes(4, "big") + b"\x01" + ORDERS_REL.to_bytes(4, "big") + (99).to_bytes(4, "big")
    )
    origin = blob(b"O" + bytes(8) + b"n\0")
    short = F.concat(row_head("I", ORDERS_REL, "N"), blob(b"\0\x02t\0\0\0\x09"), text_bytes(key.cast("string")))
    unknown = F.concat(row_head("I", 99, "N"), image(cell(key.cast("string")), cell(F.lit("x"))))
    made = [
        (40, data_frame(_position(key, 40), truncate)),
        (42, data_frame(_position(key, 42), origin)),
        (44, keepalive(_position(key, 44), 1)),
        (46, data_frame(_position(key, 46), short)),
        (48, data_frame(_position(key, 48), unknown)),
        (50, data_frame(_position(key, 50), blob(b"Z"))),
    ]
    return reduce(
        DataFrame.unionByName, [_frames(rare, "s1", _position(key, step), payload) for step, payload in made]
    )


def customer_rows(customer: DataFrame) -> DataFrame:
    """Session ``s2``: the table is described again, wider, half way through."""
    spark = customer.sparkSession
    key = F.col("c_custkey")
    narrow = relation(CUSTOMER_REL, "sales", "customer", [("custkey", True, 20, -1), ("name", False, 25, -1)])
    wide = relation(
        CUSTOMER_REL,
        "sales",
        "customer",
        [("custkey", True, 20, -1), ("name", False, 25, -1), ("segment", False, 25, -1)],
    )
    middle = 16777216 + 700 * 64 - 2
    described = [
        _frames(_one(spark), "s2", F.lit(at), data_frame(F.lit(at), blob(text)))
        for at, text in ((1, narrow), (middle, wide))
    ]
    cells = [cell(key.cast("string")), cell(F.col("c_name")), cell(F.col("c_mktsegment"))]
    message = F.concat(
        row_head("I", CUSTOMER_REL, "N"),
        F.when(key < 700, image(*cells[:2])).otherwise(image(*cells)),
    )
    rows = _frames(customer, "s2", _position(key, 0), data_frame(_position(key, 0), message))
    return reduce(DataFrame.unionByName, [*described, rows])


def change_frames(spark: SparkSession, sf_dir: str, extras: bool = True) -> DataFrame:
    """Frames of both sessions over the whole ``orders`` and ``customer`` tables."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    parts = [orders_described(spark), orders_rows(orders)]
    if extras:
        customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
        parts += [orders_boundaries(orders), orders_extras(orders), customer_rows(customer)]
    return reduce(DataFrame.unionByName, parts)


def part_relations(part: DataFrame) -> DataFrame:
    """One relation description per part: a table of two columns named after it."""
    key = F.col("p_partkey")
    message = F.concat(
        blob(b"R"),
        int_bytes(key + 20000, 4),
        text_bytes(F.concat(F.lit("cat_"), F.col("p_size").cast("string"))),
        blob(b"\0"),
        text_bytes(F.concat(F.lit("t"), key.cast("string"))),
        blob(b"\0d\0\x02\x01id\0\0\0\0\x14\xff\xff\xff\xff\0"),
        text_bytes(F.col("p_type")),
        blob(b"\0\0\0\0\x19"),
        int_bytes(F.col("p_size"), 4),
    )
    return _frames(part, "s4", key + 1, data_frame(key + 1, message))


LINEITEM_REL = 16600
LINEITEM_COLUMNS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_returnflag",
    "l_linestatus",
]


def lineitem_rows(lineitem: DataFrame) -> DataFrame:
    """Session ``s5``: every line as an insert of seven text columns."""
    spark = lineitem.sparkSession
    described = relation(LINEITEM_REL, "public", "lineitem", [(n, False, 25, -1) for n in LINEITEM_COLUMNS])
    first = _frames(_one(spark), "s5", F.lit(1), data_frame(F.lit(1), blob(described)))
    number = F.col("l_orderkey") * 8 + F.col("l_linenumber") + 16
    cells = [
        cell((F.col(n).cast("bigint") if n == "l_quantity" else F.col(n)).cast("string")) for n in LINEITEM_COLUMNS
    ]
    message = F.concat(row_head("I", LINEITEM_REL, "N"), image(*cells))
    return first.unionByName(_frames(lineitem, "s5", number, data_frame(number, message)))


def document_rows(documents: DataFrame) -> DataFrame:
    """Session ``s6``: the whole text of each document, then a byte that is not UTF-8, then ``B``."""
    key = F.col("doc_id")
    body = F.concat(text_bytes(F.col("text")), blob(b"\xffB"))
    sent = F.concat(blob(b"t"), int_bytes(F.octet_length(body), 4), body)
    message = F.concat(row_head("I", 99, "N"), image(sent))
    return _frames(documents, "s6", key + 1, data_frame(key + 1, message))


def binary_rows(events: DataFrame) -> DataFrame:
    """Session ``s7``: the properties of each event as a binary cell."""
    key, body = F.col("event_id"), text_bytes(F.col("props"))
    sent = F.concat(blob(b"b"), int_bytes(F.octet_length(body), 4), body)
    message = F.concat(row_head("I", 99, "N"), image(sent))
    return _frames(events, "s7", key + 1, data_frame(key + 1, message))


def broken_frames(orders: DataFrame) -> DataFrame:
    """A session per order whose third frame cannot be read; the fourth is past the end."""
    key = F.col("o_orderkey")
    good = F.concat(row_head("I", 99, "N"), image(cell(key.cast("string"))))
    bad = (
        F.when(key % 5 == 0, blob(b""))
        .when(key % 5 == 1, blob(b"z123"))
        .when(key % 5 == 2, blob(b"w" + bytes(20)))
        .when(key % 5 == 3, blob(b"k" + bytes(9)))
        .otherwise(data_frame(F.lit(3), blob(b"B\0\0\0")))
    )
    session = F.concat(F.lit("b"), key.cast("string"))
    frames = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).cast("bigint").alias("frame_no"), payload.alias("payload"))
                for n, payload in ((1, data_frame(F.lit(1), good)), (3, bad), (4, data_frame(F.lit(4), good)))
            ]
        )
    ).alias("f")
    return orders.select(session.alias("session_id"), frames).select("session_id", "f.frame_no", "f.payload")
