"""Which events are forwarded.

All conditions read ``kind``, ``schema`` and ``table`` only, so they can be
pushed below the decoding of row images.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.constants import DML, OPERATIONS
from rowtide.functions.lsn import parse_position
from rowtide.operators.relations import BROADCAST_LIMIT_BYTES


def table_matches(tables: Sequence[str]) -> Column:
    """A listed name is a bare table of any schema, or ``schema.table``; exact, case-sensitive."""
    if not tables:
        return F.lit(True)
    names = list(tables)
    return F.col("table").isin(names) | F.concat_ws(".", "schema", "table").isin(names)


def op_matches(ops: Sequence[str]) -> Column:
    """Any of insert, update, delete, truncate; no list means all."""
    unknown = set(ops) - set(OPERATIONS)
    if unknown:
        raise ValueError(f"unknown operations: {sorted(unknown)}")
    return F.col("kind").isin(list(ops)) if ops else F.lit(True)


def should_forward(
    tables: Sequence[str] = (),
    ops: Sequence[str] = (),
    emit_boundaries: bool = False,
    emit_schema: bool = False,
) -> Column:
    """Forwarding rule of every kind of event.

    The table filter holds for row events only: a truncate is subject to the
    operation filter alone, boundaries and descriptions to their own switch.
    """
    kind = F.col("kind")
    return (
        F.when(kind.isin(*DML), table_matches(tables) & op_matches(ops))
        .when(kind == "truncate", op_matches(ops))
        .when(kind.isin("begin", "commit"), F.lit(emit_boundaries))
        .when(kind == "relation", F.lit(emit_schema))
        .otherwise(F.lit(False))
    )


def forwardable(events: DataFrame, condition: Column) -> DataFrame:
    """Events that pass ``condition`` and decoded without error."""
    return events.filter(condition).filter(F.col("error_class").isNull())


def from_position(events: DataFrame, start: str | int | None) -> DataFrame:
    """Events at or after a log position; none given keeps all."""
    if start is None:
        return events
    value = parse_position(start) if isinstance(start, str) else start
    if value == 0:
        return events
    return events.filter(F.col("position") >= F.lit(value).cast("decimal(20,0)"))


def in_publications(events: DataFrame, members: DataFrame, publications: Sequence[str]) -> DataFrame:
    """Rows and descriptions of the tables the chosen publications list.

    ``members(publication, schema, table, all_tables)``. A publication of all
    tables lets every event through. A truncate keeps its listed relations and
    goes when it has none; boundaries, keepalives and errors pass. The member list is
    a catalog table; it is broadcast when its measured size allows and joined otherwise.
    """
    chosen = members.filter(F.col("publication").isin(list(publications)))
    if not chosen.filter("all_tables").isEmpty():
        return events
    listed = chosen.select(F.col("schema").alias("_schema"), F.col("table").alias("_table")).distinct()
    if listed.count() * 256 <= BROADCAST_LIMIT_BYTES:
        listed = F.broadcast(listed.withColumn("_listed", F.lit(True)))
    else:
        listed = listed.withColumn("_listed", F.lit(True))
    match = (F.col("schema") == F.col("_schema")) & (F.col("table") == F.col("_table"))
    is_truncate = (F.col("kind") == "truncate") & F.col("error_class").isNull()
    others = events.filter(~is_truncate).join(listed, match, "left")
    of_table = F.col("kind").isin(*DML, "relation")
    passed = others.filter(~of_table | F.col("_listed")).drop("_schema", "_table", "_listed")
    return passed.unionByName(_listed_truncates(events.filter(is_truncate), listed).select(*events.columns))


def _listed_truncates(truncates: DataFrame, listed: DataFrame) -> DataFrame:
    """Truncates with their listed relations only, in message order."""
    key = ["session_id", "frame_no"]
    each = truncates.select(*key, F.posexplode(F.arrays_zip("rel_ids", "tables")).alias("_at", "_named"))
    kept = each.join(listed, F.col("_named.tables") == F.concat_ws(".", "_schema", "_table"), "left_semi")
    # The list is as long as the message that named its relations.
    lists = kept.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_at", "_named"))).alias("_kept"))
    return (
        truncates.join(lists, key)
        .withColumn("rel_ids", F.transform("_kept", lambda k: k["_named"]["rel_ids"]))
        .withColumn("tables", F.transform("_kept", lambda k: k["_named"]["tables"]))
    )


def limit_rows(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows; 0 keeps all."""
    return df.limit(n) if n else df
