"""Change events as JSON, attributes and summaries. Projections only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide import constants as c
from rowtide.functions.lsn import lsn_text

# Fields of each kind of event, in output order after ``op``.
EVENT_FIELDS = {
    "insert": ["rel_id", "schema", "table", "new"],
    "update": ["rel_id", "schema", "table", "old", "new"],
    "delete": ["rel_id", "schema", "table", "old"],
    "truncate": ["rel_ids", "tables", "cascade", "restart_seqs"],
    "begin": ["lsn", "commit_time", "xid"],
    "commit": ["lsn", "end_lsn", "commit_time"],
    "relation": ["rel_id", "schema", "table", "columns"],
}


def image_texts(image: str) -> str:
    """SQL: row image to ``map<string,string>`` as it is printed."""
    return f"""transform_values({image}, (name, v) ->
        if(v.state = 'u', '{c.UNCHANGED_TEXT}', v.value))"""


def with_texts(events: DataFrame) -> DataFrame:
    """Replace the three-state images by printable ones, once for all uses."""
    return events.withColumns({"old": F.expr(image_texts("old")), "new": F.expr(image_texts("new"))})


def json_options(pretty: bool = False) -> dict[str, str]:
    # A missing old image and a NULL column are printed as null, not left out.
    options = {"ignoreNullFields": "false"}
    if pretty:
        options["pretty"] = "true"
    return options


def event_json(pretty: bool = False) -> Column:
    """JSON of an event whose images are printable; NULL for events never printed."""
    branches = [
        F.when(F.col("op") == op, F.to_json(F.struct("op", *fields), json_options(pretty)))
        for op, fields in EVENT_FIELDS.items()
    ]
    return F.coalesce(*branches)


def op_label(op: Column) -> Column:
    return F.upper(op)


def table_of_event() -> Column:
    """``struct<schema, table>`` of a row event, NULL for the rest."""
    return F.when(F.col("op").isin(*c.DML), F.struct("schema", "table"))


def attributes() -> Column:
    """Event attributes: name to text, absent ones left out."""
    op = F.col("op")
    is_row = op.isin(*c.DML)
    entries = {
        c.ATTR_OP: op,
        c.ATTR_LSN: lsn_text(F.col("position")),
        c.ATTR_SCHEMA: F.when(is_row, F.col("schema")),
        c.ATTR_TABLE: F.when(is_row, F.col("table")),
        c.ATTR_NEW: F.when(op.isin("insert", "update"), F.to_json("new")),
        c.ATTR_OLD: F.when(op.isin("update", "delete"), F.to_json("old")),
        c.ATTR_TABLES: F.when(op == "truncate", F.array_join("tables", ",")),
        c.ATTR_XID: F.when(op == "begin", F.col("xid").cast("string")),
    }
    return present_entries(entries)


def present_entries(entries: dict[str, Column]) -> Column:
    """Map of the entries whose value is not NULL."""
    pairs = reduce(lambda acc, kv: acc + [F.lit(kv[0]), kv[1]], entries.items(), [])
    return F.map_filter(F.create_map(*pairs), lambda _k, v: v.isNotNull())


def event_log(events: DataFrame) -> DataFrame:
    """One line per event: what, where, at which position."""
    op = F.col("op")
    return events.filter(op.isin(*EVENT_FIELDS)).select(
        "session_id",
        "frame_no",
        "op",
        "schema",
        "table",
        F.when(op == "truncate", F.array_join("tables", ", ")).alias("tables"),
        F.when(~op.isin("begin", "relation"), lsn_text(F.col("position"))).alias("lsn"),
        F.when(op == "begin", F.col("xid")).alias("xid"),
        F.when(op == "relation", F.size("columns")).alias("col_count"),
    )
