"""Frames to change events.

Two passes over the frames, whatever their number:

1. the *control pass* keeps relation descriptions, truncates and fatal frames
   and writes them once to the shared folder - a sliver of the stream;
2. the *row pass* resolves and decodes everything else against them.

Nothing is shuffled in the row pass as long as the descriptions measure small
enough to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.constants import DML, UNKNOWN_TABLE
from rowtide.functions import binary as b
from rowtide.functions.lsn import parse_position
from rowtide.functions.plan import settle
from rowtide.operators import filters
from rowtide.operators import frames as fr
from rowtide.operators import images as im
from rowtide.operators import messages as ms
from rowtide.operators import relations as rel
from rowtide.session import configure, write_shared
from rowtide.sources import index

EVENT_COLUMNS = [
    "session_id",
    "frame_no",
    "wal_start",
    "wal_end",
    "server_time",
    "kind",
    "op",
    "rel_id",
    "schema",
    "table",
    "old",
    "new",
    "rel_ids",
    "tables",
    "cascade",
    "restart_seqs",
    "lsn",
    "end_lsn",
    "commit_time",
    "xid",
    "columns",
    "reply_requested",
    "key_names",
    "position",
    "error_class",
    "error",
]

_ABSENT = {
    "rel_id": "bigint",
    "schema": "string",
    "table": "string",
    "old": ms.IMAGE,
    "new": ms.IMAGE,
    "rel_ids": "array<bigint>",
    "tables": "array<string>",
    "cascade": "boolean",
    "restart_seqs": "boolean",
    "columns": ms.COLUMNS,
    "key_names": "array<string>",
}


@dataclass
class Control:
    """Stored control records of a set of frames, with their measured sizes."""

    records: DataFrame
    relations: int
    relation_bytes: int
    truncates: int
    fatal_sessions: int

    def descriptions(self) -> DataFrame:
        good = (F.col("kind") == "relation") & F.col("error_class").isNull()
        return self.records.filter(good).select(
            "session_id",
            "frame_no",
            "rel_id",
            F.col("relation.schema").alias("schema"),
            F.col("relation.table").alias("table"),
            F.col("relation.columns").alias("columns"),
        )

    def endings(self) -> DataFrame:
        """First fatal frame of each session that has one."""
        return (
            self.records.filter(F.col("error_class") == "fatal")
            .groupBy("session_id")
            .agg(F.min("frame_no").alias("fatal_frame"))
        )


def control_records(frames: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """Relation descriptions, truncates and fatal frames.

    ``prior`` adds the records still in force from earlier micro-batches.
    """
    few = classified_frames(index.control_frames(frames))
    kept = [c for c in few.columns if c not in ("payload", "size", "error_class", "error")]
    opened = settle(
        few.selectExpr(
            *few.columns,
            f"""if(kind = 'relation' AND error_class IS NULL,
                {ms.decode_relation('payload', fr.MESSAGE)}, NULL) AS relation""",
            f"""if(kind = 'truncate' AND error_class IS NULL,
                {ms.decode_truncate('payload', fr.MESSAGE)}, NULL) AS truncate""",
        ),
        "relation",
        "truncate",
    )
    malformed = """error_class IS NULL
        AND ((kind = 'relation' AND relation IS NULL) OR (kind = 'truncate' AND truncate IS NULL))"""
    found = opened.selectExpr(
        *kept,
        "relation",
        "truncate",
        f"if({malformed}, 'record', error_class) AS error_class",
        f"if({malformed}, 'message cut short', error) AS error",
        "false AS carried",
    )
    return found if prior is None else found.unionByName(prior.withColumn("carried", F.lit(True)))


def read_control(frames: DataFrame, prior: DataFrame | None = None) -> Control:
    """Run the control pass and measure its outcome."""
    records = write_shared(control_records(frames, prior), "control")
    names = F.coalesce(
        F.aggregate(
            F.col("relation.columns"),
            F.lit(0).cast("bigint"),
            lambda total, c: total + F.octet_length(c["name"]) + 64,
        ),
        F.lit(0),
    )
    is_relation = F.col("kind") == "relation"
    sizes = records.agg(
        F.count_if(is_relation).alias("relations"),
        F.coalesce(F.sum(F.when(is_relation, names + 256)), F.lit(0)).alias("relation_bytes"),
        F.count_if((F.col("kind") == "truncate") & ~F.col("carried")).alias("truncates"),
        F.count_if(F.col("error_class") == "fatal").alias("fatal"),
    ).first()
    return Control(
        records=records,
        relations=sizes["relations"],
        relation_bytes=sizes["relation_bytes"],
        truncates=sizes["truncates"],
        fatal_sessions=sizes["fatal"],
    )


def _cut_after_fatal(rows: DataFrame, control: Control, limit: int, width: int) -> DataFrame:
    """Drop what a session holds after its first fatal frame."""
    if not control.fatal_sessions:
        return rows
    after = control.endings().select(
        "session_id",
        (F.col("fatal_frame") + 1).alias("valid_from"),
        F.lit(None).cast("bigint").alias("valid_to"),
    )
    return rel.interval_join(
        rows, after, ["session_id"], "left_anti", control.fatal_sessions * 128, limit, width
    )


def _relation_intervals(control: Control, width: int) -> DataFrame:
    return rel.validity(control.descriptions(), ["session_id", "rel_id"], control.relations, width).withColumnRenamed(
        "frame_no", "valid_from"
    )


def resolve_rows(classified: DataFrame, control: Control, limit: int, width: int) -> DataFrame:
    """Add ``schema``, ``table``, ``names`` and ``key_names`` to row messages."""
    if control.relations:
        intervals = _relation_intervals(control, width).select(
            "session_id",
            "rel_id",
            "valid_from",
            "valid_to",
            "schema",
            "table",
            F.transform("columns", lambda c: c["name"]).alias("names"),
            rel.key_names(F.col("columns")).alias("key_names"),
        )
        found = rel.interval_join(
            classified,
            intervals,
            ["session_id", "rel_id"],
            "left",
            control.relation_bytes,
            limit,
            width,
        )
    else:
        found = classified.select(
            "*",
            F.lit(None).cast("string").alias("schema"),
            F.lit(None).cast("string").alias("table"),
            F.lit(None).cast("array<string>").alias("names"),
            F.lit(None).cast("array<string>").alias("key_names"),
        )
    is_row = F.col("rel_id").isNotNull()
    return found.withColumn(
        "schema", F.when(is_row, rel.schema_or_unknown(F.col("schema"), F.col("rel_id")))
    ).withColumn("table", F.when(is_row, rel.table_or_unknown(F.col("table"))))


def decode_rows(resolved: DataFrame, images: bool | Column = True) -> DataFrame:
    """Add ``old`` and ``new`` images and mark malformed rows.

    Without ``images`` rows are only checked; both images are then NULL. A condition builds the
    images of the rows it holds for.
    """
    kept = [c for c in resolved.columns if c not in ("error", "error_class")]
    plain = [c for c in kept if c not in ("payload", "size", "names")]
    dml = ", ".join(f"'{op}'" for op in DML)
    flag = b.byte("payload", fr.MESSAGE + 5)
    counted = resolved.selectExpr(
        "*",
        # How many images a row message holds: one, for an update possibly two, or nothing readable (-1).
        f"""CASE WHEN error_class IS NOT NULL OR kind NOT IN ({dml}) THEN 0
                 WHEN kind <> 'update' OR {flag} = {b.tags('N')} THEN 1
                 WHEN {flag} IN ({b.tags('O', 'K')}) THEN 2 ELSE -1 END AS _images""",
        f"{flag} AS _flag",  # the last that is read of a payload, which goes no further than the images
    )
    given = (F.col("payload"), F.col("_images"))
    if isinstance(images, Column) or images:
        build = images if isinstance(images, Column) else None
        read = counted.withColumn("_read", im.read_images(*given, build))
        malformed = "_read.malformed"
    else:
        read = counted.withColumn("_read", im.images_malformed(*given))
        malformed = "_read"
    checked = (
        settle(read, "_read")
        .selectExpr(
            *kept,
            "_images",
            "_read",
            f"""CASE WHEN _images = 0 THEN error
                     WHEN _images < 0 THEN concat('unexpected update flag 0x', hex(_flag))
                     WHEN {malformed} THEN 'row image malformed' END AS error""",
            "error_class AS _class",
        )
        .withColumn("error_class", F.expr("coalesce(_class, if(error IS NULL, NULL, 'record'))"))
    )
    if malformed == "_read":
        return checked.select(*plain, "error_class", "error")
    valued = checked.selectExpr(
        *plain,
        "names",
        "if(_images = 2 OR kind = 'delete', _read.first, NULL) AS _old",
        "CASE WHEN _images = 2 THEN _read.second WHEN kind <> 'delete' THEN _read.first END AS _new",
        "error_class",
        "error",
    ).selectExpr(
        *plain,
        "error_class",
        "error",
        f"{ms.row_image('_old', 'names')} AS old",
        f"{ms.row_image('_new', 'names')} AS new",
    )
    return settle(valued, "old", "new")


def _with_all_columns(events: DataFrame) -> DataFrame:
    present = set(events.columns)
    failed = F.col("error_class").isNotNull()
    filled = [
        F.when(failed, F.lit("error")).otherwise(F.col("kind")).alias("op")
        if name == "op"
        else (F.col(name) if name in present else F.lit(None).cast(_ABSENT[name]).alias(name))
        for name in EVENT_COLUMNS
    ]
    return events.select(*filled)


def relation_events(control: Control) -> DataFrame:
    own = control.records.filter((F.col("kind") == "relation") & ~F.col("carried"))
    return _with_all_columns(
        own.withColumn("schema", F.col("relation.schema"))
        .withColumn("table", F.col("relation.table"))
        .withColumn("columns", F.col("relation.columns"))
        .drop("relation", "truncate", "carried")
    )


def truncate_events(control: Control, limit: int, width: int) -> DataFrame:
    """Truncates with the names of their relations, in message order."""
    own = control.records.filter((F.col("kind") == "truncate") & ~F.col("carried")).drop("relation", "carried", "rel_id")
    ids = own.select("session_id", "frame_no", F.posexplode("truncate.rel_ids").alias("_at", "rel_id"))
    if control.relations:
        intervals = _relation_intervals(control, width).select(
            "session_id", "rel_id", "valid_from", "valid_to", "schema", "table"
        )
        ids = rel.interval_join(
            ids,
            intervals,
            ["session_id", "rel_id"],
            "left",
            control.relation_bytes,
            limit,
            width,
        )
    else:
        ids = ids.withColumn("schema", F.lit(None).cast("string")).withColumn("table", F.lit(None).cast("string"))
    name = rel.qualified_or_unknown(F.col("schema"), F.col("table"), F.col("rel_id"))
    # The list is as long as the message that named its relations.
    tables = (
        ids.groupBy("session_id", "frame_no")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("_at"), name.alias("name")))).alias("_named"))
        .select("session_id", "frame_no", F.transform("_named", lambda n: n["name"]).alias("tables"))
    )
    none = F.array().cast("array<string>")
    good = F.col("error_class").isNull()
    return _with_all_columns(
        own.join(tables, ["session_id", "frame_no"], "left")
        .withColumn("tables", F.when(good, F.coalesce("tables", none)))
        .withColumn("rel_ids", F.col("truncate.rel_ids"))
        .withColumn("cascade", F.col("truncate.cascade"))
        .withColumn("restart_seqs", F.col("truncate.restart_seqs"))
        .drop("truncate")
    )


def classified_frames(frames: DataFrame) -> DataFrame:
    return fr.classify(frames)


def _relation_ids(frames: DataFrame, control: Control, tables: Sequence[str]) -> list[int] | None:
    """Ids that any description gives to one of the tables; None where they cannot narrow what is read."""
    unknown = any(name.rsplit(".", 1)[-1] == UNKNOWN_TABLE for name in tables)
    if not tables or unknown or not index.is_indexed(frames):
        return None
    described = control.descriptions().filter(filters.table_matches(tables)).select("rel_id").distinct()
    ids = [row["rel_id"] for row in described.limit(index.MOST_IDS + 1).collect()]
    return ids if len(ids) <= index.MOST_IDS else None


def decode_changes(
    frames: DataFrame,
    prior: DataFrame | None = None,
    control: Control | None = None,
    where: Column | None = None,
    images: bool | Column = True,
    broadcast_limit: int = rel.BROADCAST_LIMIT_BYTES,
    range_width: int = rel.RANGE_WIDTH,
    tables: Sequence[str] = (),
    start: str | int | None = None,
) -> DataFrame:
    """Every frame as one event row (``EVENT_COLUMNS``).

    ``tables`` and ``start`` leave out row messages of other tables and, of any table, those before a log
    position; indexed frames (``rowtide.sources.index``) of that kind are not even read. Other events stay.

    ``where`` may use ``kind``, ``rel_id``, ``schema`` and ``table``; rows that
    fail it are dropped before their images are decoded. ``images=False`` checks
    rows without building their images, enough for positions and dead letters; a condition over the same
    columns builds the images of the rows it holds for, and checks all.
    """
    configure(frames.sparkSession)
    control = control or read_control(frames, prior)
    first = parse_position(start) if isinstance(start, str) else start or 0
    rows = classified_frames(index.row_frames(frames, _relation_ids(frames, control, tables), first))
    rows = resolve_rows(rows, control, broadcast_limit, range_width)
    is_row = F.col("rel_id").isNotNull()
    if tables:
        rows = rows.filter(~is_row | filters.table_matches(tables))
    if first:
        rows = rows.filter(~is_row | (F.col("position") >= F.lit(first).cast("decimal(20,0)")))
    if where is not None:
        rows = rows.filter(where)
    events = _with_all_columns(decode_rows(rows, images))
    rare = relation_events(control)
    if control.truncates:
        rare = rare.unionByName(truncate_events(control, broadcast_limit, range_width))
    if where is not None:
        rare = rare.filter(where)
    return _cut_after_fatal(events.unionByName(rare), control, broadcast_limit, range_width)


def dead_letters(events: DataFrame) -> DataFrame:
    """Malformed records: kept aside, never forwarded, never acknowledged."""
    return events.filter(F.col("error_class") == "record").select(
        "session_id", "frame_no", "wal_end", "kind", "error"
    )
