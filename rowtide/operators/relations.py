"""Which table a row belongs to: relation descriptions as validity intervals.

A description holds from its own frame to the next one of the same relation
in the same session. Rows find theirs by an interval join on
``(session_id, rel_id)`` and ``frame_no``; the descriptions are few, so they
are broadcast while they measure small, and otherwise both sides are cut into
frame ranges so that one busy table spreads over many tasks. A range gets the
descriptions that begin in it and the one in force where it starts, and only
ranges that hold rows get any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.constants import UNKNOWN_SCHEMA_PREFIX, UNKNOWN_TABLE

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
RANGE_WIDTH = 1 << 20  # frames per range; bounds the rows sharing one join key
RANGES_PER_BLOCK = 1 << 12  # ranges of a key looked back over at a time
SPREAD = 64  # parts the ranges of one long-lived description are dealt to


def _unsent(df: DataFrame) -> DataFrame:
    """Not to be broadcast: the size Spark expects of a few columns of wide stored records is far below theirs."""
    return df.hint("merge")


def _range_of(frame_no: Column, width: int) -> Column:
    return F.floor(frame_no / F.lit(width)).cast("bigint")


def key_names(columns: Column) -> Column:
    """Names of a description's key columns; NULL where none or all of them are, as then no column tells rows apart."""
    keys = F.filter(columns, lambda c: c["is_key"])
    return F.when((F.size(keys) > 0) & (F.size(keys) < F.size(columns)), F.transform(keys, lambda c: c["name"]))


def validity(descriptions: DataFrame, keys: list[str], rows: int, width: int = RANGE_WIDTH) -> DataFrame:
    """Add ``valid_to``: ``frame_no`` of the next row of the same key, or NULL.

    ``rows`` is the measured number of descriptions. Beyond ``width`` the look
    ahead goes inside one frame range first and across ranges by their first
    rows, so a key described over and over is never sorted in one task.
    """
    if rows <= width:
        ordered = Window.partitionBy(*keys).orderBy("frame_no")
        return descriptions.withColumn("valid_to", F.lead("frame_no").over(ordered))
    ranged = descriptions.withColumn("_range", _range_of(F.col("frame_no"), width))
    in_range = Window.partitionBy(*keys, "_range").orderBy("frame_no")
    across = Window.partitionBy(*keys).orderBy("_range")
    firsts = (
        ranged.groupBy(*keys, "_range")
        .agg(F.min("frame_no").alias("_first"))
        .select(*keys, "_range", F.lead("_first").over(across).alias("_next_range"))
    )
    return (
        ranged.withColumn("_next", F.lead("frame_no").over(in_range))
        .join(_unsent(firsts), [*keys, "_range"], "left")
        .withColumn("valid_to", F.coalesce("_next", "_next_range"))
        .drop("_range", "_next", "_next_range")
    )


def in_force(touched: DataFrame, intervals: DataFrame, keys: list[str], width: int = RANGE_WIDTH) -> DataFrame:
    """The interval in force where each touched range starts: ``(*keys, _range, valid_from)``.

    ``touched(*keys, _range)`` are the ranges that hold rows. The latest start before a range comes
    from the ranges before it in its block, else from the blocks before, so a key with very many
    ranges is never one task.
    """
    begun = intervals.groupBy(*keys, _range_of(F.col("valid_from"), width).alias("_range")).agg(
        F.max("valid_from").alias("_last")
    )
    asked = touched.select(*keys, "_range", F.lit(None).cast("bigint").alias("_last"), F.lit(True).alias("_asked"))
    steps = (
        asked.unionByName(begun.withColumn("_asked", F.lit(False)))
        .groupBy(*keys, "_range")
        .agg(F.max("_last").alias("_last"), F.max("_asked").alias("_asked"))
        .withColumn("_block", F.floor(F.col("_range") / RANGES_PER_BLOCK))
    )

    def before(window):
        return window.rowsBetween(Window.unboundedPreceding, -1)

    blocks = (
        steps.groupBy(*keys, "_block")
        .agg(F.max("_last").alias("_last"))
        .select(*keys, "_block", F.max("_last").over(before(Window.partitionBy(*keys).orderBy("_block"))).alias("_carried"))
    )
    inside = before(Window.partitionBy(*keys, "_block").orderBy("_range"))
    return (
        steps.withColumn("_inside", F.max("_last").over(inside))
        .filter("_asked")
        .join(_unsent(blocks), [*keys, "_block"])
        .select(*keys, "_range", F.coalesce("_inside", "_carried").alias("valid_from"))
        .filter(F.col("valid_from").isNotNull())
    )


def by_range(touched: DataFrame, intervals: DataFrame, keys: list[str], width: int = RANGE_WIDTH) -> DataFrame:
    """``intervals`` with the ``_range`` they are needed in: where they begin, and touched ranges they last into.

    Has at most one row per interval and one per touched range, however far apart frame numbers are.
    """
    needed = in_force(touched, intervals, keys, width).withColumn("_part", F.pmod("_range", F.lit(SPREAD)))
    # An interval that lasts over very many ranges goes to them in parts.
    parts = needed.select(*keys, "valid_from", "_part").distinct().join(_unsent(intervals), [*keys, "valid_from"])
    lasting = needed.join(_unsent(parts), [*keys, "valid_from", "_part"]).filter(
        F.col("valid_to").isNull() | (F.col("valid_to") > F.col("_range") * width)
    )
    columns = [*intervals.columns, "_range"]
    begun = intervals.withColumn("_range", _range_of(F.col("valid_from"), width))
    return begun.select(columns).unionByName(lasting.select(columns))


def interval_join(
    rows: DataFrame,
    intervals: DataFrame,
    keys: list[str],
    how: str,
    size_bytes: int,
    limit: int = BROADCAST_LIMIT_BYTES,
    width: int = RANGE_WIDTH,
) -> DataFrame:
    """Join ``rows`` with the interval their ``frame_no`` falls into.

    ``intervals`` has the key columns, ``valid_from`` (inclusive),
    ``valid_to`` (exclusive, NULL = open) and payload columns; those of one key do not overlap.
    ``size_bytes`` is its measured size.
    """
    inside = (F.col("frame_no") >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col("frame_no") < F.col("valid_to"))
    )
    on = list(keys)
    if size_bytes > limit:
        rows = rows.withColumn("_range", _range_of(F.col("frame_no"), width))
        intervals = by_range(rows.select(*keys, "_range").distinct(), intervals, keys, width)
        on.append("_range")
    right = intervals.select(
        *[F.col(k).alias(f"_k_{k}") for k in on],
        *[F.col(c) for c in intervals.columns if c not in on],
    )
    condition = inside
    for k in on:
        condition = (F.col(k) == F.col(f"_k_{k}")) & condition
    right = F.broadcast(right) if size_bytes <= limit else _unsent(right)
    return rows.join(right, condition, how).drop(*[f"_k_{k}" for k in on], "_range", "valid_from", "valid_to")


def schema_or_unknown(schema: Column, rel_id: Column) -> Column:
    return F.coalesce(schema, F.concat(F.lit(UNKNOWN_SCHEMA_PREFIX), rel_id.cast("string")))


def table_or_unknown(table: Column) -> Column:
    return F.coalesce(table, F.lit(UNKNOWN_TABLE))


def qualified_or_unknown(schema: Column, table: Column, rel_id: Column) -> Column:
    """Name of a truncated relation."""
    return F.coalesce(
        F.concat(schema, F.lit("."), table), F.concat(F.lit("<rel:"), rel_id.cast("string"), F.lit(">"))
    )
