"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import string
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowtide.session import write_shared

# Bits of a routing bitmap; its broadcast is never larger than BITS / 8 bytes (16 MB).
BITMAP_BITS = 1 << 27
# A hot key is spread over this many tasks at most.
SALTS = 256
# Bytes of an Arrow batch between the JVM and a Python worker. Each task holds a few of them on either side, and the
# JVM keeps, outside its heap, what its largest ones took.
BATCH_BYTES = 2 << 20
# Rows of whole texts that a Parquet reader holds at once. It keeps them in one array, up to twice as long, and the
# outgrown ones until they are collected; the preset 4,096 rows make that some 50 MB a task for texts of 4 KB.
READ_ROWS = 256
# What separates words in every contract: space and the controls \t to \r.
NOT_SPACE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps survive lost executors."""
    return write_shared(df, f"llm-{name}")


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches of this session cut by bytes: long texts and sets do not add up in workers."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def short_reads(df: DataFrame) -> DataFrame:
    """``df``, with fewer rows at once from the Parquet readers of this session: long texts do not add up in executors."""
    df.sparkSession.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))
    return df


_REMEMBERING: list = []


def remember_only(memory) -> None:
    """Empty (``clear``) what another operator still remembers in this Python worker, which Spark reuses."""
    others = [other for other in _REMEMBERING if other is not memory]
    for other in others:
        other.clear()
    if others:
        give_back()
    _REMEMBERING[:] = [memory]


def give_back() -> None:
    """Return freed memory of this Python worker to the system; else allocators hold it for later."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once, also inside higher-order functions."""
    return F.transform(F.array(value), body)[0]


def bitmap_of(keys: DataFrame, column: str, bits: int = BITMAP_BITS) -> DataFrame:
    """Fold keys into a bitmap of fixed size, in rows of 4 KB.

    A set bit means "perhaps present", a clear bit "certainly absent". The table
    has at most ``bits / 32768`` rows whatever the number of keys, so it may be broadcast.
    """
    places = keys.select((F.pmod(F.xxhash64(column), F.lit(bits)) + 1).alias("p"))
    return (
        places.select(F.expr("bitmap_bucket_number(p)").alias("_bucket"), F.expr("bitmap_bit_position(p)").alias("_bit"))
        .groupBy("_bucket")
        .agg(F.expr("bitmap_construct_agg(_bit)").alias("_bits"))
    )


def perhaps_in(df: DataFrame, key: str, bitmap: DataFrame, flag: str, bits: int = BITMAP_BITS) -> DataFrame:
    """Add boolean ``flag``: whether the key's bit is set. Rows are neither lost nor moved."""
    place = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    marked = df.withColumn("_place", place)
    joined = marked.join(
        F.broadcast(bitmap.withColumnRenamed("_bucket", "_b")),
        F.expr("bitmap_bucket_number(_place) = _b"),
        "left",
    )
    byte = F.expr("substring(_bits, cast(bitmap_bit_position(_place) div 8 as int) + 1, 1)")
    bit = F.expr("shiftleft(1, cast(bitmap_bit_position(_place) % 8 as int))")
    present = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(bit) > 0
    return joined.withColumn(flag, F.coalesce(present, F.lit(False))).drop("_place", "_b", "_bits")


def row_mark(text: Column) -> Column:
    """With the id, what tells a row from others: rows equal in both are treated alike."""
    return F.xxhash64(text)


def drop_rows(docs: DataFrame, id_col: str, text_col: str, verdicts: DataFrame, name: str) -> DataFrame:
    """``docs`` without the rows that ``verdicts(doc_id, mark, kept)`` does not keep; rows with a null id stay.

    No text is shuffled. A bitmap tells rows that are certainly kept; a second one, of kept rows whose
    bit is set all the same, tells rows that certainly go. Only rows that are in both are looked up, in the
    list of dropped rows that are in both.
    """
    known = verdicts.select("doc_id", "mark", "kept", F.xxhash64("doc_id", "mark").alias("key"))
    known = stored(known.where("doc_id is not null"), f"{name}-verdicts")
    gone = known.where("not kept")
    gone_bits = stored(bitmap_of(gone, "key"), f"{name}-gone")
    spared = perhaps_in(known.where("kept"), "key", gone_bits, "hit").where("hit")
    spared_bits = stored(bitmap_of(spared, "key"), f"{name}-spared")
    doubtful = perhaps_in(gone, "key", spared_bits, "hit").where("hit").select("doc_id", "mark").distinct()
    doubtful = stored(doubtful, f"{name}-doubtful")
    mark = row_mark(text_or_empty(docs[text_col]))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[id_col].alias("id"),
        mark.alias("row_mark"),
        F.when(docs[id_col].isNotNull(), F.xxhash64(docs[id_col], mark)).alias("key"),
    )
    marked = perhaps_in(perhaps_in(rows, "key", gone_bits, "gone"), "key", spared_bits, "spared")
    left = marked.where("id is null or not gone or spared")
    found = (left["id"] == doubtful["doc_id"]) & (left["row_mark"] == doubtful["mark"])
    return left.join(doubtful, found, "left_anti").select("row.*")


def spread_groups(
    rows: DataFrame,
    key: str,
    spread_by: str,
    aggregates: dict[str, tuple[str, str]],
    extend: Callable[[DataFrame], DataFrame] = lambda totals: totals,
) -> DataFrame:
    """Give every row the aggregates of its group without gathering a group in one task.

    ``aggregates`` maps a new column to (kind, column), kind being "count", "max" or "min".
    Rows are cut into at most ``SALTS`` parts of a key; parts are aggregated, then totals of the
    parts, and the totals go back to the parts by a join on (key, salt). ``extend`` may add columns to
    the totals, of which there is one row per key. Null keys form a group.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
    first = {
        "count": lambda c: F.count(F.lit(1)),
        "max": lambda c: F.max(c),
        "min": lambda c: F.min(c),
    }
    again = {"count": F.sum, "max": F.max, "min": F.min}
    parts = salted.groupBy(key, "_salt").agg(*[first[k](c).alias(n) for n, (k, c) in aggregates.items()])
    totals = extend(
        parts.groupBy(key).agg(
            F.collect_list("_salt").alias("_salts"), *[again[k](n).alias(n) for n, (k, _) in aggregates.items()]
        )
    )
    kept = [c for c in totals.columns if c not in (key, "_salts")]
    back = totals.select(F.col(key).alias("_key"), F.explode("_salts").alias("_part"), *kept)
    on = salted[key].eqNullSafe(back["_key"]) & (salted["_salt"] == back["_part"])
    return salted.join(back, on, "inner").drop("_salt", "_key", "_part")


def in_order(rows: DataFrame, name: str, key: str, order: list[str], folded: tuple[str, ...] = ()) -> DataFrame:
    """Add ``place``, a row's 0-based rank within its key, and the XOR of ``folded`` columns up to and with it.

    Rows are dealt by range of (key, order), so a key with a third of all rows spreads over many
    tasks; ranks are worked out inside a range and raised by what the ranges before hold. Rows equal in
    key and order are told apart by where they stood when first written. ``key`` holds no nulls. Both
    orders are written before use: a lost executor cannot change them.
    """
    tied = stored(rows.withColumn("_tie", F.monotonically_increasing_id()), f"{name}-rows")
    sort = [key, *order, "_tie"]
    ranged = tied.repartitionByRange(*sort).sortWithinPartitions(*sort)
    dealt = stored(ranged.withColumn("_range", F.spark_partition_id()).drop("_tie"), f"{name}-ranges")
    parts = dealt.groupBy(key, "_range").agg(
        F.count(F.lit(1)).alias("_n"), *[F.bit_xor(c).alias(f"_x_{c}") for c in folded]
    )
    # A range shares at most its first and its last key with others: at most two rows a range are left.
    shared = Window.partitionBy(key)
    before = shared.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        parts.withColumn("_spread", F.count(F.lit(1)).over(shared))
        .where("_spread > 1")
        .select(
            key,
            "_range",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
            *[F.coalesce(F.bit_xor(f"_x_{c}").over(before), F.lit(0)).alias(f"_x_{c}") for c in folded],
        )
    )
    inside = Window.partitionBy(key, "_range").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = dealt.select(
        "*",
        (F.row_number().over(inside) - 1).cast("long").alias("_place"),
        *[F.bit_xor(c).over(upto).alias(f"_f_{c}") for c in folded],
    )
    joined = ranked.join(F.broadcast(carried), [key, "_range"], "left")
    kept = [c for c in rows.columns if c not in folded]
    return joined.select(
        *kept,
        (F.col("_place") + F.coalesce("_before", F.lit(0))).alias("place"),
        *[F.col(f"_f_{c}").bitwiseXOR(F.coalesce(F.col(f"_x_{c}"), F.lit(0).cast("long"))).alias(c) for c in folded],
    )
