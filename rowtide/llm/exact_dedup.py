"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each pass groups on a costlier key, and only for rows whose cheaper key is shared. What a pass
learns travels to the next scan as a bitmap of fixed size (a false "perhaps" costs one
more hash, never a wrong group), so texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import ascii_lower, bitmap_of, drop_rows, perhaps_in, row_mark, spread_groups, stored, text_or_empty

PREFIX_CHARS = 256


def _normal(text: Column, fold_case: bool) -> Column:
    return ascii_lower(text) if fold_case else text


def find_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fold_case: bool = True,
    prefix_chars: int = PREFIX_CHARS,
    digest_all: bool = False,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z (``fold_case``); the largest id of a group
    is ``keep_id``. ``text_sha256`` is null for rows that an earlier pass proved unique,
    unless ``digest_all`` asks for every digest.

    Null texts count as empty and are one group. Rows that repeat an id are rows of their own
    (both kept if theirs is the largest id of the group). A null id is smaller than any other; a
    group of null ids only has a null ``keep_id`` and is kept. Other columns are not read. An empty
    table gives an empty result.
    """
    return _grouped(docs, id_col, text_col, fold_case, prefix_chars, digest_all).drop("mark")


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, fold_case: bool, prefix_chars: int, digest_all: bool
) -> DataFrame:
    """``find_copies`` with ``mark``, which tells rows of one id apart by their text."""
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))

    lengths = texts.select(F.octet_length("text").alias("n")).groupBy("n").count().where("count > 1")
    sized = perhaps_in(texts.withColumn("n", F.octet_length("text")), "n", bitmap_of(lengths, "n"), "same_length")

    head = F.xxhash64("n", _normal(F.left("text", F.lit(prefix_chars)), fold_case))
    headed = sized.where("same_length").select(head.alias("h"))
    heads = headed.groupBy("h").count().where("count > 1")
    known = perhaps_in(
        sized.withColumn("h", F.when(F.col("same_length"), head)), "h", bitmap_of(heads, "h"), "same_head"
    )

    full = F.unhex(F.sha2(_normal(F.col("text"), fold_case), 256))
    shared = F.col("same_length") & F.col("same_head")
    digest = full if digest_all else F.when(shared, full)
    marked = known.select("doc_id", row_mark(F.col("text")).alias("mark"), shared.alias("shared"), digest.alias("digest"))
    rows = stored(marked, "digests")

    alone = rows.where(~F.col("shared")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest", "mark"
    )
    grouped = spread_groups(
        rows.where("shared").select("doc_id", "digest", "mark"),
        "digest",
        "doc_id",
        {"keep_id": ("max", "doc_id"), "group_size": ("count", "doc_id")},
    ).select("doc_id", "keep_id", "group_size", "digest", "mark")
    return alone.unionByName(grouped).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "mark",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text another row with a larger id holds; all columns stay.

    Rows are told apart by id and text. Rows equal in both stay together, rows with a null id stay. Only texts
    that share length and beginning are hashed in full, and none is shuffled.
    """
    copies = _grouped(docs, id_col, text_col, fold_case=True, prefix_chars=PREFIX_CHARS, digest_all=False)
    return drop_rows(docs, id_col, text_col, copies, "copies")
