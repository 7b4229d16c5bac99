"""Result sets cut into sheets.

Row numbers come from per-partition counts and offsets, never from one sorted
task. The rendered rows are written once with their place, so the numbers stay
the same when an executor is lost between counting and writing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide import constants as c
from rowtide.session import write_shared

PLACE = "_place"
ROW_MASK = (1 << 33) - 1  # row part of a monotonically increasing id


def number_rows(df: DataFrame, name: str = "row_no", first: int = 0) -> DataFrame:
    """Add a 0-based row number in result order; ``df``'s own columns are carried along untouched.

    ``first`` keeps that many rows. All are read - whoever counts them sees every row - but a partition stores no more.
    """
    own = [f"_{i}" for i in range(len(df.columns))]
    row = F.struct(*own).alias("row")
    numbered = df.toDF(*own).select(row, F.monotonically_increasing_id().alias(PLACE))
    if first:
        numbered = numbered.filter(F.col(PLACE).bitwiseAND(F.lit(ROW_MASK)) < first)
    placed = write_shared(numbered, "rows")
    part = F.shiftright(F.col(PLACE), 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition of the result: bounded by the number of tasks.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = F.col(PLACE).bitwiseAND(F.lit(ROW_MASK))
    result = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    if first:
        result = result.filter(F.col("_offset") + inside < first)
    return result.select(
        *[F.col("row")[o].alias(c_) for o, c_ in zip(own, df.columns)], (F.col("_offset") + inside).alias(name)
    )


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in result order, from one pass that reads all of ``df``."""
    names = [f"_{i}" for i in range(len(df.columns))]
    return number_rows(df.toDF(*names), "row_no", n).orderBy("row_no").drop("row_no").toDF(*df.columns)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, underscored until no column of ``df`` has it."""
    taken = {c_.lower() for c_ in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def split_sheets(rendered: DataFrame, rows_per_sheet: int = c.SHEET_DATA_ROWS) -> DataFrame:
    """Add ``row_no`` and the 1-based ``sheet`` each row falls into, as the last two columns.

    Where the result has columns of these names, the added ones take an underscore in front.
    """
    row_no, sheet = free_name(rendered, "row_no"), free_name(rendered, "sheet")
    numbered = number_rows(rendered, row_no)
    return numbered.withColumn(sheet, (F.floor(F.col(row_no) / rows_per_sheet) + 1).cast("int"))


def safe_sheet_name(name: Column, limit: int = c.SHEET_NAME_BYTES) -> Column:
    """Forbidden characters removed, at most ``limit`` bytes, never empty."""
    clean = F.regexp_replace(name, r"[:\\/?*\[\]]", "")
    cut = F.substring(clean.cast("binary"), 1, limit)
    # A cut inside a character leaves an invalid tail of up to three bytes.
    whole = F.coalesce(
        *[
            F.try_validate_utf8(F.substring(cut, F.lit(1), F.octet_length(cut) - back).cast("string"))
            for back in range(4)
        ]
    )
    return F.when(F.length(whole) > 0, whole).otherwise(F.lit(c.SHEET_DEFAULT_NAME))


def sheet_name(base: Column, sheet: Column) -> Column:
    """Name of the n-th sheet; the base gives way so the suffix fits."""
    suffix = F.when(sheet > 1, F.concat(F.lit(" ("), sheet.cast("string"), F.lit(")"))).otherwise(F.lit(""))
    return F.concat(safe_sheet_name(base, F.lit(c.SHEET_NAME_BYTES) - F.octet_length(suffix)), suffix)


# A number as the sheet writer reads one: no blanks, no type suffix.
_NUMBER = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\z"


def cell_kind(cell: Column) -> Column:
    """``null``, ``number``, ``boolean`` or ``text`` of a text cell."""
    return (
        F.when(cell == c.NULL_TEXT, F.lit("null"))
        .when(cell.rlike(_NUMBER), F.lit("number"))
        .when(cell.isin("true", "false"), F.lit("boolean"))
        .otherwise(F.lit("text"))
    )


def column_widths(sheets: DataFrame) -> DataFrame:
    """``(sheet, column, width)`` of ``split_sheets``: longest of header and cells, clamped and padded."""
    names = sheets.columns
    added = [n.lstrip("_") for n in names[-2:]] == ["row_no", "sheet"]
    sheet = len(names) - 1 if added else names.index("sheet")
    own = [i for i, n in enumerate(names) if i != sheet and (i != len(names) - 2 if added else n != "row_no")]
    placed = sheets.toDF(*["sheet" if i == sheet else f"_{i}" for i in range(len(names))])
    longest = placed.groupBy("sheet").agg(*[F.max(F.char_length(f"_{i}")).alias(f"_{i}") for i in own])
    widths = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(names[i]).alias("column"),
                    (
                        F.least(
                            F.greatest(F.col(f"_{i}"), F.lit(len(names[i])), F.lit(c.WIDTH_MIN)), F.lit(c.WIDTH_MAX)
                        )
                        + c.WIDTH_PAD
                    ).alias("width"),
                )
                for i in own
            ]
        )
    ).alias("w")
    return longest.select("sheet", widths).select("sheet", "w.column", "w.width")


def write_sheets(rendered: DataFrame, path: str, name: str, rows_per_sheet: int = c.SHEET_DATA_ROWS) -> None:
    """One folder per sheet, one CSV file with a header in each.

    A sheet is bounded by ``rows_per_sheet`` and so fits one task.
    """
    sheets = split_sheets(rendered, rows_per_sheet)
    *_, row_no, sheet = sheets.columns
    folder = free_name(rendered, "sheet_name")
    named = sheets.withColumn(folder, F.coalesce(sheet_name(F.lit(name), F.col(sheet)), F.lit(c.SHEET_DEFAULT_NAME)))
    # The partitioned writer wants the folder's order first; a sort by anything else would be dropped.
    (
        named.repartition(sheet)
        .sortWithinPartitions(folder, row_no)
        .drop(row_no, sheet)
        .write.partitionBy(folder)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
