"""Result sets as text cells, and the files written from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.render import cell_text, with_number_texts
from rowtide.operators.filters import limit_rows


def render(df: DataFrame, limit: int = 0) -> DataFrame:
    """Every cell as text, in one projection over the first ``limit`` rows (0 = all).

    Columns are taken by position, so names may repeat or hold any character.
    """
    placed = limit_rows(df, limit).toDF(*[f"_{i}" for i in range(len(df.columns))])
    cells = [cell_text(field) for field in placed.schema.fields]
    return with_number_texts(placed).select(*[cell.alias(name) for cell, name in zip(cells, df.columns)])


def json_records(rendered: DataFrame) -> DataFrame:
    """One JSON object per row, keys sorted, every value a string; of equal names the last column counts."""
    last = {name: f"_{i}" for i, name in enumerate(rendered.columns)}
    placed = rendered.toDF(*[f"_{i}" for i in range(len(rendered.columns))])
    return placed.select(F.to_json(F.struct(*[F.col(last[n]).alias(n) for n in sorted(last)])).alias("record"))


def display(df: DataFrame, limit: int = 0) -> DataFrame:
    """Text cells of the first ``limit`` rows; all rows unless asked otherwise."""
    return render(df, limit)


def write_csv(rendered: DataFrame, path: str) -> None:
    """Header row, text as it is, quotes doubled."""
    (
        rendered.write.option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_json(rendered: DataFrame, path: str) -> None:
    """One record per line, so that any number of tasks can write."""
    json_records(rendered).select(F.col("record").alias("value")).write.text(path)


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows fetched, whatever number is kept or shown."""
    return df.agg(F.count(F.lit(1)).alias("rows"))
