"""From SQL text to a written result."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowtide.operators import results, sheets
from rowtide.session import configure, intermediates
from rowtide.sources.tables import run_sql
from rowtide.storage import Storage

FORMATS = ("excel", "csv", "json")
DEFAULT_SHEET = "Query Result"


@dataclass
class ExportReport:
    fetched: int
    written: bool


def query(spark: SparkSession, text: str, limit: int = 0, as_json: bool = False) -> DataFrame:
    """Rows to look at: text cells, or one JSON record per row."""
    shown = results.display(run_sql(spark, text), limit)
    return results.json_records(shown) if as_json else shown


def export(
    spark: SparkSession,
    output: str,
    text: str | None = None,
    file: str | None = None,
    format: str = "excel",
    limit: int = 0,
    sheet: str = DEFAULT_SHEET,
) -> ExportReport:
    """Write the result of one statement; an empty result writes nothing.

    The statement runs once: rows are counted while they are written beside ``output``, which gets
    its name at the end if there were any. The report counts all rows, not only those kept by ``limit``.
    """
    if format not in FORMATS:
        raise ValueError(f"unknown format {format!r}")
    configure(spark)
    storage = Storage(spark, output)
    if storage.exists(output):
        raise FileExistsError(output)
    seen = Observation()
    partial = f"{output.rstrip('/')}.{uuid.uuid4().hex}.partial"
    with intermediates(spark):
        df = run_sql(spark, text, file).observe(seen, F.count(F.lit(1)).alias("rows"))
        rendered = results.render(sheets.first_rows(df, limit) if limit else df)
        if format == "csv":
            results.write_csv(rendered, partial)
        elif format == "json":
            results.write_json(rendered, partial)
        else:
            sheets.write_sheets(rendered, partial, sheet)
    fetched = seen.get["rows"]
    if fetched:
        storage.move(partial, output)
    else:
        storage.remove(partial)
    return ExportReport(fetched, bool(fetched))
