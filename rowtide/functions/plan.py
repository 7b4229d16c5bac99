"""Keeping expensive columns from being computed twice."""

from __future__ import annotations

from pyspark.sql import DataFrame


def settle(df: DataFrame, *names: str) -> DataFrame:
    """Pin computed columns: later filters on them stay above their computation.

    A filter on an ordinary computed column is pushed below it by copying the
    expression, which multiplies the work of nested walks. A generator that
    gives exactly one row keeps such a filter above, while filters on all other
    columns still move below.
    """
    others = [f"`{c}`" for c in df.columns if c not in names]
    fields = ", ".join(f"'{name}', `{name}`" for name in names)
    return df.selectExpr(*others, f"inline(array(named_struct({fields})))")
