"""Places of regular expression matches as columns: code-point offsets, end exclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowtide.llm.common import let

BLOCK = 128


def running(values: Column) -> Column:
    """Running sums of an array of numbers, the own value included.

    Sums are taken within blocks of ``BLOCK`` values, then over the blocks, so that a long array
    is not copied once per value.
    """
    zero = F.array(F.lit(0).cast("bigint"))

    def add(sums: Column, value: Column) -> Column:
        return F.concat(sums, F.array(F.element_at(sums, -1) + value))

    def within(values: Column) -> Column:
        last = F.greatest(F.floor((F.size(values) - 1) / BLOCK).cast("int"), F.lit(0))
        return F.transform(
            F.sequence(F.lit(0), last), lambda b: F.aggregate(F.slice(values, b * BLOCK + 1, BLOCK), zero, add)
        )

    def joined(blocks: Column) -> Column:
        before = F.aggregate(blocks, zero, lambda sums, block: add(sums, F.element_at(block, -1)))
        return let(
            before,
            lambda z: F.flatten(
                F.transform(blocks, lambda block, b: F.transform(F.slice(block, 2, BLOCK), lambda v: v + F.get(z, b)))
            ),
        )

    return let(let(values, within), joined)


def match_steps(text: Column, pattern: str) -> Column:
    """Array of (gap, found): each match after the text before it; what follows the last match has no ``found``.

    Patterns must not match the empty string.
    """
    return F.arrays_zip(
        F.split(text, pattern).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")
    )


def spans_of(steps: Column) -> Column:
    """Places of the matches in ``steps``, an array of (start, end, text)."""

    def placed(matched: Column) -> Column:
        def one(step: Column, end: Column) -> Column:
            start = end - F.length(step["found"])
            return F.struct(start.alias("start"), end.alias("end"), step["found"].alias("text"))

        ends = running(F.transform(matched, lambda s: (F.length(s["gap"]) + F.length(s["found"])).cast("bigint")))
        return let(ends, lambda e: F.transform(matched, lambda step, i: one(step, F.get(e, i))))

    return let(F.filter(steps, lambda s: s["found"].isNotNull()), placed)


def match_spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, text), in time linear in the text.

    Offsets are running lengths of the matches and of what lies between them. Patterns must
    not match the empty string.
    """
    none = F.array().cast("array<struct<start:bigint,end:bigint,text:string>>")
    return F.when(text.rlike(pattern), spans_of(match_steps(text, pattern))).otherwise(none)


def listed(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` joined by commas; spans are structs with ``kind`` (a place in ``kinds``), start and end."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def keyed(spans: Column, kind: int, by_start: bool) -> Column:
    """Spans with their kind, as structs that sort by start then kind, or by kind then start."""
    k = F.lit(kind).cast("int").alias("kind")

    def one(s: Column) -> Column:
        start, end = s["start"].alias("start"), s["end"].alias("end")
        return F.struct(start, k, end) if by_start else F.struct(k, start, end)

    return F.transform(spans, one)


