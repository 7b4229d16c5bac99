"""Typed values to display text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.constants import NULL_TEXT
from rowtide.functions.binary import let

_TEXT_LIKE = (T.StringType, T.CharType, T.VarcharType)
_INTEGER = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _shortest(value: str, text: str, kind: str, digits: list[int]) -> str:
    """SQL: scientific text of a float with the fewest digits that read back the same.

    The JVM's own ``text`` can be longer than needed; shorter roundings are
    tried only when it is long enough for that, or the number is tiny.
    """
    tries = ""
    for n in digits:
        # The formatter rounds the JVM's digits, not the number itself, so the
        # digits cut off are a candidate of their own.
        rounded = f"format_string('%.{n - 1}e', {value})"
        cut = rf"regexp_replace(format_string('%.20e', {value}), '^(-?[0-9][.][0-9]{{{n - 1}}})[0-9]*', '$1')"
        for candidate in (rounded, cut):
            tries += f" WHEN try_cast({candidate} AS {kind}) = {value} THEN {candidate}"
    limit, tiny = (6, "1e-43D") if kind == "float" else (14, "1e-321D")
    mantissa = rf"length(regexp_replace(split_part({text}, 'E', 1), '[-.]', ''))"
    return f"""CASE WHEN abs({value}) < {tiny} AND try_cast(format_string('%.0e', {value}) AS {kind}) = {value}
                    THEN format_string('%.0e', {value})
                    WHEN {mantissa} <= {limit} THEN {text} {tries} ELSE {text} END"""


def _positional(scientific: str) -> str:
    """SQL: scientific or plain decimal text to plain text without a trailing ``.0``."""
    plain = r"regexp_replace({0}, '\\.0$', '')".format(scientific)
    parts = rf"""named_struct('sign', if({scientific} LIKE '-%', '-', ''),
        'whole', regexp_extract({scientific}, '^-?([0-9]+)', 1),
        'part', regexp_replace(regexp_extract({scientific}, '^-?[0-9]+\\.?([0-9]*)', 1), '0+$', ''),
        'exp', cast(regexp_extract({scientific}, '[eE]([+-]?[0-9]+)$', 1) AS int))"""
    shifted = let(
        parts,
        "p",
        """CASE WHEN p.exp < 0 THEN concat(p.sign, '0.', repeat('0', -p.exp - 1), p.whole, p.part)
                WHEN length(p.part) <= p.exp THEN concat(p.sign, p.whole, rpad(p.part, p.exp, '0'))
                ELSE concat(p.sign, p.whole, substring(p.part, 1, p.exp),
                     if(length(p.part) > p.exp, concat('.', substring(p.part, p.exp + 1)), '')) END""",
    )
    return rf"if({scientific} RLIKE '[eE]', {shifted}, {plain})"


def float_text(value: str, text: str, kind: str = "double") -> Column:
    """Shortest decimal text, never an exponent: ``1.0`` is ``1``, ``1e10`` is ``10000000000``.

    ``text`` is the column holding the number's own text, made once.
    """
    digits = [7, 8, 9] if kind == "float" else [15, 16, 17]
    # Most numbers print without an exponent and short: no shortening, no shifting.
    easy = f"NOT contains({text}, 'E') AND length({text}) <= {7 if kind == 'float' else 15}"
    hard = let(_shortest(value, text, kind, digits), "s", _positional("s"))
    return F.expr(
        f"""CASE WHEN {text} = 'NaN' THEN 'NaN' WHEN {text} = 'Infinity' THEN 'inf' WHEN {text} = '-Infinity' THEN '-inf'
            WHEN {easy} THEN if(endswith({text}, '.0'), substring({text}, 1, length({text}) - 2), {text})
            ELSE {hard} END"""
    )


def number_text_name(name: str) -> str:
    return f"_text of {name}"


def with_number_texts(df: DataFrame) -> DataFrame:
    """Add the text of every floating-point column, for ``cell_text``."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({number_text_name(n): F.col(f"`{n}`").cast("string") for n in floats}) if floats else df


def cell_text(field: T.StructField) -> Column:
    """Display text of a column by its type; NULL of any type is ``NULL``."""
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.StringType):
        text = column
    elif isinstance(kind, (*_INTEGER, *_TEXT_LIKE, T.BooleanType, T.DecimalType, T.DateType)):
        text = column.cast("string")
    elif isinstance(kind, T.NullType):
        text = F.lit(None).cast("string")
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        text = float_text(f"`{field.name}`", f"`{number_text_name(field.name)}`", kind.typeName())
    elif isinstance(kind, T.TimestampType):
        text = F.concat(F.date_format(column, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))
    elif isinstance(kind, T.TimestampNTZType):
        text = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    elif isinstance(kind, T.VariantType):
        text = F.to_json(column)
    else:
        text = F.when(column.isNotNull(), F.lit(f"<{kind.typeName()}>"))
    return F.coalesce(text, F.lit(NULL_TEXT)).alias(field.name)
