"""Log positions and server timestamps.

A log position is an unsigned 64-bit number: DECIMAL(20,0) holds and orders
every value, the text form ``HI/LO`` is for display only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowtide.constants import SERVER_EPOCH_MICROS
from rowtide.functions.binary import U64, hex_of

# Hex digits with an optional plus sign, as an unsigned number is written.
_HALF = r"^\+?0*([0-9A-Fa-f]{1,16})\z"


def lsn_text(position: Column) -> Column:
    """``DECIMAL(20,0)`` to ``HI/LO``: upper case, no padding."""
    digits = F.lpad(F.conv(position.cast("string"), 10, 16), 16, "0")
    high = F.conv(F.substring(digits, 1, 8), 16, 16)
    low = F.conv(F.substring(digits, 9, 8), 16, 16)
    return F.concat(high, F.lit("/"), low)


def lsn_text_at(data: str, start: str) -> str:
    """SQL for the text of the position stored in eight bytes of ``data``."""
    high, low = hex_of(data, start, 4), hex_of(data, f"{start} + 4", 4)
    return f"concat(conv({high}, 16, 16), '/', conv({low}, 16, 16))"


def _number(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("bigint")


def parse_lsn(text: Column, strict: bool = True) -> Column:
    """``HI/LO`` to ``DECIMAL(20,0)``.

    The halves are split at the first slash. Bad text raises, or gives NULL
    with ``strict=False``.
    """
    cut = F.instr(text, "/")
    high = F.when(cut > 0, F.substring(text, F.lit(1), cut - 1))
    low = F.when(cut > 0, F.substring(text, cut + 1, F.length(text)))
    valid = F.coalesce(high.rlike(_HALF) & low.rlike(_HALF), F.lit(False))
    # The high half keeps its low 32 bits; bits of the low half beyond 32 are
    # combined with it by OR.
    high16 = F.lpad(F.regexp_extract(high, _HALF, 1), 16, "0")
    low16 = F.lpad(F.regexp_extract(low, _HALF, 1), 16, "0")
    upper = _number(F.substring(high16, 9, 8)).bitwiseOR(_number(F.substring(low16, 1, 8)))
    lower = _number(F.substring(low16, 9, 8))
    value = (upper.cast(U64) * F.lit(2**32).cast("decimal(10,0)") + lower.cast(U64)).cast(U64)
    if not strict:
        return F.when(valid, value)
    message = F.concat(F.lit("invalid log position '"), text, F.lit("'"))
    return F.when(valid, value).when(text.isNotNull(), F.raise_error(message).cast(U64))


def parse_position(text: str) -> int:
    """Check and convert one log position given as an argument."""
    high, slash, low = text.partition("/")
    halves = [re.fullmatch(_HALF.removesuffix(r"\z"), half) for half in (high, low)]
    if not slash or not all(halves):
        raise ValueError(f"invalid log position {text!r}")
    upper, lower = (int(half[1], 16) for half in halves)
    return ((upper & 0xFFFFFFFF) << 32) | lower


def is_zero(position: Column) -> Column:
    return position == F.lit(0)


def server_time(micros: str) -> str:
    """SQL: microseconds since 2000-01-01 to TIMESTAMP; NULL beyond the 64-bit range."""
    return f"timestamp_micros(try_add({micros}, {SERVER_EPOCH_MICROS}L))"


def server_micros(timestamp: Column) -> Column:
    """TIMESTAMP to microseconds since 2000-01-01."""
    return F.unix_micros(timestamp) - F.lit(SERVER_EPOCH_MICROS).cast("bigint")
