"""Reading numbers and text out of BINARY columns.

The helpers return Spark SQL text, so a whole projection is one ``selectExpr``
call. All integers are big-endian and positions are 1-based, as in SQL.
``substring`` shortens silently past the end, so callers check lengths first.
"""

from __future__ import annotations

U64 = "decimal(20,0)"


def byte(data: str, pos) -> str:
    return f"substring({data}, {pos}, 1)"


def hex_of(data: str, start, length) -> str:
    return f"hex(substring({data}, {start}, {length}))"


def uint16(data: str, start) -> str:
    return f"cast(conv({hex_of(data, start, 2)}, 16, 10) AS int)"


def uint32(data: str, start) -> str:
    return f"cast(conv({hex_of(data, start, 4)}, 16, 10) AS bigint)"


def uint64(data: str, start) -> str:
    return f"cast(conv({hex_of(data, start, 8)}, 16, 10) AS {U64})"


def int64(data: str, start) -> str:
    return f"cast(conv({hex_of(data, start, 8)}, 16, -10) AS bigint)"


def int32(data: str, start) -> str:
    """Two's complement: the upper half of the unsigned range is negative."""
    return let(uint32(data, start), "u", f"cast(u - if(u >= {2**31}, {2**32}, 0) AS int)")


def lossy_text(data: str) -> str:
    """UTF-8 text; each invalid sequence becomes the replacement character."""
    return f"make_valid_utf8(cast({data} AS string))"


def strict_text(data: str) -> str:
    """UTF-8 text, or the empty text when any byte is invalid."""
    return f"if(is_valid_utf8(cast({data} AS string)), cast({data} AS string), '')"


def hex_text(data: str) -> str:
    return rf"concat('\\x', lower(hex({data})))"


def let(value: str, name: str, body: str) -> str:
    """Evaluate ``value`` once and use it as ``name`` inside ``body``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def tags(*chars: str) -> str:
    """Binary literals, comma separated."""
    return ", ".join(f"X'{ord(c):02X}'" for c in chars)
