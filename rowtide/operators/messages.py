"""Variable-length parts of rare messages (relation descriptions, truncates), and names of image columns.

A description is walked by an ``aggregate`` that carries a byte position. The position turns NULL as
soon as the message is found malformed and stays NULL. The functions return Spark SQL text. Row
images, of which there are many, are read a batch at a time in ``rowtide.operators.images``.
"""

from __future__ import annotations

from rowtide.constants import UNKNOWN_COLUMN
from rowtide.functions import binary as b
from rowtide.operators.images import VALUE

IMAGE = f"map<string,{VALUE}>"
COLUMNS = "array<struct<name:string,is_key:boolean,type_id:bigint,type_modifier:int>>"


def row_image(values: str, names: str) -> str:
    """Pair column values with column names.

    Columns beyond the known names are called ``?``. The last of several
    columns with one name stays.
    """
    padded = f"transform({values}, (v, i) -> coalesce(get({names}, i), '{UNKNOWN_COLUMN}'))"
    exact = f"{names} IS NOT NULL AND size({names}) = size({values})"
    return f"map_from_arrays(if({exact}, {names}, {padded}), {values})"


def decode_relation(data: str, base: int = 1) -> str:
    """``struct<schema, table, columns>`` of the relation message at ``base``, NULL if malformed."""
    size = f"octet_length({data})"

    # One character per byte, so a terminator is found by position.
    def terminator(start: str) -> str:
        return rf"nullif(locate('\u0000', decode({data}, 'ISO-8859-1'), {start}), 0)"

    def name(start: str, end: str) -> str:
        return b.strict_text(f"substring({data}, {start}, {end} - ({start}))")

    column = f"""named_struct('name', {name('acc.pos + 1', 'name_end')},
        'is_key', (cast(conv({b.hex_of(data, 'acc.pos', 1)}, 16, 10) AS int) & 1) = 1,
        'type_id', {b.uint32(data, 'name_end + 1')},
        'type_modifier', {b.int32(data, 'name_end + 5')})"""
    step = b.let(
        terminator("acc.pos + 1"),
        "name_end",
        f"""if(name_end + 8 <= {size},
              named_struct('pos', name_end + 9, 'columns', array_append(acc.columns, {column})),
              named_struct('pos', cast(NULL AS int), 'columns', acc.columns))""",
    )
    none = f"cast(array() AS {COLUMNS})"
    begin = f"named_struct('pos', table_end + 4, 'columns', {none})"
    fold = f"""CASE WHEN n = 0 THEN {begin}
        WHEN n > 0 THEN aggregate(sequence(1, n), {begin}, (acc, i) -> {step}) END"""
    result = f"""if(done.pos IS NULL, NULL, named_struct(
        'schema', {name(str(base + 5), 'schema_end')},
        'table', {name('schema_end + 1', 'table_end')},
        'columns', done.columns))"""
    count = f"if(table_end + 3 <= {size}, {b.uint16(data, 'table_end + 2')}, NULL)"
    rest = b.let(count, "n", b.let(fold, "done", result))
    tables = b.let(terminator("schema_end + 1"), "table_end", rest)
    return b.let(f"if({size} >= {base + 5}, {terminator(str(base + 5))}, NULL)", "schema_end", tables)


def decode_truncate(data: str, base: int = 1) -> str:
    """``struct<rel_ids, cascade, restart_seqs>`` of the truncate at ``base``, NULL if malformed."""
    size = f"octet_length({data})"
    options = f"cast(conv({b.hex_of(data, base + 5, 1)}, 16, 10) AS int)"
    ids = f"""if(n = 0, cast(array() AS array<bigint>),
        transform(sequence(0, cast(n AS int) - 1), i -> {b.uint32(data, f'i * 4 + {base + 6}')}))"""
    body = f"""if(n * 4 + {base + 5} <= {size}, named_struct('rel_ids', {ids},
        'cascade', ({options} & 1) <> 0, 'restart_seqs', ({options} & 2) <> 0), NULL)"""
    return b.let(f"if({size} >= {base + 5}, {b.uint32(data, base + 1)}, NULL)", "n", body)
