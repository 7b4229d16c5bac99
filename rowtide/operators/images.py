"""Row images of many messages at once.

A batch of messages is one run of bytes with offsets. The walk takes the first cell of every image, then the
second of those that have one, and so on: one vector of positions per column place, however many
rows there are. What it finds - kind, place and length of each cell - is turned into Arrow arrays in a few
passes over the batch, never cell by cell.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Executors need numpy and pyarrow, not this package: its functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VALUE = "struct<state:string,value:string>"
CELLS = f"struct<malformed:boolean,first:array<{VALUE}>,second:array<{VALUE}>>"

# Kinds of cells.
TEXT, BINARY, NULL, UNCHANGED = (ord(c) for c in "tbnu")
# Where the first image of a row message starts: behind envelope, tag, relation and flag.
IMAGE_AT = 31
_HEX = np.frombuffer("".join(f"{byte:02x}" for byte in range(256)).encode(), np.uint8).reshape(256, 2)
_CELL = pa.struct([("state", pa.string()), ("value", pa.string())])
_ROW = pa.struct([("malformed", pa.bool_()), ("first", pa.list_(_CELL)), ("second", pa.list_(_CELL))])


@dataclass
class Walk:
    """Where images end (-1: malformed) and, row by row, their cells; rows without image have none."""

    end: np.ndarray
    counts: np.ndarray
    kinds: np.ndarray | None = None
    starts: np.ndarray | None = None
    sizes: np.ndarray | None = None


def _bytes_of(payloads: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array, and where each value starts and ends."""
    wide = pa.types.is_large_binary(payloads.type)
    _, offsets, data = payloads.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32, len(payloads) + 1 + payloads.offset)
    # Four bytes more, so that reading a number never leaves the array.
    read = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return np.concatenate([read, np.zeros(5, np.uint8)]), bounds[payloads.offset :].astype(np.int64)


def _number(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    value = np.zeros(len(at), np.int64)
    for k in range(width):
        value = value << 8 | data[at + k]
    return value


def walk(data: np.ndarray, start: np.ndarray, stop: np.ndarray, present: np.ndarray, collect: bool) -> Walk:
    """Follow the images at ``start`` of the rows that are ``present``; bytes behind an image are ignored.

    An image is malformed when it ends early or has a cell of unknown kind.
    """
    headed = present & (start + 2 <= stop)
    counts = np.where(headed, _number(data, np.where(headed, start, 0), 2), 0)
    # Every cell takes a byte: a count beyond that is malformed, and costs no room here.
    fits = headed & (start + 2 + counts <= stop)
    counts = np.where(fits, counts, 0)
    end = np.where(fits, start + 2, -1)
    before = np.concatenate([[0], np.cumsum(counts)])
    found = Walk(end, counts)
    if collect:
        found.kinds, found.starts, found.sizes = (np.zeros(before[-1], t) for t in (np.uint8, np.int64, np.int64))
    rows, place = np.flatnonzero(counts), 0
    while len(rows):
        at, limit = end[rows], stop[rows]
        inside = at < limit
        kind = np.where(inside, data[np.where(inside, at, 0)], 0)
        sized = ((kind == TEXT) | (kind == BINARY)) & (at + 5 <= limit)
        size = np.where(sized, _number(data, np.where(sized, at + 1, 0), 4), 0)
        bare = (kind == NULL) | (kind == UNCHANGED)
        after = np.where(sized, at + 5 + size, np.where(bare, at + 1, -1))
        good = (after >= 0) & (after <= limit)
        end[rows] = np.where(good, after, -1)
        if collect:
            slots = before[rows] + place
            found.kinds[slots], found.starts[slots], found.sizes[slots] = kind, at + 5, size
        place += 1
        rows = rows[good & (counts[rows] > place)]
    return found


def _gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of all pieces in a row."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


def _texts(data: np.ndarray, kinds: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Text of sent cells, hexadecimal for binary ones, null for the rest; invalid UTF-8 is replaced."""
    binary = kinds == BINARY
    sent = (kinds == TEXT) | binary
    sizes = np.where(sent, sizes, 0)
    if binary.any():
        read = _gathered(data, starts, sizes)
        wide = np.where(binary, 2 * sizes + 2, sizes)
        ends = np.cumsum(wide)
        out = np.empty(int(ends[-1]), np.uint8)
        from_binary = np.repeat(binary, sizes)
        # Place of every read byte: as it is, or as two digits behind the mark.
        into = np.arange(len(read)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        into = np.repeat(ends - wide, sizes) + np.where(from_binary, 2 * into + 2, into)
        out[into[~from_binary]] = read[~from_binary]
        for digit in (0, 1):
            out[into[from_binary] + digit] = _HEX[read[from_binary], digit]
        for k, mark in enumerate(b"\\x"):
            out[(ends - wide)[binary] + k] = mark
    else:
        out, wide = _gathered(data, starts, sizes), sizes
    bounds = np.concatenate([[0], np.cumsum(wide)])
    # Beyond 2 GB of text in a batch the offsets are wide; Spark reads both kinds.
    large = bounds[-1] >= 2**31
    valid = pa.py_buffer(np.packbits(sent, bitorder="little").tobytes())
    offsets = pa.py_buffer(bounds.astype(np.int64 if large else np.int32))
    kind = pa.large_binary() if large else pa.binary()
    cells = pa.Array.from_buffers(kind, len(kinds), [valid, offsets, pa.py_buffer(out)])
    try:
        texts = cells.view(pa.large_string() if large else pa.string())
        texts.validate(full=True)
    except pa.ArrowInvalid:
        texts = pa.array([None if c is None else c.decode("utf-8", "replace") for c in cells.to_pylist()], pa.string())
    return texts.cast(pa.string())


def _cells(data: np.ndarray, found: Walk, valid: np.ndarray) -> pa.Array:
    """The cells of the valid rows as lists, null for other rows."""
    counts = np.where(valid, found.counts, 0)
    kept = np.repeat(valid, found.counts)
    kinds = found.kinds[kept]
    states = np.where(kinds == BINARY, np.uint8(TEXT), kinds)
    letters = [None, pa.py_buffer(np.arange(len(states) + 1, dtype=np.int32)), pa.py_buffer(states)]
    state = pa.Array.from_buffers(pa.string(), len(states), letters)
    cells = pa.StructArray.from_arrays(
        [state, _texts(data, kinds, found.starts[kept], found.sizes[kept])], fields=list(_CELL)
    )
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    mask = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.list_(_CELL), len(valid), [mask, pa.py_buffer(bounds)], children=[cells])


def _walks(payloads: pa.Array, images: pa.Array, collect: bool) -> tuple[np.ndarray, np.ndarray, Walk, Walk]:
    """``images`` per row: how many the message should hold, 0 where none is read."""
    data, bounds = _bytes_of(payloads)
    wanted = images.fill_null(0).to_numpy(zero_copy_only=False)
    start, stop = bounds[:-1], bounds[1:]
    first = walk(data, start + IMAGE_AT, stop, wanted > 0, collect)
    # One byte separates the two images of an update.
    second = walk(data, first.end + 1, stop, (wanted > 1) & (first.end >= 0), collect)
    good = ((wanted < 1) | (first.end >= 0)) & ((wanted < 2) | (second.end >= 0))
    return data, good, first, second


def _read(payload: pa.Array, images: pa.Array, build: pa.Array = None) -> pa.Array:
    """``build`` per row: whether its cells are wanted; without it, of all rows."""
    data, good, first, second = _walks(payload, images, collect=True)
    wanted = images.fill_null(0).to_numpy(zero_copy_only=False)
    built = good if build is None else good & build.fill_null(False).to_numpy(zero_copy_only=False)
    columns = [
        pa.array(~good),
        _cells(data, first, built & (wanted > 0)),
        _cells(data, second, built & (wanted > 1)),
    ]
    return pa.StructArray.from_arrays(columns, fields=list(_ROW))


def _malformed(payload: pa.Array, images: pa.Array) -> pa.Array:
    _, good, _, _ = _walks(payload, images, collect=False)
    return pa.array(~good)


def read_images(payload: Column, images: Column, build: Column | None = None) -> Column:
    """``CELLS``: the cells of the first and second image of each message; both null where either is malformed.

    Where ``build`` is not true the images are checked only, and null.
    """
    return F.arrow_udf(_read, CELLS)(payload, images, F.lit(True) if build is None else build)


def images_malformed(payload: Column, images: Column) -> Column:
    """Whether an image is malformed, from lengths alone: no cell is kept."""
    return F.arrow_udf(_malformed, "boolean")(payload, images)


def is_unchanged(value: Column) -> Column:
    return value["state"] == "u"


def text_of(value: Column) -> Column:
    """The text of a sent, non-null column; NULL for the two other states."""
    return F.when(value["state"] == "t", value["value"])
