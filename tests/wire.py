"""Test-side packing of frames and messages."""

import struct

SERVER = 759638400000000


def xlog(data: bytes, position: int = 100) -> bytes:
    return b"w" + struct.pack(">QQq", position, position, SERVER) + data


def alive(position: int, reply: int = 1) -> bytes:
    return b"k" + struct.pack(">Qq", position, SERVER) + bytes([reply])


def relation(rel_id, schema, table, names):
    out = b"R" + struct.pack(">I", rel_id) + schema + b"\0" + table + b"\0d" + struct.pack(">H", len(names))
    for name in names:
        out += b"\0" + name + b"\0" + struct.pack(">Ii", 25, -1)
    return out


def image(*cells):
    out = struct.pack(">H", len(cells))
    for cell in cells:
        if cell is None:
            out += b"n"
        elif cell is ...:
            out += b"u"
        else:
            out += b"t" + struct.pack(">I", len(cell)) + cell
    return out


def insert(rel_id, *cells):
    return b"I" + struct.pack(">I", rel_id) + b"N" + image(*cells)


def frames(spark, sessions):
    """``{session: [payload, ...]}`` to a frames table numbered from 1."""
    rows = [
        (session, number, bytearray(payload))
        for session, payloads in sessions.items()
        for number, payload in enumerate(payloads, 1)
    ]
    return spark.createDataFrame(rows, "session_id STRING, frame_no BIGINT, payload BINARY")
