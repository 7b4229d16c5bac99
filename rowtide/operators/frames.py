"""Captured frames to classified messages: projections only, no shuffle.

``split_frames`` opens the copy-data envelope, ``classify`` names the message
inside it and reads the fields that sit at fixed offsets. Fields are read
straight from the payload, so the message bytes are never copied, and nothing
here walks a variable-length structure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions import binary as b
from rowtide.functions.lsn import lsn_text_at, server_time
from rowtide.functions.plan import settle

HEADER = 25  # bytes before the message in a data frame: tag, start, end, time
MESSAGE = HEADER + 1  # position of the message's first byte
KEEPALIVE_LENGTH = 18  # tag, end, time, reply flag
BEGIN_LENGTH = 21  # tag, position, time, transaction
COMMIT_LENGTH = 26  # tag, flags, position, end position, time
ROW_HEADER = 6  # tag, relation, flag

_WAL_END_AT = "CASE frame_kind WHEN 'data' THEN 10 WHEN 'keepalive' THEN 2 END"
_TIME_AT = "CASE frame_kind WHEN 'data' THEN 18 WHEN 'keepalive' THEN 10 END"
_ENVELOPE = [
    f"if(frame_kind = 'data', {b.uint64('payload', 2)}, NULL) AS wal_start",
    f"{b.uint64('payload', _WAL_END_AT)} AS wal_end",
    f"{server_time(b.int64('payload', _TIME_AT))} AS server_time",
    f"if(frame_kind = 'keepalive', {b.byte('payload', KEEPALIVE_LENGTH)} <> X'00', NULL) AS reply_requested",
]


def _enveloped(frames: DataFrame) -> DataFrame:
    """Add ``frame_kind``, or the reason a frame is unreadable."""
    return frames.selectExpr(
        "session_id",
        "frame_no",
        "payload",
        "coalesce(octet_length(payload), 0) AS size",
        f"{b.byte('payload', 1)} AS frame_tag",
    ).selectExpr(
        "session_id",
        "frame_no",
        "payload",
        "size",
        f"""CASE WHEN frame_tag = {b.tags('w')} AND size >= {HEADER} THEN 'data'
                 WHEN frame_tag = {b.tags('k')} AND size >= {KEEPALIVE_LENGTH} THEN 'keepalive' END AS frame_kind""",
        f"""CASE WHEN size = 0 THEN 'empty frame'
                 WHEN frame_tag = {b.tags('w')} AND size < {HEADER}
                 THEN concat('data frame too short: ', size - 1, ' bytes')
                 WHEN frame_tag = {b.tags('k')} AND size < {KEEPALIVE_LENGTH}
                 THEN concat('keepalive frame too short: ', size - 1, ' bytes')
                 WHEN frame_tag NOT IN ({b.tags('w', 'k')})
                 THEN concat('unknown frame kind 0x', lower(hex(frame_tag))) END AS frame_error""",
    )


def split_frames(frames: DataFrame) -> DataFrame:
    """``frames(session_id, frame_no, payload)`` to envelopes and message bytes.

    A frame that is empty, of an unknown kind or shorter than its envelope
    gets ``error_class = 'fatal'``: its session cannot go on after it.
    """
    return _enveloped(frames).selectExpr(
        "session_id",
        "frame_no",
        "coalesce(frame_kind, 'error') AS frame_kind",
        *_ENVELOPE,
        f"if(frame_kind = 'data', substring(payload, {MESSAGE}, size - {HEADER}), NULL) AS data",
        "if(frame_error IS NULL, NULL, 'fatal') AS error_class",
        "frame_error AS error",
    )


# First byte of each message type.
MESSAGE_KINDS = {
    "I": "insert",
    "U": "update",
    "D": "delete",
    "B": "begin",
    "C": "commit",
    "R": "relation",
    "T": "truncate",
    "O": "skipped",
    "Y": "skipped",
    "M": "skipped",
}
_KIND = "CASE tag " + " ".join(f"WHEN {b.tags(t)} THEN '{kind}'" for t, kind in MESSAGE_KINDS.items()) + " END"
# Fewest bytes of a message whose fixed fields are read.
_NEEDED = f"""CASE WHEN kind = 'begin' THEN {BEGIN_LENGTH} WHEN kind = 'commit' THEN {COMMIT_LENGTH}
    WHEN kind = 'skipped' THEN 1 ELSE {ROW_HEADER} END"""


def _at(begin: int | None, commit: int) -> str:
    """Where a field starts in a begin or commit; NULL where there is none."""
    first = "" if begin is None else f"WHEN whole = 'begin' THEN {HEADER + begin} "
    return f"CASE {first}WHEN whole = 'commit' THEN {HEADER + commit} END"


def classify(frames: DataFrame) -> DataFrame:
    """Add ``kind`` and the fixed-offset fields of each message.

    ``kind`` names what the message claims to be and depends on its first
    byte only. A transaction boundary cut short is fatal; a row message cut
    short, an unknown tag or an empty message is a record error.
    """
    classed = (
        _enveloped(frames)
        .selectExpr("*", f"if(frame_kind = 'data', {b.byte('payload', MESSAGE)}, NULL) AS tag")
        .selectExpr("*", f"if(frame_kind = 'keepalive', 'keepalive', coalesce({_KIND}, 'error')) AS kind")
        .selectExpr(
            "*",
            f"""CASE WHEN frame_kind = 'keepalive' THEN NULL
                     WHEN frame_error IS NOT NULL THEN 'fatal'
                     WHEN kind IN ('begin', 'commit') AND size - {HEADER} < {_NEEDED} THEN 'fatal'
                     WHEN kind = 'error' OR size - {HEADER} < {_NEEDED} THEN 'record' END AS error_class""",
        )
        # What may be read: NULL for every kind of error.
        .selectExpr("*", "if(error_class IS NULL, kind, NULL) AS whole")
    )
    # A filter on a field below is not copied down into what the fields are read by.
    return (
        settle(classed, "frame_kind", "tag", "kind", "error_class", "whole")
        .selectExpr(
            "session_id",
            "frame_no",
            *_ENVELOPE,
            "payload",
            "size",
            "kind",
            f"""if(whole IN ('insert', 'update', 'delete', 'relation'),
                   {b.uint32('payload', HEADER + 2)}, NULL) AS rel_id""",
            f"{lsn_text_at('payload', _at(2, 3))} AS lsn",
            f"{lsn_text_at('payload', _at(None, 11))} AS end_lsn",
            f"{b.int64('payload', _at(10, 19))} AS commit_time",
            f"if(whole = 'begin', {b.uint32('payload', HEADER + 18)}, NULL) AS xid",
            # Position the event is known by: a begin carries the transaction's
            # final position, a commit its end, a row the end of its frame.
            f"{b.uint64('payload', f'coalesce({_at(2, 11)}, {_WAL_END_AT})')} AS position",
            "error_class",
            """CASE WHEN error_class IS NULL THEN NULL
                    WHEN frame_error IS NOT NULL THEN frame_error
                    WHEN error_class = 'fatal' THEN 'transaction boundary cut short'
                    WHEN tag = X'' THEN 'empty message'
                    WHEN kind = 'error' THEN concat('unknown message type 0x', hex(tag))
                    ELSE 'message cut short' END AS error""",
        )
    )


def is_described() -> Column:
    """Relation descriptions and truncates, told from two bytes."""
    return F.expr(
        f"""coalesce({b.byte('payload', 1)} = {b.tags('w')}
            AND {b.byte('payload', MESSAGE)} IN ({b.tags('R', 'T')}), false)"""
    )


def is_fatal() -> Column:
    """Frames that end their session; agrees with ``classify``."""
    size, inner = "octet_length(payload)", b.byte("payload", MESSAGE)
    return F.expr(
        f"""CASE WHEN {b.byte('payload', 1)} = {b.tags('w')} THEN {size} < {HEADER}
                OR ({inner} = {b.tags('B')} AND {size} < {HEADER + BEGIN_LENGTH})
                OR ({inner} = {b.tags('C')} AND {size} < {HEADER + COMMIT_LENGTH})
            WHEN {b.byte('payload', 1)} = {b.tags('k')} THEN {size} < {KEEPALIVE_LENGTH}
            ELSE true END"""
    )
