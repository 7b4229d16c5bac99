"""Handing outbox rows to a caller's ``deliver`` function, in order.

``deliver(message: dict)`` returns when the message is accepted and raises when
it is not. It runs in the tasks; each outcome becomes a row of the delivery log.
With a journal it is also written down at once, for an attempt that follows a lost one.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal
from itertools import repeat

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, MapType, StructField, StructType

from rowtide.streaming import journal as journals
from rowtide.streaming.journal import Journal
from rowtide.streaming.progress import LOG_SCHEMA

# Executors need pandas and pyarrow, not this package: its functions travel with the plan.
cloudpickle.register_pickle_by_value(journals)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Deliver = Callable[[dict], None]
NOT_SENT = "not sent: an earlier message of the lane failed"
CUT_SHORT = "not sent again: an earlier attempt ended before its outcome was known"
LOG_COLUMNS = ["session_id", "frame_no", "sink", "ok", "error"]
LOG_TYPES = ["string", "bigint", "string", "boolean", "string"]
_LOG_ARROW = pa.schema(list(zip(LOG_COLUMNS, [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string()])))

# Messages are packed by ranges of frame numbers, in slices of at most so many rows and bytes.
SLICE_FRAMES = 1 << 20
SLICE_ROWS = 2_000
SLICE_BYTES = 4 << 20
# What the log of a message that is not sent is made of: a slice has it apart.
OUTCOME_COLUMNS = ("session_id", "frame_no", "sink")
_ABSENT = "_absent_"  # name of the column that tells where another is NULL


def journaled(spark: SparkSession, journal: Journal) -> DataFrame:
    """All outcomes in a journal, with the columns of the delivery log."""
    try:
        lines = spark.read.option("pathGlobFilter", "*.outcomes").text(journal.folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)
    fields = lines.select(F.from_json("value", "array<string>").alias("f")).filter(F.size("f") == len(LOG_COLUMNS))
    typed = [F.col("f")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(zip(LOG_COLUMNS, LOG_TYPES))]
    return fields.select(*typed)


class DeliveryFailed(RuntimeError):
    """Some messages of a micro-batch were not accepted."""


class Lanes:
    """What one task has sent: stopped lanes, and messages an earlier attempt had accepted."""

    def __init__(self, deliver: Deliver, stop_on_error: bool, journal: Journal | None, name: str) -> None:
        self._deliver = deliver
        self._stop = stop_on_error
        self._stopped: dict = {}  # lane: its session
        # Messages of this task's earlier attempts only: bounded by its part of the micro-batch.
        self._accepted = {(s, n) for s, n, _sink, ok, _error in journal.read(name) if ok} if journal else set()
        self._outcomes = journal.write(name) if journal else None

    def send(self, message: dict, lane, held: bool = False) -> tuple:
        session, number, sink = message.get("session_id"), int(message["frame_no"]), message["sink"]
        if self._accepted and (session, number) in self._accepted:
            return session, number, sink, True, None
        if held or lane in self._stopped:
            return session, number, sink, False, NOT_SENT
        error = None
        try:
            self._deliver(message)
        except Exception as failure:  # the log takes any failure
            error = str(failure) or type(failure).__name__
            if self._stop:
                self._stopped[lane] = session
        outcome = (session, number, sink, error is None, error)
        if self._outcomes:
            self._outcomes.add(*outcome)
        return outcome

    def send_slice(self, data: bytes, lane, held: bool = False) -> pa.RecordBatch:
        """Send a slice of a lane; its rows of the delivery log. What is held as a whole is not unpacked."""
        if not self._accepted and (held or lane in self._stopped):
            return _logged(data, False, NOT_SENT)
        oks, errors = [], []
        for message in unpacked(data):
            _session, _number, _sink, ok, error = self.send(message, lane, held)
            oks.append(ok)
            errors.append(error)
        return _logged(data, oks, errors)

    def newly_failed(self) -> set:
        """Sessions of the lanes stopped since the last call; from then on the caller holds them."""
        sessions = set(self._stopped.values())
        self._stopped.clear()
        return sessions

    def close(self) -> None:
        if self._outcomes:
            self._outcomes.close()


def _values(column: pa.Array) -> list:
    """Values of a column; equal texts are one object, so a slice holds them once."""
    if column.null_count == len(column):
        return [None] * len(column)
    if pa.types.is_map(column.type):
        keys, items = _values(column.keys), _values(column.items)
        bounds = column.offsets.to_pylist()
        known = column.is_valid().to_pylist()
        pairs = zip(known, bounds, bounds[1:])
        return [dict(zip(keys[a:b], items[a:b])) if valid else None for valid, a, b in pairs]
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        return column.to_pandas().tolist()
    if pa.types.is_integer(column.type) and not column.null_count:
        return column.to_numpy().tolist()
    if pa.types.is_boolean(column.type) and not column.null_count:
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


def _whole(column: pa.Array) -> list[int]:
    """Decimals without fraction as whole numbers."""
    try:
        return column.cast(pa.int64()).to_numpy().tolist()
    except pa.ArrowInvalid:  # beyond 63 bits
        return [int(value) for value in column.to_pylist()]


def _is_whole(kind: pa.DataType) -> bool:
    return pa.types.is_decimal(kind) and not kind.scale


def _sliced(column: list, kind: pa.DataType, begin: int, end: int) -> tuple[str, object]:
    """How a slice keeps a column: a value all rows share once, decimals as whole numbers, else a list."""
    values = column[begin:end]
    if pa.types.is_nested(kind) and any(value is not None for value in values):
        return "list", values  # values may be changed by who takes them, so each row has its own
    if not _is_whole(kind) and values.count(values[0]) == len(values):
        return "same", values[0]
    return "whole" if _is_whole(kind) and None not in values else "list", values


def _opened(rows: int, how: str, kept) -> Iterator | list:
    if how == "same":
        return repeat(kept, rows)
    return map(Decimal, kept) if how == "whole" else kept


def _compressed(part: object) -> bytes:
    data = pickle.dumps(part, protocol=5)
    body = pa.compress(data, codec="zstd", asbytes=True)
    return len(data).to_bytes(8, "big") + len(body).to_bytes(8, "big") + body


def _part(data: bytes, at: int) -> tuple[object, int]:
    """The part of a slice that begins at ``at``, and where it ends."""
    size, end = int.from_bytes(data[at : at + 8], "big"), at + 16 + int.from_bytes(data[at + 8 : at + 16], "big")
    return pickle.loads(pa.decompress(data[at + 16 : end], size, codec="zstd", asbytes=True)), end


def _packed(names: list[str], kinds: list, columns: list[list], begin: int, end: int) -> Iterator[tuple[int, int, bytes]]:
    """``(first frame, last frame, slice)`` of rows in frame order."""
    rows = end - begin
    parts = -(-rows // SLICE_ROWS)
    if parts == 1:
        kept = {name: _sliced(column, kind, begin, end) for name, kind, column in zip(names, kinds, columns)}
        head = {name: kept.get(name, ("same", None)) for name in OUTCOME_COLUMNS}
        body = _compressed([(name, None if name in head else kept[name]) for name in names])
        if int.from_bytes(body[:8], "big") <= SLICE_BYTES or rows == 1:
            numbers = columns[names.index("frame_no")]
            yield numbers[begin], numbers[end - 1], _compressed((rows, head)) + body
            return
        parts = 2
    bounds = [begin + rows * k // parts for k in range(parts + 1)]
    for first, last in zip(bounds, bounds[1:]):
        yield from _packed(names, kinds, columns, first, last)


def unpacked(data: bytes) -> list[dict]:
    """The messages of a slice as ``deliver`` takes them; maps are dicts."""
    (rows, head), end = _part(data, 0)
    body, _ = _part(data, end)
    columns = [(name, *(kept or head[name])) for name, kept in body]
    shared = {name: kept if how == "same" else None for name, how, kept in columns}
    messages = [shared.copy() for _ in range(rows)]
    for name, how, kept in columns:
        if how != "same":
            for message, value in zip(messages, _opened(rows, how, kept)):
                message[name] = value
    return messages


def _logged(data: bytes, ok: list[bool] | bool, errors: list[str | None] | str) -> pa.RecordBatch:
    """Outcomes of a slice's messages as rows of the delivery log; one for all, or one of each."""
    (rows, head), _ = _part(data, 0)
    columns = [_opened(rows, *head[name]) for name in OUTCOME_COLUMNS]
    columns += [repeat(one, rows) if isinstance(one, (bool, str)) else one for one in (ok, errors)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type, size=rows) for c, f in zip(columns, _LOG_ARROW)], schema=_LOG_ARROW)


def _present(batch: pa.RecordBatch, name: str) -> list:
    """Values of a column, those marked absent as None."""
    column = batch.column(name)
    if f"{_ABSENT}{name}" not in batch.schema.names:
        return _whole(column) if _is_whole(column.type) and not column.null_count else _values(column)
    absent = _values(batch.column(f"{_ABSENT}{name}"))
    if all(absent):
        return [None] * len(absent)
    return [None if gone else value for gone, value in zip(absent, _values(column))]


def _packer(keys: Sequence[str], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names = [n for n in batch.schema.names if n != "_range" and not n.startswith(_ABSENT)]
            kinds = [batch.schema.field(name).type for name in names]
            read = {name: _present(batch, name) for name in names}
            columns, ranges = list(read.values()), _values(batch.column("_range"))
            places = [*zip(*(read[k] for k in keys), ranges)]
            cuts = [0, *(i for i, (a, b) in enumerate(zip(places, places[1:]), 1) if a != b), len(places)]
            rows = []
            for begin, end in zip(cuts, cuts[1:]):
                rows += [(*places[begin][:-1], *part) for part in _packed(names, kinds, columns, begin, end)]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in rows], schema=schema)

    return pack


def _with_marks(outbox: DataFrame) -> DataFrame:
    """Maps and arrays without NULL, and columns that tell which were.

    Spark measures an Arrow batch after every row it adds, and goes through all NULL lists since the last other one each time.
    """
    nested = {f.name: f.dataType for f in outbox.schema if isinstance(f.dataType, (ArrayType, MapType))}
    empty = {name: (F.create_map() if isinstance(kind, MapType) else F.array()).cast(kind) for name, kind in nested.items()}
    marks = {f"{_ABSENT}{name}": F.col(name).isNull() for name in nested}
    return outbox.withColumns(marks | {name: F.coalesce(name, none) for name, none in empty.items()}) if nested else outbox


def pack_lanes(outbox: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, _first, _last, _slice)``: the messages of each key in frame order, compressed, many to a row.

    Rows become messages here, over all tasks, so the one task that sends a lane only takes slices in order: it neither
    sorts nor converts rows, and holds some ten bytes of a message until its turn.
    """
    ranged = _with_marks(outbox).withColumn("_range", F.floor(F.col("frame_no") / SLICE_FRAMES))
    ordered = ranged.repartition(*keys, "_range").sortWithinPartitions(*keys, "_range", "frame_no")
    added = [StructField("_first", LongType()), StructField("_last", LongType()), StructField("_slice", BinaryType())]
    schema = StructType([*[StructField(k, outbox.schema[k].dataType) for k in keys], *added])
    return ordered.mapInArrow(_packer(keys, to_arrow_schema(schema)), schema)


def _lane_sender(
    deliver: Deliver, stop_on_error: bool, lanes: Sequence[str], journal: Journal | None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Lanes(deliver, stop_on_error, journal, f"task-{TaskContext.get().partitionId()}")
        try:
            for batch in batches:
                places = [batch.column(name) for name in lanes]
                for i, data in enumerate(batch.column("_slice")):
                    lane = tuple(place[i].as_py() for place in places)
                    yield sent.send_slice(data.as_py(), lane)
        finally:
            sent.close()

    return send


def _sender(deliver: Deliver) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent = Lanes(deliver, False, None, "")
        for batch in batches:
            outcome = [sent.send(message, message.get("session_id")) for message in batch.to_dict("records")]
            yield pd.DataFrame(outcome, columns=LOG_COLUMNS)

    return send


def deliver_changes(
    outbox: DataFrame,
    deliver: Deliver,
    stop_on_error: bool = True,
    lanes: Sequence[str] = ("session_id",),
    journal: Journal | None = None,
) -> DataFrame:
    """Send change messages; lanes in parallel, each in frame order.

    Order is kept inside a lane, and a failure stops its lane only. Messages are made and
    packed over all tasks (``pack_lanes``) and stream through the task that owns their lane slice by
    slice; how many there are is bounded by the size of the micro-batch. ``lanes=('session_id',
    'msg_key')`` keeps order per Kafka key only; ``rowtide.streaming.epochs`` spreads a busy
    session over all tasks, for any sink. A task that Spark runs again sends what ``journal`` does not name
    as accepted; without one it sends its lanes again.
    """
    packed = pack_lanes(outbox, list(dict.fromkeys(["session_id", *lanes])))
    if journal:  # the number of parts is then fixed: a lane stays in the part its earlier attempts wrote under
        parts = int(outbox.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spread = packed.repartition(parts, *lanes)
    else:
        spread = packed.repartition(*lanes)
    ordered = spread.sortWithinPartitions("session_id", "_first", "_last")
    return ordered.mapInArrow(_lane_sender(deliver, stop_on_error, tuple(lanes), journal), LOG_SCHEMA)


def sliced_notifications(outbox: DataFrame) -> DataFrame:
    """Notifications with ``slice``: contiguous parts of the message order, sent and claimed as a whole."""
    ordered = outbox.repartitionByRange("frame_no").sortWithinPartitions("frame_no")
    return ordered.withColumn("slice", F.spark_partition_id())


def _slice_sender(deliver: Deliver, journal: Journal) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, lanes, known = None, None, {}
        try:
            for batch in batches:
                outcome = []
                for message in batch.to_dict("records"):
                    part = message.pop("slice")
                    if part != current:
                        if lanes:
                            lanes.close()
                        current, lanes, known = part, None, {}
                        name = f"slice-{part}"
                        if journal.claim(name):
                            lanes = Lanes(deliver, False, journal, name)
                        else:  # bounded by the slice
                            known = {(line[0], line[1]): line for line in journal.read(name)}
                    if lanes:
                        outcome.append(lanes.send(message, part))
                    else:
                        key = message["session_id"], int(message["frame_no"])
                        outcome.append(known.get(key, (*key, message["sink"], False, CUT_SHORT)))
                yield pd.DataFrame(outcome, columns=LOG_COLUMNS)
        finally:
            if lanes:
                lanes.close()

    return send


def deliver_slices(stored: DataFrame, deliver: Deliver, journal: Journal) -> DataFrame:
    """Send stored ``sliced_notifications`` at most once each; a failed one is logged and dropped.

    A slice belongs to the attempt that claims it before its first message. Any other attempt - of a task run again,
    a speculative copy, a replayed batch - sends nothing of it and logs the outcomes found in the journal.
    """
    ordered = stored.repartition("slice").sortWithinPartitions("slice", "frame_no")
    return ordered.mapInPandas(_slice_sender(deliver, journal), LOG_SCHEMA)


def deliver_notifications(outbox: DataFrame, deliver: Deliver) -> DataFrame:
    """Send notifications without a journal: once each unless Spark runs a task again."""
    ordered = outbox.repartitionByRange("frame_no").sortWithinPartitions("frame_no")
    return ordered.mapInPandas(_sender(deliver), LOG_SCHEMA)
