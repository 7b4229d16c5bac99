"""Notifications as a stream: subscribe, route, write or deliver at most once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowtide.operators import routing
from rowtide.sources.notify import subscribe
from rowtide.storage import Storage
from rowtide.streaming.changes import start_query
from rowtide.streaming.deliver import Deliver, deliver_slices, sliced_notifications
from rowtide.streaming.journal import Journal
from rowtide.streaming.progress import Consumer


@dataclass
class NotifyStream:
    """Which channels to forward and where to."""

    consumer: Consumer
    channels: Sequence[str]
    sink: str
    mode: str = "simple"
    options: Mapping[str, object] = field(default_factory=dict)
    deliver: Deliver | None = None

    def __post_init__(self) -> None:
        if self.sink not in routing.ROUTES:
            raise ValueError(f"unknown sink {self.sink!r}")
        if self.mode not in routing.MODES:
            raise ValueError(f"unknown mode {self.mode!r}")

    def address(self, notify: DataFrame) -> DataFrame:
        return routing.ROUTES[self.sink](subscribe(notify, self.channels), mode=self.mode, **self.options)


def process_batch(
    stream: NotifyStream, batch: DataFrame, batch_id: int, fence: Callable[[], None] | None = None
) -> None:
    """Write or send one micro-batch.

    What is sent is first stored in slices, which tasks claim before their first message: neither a task run again nor
    a replayed batch sends one twice. ``fence`` raises where this driver may no longer write.
    """
    rows = stream.address(batch)
    fence = fence or (lambda: None)
    folder = stream.consumer.batch_folder("outbox", batch_id)
    fence()
    if stream.deliver is None:
        rows.write.mode("overwrite").parquet(folder)
        return
    spark = batch.sparkSession
    journal = Journal(stream.consumer.batch_folder("journal", batch_id))
    storage, stored = Storage(spark, stream.consumer.root), f"{journal.folder}/stored"
    if not storage.exists(stored):  # no slice was claimed yet: the slices may still change
        named = rows.withColumn("session_id", F.col("channel"))
        sliced_notifications(named).write.mode("overwrite").parquet(folder)
        storage.write(stored, "")
    logged = deliver_slices(spark.read.parquet(folder), stream.deliver, journal)
    logged.write.mode("overwrite").parquet(stream.consumer.batch_folder("delivery_log", batch_id))


def start(
    notify: DataFrame, stream: NotifyStream, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    def handle(batch: DataFrame, batch_id: int, fence: Callable[[], None]) -> None:
        process_batch(stream, batch, batch_id, fence)

    return start_query(notify, stream.consumer, handle, trigger)
