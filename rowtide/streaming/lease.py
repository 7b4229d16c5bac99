"""One driver per consumer: a lease on shared storage with a number that only grows.

Taking a lease creates the file of the next number, which storage lets one driver do. Its holder renews it while its
query runs. A driver whose lease went stale and was taken by another finds a higher number and must not write.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from rowtide.storage import Storage

OWNER = uuid.uuid4().hex  # this driver
SECONDS = 60.0  # a lease not renewed for so long may be taken


class LeaseLost(RuntimeError):
    """Another driver has taken the consumer."""


def _folder(root: str, name: str) -> str:
    return f"{root}/lease/consumer={name}"


def _last(storage: Storage, folder: str) -> int:
    """The number of the newest lease; 0 where there was none."""
    return max((int(n[: -len(".lease")]) for n in storage.names(folder) if n.endswith(".lease")), default=0)


def holder(spark: SparkSession, root: str, name: str, seconds: float = SECONDS) -> str | None:
    """The driver that holds a consumer's lease; None where it is free, given back or stale."""
    storage, folder = Storage(spark, root), _folder(root, name)
    number = _last(storage, folder)
    if not number or storage.exists(f"{folder}/{number}.released"):
        return None
    beat = f"{folder}/{number}.beat"
    owner = storage.read(beat) if storage.exists(beat) else "unknown"
    # Both times are the storage's own, so drivers need no common clock.
    probe = f"{folder}/{uuid.uuid4().hex}.probe"
    storage.write(probe, "")
    age = storage.modified(probe) - storage.modified(beat if owner != "unknown" else f"{folder}/{number}.lease")
    storage.remove(probe)
    return owner if age < seconds * 1000 else None


def held_names(spark: SparkSession, root: str) -> list[str]:
    """Consumers under ``root`` that some driver holds."""
    mark = "consumer="
    names = [n[len(mark) :] for n in Storage(spark, root).names(f"{root}/lease") if n.startswith(mark)]
    return [name for name in names if holder(spark, root, name)]


class Lease:
    """A taken lease. ``check`` before every write that others read."""

    def __init__(self, spark: SparkSession, root: str, name: str, seconds: float = SECONDS) -> None:
        self._storage, self._folder, self._name = Storage(spark, root), _folder(root, name), name
        self._seconds, self._ended = seconds, threading.Event()
        by = holder(spark, root, name, seconds)
        if by not in (None, OWNER):
            raise RuntimeError(f"consumer {name!r} is in use by another driver")
        self.number = _last(self._storage, self._folder) + 1
        if not self._storage.create(f"{self._folder}/{self.number}.lease"):
            raise RuntimeError(f"consumer {name!r} was just taken by another driver")
        self.renew()
        for old in self._storage.names(self._folder):
            number = old.split(".")[0]
            if number.isdigit() and int(number) < self.number:
                self._storage.remove(f"{self._folder}/{old}")

    def renew(self) -> None:
        self._storage.write(f"{self._folder}/{self.number}.beat", OWNER)

    def check(self) -> None:
        if _last(self._storage, self._folder) != self.number:
            raise LeaseLost(f"consumer {self._name!r} was taken over by another driver")

    def keep(self) -> None:
        """Renew in the background until the release, also through long micro-batches."""

        def beat() -> None:
            while not self._ended.wait(self._seconds / 3):
                self.renew()

        threading.Thread(target=beat, daemon=True, name=f"lease-{self._name}").start()

    def release(self) -> None:
        self._ended.set()
        self._storage.write(f"{self._folder}/{self.number}.released", OWNER)


class _AtEnd(StreamingQueryListener):
    """Runs an action once when a query has ended, by itself, by ``stop`` or by a failure."""

    def __init__(self, spark: SparkSession, action: Callable[[], None]) -> None:
        self._spark, self._action, self._lock = spark, action, threading.Lock()
        self.run_id: str | None = None

    def run(self) -> None:
        with self._lock:
            action, self._action = self._action, None
        if action:
            action()
            self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.run()


def run_at_end(spark: SparkSession, start: Callable[[], StreamingQuery], action: Callable[[], None]) -> StreamingQuery:
    """Start a query and run ``action`` when it has ended, also where it cannot be started."""
    listener = _AtEnd(spark, action)
    spark.streams.addListener(listener)
    try:
        query = start()
    except BaseException:
        listener.run()
        raise
    listener.run_id = str(query.runId)
    if not query.isActive:  # it ended before its id was known here
        listener.run()
    return query
