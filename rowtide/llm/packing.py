"""Best-fit-decreasing packing of token sequences, exact over all documents.

Only lengths decide where a document goes, and there are at most ``capacity`` of them. So each task
counts its pieces by length; the plan is made from those counts (at most ``capacity`` rows,
whatever the input), and each piece finds its place from its rank among pieces of its length.
Open bins are kept as runs of equal remaining capacity; a segment tree over the capacities finds
the tightest one that fits in logarithmic time.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import remember_only, small_batches, stored, text_or_empty
from rowtide.llm.token_counts import RecentIds, RecentWords, load, values_of

CAPACITY = 4096
END_ID = 1
# Half of it just fits a dict before it takes twice the room.
REMEMBERED = 699_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


class TightestFit:
    """Which capacities have open bins: a segment tree that answers "the least one >= need"."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.open = [False] * (2 * self.size)

    def mark(self, remaining: int, has: bool) -> None:
        node = remaining + self.size
        self.open[node] = has
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def find(self, need: int) -> int | None:
        node = need + self.size
        while not self.open[node]:
            while node & 1:  # a right child: go up until there is a right neighbour
                node //= 2
            if node == 0:
                return None
            node += 1
            if node & (node - 1) == 0:  # past the last leaf
                return None
        while node < self.size:
            node = 2 * node + (not self.open[2 * node])
        return node - self.size


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over lengths with multiplicity.

    Rows (length, first, last, per_bin, bin, offset): the pieces of that length with rank first to
    last - 1 go to bins from ``bin`` on, ``per_bin`` in each, from ``offset`` on. Bins of equal
    remaining capacity are interchangeable, so a whole run of them is filled in one step, as
    if document by document.
    """
    tree, runs, rows, bins = TightestFit(capacity), [[] for _ in range(capacity + 1)], [], 0

    def put(remaining: int, first: int, n: int) -> None:
        if remaining and n:
            runs[remaining].append((first, n))
            tree.mark(remaining, True)

    def place(length: int, rank: int, first: int, n: int, remaining: int, left: int) -> int:
        """Fill bins first.. first + n - 1; the pieces that went in."""
        per_bin = remaining // length
        full = min(n, left // per_bin)
        taken = full * per_bin
        if full:
            rows.append((length, rank, rank + taken, per_bin, first, capacity - remaining))
            put(remaining - per_bin * length, first, full)
        if full < n and left > taken:  # the last bin gets what is left
            rest = left - taken
            rows.append((length, rank + taken, rank + left, per_bin, first + full, capacity - remaining))
            put(remaining - rest * length, first + full, 1)
            full, taken = full + 1, left
        put(remaining, first + full, n - full)
        return taken

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            remaining = tree.find(length)
            if remaining is None:
                n = -(-left // (capacity // length))
                taken = place(length, rank, bins, n, capacity, left)
                bins += n
            else:
                first, n = runs[remaining].pop()
                if not runs[remaining]:
                    tree.mark(remaining, False)
                taken = place(length, rank, first, n, remaining, left)
            rank, left = rank + taken, left - taken
    return rows


@functools.lru_cache(maxsize=2)
def _recent(path: str, remembered: int) -> RecentIds:
    library = load(path)
    return (RecentIds if library.words is None else RecentWords)(library, remembered)


def _pieces(
    path: str, capacity: int, end_id: int, remembered: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    library, known, part = load(path), _recent(path, remembered), TaskContext.get().partitionId()
    end, seen = np.asarray([end_id], "<u4").tobytes(), {}
    remember_only(known)
    for batch in batches:
        rows = []
        values = values_of(library, known, batch.column("text"))
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), values):
            data = b"".join(ids) + end
            for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                held = data[at : at + 4 * capacity]
                n = len(held) // 4
                nth = seen.get(n, 0)
                seen[n] = nth + 1
                rows.append((doc_id, piece, at // 4, n, zlib.crc32(held), part, nth))
        columns = list(zip(*rows)) or [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(c, pa.int32() if k in (1, 5) else pa.int64())
                for k, c in enumerate(columns)
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
        )


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A row's ids (the library's, without added tokens, then ``end_id``) are one piece; only longer ones
    are cut, into pieces of ``capacity`` and a rest. Sequences hold at most ``capacity`` ids, gapless from
    offset 0, and are as few as best-fit decreasing needs. ``remembered`` bounds the words whose ids a
    Python worker keeps (about 300 bytes each, as measured); it changes time and memory, never the rows.

    Null text counts as empty: the end id alone. Repeated rows and null ids are packed as rows of their
    own, other columns are not read, an empty table gives an empty result.
    """
    texts = small_batches(docs).select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    # Written once: a rank holds for the rows of one attempt, and every later step reads these.
    pieces = stored(texts.mapInArrow(functools.partial(_pieces, path, capacity, end_id, remembered), PIECES), "pieces")

    by_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_bins(counts, capacity)

    spark = docs.sparkSession
    columns, names = zip(*plan) if plan else [()] * 6, ["length", "first", "last", "per_bin", "bin", "at"]
    # As an Arrow table no Python worker handles it: executors would keep others, and what starts them, for this alone.
    plan_rows = spark.createDataFrame(pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    # A part's pieces of one length fall in few runs: cut each part's span of ranks by the plan.
    spans = (
        by_part.join(before, ["part", "length"])
        .join(plan_rows, "length")
        .where("first < before + n and last > before")
        .drop("n")
    )
    ranked = pieces.join(spans, ["part", "length"]).where("nth + before >= first and nth + before < last")
    rank = F.col("nth") + F.col("before") - F.col("first")
    return ranked.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("bin") + F.floor(rank / F.col("per_bin"))).alias("sequence_id"),
        (F.col("at") + rank % F.col("per_bin") * F.col("length")).alias("offset"),
    )
