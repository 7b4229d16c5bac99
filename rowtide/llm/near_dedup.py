"""Near-duplicates by an LSH forest over MinHash signatures, links confirmed on full shingle sets.

A signature is read in several orders ("trees"). Documents whose signatures agree on the first
``DEPTH`` places of an order share a region. Regions first link their members to the region's
smallest id; only regions that still hold more than one component go on: small ones compare
their members across components, in crowded ones members are compared with their neighbours in
sorted order, which share the longest prefixes (so the depth adapts to the region). What a crowded
region may have lost by that is found by an exact index of rare shingles, so no link depends
on how crowded a region is.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.bpe import Memo
from rowtide.llm.common import (
    bitmap_of,
    drop_rows,
    perhaps_in,
    remember_only,
    row_mark,
    small_batches,
    spread_groups,
    stored,
    text_or_empty,
)

SHINGLE = 5
PERCENT = 75
HASHES = 128
TREES = 32
DEPTH = 4
# Places of a signature that sort the members of a crowded region.
SORTED_BY = 24
# Members of a region that are compared with each other; beyond it only neighbours are.
REGION = 48
# Pairs of J >= 0.75 agree on 96 of 128 places on average, standard deviation 5; below 66 they are left out.
LEAST_AGREED = 66
WORDS_REMEMBERED = 87_000

_SEED = np.random.Generator(np.random.PCG64(20240601))
_MULTIPLY = _SEED.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _SEED.integers(0, 2**63, HASHES, dtype=np.uint64)
_ORDERS = np.stack([np.roll(np.arange(HASHES), -4 * t) if t < HASHES // 4 else _SEED.permutation(HASHES) for t in range(TREES)])
for _order in _ORDERS:  # the first four places are this tree's own, the rest in an order of its own
    _SEED.shuffle(_order[4:])
_MIX = np.uint64(0x9E3779B97F4A7C15)

_WORDS = Memo(xxhash.xxh3_64_intdigest, WORDS_REMEMBERED)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles; a shorter text is one shingle, no word none."""
    words = text.encode("utf-8").lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - SHINGLE + 1, 1)
    size = min(SHINGLE, len(words))
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = _mix(out * _MIX + h[k : k + n])
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, 2**64 - 1, np.uint64)
    for at in range(0, len(found), 512):
        hashed = (found[at : at + 512, None] ^ _FLIP) * _MULTIPLY
        np.minimum(least, hashed.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    remember_only(_WORDS)
    for batch in batches:
        sizes, keys, signatures = [], [], []
        for text in batch.column("text"):
            found = shingles(text.as_py())
            sizes.append(len(found))
            keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            signatures.append(signature(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("doc_id", "mark")),
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(signatures, pa.binary()),
            ],
            ["doc_id", "mark", "n_shingles", "set_key", "signature"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    remember_only(_WORDS)
    for batch in batches:
        sets = [shingles(t.as_py()).tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["v", "set"])


def _matrix(column: pa.Array, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, v, tree) of each document's region in each tree."""
    for batch in batches:
        places = _matrix(batch.column("signature"), "<u4").astype(np.uint64)
        for tree in range(TREES if len(batch) else 0):
            key = np.full(len(places), tree, np.uint64)
            for place in _ORDERS[tree][:DEPTH]:
                key = _mix(key * _MIX + places[:, place])
            trees = pa.array(np.full(len(places), tree, np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column("v"), trees], ["key", "v", "tree"])


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each row's signature in the order of its tree, as bytes that sort."""
    for batch in batches:
        if len(batch):
            places, trees = _matrix(batch.column("signature"), "<u4"), batch.column("tree").to_numpy(zero_copy_only=False)
            ordered = np.take_along_axis(places, _ORDERS[trees][:, :SORTED_BY], axis=1).astype(">u4")
            yield batch.select(["key", "v", "root"]).append_column("sorted", pa.array([r.tobytes() for r in ordered], pa.binary()))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rows that follow each other in a region, of different components."""
    before = None
    for batch in batches:
        pairs = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "v", "root"))):
            if before is not None and before[0] == row[0] and before[2] != row[2]:
                pairs.append((min(before[1], row[1]), max(before[1], row[1])))
            before = row
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], ["a", "b"]
        )


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            same = _matrix(batch.column("sa"), "u1") == _matrix(batch.column("sb"), "u1")
            yield batch.select(["a", "b"]).filter(pa.array(same.sum(axis=1) >= LEAST_AGREED))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for one, other in zip(batch.column("set_a"), batch.column("set_b")):
            a, b = np.frombuffer(one.as_py(), np.uint64), np.frombuffer(other.as_py(), np.uint64)
            shared = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * shared >= PERCENT * (len(a) + len(b) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All shingles of a text, one row each."""
    remember_only(_WORDS)
    for batch in batches:
        for v, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            found = shingles(text.as_py()).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), v, np.int64)), pa.array(found), pa.array(np.full(len(found), len(found), np.int64))], ["v", "shingle", "n"]
            )


def components(links: DataFrame) -> DataFrame:
    """``v`` and ``root`` (smallest id reachable) of every id in ``links`` (a, b).

    Labels take the smallest label of their neighbours and then that label's own label, until
    nothing changes; each round is a table in the shared folder.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links").toDF("u", "w")
    labels = stored(
        both.groupBy("u").agg(F.min("w").alias("least")).select(F.col("u").alias("v"), F.least("u", "least").alias("root")),
        "labels",
    )
    while True:
        near = both.join(labels, both["w"] == labels["v"]).groupBy("u").agg(F.min("root").alias("least"))
        lower = labels.join(near, labels["v"] == near["u"]).select("v", F.col("root").alias("old"), F.least("root", "least").alias("root"))
        of_root = labels.select(F.col("v").alias("r"), F.col("root").alias("beyond"))
        jumped = lower.join(of_root, lower["root"] == of_root["r"]).select(
            "v", "old", F.least("root", "beyond").alias("root")
        )
        after = stored(jumped, "labels")
        labels = after.select("v", "root")
        if after.where("root != old").isEmpty():
            return labels


class _Forest:
    """Signatures and texts of the class representatives, and the components found so far."""

    def __init__(self, docs: DataFrame, classes: DataFrame, strangers: DataFrame):
        self.docs, self.classes = docs, classes
        # Rows that have a representative's id, but another text.
        self.strangers = None if strangers.isEmpty() else strangers
        self.brief = classes.select("v", "brief")
        self.roots: DataFrame | None = None
        self.tried: DataFrame | None = None

    def root_of(self, rows: DataFrame, v: str, root: str) -> DataFrame:
        if self.roots is None:
            return rows.withColumn(root, F.col(v))
        roots = self.roots.select(F.col("v").alias("_v"), F.col("root").alias(root))
        return rows.join(roots, rows[v] == roots["_v"], "left").drop("_v").withColumn(root, F.coalesce(root, v))

    def texts(self, ids: DataFrame) -> DataFrame:
        """(doc_id, text) of the ids in a bitmap: perhaps of a few more."""
        wanted = perhaps_in(self.docs, "doc_id", ids, "wanted").where("wanted")
        if self.strangers is not None:
            wanted = wanted.join(self.strangers, ["doc_id", "mark"], "left_anti")
        return wanted.select("doc_id", "text")

    def sets(self, ids: DataFrame) -> DataFrame:
        """(v, set) of the ids in a bitmap, worked out again from their texts."""
        return self.texts(ids).mapInArrow(_sets, "v long, set binary")

    def confirm(self, pairs: DataFrame) -> None:
        """Keep the pairs whose full sets are similar enough, and join their components."""
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        brief = self.brief
        likely = (
            pairs.join(brief.toDF("a", "sa"), "a")
            .join(brief.toDF("b", "sb"), "b")
            .select("a", "b", "sa", "sb")
            .mapInArrow(_agreeing, "a long, b long")
        )
        likely = stored(likely, "likely")
        if likely.isEmpty():
            return
        self.tried = likely if self.tried is None else self.tried.union(likely)
        wanted = stored(bitmap_of(likely.select(F.explode(F.array("a", "b")).alias("v")).distinct(), "v"), "wanted")
        sets = stored(self.sets(wanted), "sets")
        links = (
            likely.join(sets.toDF("b", "set_b"), "b")
            .join(sets.toDF("a", "set_a"), "a")
            .select("a", "b", "set_a", "set_b")
            .mapInArrow(_linked, "a long, b long")
        )
        links = stored(links, "confirmed")
        joined = self.root_of(self.root_of(links, "a", "ra"), "b", "rb").where("ra != rb")
        merged = components(joined.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
        if self.roots is None:
            self.roots = merged
            return
        moved = merged.select(F.col("v").alias("_r"), F.col("root").alias("_to"))
        old = self.roots.join(moved, self.roots["root"] == moved["_r"], "left").select(
            "v", F.coalesce("_to", "root").alias("root")
        )
        new = merged.join(self.roots, "v", "left_anti")
        self.roots = stored(old.unionByName(new), "roots")

    def search(self) -> DataFrame:
        """Work off the regions of all trees; ids of those whose regions stay crowded and mixed."""
        rows = stored(self.classes.select("v", "signature").mapInArrow(_regions, "key long, v long, tree int"), "trees")
        regions = stored(
            rows.groupBy("key").agg(F.min("v").alias("leader"), F.count(F.lit(1)).alias("size")).where("size > 1"),
            "regions",
        )
        # Most documents are alone in most regions: the bitmap spares them the exchange.
        some = perhaps_in(rows, "key", stored(bitmap_of(regions, "key"), "occupied"), "some").where("some").drop("some")
        held = stored(some.join(regions, "key"), "members")
        self.confirm(held.where("v != leader").select(F.col("leader").alias("a"), F.col("v").alias("b")).distinct())

        rooted = self.mixed(held)
        small = rooted.where(F.col("size") <= REGION).select("key", "v", "root")
        across = small.join(small.toDF("key", "w", "other"), "key").where("v < w and root != other")
        self.confirm(across.select(F.col("v").alias("a"), F.col("w").alias("b")).distinct())

        crowded = held.where(F.col("size") > REGION)
        for _ in range(2):
            crowded = self.mixed(crowded)
            if crowded.isEmpty():
                break
            ordered = (
                crowded.join(self.classes.select("v", "signature"), "v")
                .mapInArrow(_in_order, "key long, v long, root long, sorted binary")
                .repartitionByRange("key", "sorted", "v")
                .sortWithinPartitions("key", "sorted", "v")
            )
            self.confirm(ordered.mapInArrow(_neighbours, "a long, b long").distinct())
        return self.mixed(crowded).select("v").distinct()

    def mixed(self, members: DataFrame) -> DataFrame:
        """Members, with their roots, of the regions that hold more than one component."""
        rooted = self.root_of(members.select("key", "v", "tree", "size"), "v", "root")
        keys = (
            rooted.groupBy("key")
            .agg(F.min("root").alias("low"), F.max("root").alias("high"))
            .where("low != high")
            .select("key")
        )
        return stored(rooted.join(keys, "key"), "mixed")

    def rare_shingles(self, crowded: DataFrame) -> None:
        """All links among crowded documents: similar sets share one of their rarest shingles.

        Of n shingles, those that two sets of similarity 0.75 may differ in are at most a quarter; so
        in any common order the first n - ceil(0.75 n) + 1 hold a shared one. The order is by number
        of crowded documents, rare first. Pairs within a component need no look.
        """
        ids = crowded.select("v").distinct()
        # Texts, about as large as their sets, go through one Python worker a task.
        texts = self.texts(stored(bitmap_of(ids, "v"), "crowded")).join(ids.withColumnRenamed("v", "doc_id"), "doc_id")
        all_rows = stored(texts.mapInArrow(_rare, "v long, shingle long, n long"), "shingles")
        counts = all_rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
        counted = all_rows.join(counts, "shingle")
        alone = all_rows.groupBy("v").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("all"))
        shared = counted.groupBy("v").agg(F.count(F.lit(1)).alias("shared"))
        budget = alone.join(shared, "v").select(
            "v",
            "n",
            (F.col("all") - F.col("shared")).alias("own"),
            (F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - (F.col("all") - F.col("shared"))).alias("left"),
        ).where("left > 0")
        # Shingles of one document come first and link nothing; what is left of the budget goes by rank.
        ordered = counted.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("s"))
        first = ordered.join(budget, "v").select(
            "v", "n", "own", F.posexplode(F.slice("s", 1, F.col("left").cast("int"))).alias("at", "s")
        )
        # What a document still holds from a shingle on, in the common order, bounds what it can share.
        rest = (F.col("n") - F.col("own") - F.col("at")).alias("rest")
        postings = stored(self.root_of(first.select("v", "n", rest, "s.shingle"), "v", "root"), "rare")
        mixed = postings.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
        left = postings.join(mixed.select("shingle"), "shingle")
        right = left.select(
            "shingle", F.col("v").alias("w"), F.col("n").alias("m"), F.col("rest").alias("rest_w"), F.col("root").alias("other")
        )
        near = (
            f"v < w and root != other and 100 * least(n, m) >= {PERCENT} * greatest(n, m)"
            f" and {100 + PERCENT} * least(rest, rest_w) >= {PERCENT} * (n + m)"
        )
        self.confirm(left.join(right, "shingle").where(near).select(F.col("v").alias("a"), F.col("w").alias("b")).distinct())


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept``, one row per input row.

    Documents are linked when 100 * |A and B| >= 75 * |A or B| over their sets of 5-word shingles (A-Z
    lower-cased; fewer words are one shingle). ``component_id`` is the smallest id reachable, itself
    included, and ``kept`` whether it is the row's own.

    Null, empty and blank texts have an empty set and no link. Rows that repeat an id are rows of their own,
    each with the component of its text; an id that is the smallest of several joins those. A row with a null id takes part with no link: null component,
    kept. Other columns are not read, an empty table gives an empty result. A link of
    similarity 0.75 is missed by all trees with probability 5e-6 (0.6836 to the power of 32), closer ones far less.
    """
    return _components(docs, id_col, text_col).drop("mark")


def _components(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``near_copies`` with ``mark``, which tells rows of one id apart by their text."""
    text = text_or_empty(text_col)
    texts = small_batches(docs).select(F.col(id_col).alias("doc_id"), row_mark(text).alias("mark"), text.alias("text"))
    signs = "doc_id long, mark long, n_shingles long, set_key binary, signature binary"
    signed = stored(texts.mapInArrow(_sign, signs), "signed")
    named = signed.where("set_key is not null and doc_id is not null")
    # Equal sets are one class, known by its smallest id.
    classes = stored(
        named.groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "mark")).alias("first"), F.first("signature").alias("signature"))
        .select(F.col("first.doc_id").alias("v"), F.col("first.mark").alias("own"), "signature"),
        "classes",
    )
    strangers = stored(
        named.join(classes.select("v", "own"), F.col("doc_id") == F.col("v"))
        .groupBy("doc_id", "mark")
        .agg(F.max(F.col("mark") == F.col("own")).alias("first"))
        .where("not first")
        .select("doc_id", "mark"),
        "strangers",
    )
    brief = F.unhex(F.regexp_replace(F.hex("signature"), "(..)......", "$1")).alias("brief")
    forest = _Forest(texts, classes.select("v", "signature", brief), strangers)

    crowded = forest.search()
    if not crowded.isEmpty():
        forest.rare_shingles(crowded)

    def with_root(totals: DataFrame) -> DataFrame:
        return forest.root_of(totals, "least", "component_id")

    kept = ["doc_id", "mark", "n_shingles", "component_id"]
    rows = named.select("doc_id", "mark", "n_shingles", "set_key")
    same = spread_groups(rows, "set_key", "doc_id", {"least": ("min", "doc_id")}, with_root).select(kept)
    alone = signed.where("set_key is null or doc_id is null").withColumn("component_id", F.col("doc_id")).select(kept)
    return same.unionByName(alone).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "mark",
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the rows of each component's smallest id, and rows with a null id; all columns stay.

    Rows are told apart by id and text, so an id may come with several texts; no text is shuffled for the choice.
    """
    return drop_rows(docs, id_col, text_col, _components(docs, id_col, text_col), "near")
