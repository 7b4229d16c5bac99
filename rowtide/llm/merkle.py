"""Merkle manifest of a dataset: a postorder append log written by aligned builders.

The rows of a tree are numbered in order and cut into aligned blocks of ``2 ** HEIGHT``. A builder takes a
block and appends every node when it is complete: a leaf, and behind the second child their parent. So a
node stands where the sizes of the subtrees before it say (``position``), and siblings are found without
pointers. Block roots are the leaves of the next tier of blocks; the roots of all trees, in order, are the
leaves of one more tree. Proofs go the other way: a tier hands each of its leaves the path from there to
the root, which is the path of the block below, so a block's upper siblings are looked up once.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import in_order, spread_groups, stored

# Levels a builder works through; its block has 2 ** HEIGHT leaves at most.
HEIGHT = 8
DIGEST = 32
# Where a sibling stands on the path.
NONE, LEFT, RIGHT = b"-", b"L", b"R"


def subtree_size(level: int, leaves: int) -> int:
    """Nodes of a subtree of this height over its first ``leaves`` leaves; a last odd node has a parent of its own."""
    return sum(-(-leaves >> i) for i in range(level + 1))


def position(level: int, index: int, leaves: int) -> int:
    """Place in the log of the ``index``-th node of a level, in a tree of ``leaves`` leaves.

    Before its subtree stand the complete nodes over the ``s`` leaves to the left: ``s`` leaves,
    ``s // 2`` parents and so on, which is twice ``s`` less its one bits.
    """
    s = index << level
    return 2 * s - s.bit_count() + subtree_size(level, min(1 << level, leaves - s)) - 1


def parent(*digests: bytes) -> bytes:
    """SHA-256 of the children's digests as hex text."""
    return hashlib.sha256("".join([d.hex() for d in digests]).encode()).digest()


def completion_log(leaves: list[bytes], levels: int) -> list[bytes]:
    """The nodes over a block's leaves in the order of their completion, up to one node at ``levels``."""
    log: list[bytes] = []
    open_nodes: list[tuple[int, bytes]] = []

    def complete(level: int, digest: bytes) -> None:
        log.append(digest)
        open_nodes.append((level, digest))

    def close(children: int) -> None:
        level = open_nodes[-1][0] + 1
        digests = [d for _, d in open_nodes[-children:]]
        del open_nodes[-children:]
        complete(level, parent(*digests))

    def twins() -> bool:
        return len(open_nodes) > 1 and open_nodes[-1][0] == open_nodes[-2][0]

    for leaf in leaves:
        complete(0, leaf)
        while twins():
            close(2)
    while open_nodes[-1][0] < levels:
        close(2 if twins() else 1)
    return log


def fold(digest: bytes, sides: bytes, siblings: list[bytes]) -> bytes:
    """The root that a leaf and the siblings on its path give."""
    at = iter(siblings)
    for side in sides:
        if side == NONE[0]:
            digest = parent(digest)
        elif side == LEFT[0]:
            digest = parent(next(at), digest)
        else:
            digest = parent(digest, next(at))
    return digest


SEGMENT = """tree string, block long, n long, leaves long, size int, log binary,
    labels array<string>, forged array<binary>"""


def _levels(size: int, n: int, height: int) -> int:
    """Levels of a block: all of them unless it is its tree's only one."""
    return height if n > 1 << height else (size - 1).bit_length()


def _build(height: int, block: pa.Table) -> pa.Table:
    block = block.sort_by("place")
    first = {c: block.column(c)[0].as_py() for c in ("tree", "block", "n", "leaves")}
    digests = block.column("digest").to_pylist()
    log = completion_log(digests, _levels(len(digests), first["n"], height))
    row = first | {"size": len(digests), "log": b"".join(log)}
    row |= {"labels": block.column("label").to_pylist(), "forged": block.column("forged").to_pylist()}
    fields = [("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("leaves", pa.int64())]
    fields += [("size", pa.int32()), ("log", pa.binary())]
    fields += [("labels", pa.list_(pa.string())), ("forged", pa.list_(pa.binary()))]
    return pa.Table.from_pylist([row], pa.schema(fields))


@dataclass
class Log:
    """The segments of the log by tier, and the root of each tree."""

    tiers: list[DataFrame]
    height: int

    def finished(self, tier: int) -> Column:
        """Segments that end their tree: the only block of a tier."""
        return F.col("n") <= 1 << self.height

    def roots(self) -> DataFrame:
        ended = [t.where(self.finished(k)).select("tree", "log") for k, t in enumerate(self.tiers)]
        every = functools.reduce(DataFrame.unionByName, ended)
        return every.select("tree", F.substring("log", -DIGEST, DIGEST).alias("root"))


def build(numbered: DataFrame, name: str, height: int = HEIGHT) -> Log:
    """``(tree, place, n, label, digest, forged)`` to a log; ``place`` counts from 0 to ``n - 1`` in a tree."""
    inputs, tiers = numbered.withColumn("leaves", F.col("n")), []
    while True:
        blocks = inputs.withColumn("block", F.shiftright("place", height)).groupBy("tree", "block")
        tiers.append(stored(blocks.applyInArrow(lambda block: _build(height, block), SEGMENT), f"{name}-{len(tiers)}"))
        # One number: are there trees of more than one block?
        if (tiers[-1].agg(F.max("n")).first()[0] or 0) <= 1 << height:
            return Log(tiers, height)
        inputs = (
            tiers[-1]
            .where(F.col("n") > 1 << height)
            .select(
                "tree",
                F.col("block").alias("place"),
                F.ceil(F.col("n") / (1 << height)).cast("long").alias("n"),
                "leaves",
                F.lit(None).cast("string").alias("label"),
                F.substring("log", -DIGEST, DIGEST).alias("digest"),
                F.lit(None).cast("binary").alias("forged"),
            )
        )


def nodes(log: Log) -> DataFrame:
    """The whole log: ``tree``, ``position`` (from 0, without gaps), ``level``, ``index``, ``digest`` (hex)."""
    schema = "tree string, position long, level int, index long, digest string"
    listed = [t.mapInArrow(functools.partial(_listed, log.height, k), schema) for k, t in enumerate(log.tiers)]
    return functools.reduce(DataFrame.unionByName, listed)


def _listed(height: int, tier: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            out = []
            for level in range(1 if tier else 0, _levels(row["size"], row["n"], height) + 1):
                for j in range(-(-row["size"] >> level)):
                    at = position(level, j, row["size"]) * DIGEST
                    over, index = tier * height + level, (row["block"] << (height - level)) + j
                    place = position(over, index, row["leaves"])
                    out.append((row["tree"], place, over, index, row["log"][at : at + DIGEST].hex()))
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string())
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["tree", "position", "level", "index", "digest"])


PATH = "sides binary, siblings array<binary>, subroot binary, root binary"
LEAF = f"tree string, place long, label string, leaf binary, forged binary, {PATH}"


def _descend(height: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each leaf of a segment: its path inside, then the path of the segment's own root."""
    kinds = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
    kinds += [pa.binary(), pa.list_(pa.binary()), pa.binary(), pa.binary()]
    names = ["tree", "place", "label", "leaf", "forged", "sides", "siblings", "subroot", "root"]
    for batch in batches:
        for row in batch.to_pylist():
            size, log, out = row["size"], row["log"], []
            levels = _levels(size, row["n"], height)

            def node(level: int, index: int) -> bytes:
                at = position(level, index, size) * DIGEST
                return log[at : at + DIGEST]

            for place in range(size):
                sides, siblings = b"", []
                for level in range(levels):
                    other = place >> level ^ 1
                    if other << level >= size:
                        sides += NONE
                        continue
                    sides += RIGHT if other & 1 else LEFT
                    siblings.append(node(level, other))
                out.append(
                    (
                        row["tree"],
                        (row["block"] << height) + place,
                        row["labels"][place],
                        node(0, place),
                        row["forged"][place],
                        sides + row["sides"],
                        siblings + row["siblings"],
                        row["subroot"],
                        row["root"],
                    )
                )
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def paths(log: Log, ends: DataFrame) -> DataFrame:
    """One row per leaf (``LEAF``); ``ends`` has the path of each tree's root: ``(tree, sides, siblings, subroot, root)``."""
    below, walked = None, []
    for k in reversed(range(len(log.tiers))):
        segments = log.tiers[k]
        led = segments.where(log.finished(k)).join(ends, "tree")
        if below is not None:
            upper = below.select("tree", F.col("place").alias("block"), "sides", "siblings", "subroot", "root")
            led = led.unionByName(segments.where(~log.finished(k)).join(upper, ["tree", "block"]))
        below = led.mapInArrow(functools.partial(_descend, log.height), LEAF)
        walked.append(below)
    return walked[-1]


def _field(value: Column) -> Column:
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(value.isNull(), F.lit("-")).otherwise(sized)


def leaf_digest(docs: DataFrame, n_chars: Column | None = None) -> Column:
    """Digest of a row's five fields, each with its length in front; ``-`` stands for null."""
    values = {c: docs[c] for c in ("doc_id", "source", "lang", "n_chars", "text")}
    if n_chars is not None:
        values["n_chars"] = n_chars
    return F.unhex(F.sha2(F.concat(*[_field(v) for v in values.values()]), 256))


def tampered(docs: DataFrame) -> Column:
    """The digest of a row whose length someone raised by one; null for rows left alone."""
    picked = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0
    raised = docs["n_chars"].cast("decimal(20,0)") + 1
    return F.when(F.coalesce(picked, F.lit(False)) & raised.isNotNull(), leaf_digest(docs, raised))


def manifest(docs: DataFrame, forged: Column | None = None, height: int = HEIGHT) -> tuple[Log, Log]:
    """The log of the trees, one per ``lang`` with leaves in order of ``doc_id``, and the log of the tree over them.

    A tree is named ``=`` and its language; rows without language are the tree of the empty name, the
    first. Rows with a null ``doc_id`` come first in their tree; rows of one id are put in order by digest, and
    repeated rows are leaves of their own. Nulls in other columns are part of the leaf (``-``), columns
    beyond the five are not. An empty table gives empty logs.
    """
    tree = F.coalesce(F.concat(F.lit("="), docs["lang"]), F.lit(""))
    leaves = docs.select(
        tree.alias("tree"),
        docs["doc_id"].alias("_id"),
        docs["doc_id"].cast("string").alias("label"),
        leaf_digest(docs).alias("digest"),
        (F.lit(None).cast("binary") if forged is None else forged).alias("forged"),
    )
    trees = build(_numbered(leaves, ["_id", "digest"], "leaves", height), "log", height)
    subroots = trees.roots().select(
        F.lit("").alias("tree"),
        F.col("tree").alias("label"),
        F.col("root").alias("digest"),
        F.lit(None).cast("binary").alias("forged"),
    )
    return trees, build(_numbered(subroots, ["label"], "subroots", height), "top", height)


def _numbered(leaves: DataFrame, order: list[str], name: str, height: int) -> DataFrame:
    """Add ``place`` and ``n``, its tree's number of leaves, which goes from tree to blocks to rows: no tree is one task."""
    placed = stored(
        in_order(leaves, f"merkle-{name}", "tree", order).withColumn("block", F.shiftright("place", height)),
        f"merkle-placed-{name}",
    )
    blocks = placed.groupBy("tree", "block").agg(F.max("place").alias("_upto"))
    sized = spread_groups(blocks, "tree", "block", {"_last": ("max", "_upto")})
    return placed.join(sized.select("tree", "block", (F.col("_last") + 1).alias("n")), ["tree", "block"]).select(
        "tree", "place", "n", "label", "digest", "forged"
    )


def prove(trees: Log, top: Log) -> DataFrame:
    """One row per leaf with its proof, checked.

    ``label`` (the id as text), ``leaf``, ``subroot``, ``root`` (hex), ``siblings`` (hex, from the leaf's level up to
    the root), ``sides`` (one letter a level: ``L``, ``R``, or ``-`` where the node has no sibling),
    ``folded_root``: what the forged digest, else the leaf, and the siblings give, and ``verified``:
    whether that is the root.
    """
    none = F.array().cast("array<binary>")
    start = top.roots().select(
        "tree", F.lit(b"").alias("sides"), none.alias("siblings"), F.col("root").alias("subroot"), "root"
    )
    ends = paths(top, start).select(
        F.col("label").alias("tree"), "sides", "siblings", F.col("leaf").alias("subroot"), "root"
    )
    schema = """label string, leaf string, subroot string, root string, siblings array<string>, sides string,
        folded_root string, verified boolean"""
    return paths(trees, ends).mapInArrow(_checked, schema)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string()] * 4 + [pa.list_(pa.string()), pa.string(), pa.string(), pa.bool_()]
    names = ["label", "leaf", "subroot", "root", "siblings", "sides", "folded_root", "verified"]
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            folded = fold(row["forged"] or row["leaf"], row["sides"], row["siblings"])
            known = [row[c].hex() for c in ("leaf", "subroot", "root")]
            siblings = [s.hex() for s in row["siblings"]]
            out.append((row["label"], *known, siblings, row["sides"].decode(), folded.hex(), folded == row["root"]))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def tamper_report(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Each row's proof digest, and whether it holds once every seventh row has been tampered with."""
    proofs = prove(*manifest(docs, tampered(docs), height))
    return proofs.select(
        F.col("label").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )
