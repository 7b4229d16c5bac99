"""Prefix trie of conversations, with totals of every subtree rolled up in bands of depth.

A node is a distinct sequence of first turns. Its key is its depth and the XOR of its turns' hashes, each
taken with its place, so that keys come from running sums and a parent's key is its child's less the
child's own turn. Totals: inside a band of ``height`` levels each node gives to its ancestors there, at most ``height``
of them; the band's roots are then complete, and what they hold goes to their parents, the bottom of the band
above. So neither rounds nor copies of a node grow with both depth and number of nodes.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import in_order, small_batches, spread_groups, stored, text_or_empty
from rowtide.session import write_shared

# Levels of a band, unless the trie is so deep that its square root is more.
HEIGHT = 8
# Conversation ids in a row of the lists that are hashed.
LIST_ROWS = 1 << 16
# Which conversations share first turns in the rebuilt table, and how many.
GROUP, SHARED = 5, 9


def ordered_turns(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 0), ``digest`` of role and text, ``n_bytes`` of text.

    Turns go by ``turn``, null first; equal ones by digest. Null role or text is empty. Rows without
    ``conv_id`` belong to no conversation and are left out.
    """
    role, text = text_or_empty(rows["role"]), text_or_empty(rows["text"])
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = rows.where(rows["conv_id"].isNotNull()).select(
        rows["conv_id"],
        rows["turn"].alias("_turn"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    placed = in_order(turns, "trie-turns", "conv_id", ["_turn", "digest"])
    return stored(placed.select("conv_id", "place", "digest", "n_bytes"), "trie-ordered")


def shared_starts(turns: DataFrame) -> DataFrame:
    """Ordered turns of conversations rebuilt to share their first turns by groups of ids.

    Conversation ``c`` becomes the first ``h`` turns of ``c - c % 5`` (as many as there are) and its own
    turns after its first ``h``; ``h`` comes from the CRC-32 of its decimal id. ``c % 5`` has the sign
    of ``c``. Returns ``conv_id``, ``depth`` (from 1), ``digest``, ``n_bytes``, ``last`` (the number of turns);
    depth 0 stands for the conversation itself.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED))
    convs = sizes.select("conv_id", "n", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    lent = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("lent"))
    lead = F.least("h", F.coalesce("lent", F.lit(0)))
    own = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = stored(
        convs.join(lent, "base", "left").select("conv_id", "base", "h", lead.alias("lead"), (lead + own).alias("last")),
        "trie-convs",
    )
    firsts = turns.where((F.col("place") < SHARED - 1) & (F.col("conv_id") % GROUP == 0))
    borrowed = firsts.withColumnRenamed("conv_id", "base").join(convs, "base").where(F.col("place") < F.col("lead"))
    kept = turns.join(convs, "conv_id").where(F.col("place") >= F.col("h"))
    columns = ["digest", "n_bytes", "last"]
    return (
        convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("n_bytes"), "last")
        .unionByName(borrowed.select("conv_id", (F.col("place") + 1).alias("depth"), *columns))
        .unionByName(kept.select("conv_id", (F.col("place") - F.col("h") + F.col("lead") + 1).alias("depth"), *columns))
    )


def plain_starts(turns: DataFrame) -> DataFrame:
    """Ordered turns as they are, in the form of ``shared_starts``."""
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("last"))
    heads = sizes.select(
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("n_bytes"),
        "last",
    )
    rows = turns.withColumn("depth", F.col("place") + 1).drop("place").join(sizes, "conv_id")
    return heads.unionByName(rows.select(heads.columns))


def _key(depth: str | Column, a: str | Column, b: str | Column) -> Column:
    depth, a, b = (F.col(c) if isinstance(c, str) else c for c in (depth, a, b))
    return F.struct(depth.alias("depth"), a.alias("a"), b.alias("b"))


def prefixes(starts: DataFrame) -> DataFrame:
    """A row per conversation and depth: the node's two-part hash, its own turn's part in it, and where the path ends."""
    turn = [F.when(F.col("depth") > 0, F.xxhash64("digest", "depth", F.lit(k))).otherwise(F.lit(0)) for k in (1, 2)]
    keyed = starts.select(
        "conv_id",
        "depth",
        "n_bytes",
        (F.col("depth") == F.col("last")).alias("ends"),
        turn[0].alias("own_a"),
        turn[1].alias("own_b"),
        turn[0].alias("a"),
        turn[1].alias("b"),
    )
    return stored(in_order(keyed, "trie-prefixes", "conv_id", ["depth"], ("a", "b")).drop("place"), "trie-paths")


def _joined_lists(most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node in sorted rows, as comma-joined ids, at most so many in a row."""
    node, first, ids = None, None, []

    def out() -> pa.RecordBatch:
        columns = [pa.array([node], key_type), pa.array([first], pa.int64()), pa.array([",".join(ids)], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["node", "first", "ids"])

    for batch in batches:
        key_type = batch.column("node").type
        for key, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (key != node or len(ids) == most):
                yield out()
                ids = []
            if not ids:
                node, first = key, conv
            ids.append(str(conv))
    if ids:
        yield out()


def _hashed_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's lists in a row; what is held is one state, however long they are."""
    node, state = None, None

    def out(done: list) -> pa.RecordBatch:
        columns = [pa.array([n for n, _ in done], key_type), pa.array([s.hexdigest() for _, s in done], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["node", "ends_sha256"])

    for batch in batches:
        key_type, done = batch.column("node").type, []
        for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids")):
            if state is not None and key == node:
                state.update(b",")
            else:
                if state is not None:
                    done.append((node, state))
                node, state = key, hashlib.sha256()
            state.update(ids.as_py().encode())
        yield out(done)
    if state is not None:
        yield out([(node, state)])


def ends(paths: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """``node`` and ``ends_sha256``: the digest of the sorted ids of the conversations that end there."""
    last = paths.where("ends").select(_key("depth", "a", "b").alias("node"), "conv_id")
    key = last.schema["node"].dataType.simpleString()
    # By range, so that a node where a third of all conversations end spreads over many tasks.
    ranged = last.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    lists = ranged.mapInArrow(functools.partial(_joined_lists, list_rows), f"node {key}, first long, ids string")
    whole = small_batches(lists).repartition("node").sortWithinPartitions("node", "first")
    return whole.mapInArrow(_hashed_lists, f"node {key}, ends_sha256 string")


def _nodes(paths: DataFrame, height: int) -> DataFrame:
    """A row per node, with its parent, members, children and the keys of its ancestors in its band."""
    seen = paths.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("n_bytes").alias("n_bytes"),
        F.max("own_a").alias("own_a"),
        F.max("own_b").alias("own_b"),
    )
    band = F.floor(F.col("depth") / height)
    up = _key(F.col("depth") - 1, F.col("a").bitwiseXOR(F.col("own_a")), F.col("b").bitwiseXOR(F.col("own_b")))
    known = stored(
        seen.select(
            _key("depth", "a", "b").alias("node"),
            F.when(F.col("depth") > 0, up).alias("parent"),
            "conv_id",
            "n_convs",
            "n_bytes",
            band.alias("band"),
        ),
        "trie-nodes",
    )
    below = known.where("parent is not null")
    children = below.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = known.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # A parent of very many children goes to them in salted parts.
    led = spread_groups(below, "parent", "node", {"_n": ("count", "node")}, lambda totals: totals.join(parents, "parent"))
    led = led.select("node", "parent_conv_id")
    # At most ``height`` rows of a conversation share a band.
    lines = paths.groupBy("conv_id", band.alias("band")).agg(
        F.sort_array(F.collect_list(_key("depth", "a", "b"))).alias("line")
    )
    within = (F.col("node.depth") - F.col("band") * height + 1).cast("int")
    return (
        known.join(children, "node", "left")
        .join(led, "node", "left")
        .join(lines, ["conv_id", "band"])
        .select(
            "node",
            "parent",
            "conv_id",
            "parent_conv_id",
            "n_convs",
            "band",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
            F.slice("line", F.lit(1), within).alias("line"),
        )
    )


def _rolled_up(nodes: DataFrame, bands: int) -> DataFrame:
    """``node``, ``n_leaves``, ``saved_tokens``: sums over subtrees, band by band from the deepest."""
    done, carried = None, None
    for k in reversed(range(bands)):
        mine = nodes.where(F.col("band") == k)
        if carried is not None:
            mine = mine.join(carried, "node", "left").withColumns(
                {c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in ("leaves", "saved")}
            )
        totals = stored(
            mine.select(F.explode("line").alias("node"), "leaves", "saved")
            .groupBy("node")
            .agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")),
            f"trie-band-{k}",
        )
        done = totals if done is None else done.unionByName(totals)
        # Totals of the band's roots, for the nodes above them.
        tops = nodes.where((F.col("band") == k) & (F.size("line") == 1)).select("node", "parent")
        carried = (
            totals.join(tops, "node")
            .groupBy(F.col("parent").alias("node"))
            .agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
        )
    return done


def trie(starts: DataFrame, height: int | None = None) -> DataFrame:
    """One row per node of the trie of ``starts`` (of ``shared_starts`` or ``plain_starts``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs`` (members),
    ``n_children``, ``n_leaves`` (childless nodes of the subtree, the node included), ``saved_tokens`` (over the
    subtree, what storing each last text once saves, in bytes) and ``ends_sha256`` (of the comma-joined ids,
    ascending, of members with no further turn; of the empty string if there are none).

    Two sequences count as one node if their 128-bit hashes agree. Conversations without turns are
    members of the root. An empty table gives an empty result. ``height`` sets the levels of a band.
    """
    paths = prefixes(starts)
    deepest = paths.agg(F.max("depth")).first()[0]
    levels = (0 if deepest is None else deepest) + 1
    height = height or max(HEIGHT, math.isqrt(levels - 1) + 1)
    bands = -(-levels // height)
    nodes = write_shared(_nodes(paths, height), "llm-trie-bands", partition_by="band")
    totals = _rolled_up(nodes, bands)
    none = F.sha2(F.lit(""), 256)
    return (
        nodes.join(totals, "node")
        .join(ends(paths), "node", "left")
        .select(
            "conv_id",
            F.col("node.depth").cast("long").alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )
