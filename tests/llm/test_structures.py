"""Merkle manifest, prefix trie and piece tables against brute force and the library."""

import hashlib
import math
import random
import zlib

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from conftest import ODD
from pyspark.sql import functions as F

from rowtide.llm import bpe, merkle, prefix_trie, sentencepieces
from rowtide.llm.common import in_order
from rowtide.llm.queries import ENTRIES, MERKLE_SQL, PIECE_MODEL, TRIE_SQL


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---- order without a task per key


def test_order_and_running_hash_of_a_hot_key(spark):
    rng = random.Random(2)
    rows = [("hot", rng.randrange(50), rng.getrandbits(60)) for _ in range(300)] + [("z", 1, 5), ("a", None, 7)]
    df = spark.createDataFrame(rows, "k string, v int, x long").repartition(6)
    got = in_order(df.withColumn("h", F.col("x")), "test", "k", ["v", "x"], ("h",)).collect()
    for key in ("hot", "z", "a"):
        mine = sorted((r for r in got if r.k == key), key=lambda r: r.place)
        assert [r.place for r in mine] == list(range(len(mine)))
        assert [(r.v, r.x) for r in mine] == sorted((v, x) for k, v, x in rows if k == key)
        running = 0
        for r in mine:
            running ^= r.x
            assert r.h == running
    assert in_order(df.limit(0), "test", "k", ["v"]).count() == 0


# ---- Merkle manifest


def _digest(row, more=0):
    doc_id, source, lang, n_chars, text = row
    values = (doc_id, source, lang, n_chars if n_chars is None else n_chars + more, text)
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def _proofs(rows):
    langs = sorted({r[2] for r in rows}, key=lambda lang: (lang is not None, (lang or "").encode()))
    of = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, _digest(r))) for x in langs}
    trees = {x: _levels([_digest(r) for r in of[x]]) for x in langs}
    top = _levels([trees[x][-1][0] for x in langs])
    out = []
    for rank, lang in enumerate(langs):
        for place, row in enumerate(of[lang]):
            forged = row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            siblings, digest = [], _digest(row, 1 if forged else 0)
            for levels, k in ((trees[lang], place), (top, rank)):
                for level in levels[:-1]:
                    pair = level[k & ~1 : (k & ~1) + 2]
                    siblings += [d for j, d in enumerate(pair) if j != k & 1]
                    mended = [digest if j == k & 1 else d for j, d in enumerate(pair)]
                    digest, k = sha(*mended), k >> 1
            known = (_digest(row), trees[lang][-1][0], top[-1][0], sha(*siblings))
            out.append((row[0], *known, digest, digest == top[-1][0]))
    return out


ROWS = [
    (1, "a", None, 5, "é"), (1, "a", None, 5, "é"), (None, None, "en", None, None), (7, "", "en", 2**63 - 1, ""),
    (3, "s", "", 1, "x"), *[(i, "s", "zz", i, "t" * i) for i in range(37)], (900, "s", "zz", None, "y" * 200_000),
]
FIELDS = "doc_id long, source string, lang string, n_chars long, text string, tree int, place string"


@pytest.mark.parametrize("height", [1, 8])
def test_tamper_report(spark, height):
    df = spark.createDataFrame([(*r, 1, "z") for r in ROWS], FIELDS)
    got = merkle.tamper_report(df, height).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _proofs(ROWS)))


def test_log_positions_are_gapless_and_in_postorder(spark):
    df = spark.createDataFrame([(*r, 1, "z") for r in ROWS], FIELDS)
    logs = [
        {(r.tree, r.position): (r.level, r["index"], r.digest) for r in merkle.nodes(merkle.manifest(df, None, h)[0]).collect()}
        for h in (1, 8)
    ]
    assert logs[0] == logs[1]  # the builders' blocks leave no trace
    for tree in {t for t, _ in logs[0]}:
        log = [logs[0][tree, k] for k in range(sum(t == tree for t, _ in logs[0]))]
        at = {(level, index): k for k, (level, index, _) in enumerate(log)}
        for (level, index), k in at.items():
            children = [(level - 1, 2 * index + j) for j in (0, 1) if (level - 1, 2 * index + j) in at]
            assert all(at[c] < k for c in children)
            if level:
                assert log[k][2] == sha(*[log[at[c]][2] for c in children])


def test_closed_positions():
    for n in range(1, 40):
        height = (n - 1).bit_length()
        log = merkle.completion_log([bytes([i]) * 32 for i in range(n)], height)
        assert len(log) == merkle.subtree_size(height, n)
        places = {merkle.position(lv, i, n) for lv in range(height + 1) for i in range(-(-n >> lv))}
        assert places == set(range(len(log)))
        assert [log[merkle.position(0, i, n)][0] for i in range(n)] == list(range(n))


def test_empty_manifest(spark):
    df = spark.createDataFrame([], FIELDS)
    assert merkle.tamper_report(df).count() == 0
    assert merkle.nodes(merkle.manifest(df)[0]).count() == 0


# ---- prefix trie


def _conversations(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    return {c: tuple((r, x) for *_, r, x in sorted(t)) for c, t in turns.items()}


def _rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - int(math.fmod(c, 5)), ())[:h] + turns[h:]
    return out


def _trie(convs):
    members, children, totals, out = {}, {}, {}, []
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    for node in sorted(members, key=len, reverse=True):
        below = [totals[c] for c in children.get(node, [])]
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        totals[node] = (sum(t[0] for t in below) if below else 1, own + sum(t[1] for t in below))
    for node, convs_of in members.items():
        last = ",".join(str(c) for c in sorted(convs_of) if len(convs[c]) == len(node))
        up = min(members[node[:-1]]) if node else None
        out.append((min(convs_of), len(node), up, len(convs_of), len(children.get(node, [])), *totals[node], sha(last)))
    return sorted(map(str, out))


def _talks():
    rng = random.Random(1)
    rows = [
        (None, 0, "user", "x"), (1, None, None, None), (1, 0, "user", "é"), (1, 0, "user", "é"), (2, 0, "user", "é"),
        (2, 1, "assistant", ""), (-3, 0, "a", "b"), (-5, 3, "a", "b"), (0, 1, "a", "b"), (7, 1, "", "é" * 200_000),
    ]
    rows += [(c, t, "ab"[t % 2], rng.choice("xy")) for c in range(10, 60) for t in range(rng.randint(1, 40))]
    return rows + [(c, t, "u", "same") for c in range(100, 160) for t in range(3)]


@pytest.mark.parametrize("height", [None, 1])
def test_trie_of_shared_starts(spark, height):
    rows = _talks()
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, node int")
    got = prefix_trie.trie(prefix_trie.shared_starts(prefix_trie.ordered_turns(df)), height)
    assert sorted(str(tuple(r)) for r in got.collect()) == _trie(_rebuilt(_conversations(rows)))


def test_trie_of_plain_starts_and_long_lists(spark):
    rows = _talks()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    starts = prefix_trie.plain_starts(prefix_trie.ordered_turns(df))
    assert sorted(str(tuple(r)) for r in prefix_trie.trie(starts, 4).collect()) == _trie(_conversations(rows))
    paths = prefix_trie.prefixes(starts)
    whole = {str(r.node): r.ends_sha256 for r in prefix_trie.ends(paths).collect()}
    assert whole == {str(r.node): r.ends_sha256 for r in prefix_trie.ends(paths, list_rows=7).collect()}
    assert sha(",".join(map(str, range(100, 160)))) in whole.values()
    none = df.limit(0)
    assert prefix_trie.trie(prefix_trie.shared_starts(prefix_trie.ordered_turns(none))).count() == 0


@pytest.mark.parametrize(
    "name, sql", [("op11_merkle", MERKLE_SQL), ("op12_prefix_trie", TRIE_SQL)], ids=["merkle", "trie"]
)
def test_structures_against_sql(spark, small, name, sql):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    df = ENTRIES[name].run(spark, small)
    cursor = con.execute(sql)
    order = [d[0] for d in cursor.description]
    assert sorted(map(str, map(tuple, df.select(order).collect()))) == sorted(map(str, cursor.fetchall()))


# ---- SentencePiece

PIECE_TEXTS = [
    *ODD, " ", "a", "  a  b ", "▁x", "▁▁ ▁", "é\x00b", "a\nb", "<s>x<0x41>", "　x ﬁ ½", " " * 50, "日本語 テキスト 𝕏😀",
    "a\tb\r\n c", "<unk> </s>", "�﻿ x", "word " * 40_000, "𝕏" * 20_000,
]


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def test_pieces_as_the_library(documents, pieces, monkeypatch):
    texts = [*enumerate(PIECE_TEXTS), (None, "twice"), (3, "twice"), (3, "twice")]
    got = sentencepieces.encode_decode(documents(texts), PIECE_MODEL).collect()
    want = []
    for i, t in texts:
        ids = pieces.encode(t or "")
        want.append((i, ids, pieces.decode(ids)))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    short = sentencepieces.digests(documents(texts), PIECE_MODEL).collect()
    whole = [(i, len(ids), sha(",".join(map(str, ids))), sha(text)) for i, ids, text in want]
    assert sorted(map(str, map(tuple, short))) == sorted(map(str, whole))
    assert sentencepieces.digests(documents([]), PIECE_MODEL).count() == 0
    empty = sentencepieces.encode_decode(documents([(1, ""), (2, None)]), PIECE_MODEL).collect()
    assert sorted(map(tuple, empty)) == [(1, [], ""), (2, [], "")]


def test_slices_of_one_text(pieces, monkeypatch):
    import pyarrow as pa

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(sentencepieces, "TaskContext", Task)
    monkeypatch.setattr(sentencepieces, "SLICE_BYTES", 100)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "text": ["a b a", "", "c a b c d", "a"]})
    rows = [r for b in sentencepieces._code(PIECE_MODEL, iter([batch, batch])) for r in b.to_pylist()]
    assert len(rows) > 2 and len({r["slice"] for r in rows}) == len(rows)
    model = sentencepieces.load(PIECE_MODEL)
    seen = []
    for r in rows:
        table = sentencepieces._parted(r["chunks"]) if r["chunks"] else []
        assert len(set(table)) == len(table)
        codes = iter(sentencepieces._codes_unpacked(r["codes"], r["counts"]).tolist())
        for doc_id, size in zip(r["ids"], sentencepieces._unpacked(r["sizes"])):
            seen.append((doc_id, [table[next(codes)] for _ in range(size)]))
        assert next(codes, None) is None
    texts = list(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()))
    assert seen == [(i, model.chunks(t)) for i, t in texts] * 2


def test_chunks_are_joined_as_the_library_does(pieces):
    model, rng = sentencepieces.load(PIECE_MODEL), random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("abcde  \nüß中▁'.1") for _ in range(rng.randrange(40)))
        parts = [model.segment(c) for c in model.chunks(text)]
        assert [i for p in parts for i in p] == pieces.encode(text)
        assert model.whole([model.plain(p) for p in parts]) == pieces.decode(pieces.encode(text))


def test_other_files_are_refused():
    with pytest.raises(Exception):
        sentencepieces.PieceModel(public_tokenizers.path("word_bpe_49k.json"))
    with pytest.raises(ValueError, match="word ends"):
        bpe.WordBpe(public_tokenizers.path("byte_bpe_50k.json"))
