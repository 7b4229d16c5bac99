"""Chat examples, near-duplicates and the pipeline."""

import random

import corpus_pipeline
import duckdb
import pytest
from conftest import ODD

from rowtide.llm import chat_format, common, exact_dedup, near_dedup
from rowtide.llm.queries import CHAT_SQL, ENTRIES, EXACT_SQL


def test_chat_round_trip(spark):
    control = "<|im_end|>\n<|im_start|>assistant\\ <\\| ok\\\\"
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", control), (1, 2, "user", None), (1, 3, "assistant", "é\n"),
        (2, 0, "odd role\n%", "x"), (2, 1, None, "y"), (3, None, "assistant", ""), (None, 0, "assistant", "z"),
        (4, 0, "user", "a"), (4, 0, "user", "a"), (4, 0, "assistant", "b"),
    ]
    df = spark.createDataFrame([(*t, 1, 2) for t in turns], "conv_id long, turn int, role string, text string, pieces int, last int")
    examples = chat_format.prefix_examples(df)
    read = examples.where("last").select("conv_id", chat_format.read_turns(examples["text"]).alias("t")).collect()
    for row in read:
        mine = sorted(
            ((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == row.conv_id)
        )
        assert [(x.role, x.text) for x in row.t] == [(r, t) for _, _, r, t in mine]
    assert len(read) == 5
    for row in examples.select("*", chat_format.trained_text(examples).alias("reply")).collect():
        assert row.text[row.loss_start : row.loss_end] == (row.reply.replace("\\", "\\\\").replace("<|", "<\\|"))
        assert row.text.count("<|im_start|>") == row.target
    assert chat_format.prefix_examples(df.limit(0)).count() == 0


def _brute(texts):
    sets = []
    for _, t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(texts):
        least[find(k)] = min(i, least.get(find(k), i))
    return {(i, len(sets[k]), least[find(k)], i == least[find(k)]) for k, (i, _) in enumerate(texts)}


@pytest.mark.parametrize("region", [48, 3])
def test_near_copies(documents, monkeypatch, region):
    monkeypatch.setattr(near_dedup, "REGION", region)  # small regions take the ways of crowded ones
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(4000)}"
    texts = [(k, t) for k, t in enumerate(ODD) if t is None or len(t) < 100]
    shared = [word() for _ in range(60)]
    for group in range(6):
        base = [word() for _ in range(120)]
        for _ in range(25):
            copy = [word() if rng.random() < 0.02 * (group % 3) else w for w in base]
            texts.append((len(texts) + 100, " ".join(copy)))
    texts += [(1000 + k, " ".join(shared + [word() for _ in range(25 + k)])) for k in range(30)]
    texts.append((2000, texts[20][1].upper()))
    rows = near_dedup.near_copies(documents(texts)).collect()
    assert len(rows) == len(texts) and set(map(tuple, rows)) == _brute(texts)
    null = near_dedup.near_copies(documents([(None, texts[20][1]), *texts[20:22]])).where("doc_id is null").first()
    assert null.component_id is None and null.kept
    assert near_dedup.near_copies(documents([])).count() == 0


def test_ids_that_repeat_lose_no_document(documents):
    rng = random.Random(8)
    a, b, c, x = (" ".join(f"w{rng.randrange(9000)}" for _ in range(60)) for _ in range(4))
    rows = [(5, a), (9, a), (3, b), (5, b), (7, c), (8, b + " more"), (2, x), (None, a), (None, None), (4, None)]
    kept = [(None, a), (None, None), (2, x), (3, b), (4, None), (5, a), (7, c)]
    order = lambda rows: sorted(map(str, rows))
    df = documents(rows)
    got = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_copies(df).collect() if r.doc_id is not None}
    # Text b under id 5 does not tie what is near to it to the copies of a.
    assert got == {(5, 5, True), (9, 5, False), (3, 3, True), (5, 3, False), (7, 7, True), (8, 3, False), (2, 2, True), (4, 4, True)}
    left = near_dedup.drop_near_copies(df)
    assert left.columns == df.columns and order((r.doc_id, r.text) for r in left.collect()) == order(kept)
    left = exact_dedup.drop_copies(documents([(5, a), (9, a), (3, b), (5, b.upper()), (7, c), (7, c), (None, c), (1, None), (2, "")]))
    want = [(9, a), (5, b.upper()), (7, c), (7, c), (None, c), (2, "")]
    assert order((r.doc_id, r.text) for r in left.collect()) == order(want)


@pytest.mark.parametrize("bits", [64, 1 << 15])
def test_rows_are_dropped_exactly_where_bitmaps_are_crowded(spark, documents, monkeypatch, bits):
    for name in ("bitmap_of", "perhaps_in"):
        plain = getattr(common, name)
        monkeypatch.setattr(common, name, lambda *given, plain=plain: plain(*given, bits=bits))
    texts = [(k, f"text {k % 97}") for k in range(400)]
    df = documents(texts)
    verdicts = df.select("doc_id", common.row_mark(df["text"]).alias("mark"), (df["doc_id"] % 3 != 0).alias("kept"))
    left = common.drop_rows(df, "doc_id", "text", verdicts, "test")
    assert sorted(r.doc_id for r in left.collect()) == [k for k in range(400) if k % 3]
    assert common.drop_rows(df.limit(0), "doc_id", "text", verdicts, "test").count() == 0


def test_no_text_is_shuffled(documents):
    for drop in (exact_dedup.drop_copies, near_dedup.drop_near_copies):
        plan = drop(documents([(k, f"some words here {k % 5}") for k in range(40)]))._jdf.queryExecution().executedPlan().toString()
        rows = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line or "SortMergeJoin" in line]
        assert not rows, rows


def test_queries_against_sql(spark, small):
    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    for name, sql in (("op1_exact_dedup", EXACT_SQL), ("op5_chat_format", CHAT_SQL)):
        df = ENTRIES[name].run(spark, small)
        cursor = con.execute(sql)
        order = [d[0] for d in cursor.description]
        assert sorted(map(tuple, df.select(order).collect())) == sorted(cursor.fetchall())


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "secret_scan", "packing"]
    copies = docs.limit(5).selectExpr("doc_id + 1000000 AS doc_id", "upper(text) AS text", "lang", "source", "n_chars")
    planted = spark.createDataFrame([(2_000_000, "fine words about a token=abcdef123456 here", "en", "s", 40)], docs.schema)
    given = docs.unionByName(copies).unionByName(planted)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        given = stage(spark, given, small)
        assert given.columns == docs.columns
    rows = {r.doc_id: r.text for r in given.collect()}
    assert rows[2_000_000] == "fine words about a [SECRET] here"
    assert len(rows) < docs.count() + 6
    assert corpus_pipeline.run(spark, small).columns[-2:] == ["sequence_id", "offset"]


def test_bounded_memory_leaves_the_rows(spark):
    """What a worker may remember in the pipeline, far below the words there are."""
    import numpy as np
    import pandas as pd

    from rowtide.llm import near_dedup, toxicity

    texts = pd.Series([f"some word{k} and an evil{k % 3} thing" for k in range(400)] + ["", "evilly"])
    model = np.zeros((toxicity.SYMBOLS,) * 3, np.float32)
    score = lambda **bound: list(toxicity._score(toxicity.Evidence(model, {"evil": 2.0}, 1.0, -1.0), texts, **bound))
    few = score(remembered=7)
    assert few == score() and len(set(few)) > 1
    assert len(next(iter(toxicity._LATEST.values()))[1]) > 7
    score(remembered=7)
    assert len(next(iter(toxicity._LATEST.values()))[1]) <= 7
    assert near_dedup._WORDS.limit == near_dedup.WORDS_REMEMBERED <= 200_000


def test_learning_is_bounded_and_freed_memory_is_returned(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from rowtide.llm import common, toxicity

    returned = []
    monkeypatch.setattr(common, "give_back", lambda: returned.append(1))
    monkeypatch.setattr(common, "_REMEMBERING", [])
    model = np.zeros((toxicity.SYMBOLS,) * 3, np.float32)
    texts = pa.array([f"some word{'x' * (k % 50)} and a thing" for k in range(200)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array([1] * 200), texts], ["key", "toxic", "text"])
    found = lambda **bound: list(toxicity._document_features(model, {}, iter([batch]), **bound))
    whole = found()
    assert len(common._REMEMBERING[0]) > 20 and not returned
    assert found(remembered=40) == whole
    assert len(common._REMEMBERING[0]) <= 10 and len(returned) == 1
