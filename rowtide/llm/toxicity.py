"""Toxicity of text that hides its words: noisy-channel decoding, then a score of what was restored.

Words written with look-alike signs, spaced-out letters or repeated letters span a lattice of readings; a
character trigram model of the whole corpus picks the likeliest path (Viterbi). Words without such signs
have one reading. Restored words and their beginnings are the evidence of the score.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
import uuid
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.bpe import Memo
from rowtide.llm.common import remember_only, small_batches, stored, text_or_empty

# Labelled rows that the score is fitted on, at most: those of the smallest hash of the id.
TRAIN_ROWS = 30_000
LEAST_DOCUMENTS = 5
# Near-copies share a weight of one. Minima of hashes of a text's word triples, in bands, find them; they agree to this share.
BANDS, BAND = 20, 3
LIKE = 0.4
# A beginning that one word accounts for to this share says no more than the word.
EXPLAINED = 0.9
# Chance that some feature without meaning is taken for evidence.
ALPHA = 0.01
THRESHOLD = 0.7
HELD_OUT = (3, 1)
BEGINNINGS = (4, 5, 6, 7)
REMEMBERED = 600_000
# Looking for more skeletons than this takes longer than to restore the words.
FEW = 300

# Readings of look-alike signs, and what a reading costs in log probability.
READINGS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "£": "l",
}
SIGN_COST, GAP_COST, KEPT_GAP_COST, DOUBLE_COST = -0.7, -0.2, -2.0, -0.7
_GAPS = ".-_*"  # and white space
_SIGNS = re.escape("".join(READINGS))
# A sign, gap or letter twice: the word may hide another.
_HIDDEN = re.compile(rf"[{_SIGNS}{re.escape(_GAPS)}\s]|([^\W\d_])\1")
_UNIT, _GAP = rf"[^\W_{_SIGNS}]|[{_SIGNS}]", re.escape(_GAPS)
_SPACED = re.compile(
    rf"(?<![^\s\"'`(\[{{<])(?:{_UNIT})(?:[{_GAP}]*\s[\s{_GAP}]*(?:{_UNIT})){{2,}}(?!\w)"
)
_CHUNK = re.compile(r"\S+")
_LETTERS = re.compile(r"[^\W\d_]+")
_EDGES = ".,;:?!\"'`()[]{}<>"
_PLAIN_EDGES = "".join(set(_EDGES) - set(READINGS))
# Readings of a sign fall in one class, so that a text and all its readings have one skeleton.
_CLASSES = str.maketrans({sign: letters[0] for sign, letters in READINGS.items()} | {"l": "i", "£": "i"})
_DROPPED = re.compile(rf"[\s{_GAP}]+")
_RUN = re.compile(r"(.)\1+", re.DOTALL)

# Letters are folded to a-z (1 to 26), all else is a boundary (0).
SYMBOLS = 27


@functools.cache
def _fold_table() -> np.ndarray:
    table = np.zeros(0x250, np.uint8)
    for code in range(len(table)):
        base = unicodedata.normalize("NFD", chr(code).lower())[:1]
        if "a" <= base <= "z":
            table[code] = ord(base) - 96
    return table


def fold(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    table = _fold_table()
    return np.where(codes < len(table), table[np.minimum(codes, len(table) - 1)], 0).astype(np.int64)


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    remember_only({})
    total = np.zeros(SYMBOLS**3, np.int64)
    for batch in batches:
        for text in batch.column("text"):
            c = fold(f"  {text.as_py()} ")
            total += np.bincount((c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:], minlength=SYMBOLS**3)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["gram", "n"])


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probabilities of a letter after two others, from all texts; 27**3 numbers whatever the input."""
    counts = (
        small_batches(docs).select(text_or_empty(text_col).alias("text"))
        .mapInArrow(_count_trigrams, "gram long, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    table = np.full(SYMBOLS**3, 0.1)
    for row in counts:
        table[row["gram"]] += row["n"]
    table = table.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    return np.log(table / table.sum(axis=2, keepdims=True)).astype(np.float32)


def _lattice(word: str) -> list[list[tuple[str, float]]]:
    """The readings of each sign or run of equal letters: (letters, cost)."""
    out, i = [], 0
    while i < len(word):
        j = i + 1
        while j < len(word) and word[j] == word[i]:
            j += 1
        sign, n = word[i], j - i
        if sign in READINGS:
            choices = [(letter, SIGN_COST) for letter in READINGS[sign]]
            choices += [(letter * 2, SIGN_COST + DOUBLE_COST) for letter in READINGS[sign] if n > 1]
            choices.append((sign * n, 0.0) if sign.isdigit() else (" ", KEPT_GAP_COST))
        elif sign in _GAPS or sign.isspace():
            choices = [("", GAP_COST), (" ", KEPT_GAP_COST)]
        elif n >= 3:
            choices = [(sign, 0.0), (sign * 2, DOUBLE_COST)]
        elif n == 2:
            choices = [(sign * 2, 0.0), (sign, DOUBLE_COST)]
        else:
            choices = [(sign, 0.0)]
        out.append(choices)
        i = j
    return out


def _symbol(letter: str) -> int:
    code = ord(letter)
    table = _fold_table()
    return int(table[code]) if code < len(table) else 0


def decode(word: str, model: np.ndarray) -> str:
    """The likeliest reading of a word's lattice under the character model (Viterbi).

    A state is the last two symbols; of the readings that reach a state the best is kept.
    """
    paths = {(0, 0): (0.0, None)}
    for choices in _lattice(word.lower()):
        reached: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, path) in paths.items():
            for letters, cost in choices:
                s, x, y = score + cost, a, b
                for letter in letters:
                    z = _symbol(letter)
                    s += float(model[x, y, z])
                    x, y = y, z
                if (x, y) not in reached or reached[x, y][0] < s:
                    reached[x, y] = (s, (path, letters))
        paths = reached
    _, path = max(((s + float(model[a, b, 0]), p) for (a, b), (s, p) in paths.items()), key=lambda q: q[0])
    parts = []
    while path is not None:
        path, letters = path
        parts.append(letters)
    return "".join(reversed(parts))


def skeleton(text: str) -> str:
    """Gaps dropped, signs and letters by class, runs as one: what a word's disguises have in common with it."""
    return _RUN.sub(r"\1", _DROPPED.sub("", text.lower().translate(_CLASSES)))


def skeletons(features: Iterable[str]) -> re.Pattern:
    """Found in the skeleton of each chunk that has a reading with one of ``features``."""
    return re.compile("|".join(sorted(re.escape(skeleton(f)) for f in features)) or r"(?!)")


def features_of(chunk: str, model: np.ndarray, possible: re.Pattern | None = None) -> tuple[str, ...]:
    """Words of a white-space separated chunk, restored where it hides any, and their beginnings.

    Chunks without ``possible`` in their skeleton need not be restored. A sign at the edge of a chunk may be
    punctuation as well, so both are read.
    """
    low = chunk.lower()
    words = _LETTERS.findall(low)
    if words or len(chunk.split(None, 1)) > 1:
        bare = {low.strip(_EDGES), low.strip(_PLAIN_EDGES)}
        hiding = [b for b in bare if _HIDDEN.search(b)]
        if hiding and (possible is None or possible.search(skeleton(low))):
            for b in hiding:
                words += _LETTERS.findall(decode(b, model))
    out = set()
    for word in words:
        if len(word) >= 3:
            out.add(word)
            out.update([f"{word[:n]}-" for n in BEGINNINGS if len(word) > n])
    return tuple(out)


def chunks_of(text: str) -> set[str]:
    """The distinct chunks of a text, and its runs of spaced-out letters."""
    return {*text.split(), *_SPACED.findall(text)}


def placed_chunks(text: str) -> Iterator[tuple[str, str, str]]:
    """The chunks of ``chunks_of`` at each of their places: (chunk before, chunk, chunk after)."""
    chunks = ["", *text.split(), ""]
    yield from zip(chunks, chunks[1:], chunks[2:])
    if runs := list(_SPACED.finditer(text)):
        places = [m.start() for m in _CHUNK.finditer(text)]
        for run in runs:
            # Counted from the left: chunks that start before the run, and before its end.
            k, n = bisect_left(places, run.start()), bisect_left(places, run.end())
            k -= k > 0 and places[k - 1] + len(chunks[k]) > run.start()  # the run's first chunk has an opening sign
            yield chunks[k], run[0], chunks[n + 1]


@dataclass(frozen=True)
class Evidence:
    """What the score is made of: the character model, weights of features, and a logistic of their sum."""

    model: np.ndarray
    weights: dict[str, float]
    slope: float
    bias: float
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    @functools.cached_property
    def possible(self) -> re.Pattern:
        return skeletons(self.weights)

    def of_chunk(self, chunk: str) -> tuple[str, ...]:
        return tuple(f for f in features_of(chunk, self.model, self.possible) if f in self.weights)

    def total(self, found: set[str]) -> float:
        """The three strongest count in full: beginnings of one word say the same thing."""
        return sum(sorted((self.weights[f] for f in found), reverse=True)[:3])

    def probability(self, total: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * total + self.bias))))


_LATEST: dict[str, tuple[Evidence, Memo]] = {}


def _score(evidence: Evidence, texts: pd.Series, remembered: int = REMEMBERED) -> pd.Series:
    if evidence.name not in _LATEST:
        _LATEST.clear()  # one model at a time in a worker
        _LATEST[evidence.name] = evidence, Memo(evidence.of_chunk, remembered)
    evidence, memo = _LATEST[evidence.name]
    remember_only(memo)
    out = []
    for text in texts:
        found: set[str] = set()
        for features in map(memo.__getitem__, chunks_of(text or "")):
            if features:
                found.update(features)
        out.append(evidence.probability(evidence.total(found)))
    return pd.Series(out, dtype="float64")


def toxicity_score(text: Column, evidence: Evidence, remembered: int = REMEMBERED) -> Column:
    """Score from 0 to 1 of a text column; null and empty texts score as texts without evidence."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return _score(evidence, texts, remembered)

    return score(text_or_empty(text))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Minima of ``BANDS * BAND`` hashes over a text's word triples; texts without a triple have none."""
    remember_only({})
    rng = np.random.default_rng(27)
    times = rng.integers(1, 1 << 63, (BANDS * BAND, 1), np.uint64) * np.uint64(2) + np.uint64(1)
    mix = rng.integers(1, 1 << 63, 3, np.uint64) * np.uint64(2) + np.uint64(1)
    for batch in batches:
        out = []
        for text in batch.column("text"):
            words = np.array([xxhash.xxh3_64_intdigest(w) for w in text.as_py().lower().split()], np.uint64)
            if len(words) < 3:
                out.append(None)
                continue
            triples = np.unique(words[:-2] * mix[0] ^ words[1:-1] * mix[1] ^ words[2:] * mix[2])
            triples ^= triples >> np.uint64(32)
            least = np.full(BANDS * BAND, np.iinfo(np.uint32).max, np.uint32)
            for at in range(0, len(triples), 4096):
                hashes = (triples[at : at + 4096] * times) >> np.uint64(32)
                least = np.minimum(least, hashes.min(axis=1).astype(np.uint32))
            out.append(least.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("toxic"), pa.array(out, pa.binary())], ["key", "toxic", "signature"]
        )


def _shares(rows: list) -> dict[int, float]:
    """By key, one over the number of near-copies of the same label, where a text has any.

    Texts that agree in a band are compared with the band's first and with the one before.
    """
    rows = [r for r in rows if r["signature"] is not None]
    if not rows:
        return {}
    signatures = np.stack([np.frombuffer(r["signature"], np.uint32) for r in rows])
    toxic = np.array([r["toxic"] for r in rows])
    of = list(range(len(rows)))

    def find(i: int) -> int:
        while of[i] != i:
            of[i] = of[of[i]]
            i = of[i]
        return i

    for band in range(0, BANDS * BAND, BAND):
        keys = signatures[:, band : band + BAND]
        order = np.lexsort((*keys.T, toxic))
        same = (keys[order[1:]] == keys[order[:-1]]).all(axis=1) & (toxic[order[1:]] == toxic[order[:-1]])
        starts = np.maximum.accumulate(np.where(np.append(False, same), 0, np.arange(len(order))))
        at = np.flatnonzero(same) + 1
        for other in (starts[at], at - 1):
            alike = (signatures[order[at]] == signatures[order[other]]).mean(axis=1) >= LIKE
            for i, j in zip(order[at[alike]].tolist(), order[other[alike]].tolist()):
                of[find(i)] = find(j)
    groups = [find(i) for i in range(len(rows))]
    size = Counter(groups)
    return {r["key"]: 1 / size[g] for r, g in zip(rows, groups) if size[g] > 1}


def _document_features(
    model: np.ndarray,
    shares: dict[int, float],
    batches: Iterator[pa.RecordBatch],
    wanted: frozenset[str] | None = None,
    remembered: int = REMEMBERED,
):
    memo = Memo(lambda c: features_of(c, model), remembered // 4)
    if wanted is not None:
        possible = skeletons(wanted) if len(wanted) <= FEW else None
        memo.make = lambda c: tuple(f for f in features_of(c, model, possible) if f in wanted)
    remember_only(memo)
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("key", "toxic"))
        for text, key, toxic in zip(batch.column("text"), *columns):
            yield set().union(*map(memo.__getitem__, chunks_of(text.as_py()))), toxic, shares.get(key, 1.0)


def _count_features(model, shares, wanted, remembered: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, float] = defaultdict(float)

    def flush() -> pa.RecordBatch:
        names, n = list(counts), list(counts.values())
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(n, pa.float64())], ["feature", "n"])

    for found, _, share in _document_features(model, shares, batches, wanted, remembered):
        for feature in found:
            counts[feature] += share
        if len(counts) > 1_000_000:
            yield flush()
    yield flush()


def _contexts(model, wanted: frozenset[str], remembered: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wanted features with a hash of the chunks before and after them and the label, distinct within a batch."""
    possible = skeletons(wanted)
    memo = Memo(lambda c: tuple(f for f in features_of(c, model, possible) if f in wanted), remembered // 4)
    remember_only(memo)
    for batch in batches:
        seen = set()
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
            for before, chunk, after in placed_chunks(text.as_py()):
                if features := memo[chunk]:
                    around = xxhash.xxh3_64_intdigest(f"{before} {after}") >> 1
                    seen.update((f, around, toxic) for f in features)
        names, around, toxic = zip(*seen) if seen else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(around, pa.int64()), pa.array(toxic, pa.int32())],
            ["feature", "around", "toxic"],
        )


def _totals(
    model, shares, weights: dict[int, dict[str, float]], remembered: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Evidence totals, rounded to tenths, by label; ``weights`` by label, too."""
    counts: dict[tuple[int, int], float] = defaultdict(float)
    by_label = {label: Evidence(model, w, 1.0, 0.0) for label, w in weights.items()}
    wanted = frozenset().union(*weights.values())
    for found, toxic, share in _document_features(model, shares, batches, wanted, remembered):
        known = by_label[toxic].weights
        counts[round(10 * by_label[toxic].total({f for f in found if f in known})), toxic] += share
    keys = list(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in keys], pa.int64()), pa.array([t for _, t in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.float64())],
        ["total", "toxic", "n"],
    )


def _logistic(points: list[tuple[float, int, float]]) -> tuple[float, float]:
    """Slope and bias by Newton steps on (value, label, count), with a weak pull to slope 1."""
    x = np.array([p[0] for p in points], float)
    y = np.array([p[1] for p in points], float)
    n = np.array([p[2] for p in points], float)
    rate = (n * y).sum() / n.sum()
    w = np.array([1.0, math.log(max(rate, 1e-6) / max(1 - rate, 1e-6))])
    design = np.stack([x, np.ones_like(x)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(w @ design, -30, 30)))
        gradient = design @ (n * (y - p)) - 0.02 * np.array([w[0] - 1.0, 0.0])
        hessian = (design * (n * p * (1 - p))) @ design.T + np.diag([0.02, 1e-3])
        w = w + np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return float(w[0]), float(w[1])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_rows: int = TRAIN_ROWS,
    remembered: int = REMEMBERED,
) -> Evidence:
    """The character model from all ``docs``, and evidence from labelled rows outside the held-out third.

    At most ``train_rows`` labelled rows are used (those of the smallest hash of the id); equal texts and
    near-copies of one label count once. A feature counts no more often, with either label, than it has
    different neighbours there. It is evidence if it is in five toxic texts or more, toxic in most, and more often
    so than chance allows over all features looked at. Null labels and ids are not learned from; without
    toxic or other rows the score is one constant. A quarter of ``remembered`` bounds the chunks a Python worker keeps.
    """
    model = character_model(docs, text_col)
    modulus, held = HELD_OUT
    fold_of = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & (fold_of != held))
        .select(F.col("doc_id").alias("_id"), F.col(label_col).cast("int").alias("_toxic"))
        .orderBy(F.xxhash64("_id"))
        .limit(train_rows)
    )
    # At most train_rows pairs of numbers, so they may be broadcast.
    train = stored(
        docs.join(F.broadcast(chosen), docs[id_col] == chosen["_id"])
        .select(text_or_empty(docs[text_col]).alias("text"), chosen["_toxic"].alias("toxic"))
        .groupBy("text")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("key", F.monotonically_increasing_id()),
        "train",
    )
    signed = train.mapInArrow(_signatures, "key long, toxic int, signature binary").collect()
    shares, n = _shares(signed), defaultdict(float)
    for r in signed:
        n[r["toxic"]] += shares.get(r["key"], 1.0)
    toxic, clean = n[1], n[0]
    if not toxic or not clean:
        return Evidence(model, {}, 0.0, -2.0 if not toxic else 2.0)

    def count(label: int, wanted: frozenset[str] | None) -> DataFrame:
        return (
            train.where(F.col("toxic") == label)
            .mapInArrow(functools.partial(_count_features, model, shares, wanted, remembered), "feature string, n double")
            .groupBy("feature")
            .agg(F.sum("n").alias("n"))
        )

    frequent = {r["feature"]: r["n"] for r in count(1, None).where(F.col("n") > LEAST_DOCUMENTS - 0.01).collect()}
    others = {r["feature"]: r["n"] for r in count(0, frozenset(frequent)).collect()}
    rate, bound = toxic / (toxic + clean), math.log(max(len(frequent), 1) / ALPHA)

    def weigh(a: float, b: float) -> float | None:
        if a < 0.99:
            return None
        share = a / (a + b)
        surprise = a * math.log(share / rate) + (b * math.log((1 - share) / (1 - rate)) if b else 0.0)
        if share <= max(rate, 0.5) or surprise <= bound:
            return None
        return math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))

    evident = frozenset(f for f, a in frequent.items() if weigh(a, others.get(f, 0)) is not None)
    varied = (
        train.mapInArrow(functools.partial(_contexts, model, evident, remembered), "feature string, around long, toxic int")
        .distinct()
        .groupBy("feature")
        .agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("other"))
        .collect()
    )
    for r in varied:
        frequent[r["feature"]] = min(frequent[r["feature"]], r["toxic"])
        others[r["feature"]] = min(others.get(r["feature"], 0), r["other"])
    kept = {f for f in evident if frequent[f] > LEAST_DOCUMENTS - 0.01}
    for word in [f for f in kept if not f.endswith("-")]:
        for n in BEGINNINGS:
            start = f"{word[:n]}-"
            if len(word) > n and start in kept and frequent[word] >= EXPLAINED * frequent[start]:
                kept.discard(start)
    frequent = {f: a for f, a in frequent.items() if f in kept}

    def weights_without(a_less: int, b_less: int) -> dict[str, float]:
        found = {f: weigh(a - a_less, max(others.get(f, 0) - b_less, 0)) for f, a in frequent.items()}
        return {f: w for f, w in found.items() if w is not None}

    # The logistic is fitted on totals that leave each text's own counts out.
    left_out = {0: weights_without(0, 1), 1: weights_without(1, 0)}
    totals = (
        train.mapInArrow(functools.partial(_totals, model, shares, left_out, remembered), "total long, toxic int, n double")
        .groupBy("total", "toxic")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    slope, bias = _logistic([(r["total"] / 10, r["toxic"], r["n"]) for r in totals])
    return Evidence(model, weights_without(0, 0), max(slope, 0.05), bias)


def score_documents(docs: DataFrame, evidence: Evidence, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from 0.7 on) per row.

    Null and empty texts score as texts without evidence. Repeated rows are rows of their own, a
    null id is not held out, other columns are not read, an empty table gives an empty result.
    """
    modulus, held = HELD_OUT
    fold_of = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus
    return (
        docs.select(F.col(id_col).alias("doc_id"), toxicity_score(docs[text_col], evidence).alias("score"))
        .select(
            "doc_id",
            F.coalesce(fold_of == held, F.lit(False)).alias("held_out"),
            "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        )
    )


def drop_toxic(
    docs: DataFrame, evidence: Evidence, text_col: str = "text", remembered: int = REMEMBERED
) -> DataFrame:
    """``docs`` without the rows that are predicted toxic; all columns stay.

    ``remembered`` bounds the chunks a Python worker keeps; it changes time and memory, never the rows.
    """
    return docs.where(toxicity_score(docs[text_col], evidence, remembered) < THRESHOLD)
