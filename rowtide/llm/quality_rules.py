"""Quality by a learned decision list: threshold conjunctions grown and pruned on labelled statistics.

Sequential covering: a rule is grown on two thirds of the labelled rows by adding the threshold
with the best information gain, pruned on the other third, and what it covers is removed before
the next one. The list becomes one ordered conditional expression.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import let, stored, text_or_empty

WINDOW = 5
FEATURES = [
    "n_words",
    "word_length",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "mark_share",
    "distinct_share",
    "line_words",
]
CUTS = 15
MAX_RULES, MAX_CONDITIONS = 8, 4
# A rule rejects documents, so it stays only if this share of what it covers is labelled low.
LEAST_PRECISION = 0.8
SPACES = r"[\x20\x09-\x0D]+"


def _window_hash(window: Column) -> Column:
    return F.xxhash64(window)


def _repeat_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more.

    A window is two 64-bit hashes of different seeds and its place, sorted; neighbours of equal hashes whose
    words are equal too are repeats. What they cover is added up from left to right.
    """
    window = lambda i: F.slice(words, i + 1, F.lit(WINDOW))
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.struct(_window_hash(window(i)).alias("a"), F.xxhash64(F.lit(1), window(i)).alias("b"), i.alias("at")),
    )

    def repeats(ordered: Column) -> Column:
        def equal(x: Column, y: Column) -> Column:
            return (x["a"] == y["a"]) & (x["b"] == y["b"]) & (window(x["at"]) == window(y["at"]))

        return F.filter(
            ordered,
            lambda x, k: F.coalesce(equal(x, F.get(ordered, k + 1)), F.lit(False))
            | F.coalesce(equal(x, F.get(ordered, k - 1)), F.lit(False)),
        )

    def cover(acc: Column, i: Column) -> Column:
        return F.struct(
            (acc["n"] + i + WINDOW - F.greatest(i, acc["upto"])).alias("n"), (i + WINDOW).alias("upto")
        )

    places = F.sort_array(F.transform(let(F.sort_array(hashes), repeats), lambda x: x["at"].cast("bigint")))
    zero = F.lit(0).cast("bigint")
    covered = F.aggregate(places, F.struct(zero.alias("n"), zero.alias("upto")), cover, lambda acc: acc["n"])
    return F.when(F.size(words) > WINDOW, covered).otherwise(zero)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the base counts ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``, and FEATURES.

    Words are runs of anything but space and \\t to \\r. Null and empty texts have zero counts. Repeated rows and
    null ids are rows of their own, other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    split = texts.select(
        "doc_id",
        "text",
        F.array_remove(F.split("text", SPACES), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    counted = split.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").alias("_lines"),
        F.size(F.array_distinct("words")).alias("_distinct"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("_upper"),
        F.regexp_count("text", F.lit("[0-9]")).alias("_digits"),
        F.regexp_count("text", F.lit("[!?]")).alias("_marks"),
    )
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    lines = F.greatest("_lines", F.lit(1))
    share = lambda a, b: (F.col(a) / b).cast("double")
    return counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        share("word_chars", words).alias("word_length"),
        share("n_symbols", chars).alias("symbol_share"),
        share("n_dup_lines", lines).alias("dup_line_share"),
        share("n_repeat_words", words).alias("repeat_share"),
        share("_upper", chars).alias("upper_share"),
        share("_digits", chars).alias("digit_share"),
        share("_marks", chars).alias("mark_share"),
        share("_distinct", words).alias("distinct_share"),
        share("n_words", lines).alias("line_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


Condition = tuple[str, bool, float]  # feature, whether at least (else below), threshold


def _binned(condition: tuple[int, bool, int]) -> Column:
    feature, at_least, cut = condition
    value = F.get("bins", F.lit(feature))
    return value > cut if at_least else value <= cut


def _all_of(conditions: list) -> Column:
    return reduce(lambda a, b: a & b, map(_binned, conditions), F.lit(True))


def _grow(rows: DataFrame, conditions: list, n_cuts: list[int]) -> tuple[int, bool, int] | None:
    """The next threshold, by information gain; one aggregation to at most features x cuts rows."""
    counts = (
        rows.where(_all_of(conditions))
        .select("low", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("feature", "bin")
        .agg(F.sum("low").alias("low"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    by = {}
    for r in counts:
        by.setdefault(r["feature"], {})[r["bin"]] = (r["low"], r["n"])
    best, best_gain = None, 0.0
    for feature, bins in sorted(by.items()):
        low, n = (sum(x) for x in zip(*bins.values()))
        if not low or low == n:
            return None
        before = math.log2(low / n)
        below_low = below_n = 0
        for cut in range(n_cuts[feature]):
            a, b = bins.get(cut, (0, 0))
            below_low, below_n = below_low + a, below_n + b
            for at_least, p, m in ((False, below_low, below_n), (True, low - below_low, n - below_n)):
                if p and m < n and (gain := p * (math.log2(p / m) - before)) > best_gain:
                    best, best_gain = (feature, at_least, cut), gain
    return best


def learn_rules(statistics: DataFrame, labels: DataFrame, label_col: str = "quality") -> list[list[Condition]]:
    """The decision list for low quality (label 0): conjunctions in the order they were learned.

    ``labels`` has ``doc_id`` and the label; rows without label or id are not learned from, a repeated id
    counts once per pair of rows. Thresholds are quantiles of the labelled rows. Every labelled row takes
    part: those with crc32(doc_id) mod 3 = 0 prune, the others grow. Without labels of both kinds
    the list is empty.
    """
    known = labels.where(F.col(label_col).isNotNull()).select(
        F.col("doc_id").alias("_id"), (F.col(label_col) == 0).cast("int").alias("low")
    )
    joined = statistics.join(known, statistics["doc_id"] == known["_id"]).where(~base_failed())
    labelled = stored(
        joined.select("low", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0).alias("prune"), *FEATURES),
        "labelled",
    )
    levels = [(k + 1) / (CUTS + 1) for k in range(CUTS)]
    quantiles = labelled.approxQuantile(FEATURES, levels, 0.002)
    cuts = [sorted(set(q)) for q in quantiles]
    if not any(cuts):
        return []
    # A value's bin is the number of thresholds it reaches.
    bins = F.array(*[sum(((F.col(f) >= c).cast("int") for c in cs), F.lit(0)) for f, cs in zip(FEATURES, cuts)])
    left = stored(labelled.select("low", "prune", bins.alias("bins")), "bins")
    n_cuts, rules = [len(c) for c in cuts], []
    while len(rules) < MAX_RULES:
        conditions = []
        while len(conditions) < MAX_CONDITIONS:
            more = _grow(left.where("not prune"), conditions, n_cuts)
            if more is None:
                break
            conditions.append(more)
        if not conditions:
            break
        sums = []
        for k in range(1, len(conditions) + 1):
            covered = _all_of(conditions[:k])
            sums += [F.count_if(covered).alias(f"n{k}"), F.sum(F.when(covered, F.col("low"))).alias(f"p{k}")]
        seen = left.where("prune").agg(*sums).first()
        worth = [
            ((2 * (seen[f"p{k}"] or 0) - seen[f"n{k}"]) / max(seen[f"n{k}"], 1), -k) for k in range(1, len(conditions) + 1)
        ]
        k = -max(worth)[1]
        if (seen[f"p{k}"] or 0) < LEAST_PRECISION * max(seen[f"n{k}"], 1):
            break
        rule = conditions[:k]
        rules.append([(FEATURES[f], at_least, cuts[f][cut]) for f, at_least, cut in rule])
        left = left.where(~_all_of(rule))
    return rules


def decision(rules: list[list[Condition]]) -> Column:
    """True where no rule of the list fires: one ordered conditional expression."""
    out = None
    for rule in rules:
        tests = [F.col(f) >= c if at_least else F.col(f) < c for f, at_least, c in rule]
        fires = reduce(lambda a, b: a & b, tests)
        out = F.when(fires, False) if out is None else out.when(fires, False)
    return F.lit(True) if out is None else out.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, ``base_failed`` and ``kept`` per row of ``docs``; one reading of the texts.

    ``kept`` is false where the base test fails or a learned rule fires. Nulls, empty texts and repeated
    rows as in ``document_statistics`` and ``learn_rules``; an empty table gives an empty result.
    """
    statistics = stored(document_statistics(docs, id_col, text_col), "statistics")
    rules = learn_rules(statistics, labels)
    return statistics.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & decision(rules)).alias("kept"),
    )
