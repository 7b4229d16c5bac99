"""Personal data: regular expressions as seeds, and lexical patterns learned around them.

Seeds are the matches of the base expressions. Around every identifier-like word (one with a digit
or an at sign) stand lexical patterns: the two words before it, and the word before with the
word after. Patterns and instances form a graph; scores go from instances to patterns and back in
rounds, each a pair of aggregations. Patterns of high confidence then mark unseen identifiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import let, stored, text_or_empty
from rowtide.llm.spans import count_kind, keyed, listed, match_spans, match_steps, running, spans_of

KINDS = ["email", "ip", "card", "phone", "context"]
ROUNDS = 3
# A pattern is trusted at this score, which needs some distinct seeds besides a high share of them.
CONFIDENT = 0.8
SMOOTHING = 1.0

_LABEL = "[A-Za-z0-9-]"
_LOCAL = "[A-Za-z0-9._%+-]"
# The contract's expressions, written so that long runs take neither square time nor deep recursion:
# a run is entered at its start (or where the last match ended), and repeated groups are one character wide.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?=\.{_LABEL})(?:(?={_LABEL}|\.{_LABEL})[A-Za-z0-9.-])+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:(?=[0-9]|[\x20-][0-9])[0-9\x20-])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"\A(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\z"
_WORD = r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D]*?[0-9@])[^\x20\x09-\x0D]++"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits holds."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> list[Column]:
    """Accepted matches of the four base kinds, each an array of (start, end, text)."""

    def card(span: Column) -> Column:
        return let(_digits(span["text"]), lambda d: F.length(d).between(13, 19) & luhn(d))

    def found(kind: str, hint: Column, accept) -> Column:
        none = F.array().cast("array<struct<start:bigint,end:bigint,text:string>>")
        spans = match_spans(text, PATTERNS[kind])
        return F.when(hint, F.filter(spans, accept) if accept else spans).otherwise(none)

    return [
        found("email", F.contains(text, F.lit("@")), None),
        found("ip", text.rlike(r"[0-9]\.[0-9]"), lambda s: s["text"].rlike(_BYTE)),
        found("card", text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), card),
        found("phone", F.contains(text, F.lit("+")), lambda s: F.length(_digits(s["text"])).between(9, 15)),
    ]


def _bare(word: Column) -> Column:
    return F.lower(F.regexp_replace(word, r"\A[^\p{L}\p{N}@+]+|[^\p{L}\p{N}]+\z", ""))


def _seen(text: Column, seeds: Column) -> Column:
    """Identifier-like words with their neighbours and whether a seed lies in them.

    ``seeds`` are sorted by kind, then start. Words of the text are kept once, those a neighbour can be:
    all of the identifiers, and of what lies between them the first and the last two.
    """

    def near(step: Column) -> Column:
        own = F.when(step["found"].isNull(), F.array().cast("array<string>")).otherwise(_words(step["found"]))
        return F.struct(let(_words(step["gap"]), _outer).alias("gap"), own.alias("own"))

    def seen(steps: Column, parts: Column) -> Column:
        words = F.flatten(F.transform(parts, lambda p: F.concat(p["gap"], p["own"])))
        upto = running(F.transform(parts, lambda p: (F.size(p["gap"]) + F.size(p["own"])).cast("bigint")))

        def one(words: Column, upto: Column, halves: Column) -> Column:
            own = lambda i: F.size(F.get(parts, i)["own"])
            return F.transform(spans_of(steps), lambda span, i: word(span, words, F.get(upto, i), own(i), halves))

        return let(words, lambda w: let(upto, lambda u: let(_halves(F.size(seeds)), lambda h: one(w, u, h))))

    def word(span: Column, words: Column, upto: Column, own: Column, halves: Column) -> Column:
        place = lambda k: F.get(words, (upto - own + k).cast("int"))
        last, after = F.coalesce(place(-1), F.lit("")), F.coalesce(F.get(words, upto.cast("int")), F.lit(""))
        return F.struct(
            span["start"].alias("start"),
            span["end"].alias("end"),
            _bare(span["text"]).alias("instance"),
            F.array_join(F.array(place(-2), place(-1)), " ").alias("two_before"),
            F.concat(last, F.lit(" _ "), after).alias("around"),
            _touched(span, seeds, halves).alias("seed"),
        )

    return let(match_steps(text, _WORD), lambda steps: let(F.transform(steps, near), lambda parts: seen(steps, parts)))


def _words(part: Column) -> Column:
    return F.filter(F.split(F.lower(part), r"[^\p{L}\p{N}_:=#]+"), lambda w: w != "")


def _outer(words: Column) -> Column:
    """The first and the last two words."""
    return F.when(F.size(words) > 3, F.concat(F.slice(words, 1, 1), F.slice(words, -2, 2))).otherwise(words)


def _halves(n: Column) -> Column:
    """The powers of two up to ``n``, the greatest first: steps of a search by halves."""
    return F.transform(F.sequence(F.length(F.bin(n)) - 1, F.lit(0), F.lit(-1)), lambda b: F.pow(F.lit(2), b).cast("int"))


def _touched(span: Column, seeds: Column, halves: Column) -> Column:
    """Whether a seed overlaps the span: seeds of one kind do not overlap, so a search by halves finds the one to compare."""
    n = F.size(seeds)

    def of_kind(kind: int) -> Column:
        def passed(seed: Column) -> Column:
            return (seed["kind"] < kind) | ((seed["kind"] == kind) & (seed["end"] <= span["start"]))

        def go(at: Column, step: Column) -> Column:
            return F.when((at + step <= n) & passed(F.get(seeds, at + step - 1)), at + step).otherwise(at)

        first = F.get(seeds, F.aggregate(halves, F.lit(0), go))
        return F.coalesce((first["kind"] == kind) & (first["start"] < span["end"]), F.lit(False))

    touched = of_kind(0)
    for kind in range(1, len(PATTERNS)):
        touched = touched | of_kind(kind)
    return (n > 0) & touched


def score_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``pattern`` and ``score`` from distinct (pattern, instance, seed) edges.

    An instance that is a seed scores 1. In each round a pattern scores the sum of its instances'
    scores over their number (smoothed, so that a pattern needs several), and another instance the
    noisy-or of its patterns. Only sums per key are exchanged, never a group.
    """
    scored = edges.withColumn("value", F.col("seed").cast("double"))
    patterns = None
    for turn in range(rounds):
        patterns = stored(
            scored.groupBy("pattern").agg(
                (F.sum("value") / (F.count(F.lit(1)) + SMOOTHING)).alias("score"), F.sum(F.col("seed").cast("int")).alias("seeds")
            ),
            f"patterns-{turn}",
        )
        if turn + 1 == rounds:
            break
        # Only patterns of some score move an instance; the rest add nothing to its noisy-or.
        moved = (
            edges.where(~F.col("seed"))
            .join(patterns.where("score >= 0.5"), "pattern")
            .groupBy("instance")
            .agg((1 - F.exp(F.sum(F.log(1 - F.least(F.col("score"), F.lit(0.999)))))).alias("moved"))
        )
        scored = edges.join(moved, "instance", "left").withColumn(
            "value", F.when(F.col("seed"), 1.0).otherwise(F.coalesce(F.col("moved"), F.lit(0.0)))
        )
    return patterns.select("pattern", "score")


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans``: array of (kind, start, end), by kind, then start, one row per input row.

    ``kind`` is a place in ``KINDS``: the four base kinds, then words found by their context that no base
    span touches. Offsets are code points, ends exclusive. Null and empty texts have no spans. Repeated
    rows and null ids are rows of their own (rows are followed by a number of their own), other
    columns are not read, an empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kinds = base_spans(F.col("text"))
    based = texts.select(
        "doc_id",
        "text",
        F.sort_array(F.concat(*[keyed(spans, k, by_start=False) for k, spans in enumerate(kinds)])).alias("base"),
    )
    rows = stored(
        based.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "base",
            F.when(F.col("text").rlike("[0-9@]"), _seen(F.col("text"), F.col("base"))).alias("words"),
        ),
        "private",
    )
    words = rows.select("row", F.explode("words").alias("w")).select("row", "w.*")
    uses = words.select("row", "start", "end", "instance", "seed", F.explode(F.array("two_before", "around")).alias("pattern"))
    edges = stored(
        uses.where("instance != ''").groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges"
    )
    trusted = score_patterns(edges).where(F.col("score") >= CONFIDENT).select("pattern")
    unseen = uses.where(~F.col("seed")).join(trusted, "pattern")
    found = unseen.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct(F.lit(len(KINDS) - 1).alias("kind"), "start", "end"))).alias("context")
    )
    return rows.join(found, "row", "left").select(
        "doc_id", F.when(F.col("context").isNull(), F.col("base")).otherwise(F.concat("base", "context")).alias("spans")
    )


def private_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digests of the base spans, and all spans, per document."""
    spans, n = F.col("spans"), len(PATTERNS)
    return find_private(docs, id_col, text_col).select(
        "doc_id",
        *[count_kind(spans, k).alias(f"n_{KINDS[k]}") for k in range(n)],
        F.sha2(listed(F.filter(spans, lambda s: s["kind"] < n), KINDS), 256).alias("base_sha256"),
        listed(spans, KINDS).alias("spans"),
    )
