"""Secrets by regular expressions behind a trigram inverted index.

Every rule's expression is turned into a Boolean query over the trigrams that each of its
matches must hold. The index has a posting (trigram, document) for the trigrams of all queries;
the postings are intersected per document, and only candidates are searched with the expressions.
Rules without a mandatory trigram search every text.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as parser
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import bitmap_of, perhaps_in, short_reads, stored, text_or_empty
from rowtide.llm.spans import count_kind, keyed, listed, match_spans

MAX_STRINGS = 32
# Trigrams that share a bigint when a document's postings are intersected.
WORD = 63
MASK = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    """``least`` is the shortest accepted ``group``; shorter matches are dropped after they are consumed."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
# A run shorter than least cannot hold an accepted match of these rules, whose classes are runs.
_SHORTENED = {BASE_RULES[1]: r"AKIA[A-Z0-9]{16,}", BASE_RULES[2]: r"[0-9a-f]{24,}"}
# Public formats of keys and tokens.
ADDED_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("code_host_token", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
)


def _all(queries: list) -> object:
    kept = [q for q in dict.fromkeys(queries) if q is not True]
    return True if not kept else kept[0] if len(kept) == 1 else ("and", *kept)


def _plain(query: object) -> bool:
    """Whether all trigrams of the query must be there."""
    return isinstance(query, str) or (query is not True and query[0] == "and" and all(map(_plain, query[1:])))


def _any(queries: list) -> object:
    if True in queries or not queries:
        return True
    sets = {q: trigrams_of(q) for q in queries if _plain(q)}
    # An alternative that asks for all another does, and more, adds nothing.
    kept = [q for q in dict.fromkeys(queries) if q not in sets or not any(sets[p] < sets[q] for p in sets)]
    return kept[0] if len(kept) == 1 else ("or", *kept)


def _of_strings(strings: set[str]) -> object:
    """Trigrams of one of the strings must be there; True if one is too short to say."""
    return _any([_all([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _walk(nodes) -> tuple[set[str] | None, object]:
    """The strings a part may match if they are few, and what else its matches must hold."""
    strings, queries, exact = {""}, [], True

    def end_run() -> None:
        nonlocal strings, exact
        queries.append(_of_strings(strings))
        strings, exact = {""}, False

    def extend(more: set[str]) -> None:
        nonlocal strings
        longer = {a + b for a in strings for b in more}
        if len(longer) > MAX_STRINGS:
            end_run()
            longer = more if len(more) <= MAX_STRINGS else {""}
        strings = longer

    for op, value in nodes:
        if op is sre.LITERAL:
            extend({chr(value).lower()})
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in value) and len(value) <= 6:
            extend({chr(v).lower() for _, v in value})
        elif op is sre.SUBPATTERN:
            inner, query = _walk(value[3])
            queries.append(query)
            extend(inner) if inner is not None else end_run()
        elif op is sre.BRANCH:
            parts = [_walk(part) for part in value[1]]
            if all(inner is not None for inner, _ in parts):
                extend(set().union(*(inner for inner, _ in parts)))
            else:
                end_run()
                queries.append(_any([_all([q, _of_strings(i or {""})]) for i, q in parts]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, part = value
            inner, query = _walk(part)
            if least == 0 and most == 1 and inner is not None:
                extend({""} | inner)
            else:
                if least:
                    queries.append(query)
                    if inner is not None:
                        extend(inner)
                end_run()
        elif op not in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            end_run()
    if exact:
        return strings, _all(queries)
    queries.append(_of_strings(strings))
    return None, _all(queries)


def trigram_query(pattern: str) -> object:
    """Nested ("and", ...), ("or", ...) and lower-case trigrams; True where nothing is mandatory."""
    strings, query = _walk(parser.parse(pattern))
    return _all([query, _of_strings(strings)]) if strings is not None else query


def trigrams_of(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1:]))


def _holds(query: object, has: Callable[[str], Column]) -> Column:
    if isinstance(query, str):
        return has(query)
    parts = [_holds(q, has) for q in query[1:]]
    out = parts[0]
    for part in parts[1:]:
        out = (out & part) if query[0] == "and" else (out | part)
    return out


def trigram_index(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (trigram, doc_id) of the given lower-case trigrams."""
    lower = F.lower(text_or_empty(text_col))
    texts = docs.select(F.col(id_col).alias("doc_id"), lower.alias("text"))
    present = F.array_compact(F.array(*[F.when(F.contains(F.col("text"), F.lit(t)), F.lit(t)) for t in trigrams]))
    return texts.select(F.explode(present).alias("trigram"), "doc_id")


def postings_by_document(postings: DataFrame, trigrams: list[str]) -> DataFrame:
    """``doc_id`` and the bits of its trigrams: bit ``k % WORD`` of ``bits_{k // WORD}`` is set for the k-th of ``trigrams``.

    Bits are summed up in fixed-width buffers; no set of strings is built for a document.
    """
    place = (F.array_position(F.array(*map(F.lit, trigrams)), F.col("trigram")) - 1).alias("place")
    words = range(-(-len(trigrams) // WORD))
    bits = [F.expr(f"bit_or(if(place div {WORD} = {w}, shiftleft(1L, cast(place % {WORD} as int)), 0L))") for w in words]
    return postings.select("doc_id", place).groupBy("doc_id").agg(*[b.alias(f"bits_{w}") for w, b in zip(words, bits, strict=True)])


def candidates_of(by_document: DataFrame, queries: list, trigrams: list[str]) -> DataFrame:
    """``doc_id`` of the documents whose trigrams satisfy one of ``queries``."""
    places = {t: divmod(k, WORD) for k, t in enumerate(trigrams)}

    def has(trigram: str) -> Column:
        word, bit = places[trigram]
        return F.col(f"bits_{word}").bitwiseAND(F.lit(1 << bit).cast("bigint")) != 0

    candidate = F.lit(False)
    for query in queries:
        candidate = candidate | _holds(query, has)
    return by_document.where(candidate).select("doc_id")


def _rule_spans(text: Column, rule: Rule) -> Column:
    pattern = _SHORTENED.get(rule, rule.pattern)
    spans = match_spans(text, pattern)
    if not rule.least:
        return spans
    value = (lambda s: F.regexp_extract(s["text"], rule.pattern, rule.group)) if rule.group else (lambda s: s["text"])
    return F.filter(spans, lambda s: F.length(value(s)) >= rule.least)


def find_secrets(
    docs: DataFrame,
    rules: tuple[Rule, ...] = (*BASE_RULES, *ADDED_RULES),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``row`` (a struct of the input row) and ``spans``: array of (start, kind, end), by start, then kind.

    ``kind`` is a rule's place in ``rules``; offsets are code points, ends exclusive. Null and empty texts
    have no spans. Repeated rows and null ids are rows of their own; no row is moved, lost or
    joined by its id, and columns of any name stay inside ``row``. An empty table gives an empty result.
    """
    docs = short_reads(docs)
    queries = {rule: trigram_query(rule.pattern) for rule in rules}
    indexed = [rule for rule in rules if queries[rule] is not True]
    trigrams = sorted(set().union(*(trigrams_of(queries[r]) for r in indexed)))
    postings = stored(trigram_index(docs, trigrams, id_col, text_col), "postings")
    candidates = candidates_of(postings_by_document(postings, trigrams), [queries[r] for r in indexed], trigrams)

    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(id_col).alias("id"),  # its own type, as in the index: hashes of other types differ
        text_or_empty(text_col).alias("text"),
    )
    marked = perhaps_in(rows, "id", stored(bitmap_of(candidates, "doc_id"), "candidates"), "candidate")
    text = F.col("text")
    by_start = []
    for k, rule in enumerate(rules):
        found = keyed(_rule_spans(text, rule), k, by_start=True)
        if rule in indexed:
            found = F.when(F.col("candidate"), found).otherwise(F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
        by_start.append(found)
    return marked.select("row", F.sort_array(F.concat(*by_start)).alias("spans"))


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digests of the base rules' spans, and all spans, per document."""
    rules = (*BASE_RULES, *ADDED_RULES)
    kinds, n = [r.kind for r in rules], len(BASE_RULES)
    found = find_secrets(docs.select(id_col, text_col), rules, id_col, text_col)
    spans = F.col("spans")
    return found.select(
        F.col("row")[id_col].alias("doc_id"),
        *[count_kind(spans, k).alias(f"n_{kinds[k]}") for k in range(n)],
        F.sha2(listed(F.filter(spans, lambda s: s["kind"] < n), kinds), 256).alias("base_sha256"),
        listed(spans, kinds).alias("spans"),
    )


def mask_secrets(docs: DataFrame, mask: str = MASK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every secret replaced by ``mask``; overlapping spans become one. All rows and columns stay."""
    found = find_secrets(docs, id_col=id_col, text_col=text_col)
    text = F.col("row")[text_col]
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, span: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (span["start"] - acc["at"]).cast("int"))
        inside = span["start"] < acc["at"]
        return F.struct(
            F.greatest(acc["at"], span["end"]).alias("at"),
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], gap, F.lit(mask))).alias("out"),
        )

    def rest(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))

    masked = F.when(F.size("spans") > 0, F.aggregate("spans", start, step, rest)).otherwise(text)
    return found.select(
        *[(masked if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns]
    )
