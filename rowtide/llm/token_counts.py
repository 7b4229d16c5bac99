"""Token counts by a tokenizer library inside Arrow functions; only lengths leave the workers.

Texts are cut where no token can cross (not at all for rules of which no such place is known), the cut pieces are sent to the library in batches of
about equal bytes, and counts of pieces that come again are remembered up to a bound.
"""

from __future__ import annotations

import functools
import gc
import itertools
import json
import os
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.bpe import SHORT, Memo, byte_letters, pieces
from rowtide.llm.common import text_or_empty

BATCH_BYTES = 1 << 18
BLOCK_CHARS = 1 << 20
LONG_CHARS = 1 << 16
REMEMBERED = 1_600_000
# Characters of plain pieces that go to the library as one text.
JOINED_CHARS = 1 << 14
# A split rule and the normalisation before it. Under them a plain piece - signs, or letters (of old,
# so that any version of Unicode knows them) with signs behind them or none - holds a word for its letters and one
# for its signs, or more where a letter falls apart, never less.
LETTERS_OR_SIGNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN_STEPS = ["NFC", "Replace", "Lowercase"]
PLAIN = re.compile(r"([!-&(-/:;=>?@\[-`{-~]+)|[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+([!-&(-/:;=>?@\[-`{-~]+)?")
# A plain piece whose letters stay whole and single when lower-cased (one does not): the word of its letters and that of its signs.
LETTERS_AND_SIGNS = re.compile(r"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f]*)([!-&(-/:;=>?@\[-`{-~]*)")
SIGNS_REMEMBERED = 4096
# What the byte-level step makes of each byte of a word.
BYTE_LETTERS = dict(enumerate(byte_letters()))


def words_drop_space(spec: str) -> bool:
    """Whether the file's rule removes white space between words, so that any of it is a safe cut."""
    return '"behavior":"Removed","invert":true' in spec.replace(" ", "")


def space_starts_word(spec: str) -> bool:
    """Whether a space between two letters always starts a word of the file's rule, alone or as its first sign.

    True for the byte-level rule if nothing rewrites the text or marks its start, and no added token holds
    or takes along a space. Of other rules this is not known.
    """
    rule = json.loads(spec)
    before = rule.get("pre_tokenizer") or {}
    return (
        before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space", True)
        and rule.get("normalizer") is None
        and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in rule["added_tokens"])
    )


def word_ends(spec: str) -> np.ndarray | None:
    """By id, whether it ends a word, where the file's rule is known to cut plain pieces as said of ``PLAIN``; else None."""
    rule = json.loads(spec)
    model, cut, steps = rule["model"], rule.get("pre_tokenizer") or {}, rule.get("normalizer") or {}
    end, vocab = model.get("end_of_word_suffix"), model.get("vocab")
    split, *then = cut.get("pretokenizers") or [{}]
    if (
        not end
        or model.get("dropout")
        or split.get("pattern") != {"Regex": LETTERS_OR_SIGNS}
        or [(t["type"], t["use_regex"], t["add_prefix_space"]) for t in then] != [("ByteLevel", False, False)]
        or [t["type"] for t in steps.get("normalizers") or []] != PLAIN_STEPS
        or any("<" not in t["content"] for t in rule["added_tokens"])
        or any(c + end not in vocab for c in byte_letters())
    ):
        return None
    out = np.zeros(max(vocab.values()) + 1, bool)
    out[[i for token, i in vocab.items() if token.endswith(end)]] = True
    return out


class Library:
    """A tokenizers (.json) or sentencepiece (.model) file, as batches of strings to lists of ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already fill the cores
        # What is remembered holds no cycles; the default would walk through it again and again.
        gc.set_threshold(500_000)
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda batch: model.encode(batch, num_threads=1)
            self.by_word = self.lower = self.long_cut = False  # pieces see the text's start, so it stays whole
            self.ends = self.words = None
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.encode = lambda batch: [e.ids for e in model.encode_batch_fast(batch, add_special_tokens=False)]
            with open(path, encoding="utf-8") as file:
                spec = file.read()
            self.by_word, self.lower = words_drop_space(spec), '"Lowercase"' in spec
            # Otherwise a token starts anew at a space between two lower-case letters, if the rule says so.
            self.long_cut = space_starts_word(spec) and regex.compile(r"(?<=\p{Ll})(?= \p{Ll})")
            self.ends = word_ends(spec) if self.by_word else None
            self.words = model.model if self.ends is not None else None

    def cut(self, text: str) -> list[str]:
        if self.by_word:
            if self.lower and text.isascii() and "<" not in text:  # no special string that case could make
                text = text.lower()
            return pieces(text)
        if len(text) <= LONG_CHARS or not self.long_cut:
            return [text]
        out, start = [], 0
        for at in (m.start() for m in self.long_cut.finditer(text)):
            if at - start >= LONG_CHARS:
                out.append(text[start:at])
                start = at
        return [*out, text[start:]]


    def id_bytes(self, batch: list[str]) -> list[bytes]:
        """The ids of each piece as little-endian 32-bit numbers; plain pieces are encoded as one text.

        No token crosses white space, so the ids of a joined text are those of its pieces in a row, and the ends of
        words tell them apart. If there are more ends than plain pieces make, the pieces go one by one.
        """
        words = [(m.lastindex or 1) if (m := PLAIN.fullmatch(p)) else 0 for p in batch] if self.ends is not None else []
        plain = [p for p, n in zip(batch, words) if n]
        if plain:
            ids = np.asarray(self.encode([" ".join(plain)])[0], "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            last = np.cumsum([n for n in words if n])
            if len(ends) == last[-1] and ends[-1] == len(ids):
                data, stops = ids.tobytes(), (4 * ends[last - 1]).tolist()
                found = iter([data[a:b] for a, b in zip([0, *stops], stops)])
                others = iter(self._each([p for p, n in zip(batch, words) if not n]))
                return [next(found if n else others) for n in words]
        return self._each(batch)

    def word_bytes(self, word: str) -> bytes:
        """The ids of lower-case letters or of signs of a plain piece: the rule leaves them as they are, so the model alone is asked."""
        if not word.isascii():
            word = word.encode("utf-8").decode("latin-1").translate(BYTE_LETTERS)
        ids = [token.id for token in self.words.tokenize(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _each(self, batch: list[str]) -> list[bytes]:
        return [np.asarray(ids, "<u4").tobytes() for ids in self.encode(batch)] if batch else []


@functools.lru_cache(maxsize=4)
def load(path: str) -> Library:
    return Library(path)


def balanced(texts: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Batches of about ``limit`` bytes, whatever the number of texts; a longer text is a batch."""
    batch, held = [], 0
    for text in texts:
        if batch and held + len(text) > limit:
            yield batch
            batch, held = [], 0
        batch.append(text)
        held += len(text)
    if batch:
        yield batch


class Remembered:
    """What ``value`` makes of the ids of each piece, asked from the library once while remembered."""

    def __init__(self, library: Library, value: Callable, limit: int):
        self.library, self.value, self.limit, self.known = library, value, limit, {}

    def of(self, parts: list[str]) -> list:
        known = self.known
        try:
            return list(map(known.__getitem__, parts))
        except KeyError:
            pass
        fresh = {}
        for batch in balanced([p for p in dict.fromkeys(parts) if p not in known]):
            fresh.update(zip(batch, map(self.value, self.library.encode(batch))))
        out = [known[p] if p in known else fresh[p] for p in parts]
        if len(known) + len(fresh) > self.limit:
            known.clear()
        known.update((p, v) for p, v in fresh.items() if len(p) <= SHORT)
        return out


class RecentIds:
    """The ids of pieces, as bytes, asked from the library once while remembered.

    Of at most ``limit`` pieces those not used of late are forgotten when half of it is used, the frequent ones stay.
    """

    def __init__(self, library: Library, limit: int):
        self.library, self.half = library, limit // 2
        self.clear()

    def clear(self) -> None:
        self.known, self.before = {}, {}

    def of(self, parts: list[str]) -> list[bytes]:
        out = list(map(self.known.get, parts))
        places = [k for k, ids in enumerate(out) if ids is None]
        if places:
            fresh = self._fresh(dict.fromkeys([parts[k] for k in places]))
            for k in places:
                out[k] = fresh[parts[k]]
            if len(self.known) + len(fresh) > self.half:
                self.before, self.known = self.known, {}
            if len(fresh) > self.half:
                fresh = dict(itertools.islice(fresh.items(), self.half))
            self.known.update(fresh)
            for p in [p for p in fresh if len(p) > SHORT]:
                del self.known[p]
        return out

    def _fresh(self, missing: dict[str, None]) -> dict[str, bytes]:
        before = self.before
        fresh = {p: before[p] for p in missing if p in before}
        for batch in balanced([p for p in missing if p not in fresh], JOINED_CHARS):
            fresh.update(zip(batch, self.library.id_bytes(batch)))
        return fresh


class RecentWords(RecentIds):
    """``RecentIds`` where ``LETTERS_AND_SIGNS`` holds: such pieces are put together from the ids of their two words.

    A word remembered from another piece is not asked for again; others are asked from the model, without the steps before it.
    """

    def clear(self) -> None:
        super().clear()
        self.signs = Memo(self.library.word_bytes, SIGNS_REMEMBERED)

    def _fresh(self, missing: dict[str, None]) -> dict[str, bytes]:
        known, before, signs_of, make = self.known, self.before, self.signs, self.library.word_bytes
        split, fresh, others = LETTERS_AND_SIGNS.fullmatch, {}, []
        for p in missing:
            ids = before.get(p)
            if ids is None:
                if not (m := split(p)):
                    others.append(p)
                    continue
                letters, signs = m.groups()
                if letters:
                    letters = letters.lower()
                    ids = known.get(letters) or before.get(letters) or fresh.get(letters) or make(letters)
                    if signs:
                        ids += signs_of[signs]
                else:
                    ids = signs_of[signs] if signs else b""
            fresh[p] = ids
        for batch in balanced(others):
            fresh.update(zip(batch, self.library.id_bytes(batch)))
        return fresh


def values_of(library: Library, known: Remembered | RecentIds, texts: pa.Array) -> Iterator[list]:
    """The values of each text's pieces; texts go to the library in blocks of about equal size."""
    block, held = [], 0
    for k, text in enumerate(texts):
        text = text.as_py()
        block.append(library.cut(text))
        held += len(text)
        if held >= BLOCK_CHARS or k + 1 == len(texts):
            values, at = known.of(list(itertools.chain.from_iterable(block))), 0
            for parts in block:
                yield values[at : at + len(parts)]
                at += len(parts)
            block, held = [], 0


@functools.lru_cache(maxsize=4)
def lengths(path: str) -> Remembered:
    return Remembered(load(path), len, REMEMBERED)


def count_tokens(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``) of each row.

    As the library counts: no begin, end or added special tokens; special strings inside a text as
    is its default; nothing truncated or padded. Null text counts as empty. Repeated rows and null ids
    pass through, other columns are not read, an empty table gives an empty result.
    """
    return docs.select(
        F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")
    ).withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(
        functools.partial(_counts, path, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


def _counts(path: str, limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    library, known = load(path), lengths(path)
    for batch in batches:
        counts = [sum(v) for v in values_of(library, known, batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("n_bytes"),
                pa.array(counts, pa.int64()),
                pa.array([n > limit for n in counts], pa.bool_()),
            ],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )
