"""Byte-pair encoding and decoding: merge ranks in a priority queue over a linked list of symbols."""

from __future__ import annotations

import functools
import gc
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import text_or_empty

# Fixed value: words of the vocabulary file's split rule.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
SPACE = regex.compile(r"[\t-\r \x85\xa0  -     　]+")
# Python's split() also cuts at these, the vocabulary's rule does not.
ODD_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
PIECE_LIMIT = 200_000
WORD_LIMIT = 800_000
# Longer pieces are worked out each time, so that what is remembered is bounded in bytes too.
SHORT = 64


def byte_letters() -> list[str]:
    """Letter that stands for each byte: itself if printable, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class Memo(dict):
    """Values by piece of text; emptied when ``limit`` entries are held, so that memory stays bounded."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= SHORT:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def pieces(text: str) -> list[str]:
    """Cut at white space, which no token of the vocabulary spans."""
    if any(c in text for c in ODD_SPACE):
        return [p for p in SPACE.split(text) if p]
    return text.split()


class WordBpe:
    """The vocabulary of a tokenizers file with word ends: lower case, white space dropped."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if not model.get("end_of_word_suffix"):
            raise ValueError(f"{path}: not a vocabulary with word ends; its split rule is another one")
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.strings = {i: s for s, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s for s, i in self.special.items()}
        self.inner = [self.ids[c] for c in byte_letters()]
        self.last = [self.ids[c + self.end] for c in byte_letters()]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {(self.ids[a], self.ids[b]): (r, self.ids[a + b]) for r, (a, b) in enumerate(pairs)}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.words = Memo(self._word, WORD_LIMIT)
        self.texts = Memo(self._texts, PIECE_LIMIT)

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply the pair of lowest rank, leftmost first, until none is left.

        The queue holds rank and place as one number. ``following`` and ``before`` link the symbols
        still there; an entry whose pair has changed since is stale and skipped.
        """
        n, find = len(symbols), self.merges.get
        symbols.append(-1)  # end mark: in no pair
        following, before = list(range(1, n + 1)), list(range(-1, n))
        queue = []
        for i, pair in enumerate(zip(symbols, symbols[1:])):
            if found := find(pair):
                queue.append(found[0] * n + i)
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            rank, i = divmod(pop(queue), n)
            j = following[i]
            found = find((symbols[i], symbols[j]))
            if found is None or found[0] != rank:
                continue
            merged = symbols[i] = found[1]
            symbols[j] = -1
            k = following[i] = following[j]
            if k < n:
                before[k] = i
                if found := find((merged, symbols[k])):
                    push(queue, found[0] * n + i)
            h = before[i]
            if h >= 0 and (found := find((symbols[h], merged))):
                push(queue, found[0] * n + h)
        out, i = [], 0
        while i < n:
            out.append(symbols[i])
            i = following[i]
        return out

    def _word(self, word: str) -> tuple[int, ...]:
        data = word.encode("utf-8")
        return tuple(self.merge([self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]))

    def _plain(self, piece: str) -> list[int]:
        if not piece.isascii():
            # Letter by letter: a word-final sigma is no case of its own here.
            piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
        words = self.words
        return [i for w in WORD.findall(piece.lower()) for i in words[w]]

    def encode_piece(self, piece: str) -> list[int]:
        if self.cut is None or "<|" not in piece:
            return self._plain(piece)
        out = []
        for k, part in enumerate(self.cut.split(piece)):
            out += [self.special[part]] if k % 2 else self._plain(part)
        return out

    def encode(self, text: str) -> list[int]:
        return [i for p in pieces(text) for i in self.encode_piece(p)]

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings in a row, a space between, as a file without decoder prescribes."""
        return " ".join([self.strings[i] for i in ids])

    def _texts(self, piece: str) -> tuple[int, str, str]:
        ids = self.encode_piece(piece)
        return len(ids), " ".join(map(str, ids)), self.decode(ids)

    def both(self, text: str) -> tuple[int, str, str]:
        """Number of ids, their decimal list, and the decoded text."""
        parts = list(map(self.texts.__getitem__, pieces(text)))
        return sum([p[0] for p in parts]), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts])


@functools.lru_cache(maxsize=4)
def load(path: str) -> WordBpe:
    """One per Python worker."""
    gc.set_threshold(500_000)  # what is remembered holds no cycles
    return WordBpe(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and the text decoded from them: ``doc_id``, ``ids`` (array<int>), ``decoded``.

    Null text gives no ids and an empty text. Rows are independent: repeated rows and null ids pass
    through, other columns are not read, an empty table gives an empty result. ``path`` is a
    vocabulary file that every executor can open.
    """
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(
        functools.partial(_ids_of, path), "doc_id long, ids array<int>, decoded string"
    )


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_decode`` with count and SHA-256 digests in place of ids and text; same rules."""
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(
        functools.partial(_digests_of, path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _ids_of(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bpe = load(path)
    for batch in batches:
        ids = [bpe.encode(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(map(bpe.decode, ids), pa.string())],
            ["doc_id", "ids", "decoded"],
        )


def _digests_of(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bpe, sha = load(path), hashlib.sha256
    for batch in batches:
        counts, ids, decoded = [], [], []
        for text in batch.column("text"):
            n, listed, back = bpe.both(text.as_py())
            counts.append(n)
            ids.append(sha(listed.encode()).hexdigest())
            decoded.append(sha(back.encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )
