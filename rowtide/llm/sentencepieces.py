"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the model crosses a whitespace marker that follows other text, so a text falls into chunks -
markers and the word behind them - that are segmented apart. Texts are cut into *slices* (what one task
reads, at most ``SLICE_BYTES``); a slice numbers its distinct chunks, and a text becomes the list of its
chunks' numbers. Every distinct chunk of all slices is segmented once, and the ids go back to their places
by slice and number. Slices, lists and tables are compressed, since they are written and shuffled.
"""

from __future__ import annotations

import array
import functools
import hashlib
import heapq
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import small_batches, stored, text_or_empty

MARK = "▁"
# Bytes of text in a slice, but for one longer text: bounds what a task holds at a time.
SLICE_BYTES = 48 << 20
# What a text counts besides, so that very many empty ones end a slice too.
ROW_BYTES = 64
# Bytes of chunks in a bucket of the table.
BUCKET_BYTES = 32 << 20
# Kinds of pieces and models, and field numbers, of a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE_MODEL = 2
PIECES, TRAINING, NORMALISING = 1, 2, 3


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        wire = key & 7
        if wire == 0:
            yield key >> 3, number()
            continue
        length = {1: 8, 5: 4}.get(wire) or number()
        yield key >> 3, data[at : at + length]
        at += length


class PieceModel:
    """A byte-pair model with byte fallback whose normalisation only marks spaces; others are refused."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            parts = list(_fields(file.read()))
        training = {k: v for part, data in parts if part == TRAINING for k, v in _fields(data)}
        rules = {k: v for part, data in parts if part == NORMALISING for k, v in _fields(data)}
        # Fields of the two specifications, with their defaults.
        if training.get(3, 1) != BPE_MODEL or not training.get(35, 0) or training.get(24, 0):
            raise ValueError(f"{path}: not a byte-pair model with byte fallback")
        if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
            raise ValueError(f"{path}: normalises more than spaces")
        self.prefixed = bool(rules.get(3, 1))
        self.pieces: list[str] = []
        self.bytes: list[int] = [0] * 256
        self.byte_of: dict[int, int] = {}
        self.hidden: set[int] = set()
        scores: dict[str, float] = {}
        for i, data in enumerate(data for part, data in parts if part == PIECES):
            piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(data))
            text, kind = piece[1].decode("utf-8"), piece[3]
            self.pieces.append(text)
            if kind == NORMAL:
                scores[text] = struct.unpack("<f", piece[2])[0]
            elif kind == BYTE:
                self.bytes[int(text[3:5], 16)] = i
                self.byte_of[i] = int(text[3:5], 16)
            elif kind in (CONTROL, UNKNOWN):
                self.hidden.add(i)
            else:
                raise ValueError(f"{path}: has pieces of kind {kind}")
        self.ids = {p: i for i, p in enumerate(self.pieces) if p in scores}
        order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {p: order[score] for p, score in scores.items()}
        # Where a piece holds a marker behind other text, no cut is safe and a text is one chunk.
        crossing = any(MARK in p.lstrip(MARK) for p in self.ids)
        self.cut = (lambda text: [text]) if crossing else re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall
        self.id_bytes = "<u2" if len(self.pieces) <= 1 << 16 else "<u4"

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text in order; joined they are its marked form."""
        if not text:
            return []
        return self.cut((MARK if self.prefixed else "") + text.replace(" ", MARK))

    def segment(self, chunk: str) -> list[int]:
        """Join the neighbours whose piece scores best, leftmost first, until no two make a piece."""
        symbols, n, rank = list(chunk), len(chunk), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i, 2) for i in range(n - 1) if (r := rank(symbols[i] + symbols[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, length = heapq.heappop(queue)
            j = after[i]
            # An entry is stale where either side has been joined to something since.
            if not symbols[i] or j >= n or len(symbols[i]) + len(symbols[j]) != length:
                continue
            symbols[i] += symbols[j]
            symbols[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank(symbols[i] + symbols[k])) is not None:
                    heapq.heappush(queue, (r, i, len(symbols[i]) + len(symbols[k])))
            h = before[i]
            if h >= 0 and (r := rank(symbols[h] + symbols[i])) is not None:
                heapq.heappush(queue, (r, h, len(symbols[h]) + len(symbols[i])))
        out: list[int] = []
        for symbol in filter(None, symbols):
            found = self.ids.get(symbol)
            out += [found] if found is not None else [self.bytes[b] for b in symbol.encode("utf-8")]
        return out

    def plain(self, ids: list[int]) -> str:
        """The text of a chunk's ids; markers become spaces, bytes in a row the text they spell."""
        out, spelt = [], bytearray()
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                spelt.append(byte)
                continue
            if spelt:
                out.append(spelt.decode("utf-8", "replace"))
                spelt.clear()
            out.append("" if i in self.hidden else self.pieces[i])
        return ("".join(out) + spelt.decode("utf-8", "replace")).replace(MARK, " ")

    def whole(self, parts: list[str]) -> str:
        """The text of its chunks' texts: the space put before it goes again."""
        text = "".join(parts)
        return text[1:] if self.prefixed and text.startswith(" ") else text


@functools.lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    """One per Python worker."""
    return PieceModel(path)


def _packed(numbers, kind: str = "<u4", effort: int = 3) -> bytes:
    """Numbers compressed, all lowest bytes first: the high ones are mostly alike."""
    array = np.asarray(numbers, dtype=kind)
    planes = array.view(np.uint8).reshape(len(array), array.itemsize).T
    return zstandard.compress(planes.tobytes(), effort)


def _unpacked(data: bytes, kind: str = "<u4") -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _joined(chunks: list[str], effort: int = 9) -> bytes:
    """Chunks hold no space, so a space parts them."""
    return zstandard.compress(" ".join(chunks).encode("utf-8"), effort)


def _parted(data: bytes) -> list[str]:
    return zstandard.decompress(data).decode("utf-8").split(" ")


def _numbered(seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each chunk occurs, by first appearance, and the chunks' order by that: the commonest is number 0."""
    counts = np.bincount(seen)
    return counts, _by_count(counts)


def _by_count(counts: np.ndarray) -> np.ndarray:
    return np.argsort(-counts.astype(np.int64), kind="stable")


def _codes_packed(seen: np.ndarray, order: np.ndarray) -> bytes:
    """Chunk numbers in text order, one more each; a chunk that appears first is 0, as the counts tell its number."""
    number = np.empty(len(order), np.uint32)
    number[order] = np.arange(1, len(order) + 1, dtype=np.uint32)
    sent = number[seen]
    sent[np.unique(seen, return_index=True)[1]] = 0
    return _packed(sent, effort=9)


def _codes_unpacked(codes: bytes, counts: bytes) -> np.ndarray:
    sent, order = _unpacked(codes).astype(np.int64), _by_count(_unpacked(counts))
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    new = sent == 0
    sent -= 1
    sent[new] = number[: new.sum()]
    return sent


SLICE = ["slice", "ids", "sizes", "codes", "counts", "chunks", "n_bytes"]


def _code(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each slice: its texts' ids, how many chunks each has, the chunks' numbers, counts and the chunks."""
    model = load(path)
    number = TaskContext.get().partitionId() << 32
    known: dict[str, int] = {}
    ids: list[pa.Array] = []
    sizes, codes, size = [], array.array("I"), 0

    def out() -> pa.RecordBatch:
        listed, chunks = pa.concat_arrays(ids), list(known)
        seen = np.array(codes, np.uint32)
        counts, order = _numbered(seen)
        chunks = [chunks[i] for i in order.tolist()]
        columns = [
            pa.array([number], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(listed)], pa.int32()), listed),
            pa.array([_packed(sizes)], pa.binary()),
            pa.array([_codes_packed(seen, order)], pa.binary()),
            pa.array([_packed(counts)], pa.binary()),
            pa.array([_joined(chunks) if chunks else None], pa.binary()),
            pa.array([sum(map(len, chunks))], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, SLICE)

    for batch in batches:
        begun = 0
        for k, text in enumerate(batch.column("text")):
            text = text.as_py()
            if size and size + len(text) > SLICE_BYTES:
                ids.append(batch.column("doc_id").slice(begun, k - begun))
                yield out()
                begun, number = k, number + 1
                known, ids, sizes, codes, size = {}, [], [], array.array("I"), 0
            size += len(text) + ROW_BYTES
            chunks = model.chunks(text)
            codes.extend([known.setdefault(c, len(known)) for c in chunks])
            sizes.append(len(chunks))
        ids.append(batch.column("doc_id").slice(begun))
    if sizes:
        yield out()


def _deal(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of a slice dealt to buckets by their hash, with their numbers."""
    for batch in batches:
        for slice_no, packed in zip(batch.column("slice").to_pylist(), batch.column("chunks")):
            dealt: list[tuple[list[int], list[str]]] = [([], []) for _ in range(buckets)]
            for code, chunk in enumerate(_parted(packed.as_py())):
                codes, chunks = dealt[zlib.crc32(chunk.encode("utf-8")) % buckets]
                codes.append(code)
                chunks.append(chunk)
            # Numbers rise within a bucket: their steps are small.
            filled = [(b, _packed(np.diff(c, prepend=0)), _joined(words)) for b, (c, words) in enumerate(dealt) if c]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*filled), (pa.int32(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(
                [columns[0], pa.array([slice_no] * len(filled), pa.int64()), *columns[1:]],
                ["bucket", "slice", "codes", "chunks"],
            )


SEGMENTED = "slice long, codes binary, lengths binary, ids binary"


def _segment(path: str, bucket: pa.Table) -> pa.Table:
    """Segment each distinct chunk of a bucket once; give the ids back for every slice that has it."""
    model = load(path)
    done: dict[str, list[int]] = {}
    lengths, ids = [], []
    for packed in bucket.column("chunks"):
        found = []
        for chunk in _parted(packed.as_py()):
            if (known := done.get(chunk)) is None:
                known = done[chunk] = model.segment(chunk)
            found.append(known)
        lengths.append(_packed([len(f) for f in found]))
        ids.append(_packed([i for f in found for i in f], model.id_bytes, 9))
    columns = [bucket.column("slice"), bucket.column("codes"), pa.array(lengths, pa.binary()), pa.array(ids, pa.binary())]
    return pa.Table.from_arrays(columns, ["slice", "codes", "lengths", "ids"])


def _table_of(model: PieceModel, segmented: pa.Table) -> list[list[int]]:
    """Ids by chunk number of one slice."""
    rows = []
    for codes, lengths, ids in zip(*(segmented.column(c) for c in ("codes", "lengths", "ids"))):
        ends = np.cumsum(_unpacked(lengths.as_py())).tolist()
        flat = _unpacked(ids.as_py(), model.id_bytes).tolist()
        numbers = np.cumsum(_unpacked(codes.as_py()), dtype=np.int64).tolist()
        rows += [(c, flat[a:b]) for c, a, b in zip(numbers, [0, *ends], ends)]
    table: list[list[int]] = [[]] * len(rows)
    for code, ids in rows:
        table[code] = ids
    return table


def _texts_of(texts: pa.Table) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, ends and chunk numbers of a slice's texts."""
    for ids, sizes, codes, counts in zip(*(texts.column(c) for c in ("ids", "sizes", "codes", "counts"))):
        ends = np.cumsum(_unpacked(sizes.as_py()), dtype=np.int64)
        yield ids.values, ends, _codes_unpacked(codes.as_py(), counts.as_py())


def _rejoin(path: str, texts: pa.Table, segmented: pa.Table) -> pa.Table:
    model = load(path)
    table = _table_of(model, segmented)
    plain = [model.plain(ids) for ids in table]
    parts = []
    for doc_ids, ends, codes in _texts_of(texts):
        codes, ends = codes.tolist(), ends.tolist()
        cuts = list(zip([0, *ends], ends))
        ids = [[i for c in codes[a:b] for i in table[c]] for a, b in cuts]
        decoded = [model.whole([plain[c] for c in codes[a:b]]) for a, b in cuts]
        columns = [doc_ids, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
        parts.append(pa.Table.from_arrays(columns, ["doc_id", "ids", "decoded"]))
    return pa.concat_tables(parts)


def _redigest(path: str, texts: pa.Table, segmented: pa.Table) -> pa.Table:
    model, sha = load(path), hashlib.sha256
    table = _table_of(model, segmented)
    counts = np.array([len(ids) for ids in table], dtype=np.int64)
    plain = [model.plain(ids) for ids in table]
    listed = [",".join(map(str, ids)) for ids in table]
    parts = []
    for doc_ids, ends, codes in _texts_of(texts):
        upto = np.concatenate([[0], np.cumsum(counts[codes])]) if len(codes) else np.zeros(1, np.int64)
        totals = np.diff(upto[np.concatenate([[0], ends])])
        codes, ends = codes.tolist(), ends.tolist()
        ids, decoded = [], []
        for a, b in zip([0, *ends], ends):
            mine = codes[a:b]
            ids.append(sha(",".join([listed[c] for c in mine]).encode()).hexdigest())
            decoded.append(sha(model.whole([plain[c] for c in mine]).encode("utf-8")).hexdigest())
        columns = [doc_ids, pa.array(totals, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
        parts.append(pa.Table.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]))
    return pa.concat_tables(parts)


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, finish, columns: str) -> DataFrame:
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    ids = texts.schema["doc_id"].dataType.simpleString()
    schema = f"slice long, ids array<{ids}>, sizes binary, codes binary, counts binary, chunks binary, n_bytes long"
    coded = stored(small_batches(texts).mapInArrow(functools.partial(_code, path), schema), "chunk-codes")
    slices = coded.where("chunks is not null")
    n_bytes = slices.agg(F.sum("n_bytes")).first()[0] or 0
    parallel = int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parallel, n_bytes // BUCKET_BYTES)
    dealt = slices.select("slice", "chunks").mapInArrow(
        functools.partial(_deal, buckets), "bucket int, slice long, codes binary, chunks binary"
    )
    segmented = dealt.groupBy("bucket").applyInArrow(lambda bucket: _segment(path, bucket), SEGMENTED)
    return (
        coded.select("slice", "ids", "sizes", "codes", "counts")
        .groupBy("slice")
        .cogroup(segmented.groupBy("slice"))
        .applyInArrow(lambda texts, chunks: finish(path, texts, chunks), f"doc_id {ids}, {columns}")
    )


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and the text decoded from them: ``doc_id``, ``ids`` (array<int>), ``decoded``.

    No begin or end ids, no sampling. Null text counts as empty and gives no ids and an empty text. Rows
    are independent: repeated rows and null ids pass through, other columns are not read, an empty table
    gives an empty result. A marker character in a text decodes as a space, as the library has it. ``path`` is
    a model file that every executor can open; models other than byte-pair with byte fallback, and
    those that normalise more than spaces, are refused.
    """
    return _encoded(docs, path, id_col, text_col, _rejoin, "ids array<int>, decoded string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_decode`` with count and SHA-256 digests in place of ids (joined by commas) and text; same rules."""
    return _encoded(docs, path, id_col, text_col, _redigest, "n_tokens long, ids_sha256 string, decoded_sha256 string")
