"""Byte-level BPE: ranked merges folded over the bytes of distinct words, and decoding.

A text is cut into the matches of the tokenizer's pattern, a chunk of documents is
dictionary-encoded, and each distinct match of the chunk is merged once: a fold over its
bytes that replaces the leftmost pair of lowest rank until no pair has a rank. Words of one
length are folded together as one array. The rank map is a bounded literal, sent once to
each executor. Nothing is shuffled, and a task holds one chunk.

Null text is empty text and gives no ids; repeated rows are encoded alike; all other
columns are kept as they are. Any text decodes to its own bytes.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import chunks, flat_text, lists, ranges
from waybill.llm.tables import Table

#: Words of more bytes are merged one by one with a heap instead of as an array.
ARRAY_BYTES = 64
OTHER, LETTER, NUMBER, SPACE = range(4)
#: White_Space of Unicode, as the tokenizers' regular expressions have it.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as rows:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, rows)}


class RankMap:
    """Ranks of mergeable pairs, at most 65,536 tokens.

    Tokens are numbered by rank, so a merge's rank is the number of the token it makes. A
    pair is ``left * 65536 + right``.
    """

    NONE = 1 << 16

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = sorted(ranks, key=ranks.__getitem__)
        self.ids = np.array([ranks[t] for t in self.tokens], dtype=np.int32)
        if len(set(ranks.values())) != len(ranks) or len(ranks) > self.NONE:
            raise ValueError("each token needs a rank of its own, 65,536 at most")
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every byte needs a rank")
        number = {t: n for n, t in enumerate(self.tokens)}
        self.bytes = np.array([number[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {
            (number[t[:i]] << 16) + number[t[i:]]: n
            for n, t in enumerate(self.tokens)
            for i in range(1, len(t))
            if t[:i] in number and t[i:] in number
        }
        self.table = Table(pairs)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of the token that each pair makes, or ``NONE``."""
        return self.table.get((left << 16) + right, self.NONE)

    def fold(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token numbers of words given as bytes: flat numbers, and how many each word has."""
        sizes = np.diff(offsets)
        counts = np.zeros(len(sizes), dtype=np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for size in np.unique(sizes):
            words = np.flatnonzero(sizes == size)
            if size > ARRAY_BYTES:
                for w in words:
                    merged = self._merge_long(data[offsets[w] : offsets[w + 1]])
                    done.append((np.array([w]), merged[None, :]))
            elif size:
                parts = self.bytes[data[offsets[words][:, None] + np.arange(size)]]
                done.extend(self._merge_equal(words, parts))
        for words, parts in done:
            counts[words] = parts.shape[1]
        starts = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), dtype=np.int64)
        for words, parts in done:
            flat[starts[words][:, None] + np.arange(parts.shape[1])] = parts
        return flat, counts

    def _merge_equal(self, words: np.ndarray, parts: np.ndarray) -> Iterator[tuple]:
        """Words of one length, which get one part shorter in each step; those without a pair leave."""
        ranks = self.merge(parts[:, :-1], parts[:, 1:])
        while parts.shape[1] > 1:
            best = ranks.min(axis=1)
            go = best < self.NONE
            if not go.all():
                yield words[~go], parts[~go]
                words, parts, ranks, best = words[go], parts[go], ranks[go], best[go]
            if not len(words):
                return
            n, width = parts.shape
            row, at = np.arange(n), ranks.argmin(axis=1)
            parts[row, at] = best
            parts = parts[np.arange(width) != (at + 1)[:, None]].reshape(n, width - 1)
            ranks = ranks[np.arange(width - 1) != at[:, None]].reshape(n, width - 2)
            some = np.flatnonzero(at > 0)
            ranks[some, at[some] - 1] = self.merge(parts[some, at[some] - 1], best[some])
            some = np.flatnonzero(at < width - 2)
            ranks[some, at[some]] = self.merge(best[some], parts[some, at[some] + 1])
        yield words, parts

    def _merge_long(self, data: np.ndarray) -> np.ndarray:
        """One word of any length, in n log n: a heap of pairs over a linked list of parts."""
        part = self.bytes[data].tolist()
        after, before = [*range(1, len(part) + 1)], [*range(-1, len(part) - 1)]
        ranks = self.merge(self.bytes[data[:-1]], self.bytes[data[1:]])
        heap = [(int(ranks[i]), int(i)) for i in np.flatnonzero(ranks < self.NONE)]
        heapq.heapify(heap)
        pair = ranks.tolist() + [self.NONE]

        def renew(i: int) -> None:
            j = after[i]
            pair[i] = self.NONE
            if j < len(part):
                rank = self.table.one((part[i] << 16) + part[j])
                if rank is not None:
                    pair[i] = rank
                    heapq.heappush(heap, (rank, i))

        while heap:
            rank, i = heapq.heappop(heap)
            if part[i] < 0 or pair[i] != rank:
                continue
            j = after[i]
            part[i], part[j], after[i] = rank, -1, after[j]
            if after[i] < len(part):
                before[after[i]] = i
            renew(i)
            if before[i] >= 0:
                renew(before[i])
        return np.array([p for p in part if p >= 0], dtype=np.int64)


@cache
def _classes() -> np.ndarray:
    """Of each code point: letter, number, white space or other."""
    kinds = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        major = unicodedata.category(chr(c))[0]
        kinds[c] = LETTER if major == "L" else NUMBER if major == "N" else OTHER
    kinds[WHITE] = SPACE
    return kinds


def byte_classes(data: np.ndarray) -> np.ndarray:
    """The class of each byte's character."""
    kinds = _classes()[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        first = data[lead].astype(np.int64)
        length = 2 + (first >= 0xE0) + (first >= 0xF0)
        point = first & np.array([0, 0, 0x1F, 0x0F, 0x07])[length]
        for i in (1, 2, 3):
            more = length > i
            point[more] = point[more] << 6 | data[lead[more] + i] & 0x3F
        kind = _classes()[point]
        kinds[lead] = kind
        for i in (1, 2, 3):
            kinds[lead[length > i] + i] = kind[length > i]
    return kinds


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets where the pattern's matches start, in texts that stand one after the other.

    The matches of ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
    cover a text: runs of one class of characters, but that a run of white space leaves its
    last character to what follows. That character joins the run if it is a space and is a
    match of its own if not. An apostrophe that starts a match takes the ending after it.
    """
    n = len(data)
    kinds = byte_classes(data)
    start = np.zeros(n + 1, dtype=bool)
    start[1:n] = kinds[1:] != kinds[:-1]
    text = np.zeros(n + 1, dtype=bool)
    text[offsets] = True
    start |= text
    # the last white character before other characters of the same text
    after = np.flatnonzero(start[:n] & ~text[:n] & (kinds != SPACE))
    after = after[kinds[after - 1] == SPACE]
    last = after - 1
    while (inner := (data[last] & 0xC0) == 0x80).any():
        last = last - inner
    start[last] = True
    start[after[data[last] == 0x20]] = False
    # contractions
    quote = np.flatnonzero(start[:n] & (data == 0x27))
    quote = quote[start[quote + 1] & ~text[quote + 1]]
    padded = np.append(data, np.zeros(3, dtype=np.uint8))
    a, b = padded[quote + 1], padded[quote + 2]
    two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    two &= ~text[np.minimum(quote + 2, n)]
    one = np.isin(a, np.frombuffer(b"stmd", dtype=np.uint8))
    for chosen, size in ((one, 2), (two & ~one, 3)):
        start[quote[chosen] + 1] = False
        end = quote[chosen] + size
        start[end[end < n]] = True
    return np.flatnonzero(start[:n])


def _pieces_by(pattern: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the matches of any pattern, text by text."""
    import regex

    compiled, found = regex.compile(pattern), []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        at, text = a, data[a:b].tobytes().decode()
        past = 0
        for m in compiled.finditer(text):
            at += len(text[past : m.start()].encode())
            past, size = m.end(), len(m[0].encode())
            found.append((at, at + size))
            at += size
    pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _encode(ranks: RankMap, pattern: str | None, text: pa.Array) -> pa.Array:
    data, offsets = flat_text(text)
    if pattern is None:
        starts = pieces(data, offsets)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
    else:
        starts, ends = _pieces_by(pattern, data, offsets)
    flat = data[ranges(starts, ends - starts)] if pattern else data
    at = np.append(np.cumsum(ends - starts) - (ends - starts), (ends - starts).sum())
    matches = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(flat)]
    )
    coded = matches.dictionary_encode()
    numbers, counts = ranks.fold(*flat_text(coded.dictionary))
    word = coded.indices.to_numpy(zero_copy_only=False)
    sizes = counts[word]
    ids = ranks.ids[numbers[ranges((np.cumsum(counts) - counts)[word], sizes)]]
    ends = np.append(0, np.cumsum(sizes))
    return lists(ids, ends[np.searchsorted(starts, offsets)], pa.int32())


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str | None = None, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """All columns and the token ids of the text, ``ids array<int>``, without special tokens.

    ``pattern`` None is the pattern of :func:`pieces`; another one is matched text by text,
    and characters outside its matches are left out, as the rank-file library does.
    """
    held = docs.sparkSession.sparkContext.broadcast(RankMap(ranks))
    names = [c for c in docs.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            coded = _encode(held.value, pattern, batch.column(text))
            yield pa.RecordBatch.from_arrays([*batch.columns, coded], names=[*names, ids])

    return _mapped(docs.select(*(F.col(f"`{c}`") for c in names)), run, ids, "array<int>")


#: Ids that a task decodes at once.
DECODE_IDS = 1 << 19


def _by_ids(batches: Iterator[pa.RecordBatch], ids: str) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``DECODE_IDS`` ids each, or of one longer row."""
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // DECODE_IDS)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def decode(tokens: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and the bytes that the ids stand for: their pieces joined; null ids are none.

    An id without a rank, or a null within the ids, is an error.
    """
    kept = sorted(ranks, key=ranks.__getitem__)
    held = tokens.sparkSession.sparkContext.broadcast((kept, np.array([ranks[t] for t in kept])))
    names = [c for c in tokens.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = pa.array(held.value[0], type=pa.large_binary()), held.value[1]
        for batch in _by_ids(batches, ids):
            column = batch.column(ids).fill_null([]) if batch.column(ids).null_count else batch.column(ids)
            flat, ends = column.flatten(), column.offsets.to_numpy()
            if flat.null_count:
                raise ValueError("a null among the ids")
            wanted = flat.to_numpy()
            place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            if not (known[place] == wanted).all():
                raise ValueError("an id without a rank")
            data, offsets = flat_text(vocabulary.take(pa.array(place)))
            cuts = np.ascontiguousarray(offsets[ends - ends[0]])
            joined = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, joined.cast(pa.binary())], names=[*names, out])

    return _mapped(tokens.select(*(F.col(f"`{c}`") for c in names)), run, out, "binary")


def _mapped(df: DataFrame, run, name: str, kind: str) -> DataFrame:
    schema = df.withColumn(name, F.lit(None).cast(kind)).schema
    return df.mapInArrow(run, schema)
