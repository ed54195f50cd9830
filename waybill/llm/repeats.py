"""Word passages that stand in earlier documents, found by recompression.

Each round names every run of equal symbols and then every pair of neighbours of which the first
falls into the lower and the second into the upper half of the symbols. Names are digests of
what they stand for and the halves are digests of names, so all tasks name alike and equal
passages get equal symbols but for a few at their ends, without a table of names that would
have to be shuffled in every round. A symbol's context is the words that fix it: wherever
these words stand, there is the symbol.

Every window of words is given a symbol whose context lies inside it, of several that of the
largest digest, so equal windows have equal symbols whatever stands around them, and neighbouring
windows mostly have the same one. The few windows without any are their own key. Windows that
meet at a shared symbol are verified by 64-bit digests of all their words beside the symbol's own
64 bits, all of them compared, and a window that an earlier document has too is marked. The words under marked windows go.

Words are runs of characters other than the six ASCII white ones, unchanged. Null text has no
words; a document shorter than a window loses nothing. Documents of equal ids, repeated rows
among them, are not earlier than each other; a null id is later than all others.

Symbols are dealt to buckets, whose number follows the corpus, and the windows that a batch has
for a bucket travel as one packed row. A passage that very many documents share is combined
before that: a document goes on only for windows of which it is the earliest in its batch.
A phrase shorter than a window, with other words around it in very many documents, gives distinct
windows of one symbol. Symbols of so many windows are found first, by counts over a sample of the
documents, and their windows are dealt by digest: equal windows still meet, whichever symbols
are taken for such, so the sample only decides how evenly the work is dealt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import chunks, flat_text, ranges
from waybill.llm.jaccard import _mixed, word_hashes

WINDOW, ROUNDS = 13, 2
_FAR = 1 << 40
_NO_ID = (1 << 63) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Words: runs of characters other than the six ASCII white ones.
WORDS = r"[^\x20\x09-\x0D]+"


def _joined(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    return _mixed(_mixed(a, salt) + b * _BASE, salt + 1)


class Symbols:
    """The symbols of one round: name, text, and the words from and to that fix each of them."""

    def __init__(self, name, text, low, high):
        self.name, self.text, self.low, self.high = name, text, low, high

    def _beside(self, values: np.ndarray, at: np.ndarray, step: int, none: int) -> np.ndarray:
        """The neighbours' values, where they are of the same text."""
        to = at + step
        inside = (to >= 0) & (to < len(self.name))
        to = np.where(inside, to, 0)
        return np.where(inside & (self.text[to] == self.text[at]), values[to], none)

    def runs(self) -> Symbols:
        same = (self.name[1:] == self.name[:-1]) & (self.text[1:] == self.text[:-1])
        first = np.flatnonzero(np.append(True, ~same)[: len(self.name)])
        last = np.append(first[1:], len(self.name)) - 1
        name, size = self.name[first], (last - first + 1).astype(np.uint64)
        many = size > 1
        name[many] = _joined(name[many], size[many], 30)
        return Symbols(
            name,
            self.text[first],
            self._beside(self.low, first, -1, -_FAR),
            self._beside(self.high, last, 1, _FAR),
        )

    def pairs(self, round_: int) -> Symbols:
        upper = _mixed(self.name, 40 + round_) >> np.uint64(63) == 1
        n = len(self.name)
        left = np.zeros(n, dtype=bool)
        left[: max(0, n - 1)] = ~upper[:-1] & upper[1:] & (self.text[1:] == self.text[:-1])
        right = np.append(False, left)[:n]
        at = np.flatnonzero(~right)
        paired = left[at]
        to = np.minimum(at + 1, n - 1)
        name, up = self.name[at], upper[at]
        name[paired] = _joined(name[paired], self.name[to[paired]], 60)
        low = np.where(paired | ~up, self.low[at], self._beside(self.low, at, -1, -_FAR))
        high = np.where(
            paired, self.high[to], np.where(up, self.high[at], self._beside(self.high, at, 1, _FAR))
        )
        return Symbols(name, self.text[at], low, high)


def _digests(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over words and powers that give the digest of any short range."""
    powers = np.cumprod(np.append(np.uint64(1), np.full(len(words), _BASE | np.uint64(1))))
    back = np.cumprod(np.append(np.uint64(1), np.full(len(words), np.uint64(pow(int(_BASE) | 1, -1, 1 << 64)))))
    sums = np.append(np.uint64(0), np.cumsum(_mixed(words, 50) * powers[:-1]))
    return sums, back


def window_keys(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts one after the other: where windows start, each window's key and its digest."""
    sizes = np.diff(first)
    text = np.repeat(np.arange(len(sizes)), sizes)
    n = len(words)
    starts = ranges(first[:-1], np.maximum(sizes - WINDOW + 1, 0))
    sums, back = _digests(words)

    def digest(a, b, salt):
        return _mixed((sums[b] - sums[a]) * back[a], salt)

    here = np.arange(n)
    now = Symbols(words.copy(), text, here, here + 1)
    found = []
    for round_ in range(ROUNDS):
        if n:
            now = now.runs().pairs(round_)
        fits = (now.high - now.low <= WINDOW) & (now.low >= 0)
        found.append((now.low[fits], now.high[fits], now.text[fits]))
    key = np.zeros(n + 1, dtype=np.uint64)
    for low, high, owner in found:
        order = digest(low, high, 51)
        begin = np.maximum(high - WINDOW, first[owner])
        end = np.minimum(low, first[owner + 1] - WINDOW)
        for step in range(WINDOW):
            some = begin + step <= end
            if not some.any():
                break
            np.maximum.at(key, begin[some] + step, order[some])
    own = starts[key[starts] == 0]
    key[own] = digest(own, own + WINDOW, 52)
    return starts, key[starts], digest(starts, starts + WINDOW, 53)


PACKED = "row long, doc_id long, n_words long, packed binary"
#: Words of the corpus for each bucket that windows are dealt to by symbol.
BUCKET_WORDS = 1 << 18
#: A symbol of as many windows is dealt by their digests; one of so many documents is counted for that.
HOT, SAMPLE = 1 << 19, 16


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in chunks(batches):
        data, offsets = flat_text(batch.column("text"))
        _, first = word_hashes(data, offsets, lower=False)
        raw = data.tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc_id"),
                pa.array(np.diff(first).astype(np.int64)),
                pa.array([pack.compress(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]),
            ],
            names=["row", "doc_id", "n_words", "packed"],
        )


def _unpacked(batches: Iterator[pa.RecordBatch], step: int = 1024) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of batches and their texts, packed or plain; null text is empty."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for a in range(0, batch.num_rows, step):
            part = batch.slice(a, step)
            if "packed" not in part.schema.names:
                yield part, pa.compute.fill_null(part.column("text").cast(pa.large_binary()), b"")
                continue
            raw = [unpack.decompress(x) for x in part.column("packed").to_pylist()]
            yield part, pa.array(raw, type=pa.large_binary())


def _earliest(key: np.ndarray, digest: np.ndarray, id_: np.ndarray) -> np.ndarray:
    """For each window, the smallest id among those of equal key and equal digest."""
    if not len(key):
        return id_
    order = np.lexsort((key, digest))
    one, other = key[order], digest[order]
    fresh = np.append(True, (one[1:] != one[:-1]) | (other[1:] != other[:-1]))
    least = np.minimum.reduceat(id_[order], np.flatnonzero(fresh))
    result = np.empty_like(id_)
    result[order] = least[np.cumsum(fresh) - 1]
    return result


def _stretches(*same: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of consecutive starts with all ``same`` equal begin, and how long they are."""
    cut = start[1:] != start[:-1] + 1
    for values in same:
        cut |= values[1:] != values[:-1]
    begin = np.flatnonzero(np.append(True, cut)[: len(start)])
    return begin, np.diff(np.append(begin, len(start)))


def _parcel(key, row, id_, start, digest) -> bytes:
    """Windows of one bucket as bytes: stretches of one key, and all digests behind them."""
    begin, size = _stretches(key, row, start=start)
    head = np.concatenate(
        [row[begin], id_[begin], start[begin], size]
    ).astype(np.int64)
    front = zstandard.ZstdCompressor(level=1).compress(head.tobytes())
    return b"".join(
        [np.array([len(begin), len(front)], dtype=np.int64).tobytes(), front, key[begin].tobytes(), digest.tobytes()]
    )


def _opened(parcels: list[bytes]) -> tuple[np.ndarray, ...]:
    """The windows of parcels again: key, row, id, start, digest."""
    parts = []
    for parcel in parcels:
        n, front = np.frombuffer(parcel, dtype=np.int64, count=2)
        head = zstandard.ZstdDecompressor().decompress(parcel[16 : 16 + front])
        row, id_, start, size = np.frombuffer(head, dtype=np.int64).reshape(4, n)
        key = np.frombuffer(parcel, dtype=np.uint64, count=n, offset=16 + front)
        digest = np.frombuffer(parcel, dtype=np.uint64, offset=16 + front + 8 * n)
        each = [np.repeat(x, size) for x in (key, row, id_)]
        parts.append((*each, ranges(start, size), digest))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Windows of each batch: key, row, id, start, digest, and whether an earlier document of the batch has it."""
    for part, raw in _unpacked(batches):
        words, first = word_hashes(*flat_text(raw), lower=False)
        starts, key, digest = window_keys(words, first)
        text = np.searchsorted(first, starts, "right") - 1
        row = part.column("row").to_numpy()[text]
        id_ = part.column("doc_id").fill_null(_NO_ID).to_numpy()[text]
        yield key, row, id_, starts - first[text], digest, id_ > _earliest(key, digest, id_)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symbols of each batch with their numbers of windows that go on."""
    for key, _, _, _, _, marked in _windows(batches):
        symbol, n = np.unique(key[~marked], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(symbol.view(np.int64)), pa.array(n)], names=["symbol", "windows"])


def _hot_symbols(packed: DataFrame, hot: int, sample: int) -> np.ndarray:
    """Symbols of ``hot`` windows or more, ascending; documents as long as that are all counted.

    ``packed`` has ``row`` and ``n_words``, and ``packed`` or ``text``.
    """
    long = F.col("n_words") >= hot
    chosen = F.pmod(F.xxhash64("row"), F.lit(sample)) == 0
    whole = packed.filter(long).mapInArrow(_counted, "symbol long, windows long")
    part = packed.filter(~long & chosen & (F.col("n_words") >= WINDOW)).mapInArrow(_counted, "symbol long, windows long")
    counts = whole.unionByName(part.withColumn("windows", F.col("windows") * sample))
    sums = counts.groupBy("symbol").agg(F.sum("windows").alias("windows"))
    # a bounded table: as many rows as the corpus has times ``hot`` windows, at most
    found = sums.filter(F.col("windows") >= hot).select("symbol").toArrow()["symbol"].to_numpy()
    return np.sort(found.astype(np.int64).view(np.uint64))


def _meeting(buckets: int, hot: np.ndarray):
    """Windows dealt by symbol, those of hot ones by digest too; those that an earlier document of the batch has are marked at once."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, row, id_, start, digest, marked in _windows(batches):
            if marked.any():
                bucket = int(row[0]) % buckets
                yield _sent([-1 - bucket], [_marks(row[marked], start[marked])])
            go = np.flatnonzero(~marked)
            deal = np.where(np.isin(key[go], hot), _joined(key[go], digest[go], 57), key[go])
            bucket = (_mixed(deal, 56) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            go, bucket = go[order], bucket[order]
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(go)])
            parcels = []
            for a, b in zip(cuts, [*cuts[1:], len(go)], strict=True):
                at = go[a:b]
                parcels.append(_parcel(key[at], row[at], id_[at], start[at], digest[at]))
            yield _sent(bucket[cuts], parcels)

    return meet


def _sent(bucket, parcels: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, type=pa.int64()), pa.array(parcels, type=pa.binary())], names=["bucket", "parcel"]
    )


def _marks(row: np.ndarray, start: np.ndarray) -> bytes:
    begin, size = _stretches(row, start=start)
    return np.concatenate([row[begin], start[begin], size]).astype(np.int64).tobytes()


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of windows that earlier documents have, from parcels sorted by bucket."""

    def told(marks: bytes) -> pa.RecordBatch:
        row, start, size = np.frombuffer(marks, dtype=np.int64).reshape(3, -1)
        return pa.RecordBatch.from_arrays(
            [pa.array(row), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32))],
            names=["row", "start", "windows"],
        )

    def compared(parcels: list[bytes]) -> Iterator[pa.RecordBatch]:
        key, row, id_, start, digest = _opened(parcels)
        marked = np.flatnonzero(id_ > _earliest(key, digest, id_))
        marked = marked[np.lexsort((start[marked], row[marked]))]
        if len(marked):
            yield told(_marks(row[marked], start[marked]))

    now, held = None, []
    for batch in batches:
        for bucket, parcel in zip(batch.column("bucket").to_pylist(), batch.column("parcel"), strict=True):
            if bucket < 0:
                yield told(parcel.as_py())
                continue
            if bucket != now and held:
                yield from compared(held)
                held = []
            now = bucket
            held.append(parcel.as_py())
    if held:
        yield from compared(held)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, raw in _unpacked(batches):
        removed, kept = [], []
        for text, spans in zip(raw.to_pylist(), part.column("spans").to_pylist(), strict=True):
            words = text.split()
            keep = np.ones(len(words), dtype=bool)
            for span in spans or []:
                keep[span["start"] : span["start"] + span["windows"] + WINDOW - 1] = False
            removed.append(len(words) - int(keep.sum()))
            kept.append(b" ".join(words if not removed[-1] else [words[i] for i in np.flatnonzero(keep)]))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("row"),
                part.column("doc_id"),
                part.column("n_words"),
                pa.array(removed, type=pa.int64()),
                pa.array(kept, type=pa.binary()).cast(pa.string()),
            ],
            names=["row", "doc_id", "n_words", "n_removed", "kept"],
        )


def remove(
    docs: DataFrame,
    row: str = "row",
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_words: int = BUCKET_WORDS,
    hot: int = HOT,
    sample: int = SAMPLE,
) -> DataFrame:
    """``row, doc_id, n_words, n_removed, kept`` of every row; ``kept`` is the words left, joined by a space.

    ``row`` numbers the rows, each with a number of its own.
    """
    rows = docs.select(
        F.col(row).cast("long").alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    # words are counted in the JVM and texts read where they are needed: packed texts are shuffled
    # once, for the cut, and never written beside the shuffle
    sized = rows.withColumn("n_words", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS)).cast("long"))
    total = sized.agg(F.sum("n_words")).first()[0] or 0
    symbols = _hot_symbols(sized, hot, sample) if total >= hot else np.zeros(0, dtype=np.uint64)
    met = sized.filter(F.col("n_words") >= WINDOW).mapInArrow(
        _meeting(1 + total // bucket_words, symbols), "bucket long, parcel binary"
    )
    marks = met.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _compare, "row long, start int, windows int"
    )
    spans = marks.groupBy("row").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    return rows.mapInArrow(_pack, PACKED).join(spans, "row", "left").mapInArrow(
        _cut, "row long, doc_id long, n_words long, n_removed long, kept string"
    )
