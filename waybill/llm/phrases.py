"""Phrases of two to four words that occur together more than their parts suggest.

Candidates are found length by length: a phrase is looked at where both phrases of one word less
inside it are frequent. Which are, tasks read from a bitmap of fixed size that holds a bit for
the hash of each frequent phrase, so a false bit adds a candidate and none is lost. The hashes of
the places that are left are counted in each chunk of text, summed, and those that reach the least
count are candidates: equal hashes of different phrases only add to a sum, so this too is safe.

Candidates are then counted exactly. They are dealt to shards of bounded size by hash, and each
shard becomes a double-array trie over language and words, which is broadcast. In each task numpy
advances the states of all places of a chunk at once, a word at a time, and counts the accepting
states; each place found is a row of its phrase's number, and Spark sums them. There is one such
pass for each shard.

A-Z are lower-cased, text is cut into pieces at ``.,;:!?`` and line ends, and words are runs of
characters other than space and tab. Null text has no words; languages are counted apart, and null
is ``und``. Rows are documents of their own, whatever their ids, and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waybill.llm.common import chunks, flat_text, written

LEAST, LONGEST, TOP = 30, 4, 2000
#: A candidate inside a longer one with at least this share of its count, in percent, is dropped.
COVERED = 80
#: The bitmap of a length has 2**BITS bits, 8 MB.
BITS = 26
#: Candidates of a trie; its arrays take some 150 bytes for each.
SHARD = 1 << 20
#: Bytes of text whose words are worked on at once.
CHUNK = 4 << 20
#: A word's code is two symbols of so many bits.
SYMBOL = 10

_WORD, _BREAK = 0, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a chunk's texts one after the other: their numbers, their pieces, their texts' languages."""

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = flat_text(batch.column("text"))
        kind = _KIND[data]
        inside = kind == _WORD
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        full = np.flatnonzero(np.diff(offsets))
        begins[offsets[full]] = inside[offsets[full]]
        ends[offsets[full + 1] - 1] = inside[offsets[full + 1] - 1]
        starts = np.flatnonzero(begins)
        stops = np.append(0, np.cumsum(np.flatnonzero(ends) + 1 - starts))
        letters = _LOWER[data[inside]]
        coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(stops), pa.py_buffer(letters)).dictionary_encode()
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
        self.known: pa.Array = coded.dictionary
        self.word = coded.indices.to_numpy(zero_copy_only=False)
        self.piece = np.searchsorted(np.flatnonzero(kind == _BREAK), starts) + text
        langs = batch.column("lang").dictionary_encode()
        self.langs: list[str] = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each place's word with its language, and that of the word alone."""

        def of(values):
            return np.array([xxhash.xxh3_64_intdigest(v) for v in values], dtype=np.uint64)

        words, langs = of(self.known.to_pylist())[self.word], of(self.langs)[self.lang]
        return _mixed(langs * _ODD + words), words

    def together(self, at: np.ndarray, words: int) -> np.ndarray:
        """Those of the places at which so many words stand in one piece."""
        at = at[: np.searchsorted(at, len(self.word) - words + 1)]
        return at[self.piece[at] == self.piece[at + words - 1]]

    def phrases(self, at: np.ndarray, words: int) -> pa.Array:
        parts = [self.known.take(pa.array(self.word[at + i])) for i in range(words)]
        return pc.binary_join_element_wise(*parts, pa.scalar(" ", parts[0].type)).cast(pa.string())


def _once(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, a place of each, and how often each occurs."""
    return np.unique(values, return_index=True, return_counts=True)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, size=CHUNK):
        words = Words(batch)
        _, at, many = _once(words.lang * len(words.known) + words.word.astype(np.int64))
        hashes = words.hashes()[0][at].view(np.int64)
        langs = pa.array(words.langs, pa.string()).take(pa.array(words.lang[at]))
        yield pa.RecordBatch.from_arrays(
            [langs, words.phrases(at, 1), pa.array(hashes), pa.array(many)], names=["lang", "phrase", "hash", "f"]
        )


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _places(words: Words, bitmaps: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For 2, 3, ... words: places whose two shorter phrases have a bit, and the hashes there.

    The length after the last bitmap's is the last.
    """
    hashes, alone = words.hashes()
    at = np.arange(len(hashes))
    for size, bitmap in enumerate(bitmaps, 2):
        slot = _slot(hashes[at])
        at = at[bitmap[slot >> 3] >> (slot & 7) & 1 == 1]
        both = np.zeros(len(hashes) + 1, dtype=bool)
        both[at] = True
        at = words.together(at[both[at + 1]], size)
        hashes[at] = _mixed(hashes[at] * _ODD + alone[at + size - 1])
        yield size, at, hashes[at]


def _hash_counts(bitmaps: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, size=CHUNK):
            *_, (_, _, hashes) = _places(Words(batch), bitmaps.value)
            found, many = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(many)], names=["hash", "f"])

    return run


def _named(bitmaps: Broadcast):
    """The words of the phrases that have a bit of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, size=CHUNK):
            words = Words(batch)
            for size, at, hashes in _places(words, bitmaps.value[:-1]):
                slot = _slot(hashes)
                own = bitmaps.value[size - 1][slot >> 3] >> (slot & 7) & 1 == 1
                found, first, _ = _once(hashes[own])
                at = at[own][first]
                langs = pa.array(words.langs, pa.string()).take(pa.array(words.lang[at]))
                yield pa.RecordBatch.from_arrays(
                    [langs, words.phrases(at, size), pa.array(found.view(np.int64))], names=["lang", "phrase", "hash"]
                )

    return run


def _bitmap(frequent: DataFrame) -> np.ndarray:
    """A bit for each hash; at most 2**BITS bits come to the driver."""
    slot = F.shiftrightunsigned("hash", 64 - BITS) + 1
    rows = frequent.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    bitmap = np.zeros((1 << BITS) // 8, dtype=np.uint8)
    for row in rows.collect():
        bits = np.frombuffer(bytes(row.bits), dtype=np.uint8)
        bitmap[(row.bucket - 1) * 4096 :][: len(bits)] = bits
    return bitmap


class PhraseTrie:
    """A double-array trie of phrases: a symbol leads from state s to ``base[s] + symbol`` if ``check`` there is s."""

    def __init__(self, numbers: np.ndarray, langs: pa.Array, phrases: pa.Array):
        langs = langs.dictionary_encode()
        split = pc.split_pattern(phrases, " ")
        coded = split.values.dictionary_encode()
        self.numbers, self.langs, self.known = numbers, langs.dictionary.to_pylist(), coded.dictionary
        sizes = pc.list_value_length(split).to_numpy()
        codes = np.full((len(numbers), LONGEST + 1), -1, dtype=np.int64)
        codes[:, 0] = langs.indices.to_numpy()
        row = np.repeat(np.arange(len(sizes)), sizes)
        codes[row, np.arange(len(row)) - (np.cumsum(sizes) - sizes)[row] + 1] = coded.indices.to_numpy()
        if max(len(self.known), len(self.langs)) > 1 << 2 * SYMBOL:
            raise ValueError("more words than codes")
        symbols = np.column_stack([codes >> SYMBOL, codes & (1 << SYMBOL) - 1]).reshape(len(codes), 2, -1)
        symbols = symbols.transpose(0, 2, 1).reshape(len(codes), -1)
        symbols[np.repeat(codes < 0, 2, axis=1)] = -1
        self._build(symbols)

    def _build(self, symbols: np.ndarray) -> None:
        order = np.lexsort(symbols.T[::-1])
        symbols = symbols[order]
        node, total = np.zeros(len(symbols), dtype=np.int64), 1
        parents, codes, last = [], [], np.zeros(len(symbols), dtype=np.int64)
        new = np.zeros(len(symbols), dtype=bool)
        new[:1] = True
        for depth in range(symbols.shape[1]):
            inside = symbols[:, depth] >= 0
            new = new | np.append(False, symbols[1:, depth] != symbols[:-1, depth])[: len(symbols)]
            fresh = new & inside
            parents.append(node[fresh])
            codes.append(symbols[fresh, depth])
            number = total - 1 + np.cumsum(fresh)
            node = np.where(inside, number, node)
            last[inside] = node[inside]
            total += int(fresh.sum())
        slots = self._place(np.concatenate(parents), np.concatenate(codes), total)
        self.accept = np.full(len(self.base), -1, dtype=np.int32)
        self.accept[slots[last]] = order

    def _place(self, parent: np.ndarray, code: np.ndarray, total: int) -> np.ndarray:
        """Give each node's children free slots at one base; the slot of every node."""
        order = np.argsort(parent, kind="stable")
        parent, code = parent[order], code[order]
        heads = np.flatnonzero(np.append(True, parent[1:] != parent[:-1])[: len(parent)])
        sizes = np.diff(np.append(heads, len(parent)))
        width, rnd = 1 << SYMBOL, np.random.default_rng(0)
        room = 3 * total + 4 * width
        used = np.zeros(room + width, dtype=bool)
        used[0] = True
        bases = np.zeros(total, dtype=np.int64)
        grade = np.ceil(np.log2(np.maximum(sizes, 1)))
        for size in np.unique(grade)[::-1]:
            wait, tries = np.flatnonzero(grade == size), 0
            while len(wait):
                tries += 1
                if tries % 64 == 0:
                    room += room // 2
                    used = np.append(used, np.zeros(room + width - len(used), dtype=bool))
                many = sizes[wait]
                family = np.repeat(np.arange(len(wait)), many)
                child = np.arange(len(family)) - (np.cumsum(many) - many)[family] + heads[wait][family]
                base = rnd.integers(1, room, len(wait))
                slot = base[family] + code[child]
                # of families that want the same free slot, the first has it
                first = np.unique(slot, return_index=True)[1]
                mine = np.zeros(len(slot), dtype=bool)
                mine[first] = True
                failed = np.bincount(family, ~mine | used[slot], len(wait)) > 0
                used[slot[~failed[family]]] = True
                bases[parent[heads[wait[~failed]]]] = base[~failed]
                wait = wait[failed]
        slots = np.zeros(total, dtype=np.int64)
        slots[order + 1] = bases[parent] + code
        self.base = np.zeros(len(used), dtype=np.int32)
        self.check = np.full(len(used), -1, dtype=np.int32)
        self.base[slots] = bases
        self.check[slots[order + 1]] = slots[parent]
        return slots

    def step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a word leads from each state, and which of the states it leads on from."""
        alive = np.flatnonzero(code >= 0)
        state = state[alive]
        for shift in (SYMBOL, 0):
            to = self.base[state] + (code[alive] >> shift & (1 << SYMBOL) - 1)
            kept = self.check[to] == state
            state, alive = to[kept], alive[kept]
        return state, alive

    def count(self, words: Words) -> np.ndarray:
        """How often each phrase occurs."""
        return np.bincount(self.found(words), minlength=len(self.numbers))

    def found(self, words: Words) -> np.ndarray:
        """The phrase of each place at which one occurs, as its index."""
        found = []
        known = pc.fill_null(pc.index_in(words.known, self.known.cast(words.known.type)), -1).to_numpy()
        code = known.astype(np.int64)[words.word]
        langs = np.array([self.langs.index(v) if v in self.langs else -1 for v in words.langs], dtype=np.int64)
        at = np.flatnonzero(code >= 0)
        state, kept = self.step(np.zeros(len(at), dtype=np.int32), langs[words.lang[at]])
        at = at[kept]
        for size in range(1, LONGEST + 1):
            near = words.together(at, size)
            state = state[np.searchsorted(at, near)]
            state, kept = self.step(state, code[near + size - 1])
            at = near[kept]
            accepted = self.accept[state]
            found.append(accepted[accepted >= 0])
        return np.concatenate(found).astype(np.int64)


def _phrase_places(trie: Broadcast):
    """The number of the phrase at each place where one occurs; Spark sums them, so a task's rows grow with its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, size=CHUNK):
            found = trie.value.found(Words(batch))
            yield pa.RecordBatch.from_arrays([pa.array(trie.value.numbers[found])], names=["number"])

    return run


def _candidates(spark: SparkSession, texts: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """``number, lang, phrase`` of every phrase that may reach the least count, and perhaps others."""
    bitmaps, hot = [_bitmap(words.filter(F.col("f") >= least).select("hash"))], []
    for size in range(2, LONGEST + 1):
        counted = texts.mapInArrow(_hash_counts(spark.sparkContext.broadcast(bitmaps)), "hash long, f long")
        counted = counted.groupBy("hash").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
        hot.append(written(counted.select("hash"), f"hashes-{size}"))
        bitmaps.append(_bitmap(hot[-1]))
    named = texts.mapInArrow(_named(spark.sparkContext.broadcast(bitmaps)), "lang string, phrase string, hash long")
    hashes = reduce(DataFrame.unionByName, hot).distinct()
    found = named.distinct().join(hashes.hint("merge"), "hash", "left_semi").select("lang", "phrase").distinct()
    return written(found.withColumn("number", F.monotonically_increasing_id()), "candidates")


def counts(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, f`` of all words, and of all phrases that occur at least so often."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    words = texts.mapInArrow(_word_counts, "lang string, phrase string, hash long, f long")
    words = written(words.groupBy("lang", "phrase", "hash").agg(F.sum("f").alias("f")), "words")
    found = _candidates(spark, texts, words, least)
    shards = found.count() // shard + 1
    of = F.pmod(F.xxhash64("lang", "phrase"), F.lit(shards))
    parts = []
    for number in range(shards):
        # a shard's size is bounded, and so are the driver's table and the broadcast
        rows = found.filter(of == number).select("number", "lang", "phrase").toArrow().combine_chunks()
        if rows.num_rows:
            columns = [rows[c].combine_chunks() for c in ("number", "lang", "phrase")]
            trie = spark.sparkContext.broadcast(PhraseTrie(columns[0].to_numpy(), *columns[1:]))
            places = texts.mapInArrow(_phrase_places(trie), "number long")
            parts.append(written(places.groupBy("number").agg(F.count("*").alias("a")), f"counts-{number}"))
            trie.unpersist()
    if not parts:
        return words.drop("hash"), words.drop("hash").filter("false")
    summed = reduce(DataFrame.unionByName, parts).groupBy("number").agg(F.sum("a").alias("f")).filter(F.col("f") >= least)
    return words.drop("hash"), written(found.join(summed.hint("merge"), "number").select("lang", "phrase", "f"), "phrases")


def _spans(phrase: str, start: str, size: str):
    return F.expr(f"array_join(slice(split({phrase}, ' '), {start}, {size}), ' ')")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP, shard: int = SHARD
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of each language."""
    words, found = counts(docs, lang, text, least, shard)
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    known = words.filter(F.col("f") >= least).unionByName(found)
    sized = found.withColumn("words", F.size(F.split("phrase", " "))).withColumnRenamed("f", "a")
    cuts = sized.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"left": _spans("phrase", "1", "k"), "right": _spans("phrase", "k + 1", "words - k")})
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side])
    exact = "cast(2000000 AS decimal(7,0)) * cast(a AS decimal(20,0)) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))"
    cuts = cuts.withColumn("score", F.expr(exact))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = sized.filter("words > 2").selectExpr(
        "lang", "a AS longer", "words", "phrase", "explode(sequence(2, words - 1)) AS size"
    )
    inner = inner.selectExpr("*", "explode(sequence(1, words - size + 1)) AS start")
    inner = inner.select("lang", "longer", _spans("phrase", "start", "size").alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    share = f"longer IS NULL OR cast(100 AS decimal(3,0)) * longer < cast({COVERED} AS decimal(3,0)) * a"
    kept = best.join(covered, ["lang", "phrase"], "left").filter(share)
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
