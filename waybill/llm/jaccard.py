"""Documents whose sets of word shingles overlap: an exact Jaccard join and its components.

Shingles are hashed into groups, and a document is the point of its group counts. The common
shingles of two documents are at most the sum of the smaller counts of each group, so trees over
the points find the pairs that may reach the threshold, and only those are verified.

Boxes of long documents' counts overlap whatever they say, so a tree over the whole corpus would
prune nothing at its top. Its top level is therefore an exact key instead of boxes. In one order of
all shingles, two sets that link share one of the first few of each: so many that fewer than the
overlap that the threshold asks for come after them. Any order is right; here shingles that very
many documents have come last, so that a passage that they share makes no cell of its own. These are
told by counts over a sample of the documents, which decides nothing but the order. A shingle that
several sets have among their first is a cell, and cells are what Spark deals out.

Equal sets are one node. Every cell's nodes are first held against its smallest node only: in
a cell of thousands of near copies that gives thousands of pairs and not millions. In cells that
still hold several components, rounds of other members drawn as pivots follow while these find
links. What remains are the pairs of one cell in different components; trees over the group counts
of such cells list them, in tiles of bounded size, and they are verified too. So no link between
different sets is lost, while links inside a component need not all be listed. Before texts are
fetched, pairs are held against two bounds: the group counts, and the parities of many groups.

Words are runs of characters other than the six ASCII white ones, with A-Z lower-cased. Null
text and text without words is an empty set and links with nothing; with fewer words than a
shingle has, the whole sequence is the only one. Rows with equal ids, and with null ids, are
documents of their own; a component's id is its smallest id that is not null.

Both sides of all joins grow with the corpus, so they are merged and never broadcast; adaptive
execution splits their hot keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waybill.llm.common import CHUNK_BYTES, chunks, flat_text, forget, lists, ranges, written
from waybill.llm.graph import components

#: Words of a shingle, unless the caller says otherwise.
SHINGLE = 3
#: Two documents link when LINK[1] * intersection >= LINK[0] * union, unless the caller says otherwise.
LINK = (90, 100)
#: Groups of the points that trees are built over.
GROUPS = 32
#: One of so many documents is sampled for the order of shingles, in 2**BUCKETS buckets.
SAMPLED, BUCKETS = 8, 22
#: Bits that tell whether an odd number of shingles is in a group: as many differ as shingles do, at most.
PARITY = 1024
#: Cells of a node in a round of pivots, the share of links that a round must find for another one,
#: and members of a cell that are held against each other without a tree.
PIVOTS, FRUITFUL, FEW = 4, 0.02, 64
#: Points of a tree's leaf and children of its nodes; points of a tile.
FANOUT, TILE = 32, 4096

_SPACE = np.ones(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Another hash of hashes for every salt."""
    x = x + np.uint64(xxhash.xxh3_64_intdigest(f"salt {salt}"))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of texts one after the other, and each text's first word."""
    inside = _SPACE[data]
    begins = inside & ~np.append(False, inside)[:-1]
    cut = offsets[:-1][np.diff(offsets) > 0]
    begins[cut] = inside[cut]
    starts = np.flatnonzero(begins)
    ends = np.append((np.cumsum(inside) - 1)[starts], inside.sum()).astype(np.int64)
    letters = np.ascontiguousarray((_LOWER[data] if lower else data)[inside])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)]
    ).dictionary_encode()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words.dictionary.to_pylist()], dtype=np.uint64)
    return hashes[words.indices.to_numpy(zero_copy_only=False)], np.searchsorted(starts, offsets)


def _sort_each(keys: np.ndarray, sizes: np.ndarray) -> None:
    """Sort the keys of each row in place; short sorts, which stay in the processor's cache."""
    ends = np.cumsum(sizes)
    for a, b in zip((ends - sizes)[sizes > 1].tolist(), ends[sizes > 1].tolist(), strict=True):
        keys[a:b].sort()


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's begin."""
    words, first = word_hashes(data, offsets, lower=True)
    sizes = np.diff(first)
    width = np.minimum(sizes, shingle)
    many = np.where(sizes > 0, sizes - width + 1, 0)
    row = np.repeat(np.arange(len(sizes)), many)
    at = np.arange(len(row)) - (np.cumsum(many) - many)[row] + first[:-1][row]
    hashes = _mixed(width[row].astype(np.uint64), 0)
    for i in range(shingle):
        some = width[row] > i
        hashes[some] = _mixed(hashes[some] ^ _mixed(words[at[some] + i], i + 1), 9)
    _sort_each(hashes, many)
    fresh = np.append(True, (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1]))[: len(row)]
    row, hashes = row[fresh], hashes[fresh]
    return hashes, np.searchsorted(row, np.arange(len(sizes) + 1))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (_mixed(hashes, 20) >> np.uint64(64 - BUCKETS)).astype(np.int64)


def _sampled_counts(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """In how many of the documents there is a shingle of each bucket."""
    for batch in chunks(batches):
        found, many = np.unique(_bucket(shingle_sets(*flat_text(batch.column("text")), shingle)[0]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(many)], names=["bucket", "n"])


def _common(rows: DataFrame, shingle: int) -> np.ndarray:
    """How common the shingles of each bucket are, in powers of two above a bucket's share; 0 for most."""
    part = rows.filter(F.pmod(F.xxhash64("row"), F.lit(SAMPLED)) == 0)
    counts = part.mapInArrow(partial(_sampled_counts, shingle=shingle), "bucket long, n long")
    counts = written(counts.groupBy("bucket").agg(F.sum("n").alias("n")), "sampled")
    mean = (counts.agg(F.sum("n")).first()[0] or 0) / (1 << BUCKETS)
    share = mean + 2 * np.sqrt(mean) + 1
    much = counts.filter(F.col("n") >= share).toArrow()  # 2**BUCKETS rows at most
    grades = np.zeros(1 << BUCKETS, dtype=np.uint8)
    grades[much["bucket"].to_numpy()] = np.minimum(1 + np.log2(much["n"].to_numpy() / share), 15)
    forget(counts)
    return grades


def _cells(hashes: np.ndarray, first: np.ndarray, link: tuple[int, int], grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the first shingles of each set, and where each set's begin.

    A key is the place in the order: the grade, then a hash. Shingles of equal keys are one cell.
    """
    sizes = np.diff(first)
    low, high = link
    # a set links with others only if it may with one that has a shingle more
    may = (sizes > 0) & (low * (sizes + 1) <= high * sizes)
    many = np.where(may, sizes + low * -sizes // high + 1, 0)
    keys = (grades[_bucket(hashes)].astype(np.uint64) << np.uint64(60)) | (_mixed(hashes, 22) >> np.uint64(4))
    _sort_each(keys, sizes)
    return keys[ranges(first[:-1], many)].view(np.int64), np.append(0, np.cumsum(many))


FEATURES = (
    "row long, doc_id long, n_shingles long, k1 long, k2 long, points binary, parity binary, "
    "cells array<long>, packed binary"
)


def _features(
    batches: Iterator[pa.RecordBatch], shingle: int, link: tuple[int, int], grades: Broadcast
) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in chunks(batches):
        data, offsets = flat_text(batch.column("text"))
        hashes, first = shingle_sets(data, offsets, shingle)
        sizes, n = np.diff(first), batch.num_rows
        row = np.repeat(np.arange(n), sizes)
        keys = []
        for salt in (10, 11):
            key = np.zeros(n, dtype=np.uint64)
            np.add.at(key, row, _mixed(hashes, salt))
            keys.append(pa.array(key.view(np.int64), mask=sizes == 0))
        group = (_mixed(hashes, 12) % np.uint64(GROUPS)).astype(np.int64)
        points = np.bincount(row * GROUPS + group, minlength=n * GROUPS).reshape(n, GROUPS).astype(np.int32)
        odd = np.bincount(row * PARITY + (_mixed(hashes, 13) % np.uint64(PARITY)).astype(np.int64), minlength=n * PARITY)
        parity = np.packbits((odd & 1).astype(np.uint8).reshape(n, PARITY), axis=1)
        cells, cut = _cells(hashes, first, link, grades.value)
        raw = data.tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc_id"),
                pa.array(sizes.astype(np.int64)),
                *keys,
                pa.array([p.tobytes() for p in points]),
                pa.array([p.tobytes() for p in parity]),
                lists(cells, cut, pa.int64()),
                pa.array([pack.compress(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]),
            ],
            names=[f.split()[0] for f in FEATURES.split(", ")],
        )


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each cell of a batch once: its smallest node and all others."""
    for batch in batches:
        cells = batch.column("cells")
        flat = cells.flatten().to_numpy()
        node = np.repeat(batch.column("node").to_numpy(), np.diff(cells.offsets.to_numpy()))
        order = np.lexsort((node, flat))
        flat, node = flat[order], node[order]
        fresh = np.append(True, flat[1:] != flat[:-1])[: len(flat)]
        head = np.flatnonzero(fresh)
        rest = ~fresh
        ends = np.append(0, np.cumsum(np.diff(np.append(head, len(flat))) - 1))
        for a in range(0, len(head), 1 << 18):
            part = head[a : a + (1 << 18)]
            cut = ends[a : a + len(part) + 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[part]), pa.array(node[part]), lists(node[rest][cut[0] : cut[-1]], cut - cut[0], pa.int64())],
                names=["cell", "head", "others"],
            )


class CountTree:
    """A packed tree over points, with the largest counts and the smallest size below each node."""

    def __init__(self, points: np.ndarray, link: tuple[int, int] = LINK):
        self.link = link
        size = points.sum(axis=1)
        self.order = np.lexsort((*points.T[:3], size))
        self.points = points[self.order]
        self.levels = [(self.points, size[self.order])]
        while len(self.levels[-1][0]) > FANOUT:
            tops, least = self.levels[-1]
            cuts = np.arange(0, len(tops), FANOUT)
            self.levels.append((np.maximum.reduceat(tops, cuts), np.minimum.reduceat(least, cuts)))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of points, by number, that may reach the threshold."""
        top = len(self.levels[-1][0])
        a, b = np.triu_indices(top)
        for level in range(len(self.levels) - 1, -1, -1):
            tops, least = self.levels[level]
            kept = [self._may(tops, least, a[i : i + 8192], b[i : i + 8192]) for i in range(0, len(a), 8192)]
            kept = np.concatenate(kept) if kept else np.zeros(0, dtype=bool)
            a, b = a[kept], b[kept]
            if level:
                a, b = self._children(a, b, len(self.levels[level - 1][0]))
        apart = a < b
        return self.order[a[apart]], self.order[b[apart]]

    def _may(self, tops, least, a, b) -> np.ndarray:
        common = np.minimum(tops[a], tops[b]).sum(axis=1)
        return sum(self.link) * common >= self.link[0] * (least[a] + least[b])

    @staticmethod
    def _children(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        x, y = np.divmod(np.arange(FANOUT * FANOUT), FANOUT)
        first, second = (a[:, None] * FANOUT + x).ravel(), (b[:, None] * FANOUT + y).ravel()
        fine = (first < n) & (second < n) & (first <= second)
        return first[fine], second[fine]


class Bounds:
    """Group counts and parities of nodes, which bound from above what two have in common."""

    def __init__(self, rows: pa.RecordBatch | pa.Table, link: tuple[int, int], end: str = ""):
        self.link = link
        self.points = self._column(rows, f"points{end}", np.int32, GROUPS)
        self.parity = self._column(rows, f"parity{end}", np.uint8, PARITY // 8)
        self.size = self.points.sum(axis=1)

    @staticmethod
    def _column(rows: pa.RecordBatch | pa.Table, name: str, kind: type, width: int) -> np.ndarray:
        return np.frombuffer(b"".join(rows[name].to_pylist()), dtype=kind).reshape(-1, width)

    def allow(self, a: np.ndarray, other: Bounds, b: np.ndarray) -> np.ndarray:
        """Which of the pairs of nodes, by number, may reach the threshold."""
        low, high = self.link
        fine = np.zeros(len(a), dtype=bool)
        for i in range(0, len(a), 8192):
            x, y = a[i : i + 8192], b[i : i + 8192]
            total = self.size[x] + other.size[y]
            common = np.minimum(self.points[x], other.points[y]).sum(axis=1)
            apart = np.bitwise_count(self.parity[x] ^ other.parity[y]).sum(axis=1, dtype=np.int64)
            fine[i : i + 8192] = ((low + high) * common >= low * total) & ((low + high) * apart <= (high - low) * total)
        return fine


def _bounded(batches: Iterator[pa.RecordBatch], link: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs that the bounds allow to link."""
    for batch in batches:
        at = np.arange(batch.num_rows)
        fine = Bounds(batch, link, "_a").allow(at, Bounds(batch, link, "_b"), at)
        yield batch.select(["a", "b"]).filter(pa.array(fine))


def _listed(batches: Iterator[pa.RecordBatch], link: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by tile: pairs of different components that may reach the threshold."""

    def ordered(a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def apart(rows: pa.Table, bounds: Bounds, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        node, comp = rows["node"].to_numpy(), rows["comp"].to_numpy()
        other = comp[a] != comp[b]
        a, b = a[other], b[other]
        fine = bounds.allow(a, bounds, b)
        return ordered(node[a[fine]], node[b[fine]])

    def few(rows: pa.Table, tile: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All small tiles at once, by the distance of their rows."""
        bounds, at, step = Bounds(rows, link), np.arange(len(tile)), 1
        while len(at):
            at = at[: np.searchsorted(at, len(tile) - step)]
            at = at[tile[at] == tile[at + step]]
            yield apart(rows, bounds, at, at + step)
            step += 1

    def many(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(rows, link)
        yield apart(rows, bounds, *CountTree(bounds.points, link).pairs())

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = np.column_stack([rows[c].to_numpy() for c in ("cell", "i", "j")])
        heads = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        sizes = np.diff(np.append(heads, len(keys)))
        small = np.repeat(sizes <= FEW, sizes)
        if small.any():
            yield from few(rows.filter(pa.array(small)), np.repeat(np.arange(len(sizes)), sizes)[small])
        for head, size in zip(heads[sizes > FEW], sizes[sizes > FEW], strict=True):
            yield from many(rows.slice(head, size).combine_chunks())

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(c).to_numpy() for c in ("cell", "i", "j")])
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        if held and (tuple(keys[0]) != last or len(cuts)):
            cut = 0 if tuple(keys[0]) != last else cuts[0]
            yield from pairs(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held, batch, cuts = [], batch.slice(cut), cuts[cuts > cut] - cut
        if len(cuts):
            yield from pairs(pa.Table.from_batches([batch.slice(0, cuts[-1])]))
            batch = batch.slice(cuts[-1])
        held.append(batch)
        last = tuple(keys[-1])
    if held:
        yield from pairs(pa.Table.from_batches(held))


def _set_of_each(packed: dict[int, bytes], shingle: int) -> dict[int, np.ndarray]:
    """The sets of packed texts, all in one go."""
    unpack = zstandard.ZstdDecompressor()
    raw = [unpack.decompress(p) for p in packed.values()]
    offsets = np.append(0, np.cumsum([len(r) for r in raw], dtype=np.int64))
    hashes, first = shingle_sets(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets, shingle)
    return {node: hashes[a:b].copy() for node, a, b in zip(packed, first[:-1], first[1:], strict=True)}


def _verified(batches: Iterator[pa.RecordBatch], shingle: int, link: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs of packed texts whose sets link; the texts of a run of pairs are opened at once."""
    held: dict[int, np.ndarray] = {}

    def linked(pairs: list[tuple[int, int]], fresh: dict[int, bytes]) -> Iterator[bool]:
        known = {node: held[node] for pair in pairs for node in pair if node not in fresh}
        held.clear()
        held.update(known | _set_of_each(fresh, shingle))
        for a, b in pairs:
            common = len(np.intersect1d(held[a], held[b], assume_unique=True))
            yield link[1] * common >= link[0] * (len(held[a]) + len(held[b]) - common)

    for batch in batches:
        fine: list[bool] = []
        pairs: list[tuple[int, int]] = []
        fresh: dict[int, bytes] = {}
        size = 0
        for a, b, x, y in zip(*(batch[c].to_pylist() for c in ("a", "b", "packed_a", "packed_b")), strict=True):
            if size > CHUNK_BYTES:
                fine.extend(linked(pairs, fresh))
                pairs, fresh, size = [], {}, 0
            for node, packed in ((a, x), (b, y)):
                if node not in held and node not in fresh:
                    fresh[node] = packed
                    size += zstandard.frame_content_size(packed)
            pairs.append((a, b))
        if pairs:
            fine.extend(linked(pairs, fresh))
        yield batch.select(["a", "b"]).filter(pa.array(fine, type=pa.bool_()))


def _paired(pairs: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """The columns of both nodes of each pair, named by the end that they are of."""
    for end in "ab":
        own = nodes.select(F.col("node").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in columns))
        pairs = pairs.join(own.hint("merge"), end)
    return pairs


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int, link: tuple[int, int]) -> DataFrame:
    """The pairs that link, each with its smaller node first."""
    bounded = _paired(pairs, nodes, "points", "parity").mapInArrow(partial(_bounded, link=link), "a long, b long")
    near = _paired(bounded, texts, "packed")
    return written(near.mapInArrow(partial(_verified, shingle=shingle, link=link), "a long, b long"), "links")


def _open_cells(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their components, of cells that still hold several."""
    known = members.join(labels.hint("merge"), "node", "left").select(
        "cell", "node", F.coalesce("label", "node").alias("comp")
    )
    mixed = known.groupBy("cell").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.ceil(F.count("*") / TILE).cast("int").alias("tiles")
    )
    return written(known.join(mixed.filter("low <> high").select("cell", "tiles").hint("merge"), "cell"), "open")


def _pivots(open_: DataFrame, tried: DataFrame, round_: int) -> DataFrame:
    """Nodes of open cells with a member of another component: of each cell one, of each node a few cells."""
    drawn = F.xxhash64("cell", "node", F.lit(round_))
    pivot = open_.groupBy("cell").agg(F.min_by(F.struct("node", "comp"), drawn).alias("pivot"))
    some = W.partitionBy("node").orderBy(F.xxhash64("cell", F.lit(round_)))
    pairs = open_.join(pivot.hint("merge"), "cell").filter(F.col("comp") != F.col("pivot.comp"))
    pairs = pairs.withColumn("place", F.row_number().over(some)).filter(F.col("place") <= PIVOTS)
    ends = F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")
    return written(pairs.select(*ends).distinct().join(tried.hint("merge"), ["a", "b"], "left_anti"), "pivots")


def groups(
    docs: DataFrame,
    row: str = "row",
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    link: tuple[int, int] = LINK,
) -> DataFrame:
    """``row, doc_id, n_shingles, component_id, first`` of every row.

    ``row`` numbers the rows, each with a number of its own. ``first`` marks one row of each
    component, one that has the component's id. Shingles have ``shingle`` words, and two sets
    link when ``link[1]`` * intersection >= ``link[0]`` * union.
    """
    if shingle < 1 or not 0 < link[0] <= link[1]:
        raise ValueError(f"shingle {shingle}, link {link}")
    rows = docs.select(
        F.col(row).cast("long").alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    grades = docs.sparkSession.sparkContext.broadcast(_common(rows, shingle))
    make = partial(_features, shingle=shingle, link=link, grades=grades)
    features = written(rows.mapInArrow(make, FEATURES), "features")
    full = features.filter("n_shingles > 0")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    nodes = written(
        full.groupBy("k1", "k2").agg(F.min("row").alias("node"), F.min_by("points", "row").alias("points"), F.min_by("parity", "row").alias("parity"), best.alias("best")),
        "nodes",
    )
    with_cells = full.filter(F.size("cells") > 0).select("row", "cells").join(
        nodes.select(F.col("node").alias("row")).hint("merge"), "row", "left_semi"
    )
    heads = with_cells.select(F.col("row").alias("node"), "cells").mapInArrow(
        _heads, "cell long, head long, others array<long>"
    )
    over = W.partitionBy("cell")
    digest = "aggregate(others, xxhash64(head, {0}), (x, n) -> x ^ xxhash64(n, {0}))"
    cells = heads.withColumns(
        {
            "least": F.min("head").over(over),
            "n": F.sum(F.size("others") + 1).over(over),
            "x": F.bit_xor(F.expr(digest.format(1))).over(over),
            "y": F.bit_xor(F.expr(digest.format(2))).over(over),
        }
    )
    cells = written(cells.filter("n > 1"), "cells")
    # the shingles of a shared passage make cells of the same members: one of these is enough
    once = cells.groupBy("least", "n", "x", "y").agg(F.min("cell").alias("cell")).select("cell")
    members = cells.join(once.hint("merge"), "cell", "left_semi")
    members = written(
        members.select("cell", "least", F.explode(F.concat(F.array("head"), "others")).alias("node")), "members"
    )
    forget(cells)
    stars = members.filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    stars = written(stars, "stars")
    ends = members.select(F.col("node").alias("row")).distinct().hint("merge")
    texts = features.select("row", "packed").join(ends, "row", "left_semi")
    texts = written(texts.withColumnRenamed("row", "node"), "texts")
    slim = written(features.drop("points", "parity", "cells", "packed"), "rows")
    forget(features)
    links, tried = [_links(stars, nodes, texts, shingle, link)], [stars]
    labels = components(links[0])
    while True:
        open_ = _open_cells(members, labels)
        tried.append(_pivots(open_, reduce(DataFrame.unionByName, tried), len(tried)))
        links.append(_links(tried[-1], nodes, texts, shingle, link))
        found, tests = links[-1].count(), tried[-1].count()
        if found:
            labels = components(reduce(DataFrame.unionByName, links))
        forget(open_)
        if found <= FRUITFUL * tests:
            break
    open_ = _open_cells(members, labels)
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    tiled = open_.join(nodes.select("node", "points", "parity").hint("merge"), "node").withColumn("tile", tile)
    tiled = tiled.withColumn("other", other)
    tiled = tiled.withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")})
    listed = (
        tiled.select("cell", "i", "j", "node", "comp", "points", "parity")
        .repartition("cell", "i", "j")
        .sortWithinPartitions("cell", "i", "j")
        .mapInArrow(partial(_listed, link=link), "a long, b long")
        .distinct()
    )
    more = written(listed.join(reduce(DataFrame.unionByName, tried).hint("merge"), ["a", "b"], "left_anti"), "pairs")
    if more.limit(1).count():
        links.append(_links(more, nodes, texts, shingle, link))
        labels = components(reduce(DataFrame.unionByName, links))
    named = nodes.join(labels.hint("merge"), "node", "left").select("k1", "k2", "best", F.coalesce("label", "node").alias("comp"))
    named = written(named, "named")
    forget(nodes, members, texts, open_, more, *tried, *links)
    least = named.groupBy("comp").agg(F.min("best").alias("comp_best"))
    ids = named.join(least.hint("merge"), "comp").select(
        "k1", "k2", F.col("comp_best.doc_id").alias("component_id"), F.col("comp_best.row").alias("first_row")
    )
    result = slim.join(ids.hint("merge"), ["k1", "k2"], "left")
    empty = F.col("n_shingles") == 0
    return result.select(
        "row",
        "doc_id",
        "n_shingles",
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (empty | (F.col("row") == F.col("first_row"))).alias("first"),
    )
