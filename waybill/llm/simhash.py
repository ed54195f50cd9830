"""Near duplicates by SimHash: fingerprints that differ in few bits, and their components.

A fingerprint's bits are cut into segments and the number of ones of each segment makes a point
of a grid. Two fingerprints that differ in d bits stand at most d steps apart there (Manhattan
distance), so links are found by a range join on the grid and then verified on the bits. For
links of two bits, every fingerprint goes to its own grid point and to all points one step away:
two points at most two steps apart share one of these, the one between them. Segments have two
bits, so a grid point fits a 64-bit number exactly and is no hash.

Equal fingerprints are one node. Nodes meet point by point, in rows sorted by point, and a point
gives as many edges as connect what links there, never all pairs. A point where more than
``CROWD`` nodes meet isn't held: its nodes are streamed on with segments of one bit, where the
points are the fingerprints one bit away and all that meet there link without a test. At most 65
fingerprints meet at such a point.

Words are runs of characters other than the six ASCII white ones, with A-Z lower-cased; shingles
count as often as they occur; with fewer words than a shingle has, the whole sequence is the only
one. Null text and text without words has the fingerprint zero, which links like any other. Rows
with equal ids, and with null ids, are documents of their own; a component's id is its smallest
id that is not null, or null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waybill.llm.common import chunks, flat_text, lists, written
from waybill.llm.graph import components

SHINGLE, SEED = 3, 42
#: Fingerprints link at this many differing bits or fewer; the grid's shared points allow two.
BITS_APART = 2
#: Nodes of a grid point that are compared with each other; beyond, segments are of one bit.
CROWD = 1024
#: Shingles whose bits are counted at once; grid rows of a task.
BLOCK, TASK_ROWS = 1 << 17, 4_000_000

_INSIDE = np.ones(256, dtype=bool)
_INSIDE[[9, 10, 11, 12, 13, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LOW = np.uint64(0x5555555555555555)
_STEPS = np.uint64(1) << np.arange(0, 64, 2, dtype=np.uint64)


def _joined_words(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words with one space before each, their starts and ends there, each text's first word."""
    inside = _INSIDE[data]
    begins = inside & ~np.append(False, inside)[:-1]
    cut = offsets[:-1][np.diff(offsets) > 0]
    begins[cut] = inside[cut]
    at = np.flatnonzero(begins)
    letters = np.cumsum(inside)
    before = letters[at] - 1
    number = np.arange(len(at))
    buffer = np.full((int(letters[-1]) if len(letters) else 0) + len(at), 32, dtype=np.uint8)
    buffer[(letters - 1 + np.cumsum(begins))[inside]] = _LOWER[data[inside]]
    ends = np.append(before[1:], letters[-1:])[: len(at)] + number + 1
    return buffer.tobytes(), before + number + 1, ends, np.searchsorted(at, offsets)


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The fingerprint of each of the texts one after the other."""
    buffer, starts, ends, first = _joined_words(data, offsets)
    words = np.diff(first)
    many = np.where(words > 0, np.maximum(words - SHINGLE + 1, 1), 0)
    text = np.repeat(np.arange(len(words)), many)
    cuts = np.cumsum(many) - many
    at = np.arange(len(text)) - cuts[text] + first[:-1][text]
    low, high = starts[at], ends[np.minimum(at + SHINGLE, first[1:][text]) - 1]
    ones = np.zeros((len(words), 64), dtype=np.int64)
    hash64 = xxhash.xxh64_intdigest
    for a in range(0, len(text), BLOCK):
        spans = zip(low[a : a + BLOCK].tolist(), high[a : a + BLOCK].tolist(), strict=True)
        hashes = np.array([hash64(buffer[x:y], SEED) for x, y in spans], dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        row = text[a : a + BLOCK]
        heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        ones[row[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > many[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint of a chunk once, with the ids that have it: copies are combined before the shuffle."""
    for batch in chunks(batches):
        found = fingerprints(*flat_text(batch.column("text"))).view(np.int64)
        order = np.argsort(found, kind="stable")
        heads = np.flatnonzero(np.append(True, np.diff(found[order]) != 0))
        ids = batch.column("doc_id").take(pa.array(order))
        cut = pa.array(np.append(heads, len(order)).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found[order][heads]), pa.ListArray.from_arrays(cut, ids)], names=["node", "ids"]
        )


def grid(prints: np.ndarray) -> np.ndarray:
    """Ones of each segment, two bits for each."""
    return prints - (prints >> np.uint64(1) & _LOW)


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node at its grid point and at all points one step away."""
    for batch in batches:
        node = batch.column("node").to_numpy()
        for a in range(0, len(node), 4096):
            part = node[a : a + 4096]
            point = grid(part.view(np.uint64))
            rows, points = [np.arange(len(part))], [point]
            for i, step in enumerate(_STEPS):
                ones = point >> np.uint64(2 * i) & np.uint64(3)
                for may, near in ((ones < 2, point + step), (ones > 0, point - step)):
                    rows.append(np.flatnonzero(may))
                    points.append(near[may])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(points).view(np.int64)), pa.array(part[np.concatenate(rows)])],
                names=["point", "node"],
            )


def _edges(point: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the nodes which link at a point; rows are sorted by point."""
    firsts, seconds = [], []
    at, step = np.arange(len(point)), 1
    while True:
        at = at[: np.searchsorted(at, len(point) - step)]
        at = at[point[at] == point[at + step]]
        if not len(at):
            break
        near = np.bitwise_count((node[at] ^ node[at + step]).view(np.uint64)) <= BITS_APART
        firsts.append(at[near])
        seconds.append(at[near] + step)
        step += 1
    label = np.arange(len(point))
    if firsts:
        a, b = np.concatenate(firsts), np.concatenate(seconds)
        while True:
            least = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, a, least)
            np.minimum.at(new, b, least)
            new = new[new]
            if (new == label).all():
                break
            label = new
    joined = np.flatnonzero(label != np.arange(len(label)))
    return node[label[joined]], node[joined]


def _met(batches: Iterator[pa.RecordBatch], crowd: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by point: edges, and for crowded points their nodes at the next finer points."""

    def edges(point, node):
        a, b = _edges(point, node)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.zeros(len(a), dtype=bool))], names=["a", "b", "finer"])

    def finer(node):
        for a in range(0, len(node), 4096):
            part = node[a : a + 4096].view(np.uint64)[:, None]
            near = np.column_stack([part, part ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))])
            points, nodes = near.ravel().view(np.int64), np.repeat(node[a : a + 4096], 65)
            yield pa.RecordBatch.from_arrays([pa.array(points), pa.array(nodes), pa.array(np.ones(len(nodes), dtype=bool))], names=["a", "b", "finer"])

    point, node, full = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), None
    for batch in batches:
        if not batch.num_rows:
            continue
        point = np.concatenate([point, batch.column("point").to_numpy()])
        node = np.concatenate([node, batch.column("node").to_numpy()])
        heads = np.flatnonzero(np.append(True, point[1:] != point[:-1]))
        sizes = np.diff(np.append(heads, len(point)))
        crowded = (sizes > crowd) | (point[heads] == full if full is not None else False)
        done = np.repeat(crowded, sizes)
        yield from finer(node[done])
        full = point[-1] if len(point) and crowded[-1] else None
        # the last point's rows go on in the next batch
        open_ = np.zeros(len(point), dtype=bool)
        open_[heads[-1] :] = not crowded[-1]
        rest = ~done & ~open_
        yield edges(point[rest], node[rest])
        point, node = point[open_], node[open_]
    yield edges(point, node)


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    features = written(rows.mapInArrow(_features, "node long, ids array<long>"), "fingerprints")
    nodes = written(features.groupBy("node").agg(F.min(F.array_min("ids")).alias("least")), "nodes")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), nodes.count() * 65 // TASK_ROWS)
    around = nodes.select("node").mapInArrow(_around, "point long, node long")
    met = (
        around.repartition(tasks, "point")
        .sortWithinPartitions("point")
        .mapInArrow(partial(_met, crowd=crowd), "a long, b long, finer boolean")
    )
    met = written(met, "met")
    # at most 65 fingerprints are one bit or none away from a point
    finer = met.filter("finer").select("a", "b").distinct()
    stars = finer.withColumn("least", F.min("b").over(W.partitionBy("a"))).filter("b <> least")
    labels = components(met.filter("not finer").select("a", "b").unionByName(stars.select(F.col("least").alias("a"), "b")))
    named = nodes.join(labels.hint("merge"), "node", "left").select("node", "least", F.coalesce("label", "node").alias("comp"))
    named = written(named, "named")
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    ids = named.select("node", "comp").join(least.hint("merge"), "comp").select("node", "component_id")
    result = features.join(ids.hint("merge"), "node")
    return result.select(
        F.explode("ids").alias("doc_id"),
        F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
