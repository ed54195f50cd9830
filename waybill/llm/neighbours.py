"""Approximate nearest neighbours by collision counting.

Vectors stand in blocks of bounded size. A block projects its vectors on random lines and
sorts each line. A query opens a window around its own projection on every line and counts,
for each vector, the windows that it falls in. Virtual rehashing widens the windows step by
step: only what a wider window adds is counted. A vector that collides often enough is
verified by its exact measure, and the search ends when as many as are asked for lie within
the windows' radius. There is no limit on candidates; a block's vectors are all indexed.

The measure is the inner product. One more coordinate, ``sqrt(M*M - |x|*|x|)`` with the largest
norm M of the block, turns it into a distance with the same order.

The queries of each block follow its vectors in one sorted partition and pass through in
batches, so a task holds one block and a batch, however many queries there are. Each block
answers with its own nearest, and those of all blocks are ranked.

Vectors that are null, empty, zero, or hold a null or non-finite component, and rows without
an id, take no part; all others need one length. A query is never its own neighbour: rows with
its id are left out. Equal measures go to the smaller id; a repeated row is a candidate each
time. Fewer candidates than asked for are all returned, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waybill.llm.common import written

#: Vectors of a block, about, and lines it projects them on.
BLOCK_ROWS, LINES = 8192, 48
#: Queries whose windows a step widens together.
QUERIES_AT_ONCE = 64
#: Half a window's width as part of the radius, and how much a radius grows in each step.
HALF, GROWTH = 0.7, 1.12
#: Chance that a vector just within the radius falls in a window: a normal within HALF.
CHANCE = 0.516
#: Standard deviations below the expected number of collisions that still make a candidate.
MARGIN = 2.0


def _scaled(vectors: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Vectors by a power of two, so that squares neither overflow nor vanish; the order of measures stays."""
    return np.ldexp(vectors, -np.frexp(most)[1])


class Block:
    """The sorted lines of a block's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int):
        self.ids, self.exact = ids, vectors
        self.scaled = vectors = _scaled(vectors, np.abs(vectors).max())
        square = np.einsum("ij,ij->i", vectors, vectors)
        self.square = float(square.max())
        lift = np.sqrt(np.maximum(self.square - square, 0))
        self.lines = np.random.default_rng(seed).standard_normal((vectors.shape[1] + 1, LINES))
        places = np.column_stack([vectors, lift]) @ self.lines
        order = np.argsort(places, axis=0, kind="stable")
        self.order = order.T.astype(np.intp).ravel()
        self.sorted = [np.ascontiguousarray(np.take_along_axis(places, order, axis=0)[:, i]) for i in range(LINES)]
        self.least = int(np.ceil(CHANCE * LINES - MARGIN * np.sqrt(LINES * CHANCE * (1 - CHANCE))))

    def windows(self, places: np.ndarray, side: str = "left") -> np.ndarray:
        """Where places on each line stand in the order of all lines, line behind line."""
        n = len(self.ids)
        return np.column_stack([i * n + s.searchsorted(places[:, i], side) for i, s in enumerate(self.sorted)])

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each query, ids and measures of the block's nearest, best first.

        A step widens the windows of all queries that still search.
        """
        exact, queries = queries, _scaled(queries, np.abs(queries).max(axis=1, keepdims=True))
        searches = [Search(self, i, q, e, k) for i, q, e in zip(query_ids, queries, exact, strict=True)]
        places = queries @ self.lines[:-1]
        radius = np.array([0.4 * np.sqrt(s.most) for s in searches])
        low = self.windows(places)
        high = low.copy()
        active = np.array([i for i, s in enumerate(searches) if s.k], dtype=np.intp)
        while len(active):
            reach = HALF * radius[active, None]
            wide_low, wide_high = self.windows(places[active] - reach), self.windows(places[active] + reach, "right")
            going = [
                not searches[i].widen(
                    np.concatenate([wide_low[j], high[i]]), np.concatenate([low[i], wide_high[j]]), radius[i]
                )
                for j, i in enumerate(active)
            ]
            low[active], high[active] = wide_low, wide_high
            active = active[going]
            radius[active] *= GROWTH
        return [s.best() for s in searches]


class Search:
    """What one query has counted and verified in a block."""

    def __init__(self, block: Block, query_id: int, query: np.ndarray, exact: np.ndarray, k: int):
        self.block, self.query, self.exact = block, query, exact
        self.left = block.ids != query_id
        self.k = min(k, int(self.left.sum()))
        self.most = float(query @ query) + block.square
        self.hits = np.zeros(len(block.ids), dtype=np.uint8)
        self.found, self.scores = np.zeros(0, dtype=np.int64), np.zeros(0)

    def widen(self, starts: np.ndarray, ends: np.ndarray, radius: float) -> bool:
        """Count what stands at places ``start .. end - 1`` of the lines; whether the search ends."""
        block = self.block
        more = [block.order[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        self.hits += np.bincount(np.concatenate(more), minlength=len(block.ids)).astype(np.uint8)
        fresh = np.flatnonzero(self.left & (self.hits >= block.least))
        if len(fresh):
            self.left[fresh] = False
            self.found = np.append(self.found, fresh)
            self.scores = np.append(self.scores, np.einsum("ij,j->i", block.scaled.take(fresh, axis=0), self.query))
        if len(self.found) < self.k:
            return False
        return self.most - 2 * self.kth() <= radius * radius or not self.left.any()

    def kth(self) -> float:
        place = len(self.scores) - self.k
        return np.partition(self.scores, place)[place]

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        top = np.flatnonzero(self.scores >= self.kth()) if self.k else self.found
        ids = self.block.ids[self.found[top]]
        with np.errstate(over="ignore", invalid="ignore"):
            scores = np.einsum("ij,j->i", self.block.exact.take(self.found[top], axis=0), self.exact)
            # sums of products beyond all doubles of either sign: the measure has the scaled one's sign
            scores = np.where(np.isfinite(scores), scores, np.sign(self.scores[top]) * np.inf)
        best = np.lexsort((ids, -scores))[: self.k]
        return ids[best], scores[best]


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    seed: int = 7,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the nearest rows of every query row."""
    rows = vectors.filter(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("q")
    )
    rows = written(rows, "vectors")
    blocks = max(1, -(-rows.count() // block_rows))
    stored = rows.select((F.monotonically_increasing_id() % blocks).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "v")
    asked = rows.filter("q").select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "id", "v"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, held = None, [], []
        now = None
        for batch in batches:
            number, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.diff(number * 2 + kind)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                part = batch.slice(a, b - a)
                if number[a] != now:
                    now, block, ids, held = number[a], None, [], []
                key = part.column("id").to_numpy()
                flat = part.column("v").flatten().to_numpy().reshape(len(key), -1)
                if kind[a] == 0:
                    ids.append(key)
                    held.append(flat)
                    continue
                if block is None and held:
                    block = Block(np.concatenate(ids), np.concatenate(held), seed)
                    ids, held = [], []
                for at in range(0, len(key) if block else 0, QUERIES_AT_ONCE):
                    asking = key[at : at + QUERIES_AT_ONCE]
                    found = block.nearest(asking, flat[at : at + QUERIES_AT_ONCE], k)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(asking, [len(f[0]) for f in found])),
                            pa.array(np.concatenate([f[0] for f in found])),
                            pa.array(np.concatenate([f[1] for f in found])),
                        ],
                        names=["query_id", "vec_id", "score"],
                    )

    dealt = stored.unionByName(asked).repartition("block").sortWithinPartitions("block", "kind")
    best = dealt.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
