"""Exact top-k inner products over KD-trees, one tree per shard.

Space is cut into cells by the top of one KD-tree, whose median splits come from a bounded sample (`SAMPLE_ROWS`). A cell's
rows are dealt into as many shards as they ask for, by the hash of their id, so that equal vectors, however many, are spread;
and every cell has a tight bounding box of all its rows. A shard's task builds its own tree: median splits on the widest
dimension and a tight box at every node. For a query q and a box [lo, hi] the sum of max(q*lo, q*hi) bounds every inner
product in it; nodes are opened best first by that bound, and the traversal ends once the best open bound is below the k-th
score so far. The k-th score travels: each query first searches one shard of the cell of its highest bound, and with the
k-th score found there enters only the shards of cells whose box may hold as high a score. Queries meet a shard in blocks,
as many as it has queries, so a task holds one shard and one block. All scores are integers in int64 and so exact.

There are at most `MOST_CELLS` cells, and fewer in many dimensions (`MOST_NUMBERS`): every task gets their splits and boxes.

Cases: vectors that are null, hold a null or a non-finite component, or have another length than most take no part, as
query or as candidate (vectors of different lengths have no product). Equal scores go to the smaller id; a row is never
its own candidate, and rows that share an id count as one row each, none a candidate for the others' query. An empty
table gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from comarca.llm.common import Scratch, cut

LEAF = 64
#: Rows of a shard and of a block of queries, at most: what is copied for N rows and Q queries is N * Q * (1 / SHARD_ROWS + 1 / QUERY_ROWS) rows where nothing is pruned.
SHARD_ROWS = 8192
QUERY_ROWS = 4096
#: Rows, at most, that the cells' splits are fitted on.
SAMPLE_ROWS = 20_000
#: Cells, and numbers of all their boxes, at most.
MOST_CELLS, MOST_NUMBERS = 4_096, 1 << 19


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) with v = floor(256 * x) as array<long>, of the rows whose vectors are whole and finite."""
    x = F.col(vector)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    whole = vectors.where(x.isNotNull() & (F.size(x) > 0) & ~bad & F.col(vec_id).isNotNull())
    return whole.select(F.col(vec_id).cast("long").alias("id"), F.transform(x, lambda e: F.floor(e.cast("double") * 256.0)).alias("v"))


class KdTree:
    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.ids, self.points, self.lo, self.hi, self.span, self.kids = ids, points, [], [], [], []
        if len(ids):
            self.order = np.arange(len(ids))
            self._build(0, len(ids))
            self.ids, self.points = ids[self.order], points[self.order]
            self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def _build(self, a: int, b: int) -> int:
        own, here = self.points[self.order[a:b]], len(self.span)
        lo, hi = own.min(axis=0), own.max(axis=0)
        self.lo.append(lo)
        self.hi.append(hi)
        self.span.append((a, b))
        self.kids.append(None)
        wide = int(np.argmax(hi - lo))
        if b - a > LEAF and hi[wide] > lo[wide]:
            mid = (a + b) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(own[:, wide], mid - a)]
            self.kids[here] = (self._build(a, mid), self._build(mid, b))
        return here

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of every query's product with every node's box."""
        return np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T

    def top(self, query_id: int, query: np.ndarray, bound: np.ndarray, k: int, kth: int | None) -> list[tuple[int, int]]:
        """Up to k (score, id), best first, that may still be among the k best if the k-th score elsewhere is kth."""
        best: list[tuple[int, int]] = []  # heap of (score, -id), the worst on top
        open_ = [(-int(bound[0]), 0)]
        while open_:
            most, node = heapq.heappop(open_)
            floor = max((x for x in (kth, best[0][0] if len(best) == k else None) if x is not None), default=None)
            if floor is not None and -most < floor:
                break
            if self.kids[node]:
                for kid in self.kids[node]:
                    if floor is None or bound[kid] >= floor:
                        heapq.heappush(open_, (-int(bound[kid]), kid))
                continue
            a, b = self.span[node]
            scores = self.points[a:b] @ query
            near = np.flatnonzero(self.ids[a:b] != query_id)
            if floor is not None:
                near = near[scores[near] >= floor]
            for score, other in zip(scores[near].tolist(), self.ids[a:b][near].tolist(), strict=True):
                if len(best) < k:
                    heapq.heappush(best, (score, -other))
                elif (score, -other) > best[0]:
                    heapq.heapreplace(best, (score, -other))
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _search(k: int):
    out = pa.schema([("query_id", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64())])

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            matrix = lambda t: t.column("v").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
            tree, queries = KdTree(left.column("id").to_numpy(), matrix(left)), matrix(right)
            bounds = tree.bounds(queries)
            for n, (q, kth) in enumerate(zip(right.column("id").to_pylist(), right.column("kth").to_pylist(), strict=True)):
                rows += [(q, s, i) for s, i in tree.top(q, queries[n], bounds[n], k, kth)]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 3, schema=out)

    return run


class Cells:
    """The top of a KD-tree: median splits of a sample, down to `cells` leaves."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.split, self.at, self.kids, self.leaves = [], [], [], 0
        self._build(sample, cells)
        self.split, self.at, self.kids = np.array(self.split, np.int64), np.array(self.at, np.float64), np.array(self.kids, np.int64).reshape(-1, 2)

    def _build(self, own: np.ndarray, cells: int) -> int:
        """The number of the node of own, or of a leaf counted from -1 downwards."""
        spread = own.max(axis=0) - own.min(axis=0) if len(own) else np.zeros(1)
        wide = int(np.argmax(spread))
        if cells < 2 or spread[wide] == 0:
            self.leaves += 1
            return -self.leaves
        middle = np.median(own[:, wide])
        low = own[:, wide] <= middle if middle < own[:, wide].max() else own[:, wide] < middle
        here = len(self.split)
        self.split.append(wide)
        self.at.append(float(own[low, wide].max()))
        self.kids.append((0, 0))
        self.kids[here] = (self._build(own[low], cells // 2), self._build(own[~low], cells - cells // 2))
        return here

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell, from 0, of each point."""
        node = np.full(len(points), 0 if len(self.split) else -1)
        while (inner := np.flatnonzero(node >= 0)).size:
            n = node[inner]
            node[inner] = self.kids[n, (points[inner, self.split[n]] > self.at[n]).astype(np.int64)]
        return -node - 1


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _cell_udf(cells: Cells, d: int):
    @F.arrow_udf("int")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(cells.of(_matrix(batch, d)), pa.int32())

    return run


def _boxes(rows: DataFrame, d: int) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Number of rows and tight box of each cell; a task gives one box for each cell it saw, and those of a cell meet in one group."""
    kind = pa.schema([("cell", pa.int32()), ("rows", pa.int64()), ("lo", pa.list_(pa.int64())), ("hi", pa.list_(pa.int64()))])
    ddl = "cell int, rows long, lo array<long>, hi array<long>"

    def joined(parts: Iterator[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        held: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        for cell, n, lo, hi in parts:
            m, a, b = held.get(cell, (0, lo, hi))
            held[cell] = (m + n, np.minimum(a, lo), np.maximum(b, hi))
        return pa.record_batch([list(held), [x[0] for x in held.values()], [x[1].tolist() for x in held.values()], [x[2].tolist() for x in held.values()]], schema=kind)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for batch in batches:
            cell, v = batch.column("cell").to_numpy(), _matrix(batch.column("v"), d)
            for c in np.unique(cell):
                own = v[cell == c]
                yield int(c), len(own), own.min(axis=0), own.max(axis=0)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield joined(seen(batches))

    def whole(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in ("cell", "rows", "lo", "hi")]
        return pa.Table.from_batches([joined((c, n, np.array(lo), np.array(hi)) for c, n, lo, hi in zip(*columns, strict=True))])

    found = rows.select("cell", "v").mapInArrow(partial, ddl).groupBy("cell").applyInArrow(whole, ddl).collect()  # MOST_CELLS rows at most
    return {r["cell"]: (r["rows"], np.array(r["lo"]), np.array(r["hi"])) for r in found}


class Shards:
    """Which shards a query must enter: those of cells whose box may hold its k-th score."""

    def __init__(self, boxes: dict[int, tuple[int, np.ndarray, np.ndarray]], shard_rows: int):
        self.cells = sorted(boxes)
        self.parts = np.array([max(1, -(-boxes[c][0] // shard_rows)) for c in self.cells], np.int64)
        self.first = np.r_[0, np.cumsum(self.parts)]
        self.lo, self.hi = (np.array([boxes[c][k] for c in self.cells], np.float64) for k in (1, 2))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds in floating point, widened by more than their rounding."""
        q = queries.astype(np.float64)
        bound = np.maximum(q, 0) @ self.hi.T + np.minimum(q, 0) @ self.lo.T
        size = np.abs(q) @ np.maximum(np.abs(self.lo), np.abs(self.hi)).T
        return bound + 1 + 1e-9 * size

    def shard_of(self):
        """Column function (cell, id): the shard that a row lies in."""
        starts, parts = np.zeros(self.cells[-1] + 1, np.int64), np.ones(self.cells[-1] + 1, np.int64)
        starts[self.cells], parts[self.cells] = self.first[:-1], self.parts
        listed = lambda x: F.array(*[F.lit(int(y)) for y in x])
        return lambda cell, key: (F.get(listed(starts), cell) + F.pmod(F.xxhash64(key, F.lit(1)), F.get(listed(parts), cell))).cast("int")

    def home_udf(self, d: int):
        """A shard of the cell of highest bound."""

        @F.arrow_udf("int")
        def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for v, draw in batches:
                best = np.argmax(self.bounds(_matrix(v, d)), axis=1)
                yield pa.array(self.first[best] + draw.to_numpy() % self.parts[best], pa.int32())

        return run

    def others_udf(self, d: int):
        """The shards, other than the home, that may hold the k-th score; all where there is none yet."""

        @F.arrow_udf("array<int>")
        def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for v, kth, home in batches:
                least = np.array([-np.inf if x is None else x for x in kth.to_pylist()])
                fits = self.bounds(_matrix(v, d)) >= least[:, None]
                rows = [np.concatenate([np.arange(self.first[c], self.first[c + 1]) for c in np.flatnonzero(f)] or [np.zeros(0, np.int64)]) for f in fits]
                yield pa.array([r[r != h] for r, h in zip(rows, home.to_pylist(), strict=True)], pa.list_(pa.int32()))

        return run


def _deal(n, seed: int):
    """A block number of 0..n-1."""
    return F.pmod(F.xxhash64("id", F.lit(seed)), n).cast("int")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """vectors, queries: (id, v) as usable() makes them. Returns query_id, rank, vec_id, score."""
    with Scratch(vectors.sparkSession, "top_k") as scratch:
        return cut(_top_k(vectors, queries, k, shard_rows, query_rows, scratch))


def _top_k(vectors: DataFrame, queries: DataFrame, k: int, shard_rows: int, query_rows: int, scratch: Scratch) -> DataFrame:
    most = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d, n = (most["d"], most["count"]) if most else (1, 0)
    vectors, queries = vectors.where(F.size("v") == d), queries.where(F.size("v") == d)
    whole = 1 << 30
    some = vectors.where(F.pmod(F.xxhash64("id", "v"), F.lit(whole)) < min(whole, int(whole * SAMPLE_ROWS / max(1, n)))).select("v").limit(SAMPLE_ROWS).toArrow()
    cells = Cells(_matrix(some.column("v").combine_chunks(), d), max(1, min(MOST_CELLS, MOST_NUMBERS // d, -(-n // shard_rows))))
    placed = scratch.cut(vectors.select("id", "v", _cell_udf(cells, d)("v").alias("cell")))
    boxes = _boxes(placed, d)
    if not boxes:
        return vectors.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score"))
    shards = Shards(boxes, shard_rows)
    own = placed.select("id", "v", shards.shard_of()(F.col("cell"), F.col("id")).alias("shard"))
    asks = queries.select(F.col("id").alias("id"), F.col("v").alias("v")).dropDuplicates(["id", "v"])
    asks = scratch.cut(asks.withColumn("home", shards.home_udf(d)("v", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 31)))))

    def search(asked: DataFrame) -> DataFrame:
        """asked (shard, id, v, kth): what each shard finds. A shard meets its queries in as many blocks as they ask for, and one without any is not read."""
        blocks = asked.groupBy("shard").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("blocks"))
        rows = own.join(blocks, "shard").select("id", "v", "shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        dealt = asked.join(blocks, "shard").select("id", "v", "shard", _deal(F.col("blocks"), 2).alias("block"), "kth")
        return rows.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block")).applyInArrow(_search(k), "query_id long, score long, vec_id long")

    found = scratch.cut(search(asks.select("id", "v", F.col("home").alias("shard"), F.lit(None).cast("long").alias("kth"))))
    if shards.first[-1] > 1:
        kth = found.groupBy("query_id").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") >= k).select(F.col("query_id").alias("id"), "kth")
        known = asks.join(kth, "id", "left").select("id", "v", "kth", F.explode(shards.others_udf(d)("v", "kth", "home")).alias("shard"))
        found = found.unionByName(scratch.cut(search(scratch.cut(known))))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
