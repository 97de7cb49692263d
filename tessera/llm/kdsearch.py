"""Exact top-k search with k-d trees per shard.

Vectors are dealt to shards of about ``SHARD`` rows: by distributed median splits of the
widest dimension into at most ``REGIONS`` regions, and inside a region by a hash of their id. A
shard's tree splits at medians of its widest dimension in the same way; every node knows
the tight bounding box of its vectors and their smallest id. For a query q the inner
product inside a box is at most sum(max(q_i * low_i, q_i * high_i)). Nodes are visited
best bound first until no bound can beat the kth score; a node whose bound equals it
must hold a smaller id to be visited, as ties go to smaller ids.

Queries search their own shard first. The kth score (and id) found there goes with
them, and they go on only to regions whose box could beat it. A task builds the tree of a
shard once and takes its queries as they come, batch by batch: vectors are shuffled twice, however
many queries there are. All is exact.

Scores are integer inner products: doubles hold them exactly below 2**53, beyond
that a cell counts in 64-bit integers.

Defined results: vectors that are null, or hold a null or non-finite component, take
no part; vectors of different lengths are not compared; rows of a repeated id are
candidates each, its smallest vector asks, and a query meets no row of its own id;
ids that are null take no part.
"""

from __future__ import annotations

import heapq

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tessera.llm.kdshards import route, tree
from tessera.session import materialize

K = 5
SHARD = 8_192           # vectors of a shard, about
REGIONS = 256           # regions, at most: their boxes go to every task
LEAF = 48               # vectors of a leaf, at most
EXACT = 2.0**53
LARGEST = 2**62         # components beyond are cut to it; products of such leave 64 bits anyway

HITS = "query_id long, vec_id long, score long"


class Tree:
    """A k-d tree over the rows of ``points``; nodes lie in one array, children behind parents."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.span: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        stack = [(0, len(ids), -1, 0)]
        while stack:
            a, b, parent, side = stack.pop()
            node = len(self.span)
            self.span.append((a, b))
            self.children.append(None)
            if parent >= 0:
                left, right = self.children[parent]
                self.children[parent] = (node, right) if side == 0 else (left, node)
            if b - a <= leaf or not points.shape[1]:
                continue
            own = points[order[a:b]]
            widest = int((own.max(0) - own.min(0)).argmax())
            middle = (b - a) // 2
            # By position, so that equal values split as evenly as others.
            order[a:b] = order[a:b][np.argpartition(own[:, widest], middle, kind="introselect")]
            self.children[node] = (-1, -1)
            stack += [(a + middle, b, node, 1), (a, a + middle, node, 0)]
        self.ids, self.points = ids[order], points[order]
        self.low = np.array([self.points[a:b].min(0) for a, b in self.span])
        self.high = np.array([self.points[a:b].max(0) for a, b in self.span])
        self.least = [int(self.ids[a:b].min()) for a, b in self.span]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest possible score of each query (row) in each node (column)."""
        zero = queries.dtype.type(0)
        return np.maximum(queries, zero) @ self.high.T + np.minimum(queries, zero) @ self.low.T

    def search(self, query_id: int, query: np.ndarray, bound: np.ndarray, k: int,
               known: tuple[int, int] | None) -> list[tuple[int, int]]:
        """The at most k best (score, id), better than the known kth (score, id) if there is one."""
        best: list[tuple[int, int]] = []            # heap of (score, -id): the worst on top
        worst = (known[0], -known[1]) if known else None
        frontier = [(-bound[0], 0)]
        while frontier:
            most, node = heapq.heappop(frontier)
            if worst and (-most < worst[0] or -most == worst[0] and -self.least[node] <= worst[1]):
                if -most < worst[0]:
                    break
                continue
            pair = self.children[node]
            if pair:
                for child in pair:
                    heapq.heappush(frontier, (-bound[child], child))
                continue
            a, b = self.span[node]
            scores = self.points[a:b] @ query
            for i in np.flatnonzero(scores >= worst[0]) if worst else range(b - a):
                hit = (int(scores[i]), -int(self.ids[a + i]))
                if -hit[1] == query_id or worst and hit <= worst:
                    continue
                heapq.heappush(best, hit)
                if len(best) > k:
                    heapq.heappop(best)
                if len(best) == k:
                    worst = max(worst, best[0]) if worst else best[0]
        return [(s, -i) for s, i in best]


@dataclass(frozen=True)
class Region:
    """The box of a part of the space, its smallest id, and the shards its vectors are dealt to."""

    number: int
    low: list[int]
    high: list[int]
    least: int
    shards: int


def _exactly(points: np.ndarray, asked: np.ndarray) -> bool:
    """Whether doubles hold every product and sum of the two."""
    most = lambda x: float(np.abs(x.astype(np.float64)).max(initial=0))
    return most(points) * most(asked) * max(1, points.shape[1]) < EXACT


class Cell:
    """A shard's tree, with coordinates as the queries need them."""

    def __init__(self, ids: list[np.ndarray], points: list[np.ndarray]):
        self.tree = Tree(np.concatenate(ids), np.concatenate(points))
        self.exact = (self.tree.points, self.tree.low, self.tree.high)
        self.fast = tuple(x.astype(np.float64) for x in self.exact)

    def search(self, query_ids: list[int], asked: np.ndarray, kth: list, k: int):
        tree_ = self.tree
        if _exactly(self.exact[0], asked):
            asked = asked.astype(np.float64)
            tree_.points, tree_.low, tree_.high = self.fast
        else:
            tree_.points, tree_.low, tree_.high = self.exact
        bounds = tree_.bounds(asked)
        for i, query_id in enumerate(query_ids):
            for score, vec in tree_.search(query_id, asked[i], bounds[i], k, kth[i]):
                yield query_id, vec, score


def _matrix(column) -> np.ndarray:
    """Lists of equal length as rows."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _search_cells(k: int):
    """Rows sorted by cell, vectors before queries; cells span batches, and so do the queries of a cell."""

    def run(batches):
        cell, ids, points, built = None, [], [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("dim", "region", "shard"))))
            asks = batch.column("asks").to_pylist()
            out, a = [], 0
            while a < len(keys):
                b = a + 1
                while b < len(keys) and keys[b] == keys[a] and asks[b] == asks[a]:
                    b += 1
                if keys[a] != cell:
                    cell, ids, points, built = keys[a], [], [], None
                x = _matrix(batch.column("x").slice(a, b - a)).reshape(b - a, cell[0])
                own = batch.column("id").slice(a, b - a)
                if not asks[a]:
                    ids.append(own.to_numpy())
                    points.append(x)
                elif ids:
                    built = built or Cell(ids, points)
                    kth = [None if s is None else (s, i) for s, i in zip(
                        *(batch.column(c).slice(a, b - a).to_pylist() for c in ("kth_score", "kth_id")))]
                    out += built.search(own.to_pylist(), x, kth, k)
                a = b
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["query_id", "vec_id", "score"])

    return run


def _worth(regions: list[Region]):
    """Queries with their kth score to the shards, other than their own, whose region could beat it."""
    low = np.array([r.low for r in regions], np.int64)
    high = np.array([r.high for r in regions], np.int64)

    def run(batches):
        for batch in batches:
            asked = _matrix(batch.column("x"))
            whole = not _exactly(np.vstack([low, high]), asked)
            kind = np.int64 if whole else np.float64
            q, zero = asked.astype(kind), kind(0)
            bounds = np.maximum(q, zero) @ high.T.astype(kind) + np.minimum(q, zero) @ low.T.astype(kind)
            rows, cells = [], []
            columns = [batch.column(c).to_pylist() for c in ("region", "shard", "kth_score", "kth_id")]
            for i, (home, own, score, vec) in enumerate(zip(*columns)):
                for j, r in enumerate(regions):
                    if score is None or bounds[i, j] > score or bounds[i, j] == score and r.least < vec:
                        for shard in range(r.shards):
                            if (r.number, shard) != (home, own):
                                rows.append(i)
                                cells.append((r.number, shard))
            # A query goes to many cells: in slices, so that a batch stays small.
            for a in range(0, len(rows), 10_000):
                part = batch.take(pa.array(rows[a:a + 10_000], pa.int64()))
                to = list(zip(*cells[a:a + 10_000]))
                yield part.set_column(part.schema.get_field_index("region"), "region", pa.array(to[0], pa.int32())) \
                    .set_column(part.schema.get_field_index("shard"), "shard", pa.array(to[1], pa.int32()))

    return run


def quantised(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, x) of the vectors that take part; x: floor(scale * component) as longs."""
    return (vectors.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull())
            .select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
            .where(usable("v")).select("vec_id", whole_numbers("v", scale).alias("x")))


def usable(column: str) -> Column:
    """Neither null, NaN nor infinite in any component."""
    return F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                    & (F.abs(v.cast("double")) < float("inf")))


def whole_numbers(column: str, scale: int) -> Column:
    limit = float(LARGEST)
    return F.transform(column, lambda v: F.greatest(F.least(
        F.floor(v.cast("double") * scale).cast("double"), F.lit(limit)), F.lit(-limit)).cast("long"))


def _regions(rows: DataFrame, dim: int, count: int, shard_rows: int) -> tuple[DataFrame, list[Region]]:
    """Vectors of one length with their region and shard, and the regions."""
    names = [f"c{i}" for i in range(dim)]
    wide = rows.select("vec_id", "x", F.lit(1).cast("long").alias("one"), *(F.col("x")[i].alias(n) for i, n in enumerate(names)))
    shards = -(-count // shard_rows)
    root = tree(wide, names, ["vec_id"], "one", min(shards, REGIONS)) if names else None
    placed = wide.withColumn("region", F.expr(route(root) if root else "0").cast("int"))
    found = placed.groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"),
        F.array(*(F.min(n) for n in names)).cast("array<bigint>").alias("low"),
        F.array(*(F.max(n) for n in names)).cast("array<bigint>").alias("high")).collect()     # at most REGIONS rows
    regions = [Region(r.region, r.low, r.high, r.least, -(-r.n // shard_rows)) for r in sorted(found)]
    parts = F.lit(1)
    for r in regions:
        if r.shards > 1:
            parts = F.when(F.col("region") == r.number, r.shards).otherwise(parts)
    return placed.select("vec_id", "x", "region", F.pmod(F.xxhash64("vec_id"), parts).cast("int").alias("shard")), regions


def top_k(vectors: DataFrame, is_query: Column, k: int = K, *, shard_rows: int = SHARD, **columns) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query, which is a row where ``is_query``."""
    rows = materialize(quantised(vectors, **columns).withColumn("dim", F.size("x")), "vectors")
    counts = {r.dim: r["count"] for r in rows.groupBy("dim").count().collect()}      # a row per length
    large = sorted(dim for dim, n in counts.items() if n > shard_rows)
    # Lengths of one shard need no regions, and are searched together.
    whole = rows.where(~F.col("dim").isin(large)).select(
        "vec_id", "x", "dim", F.lit(0).alias("region"), F.lit(0).alias("shard"))
    regions: dict[int, list[Region]] = {}
    for dim in large:
        placed, regions[dim] = _regions(rows.where(F.col("dim") == dim), dim, counts[dim], shard_rows)
        whole = whole.unionByName(placed.withColumn("dim", F.lit(dim)))
    stored = materialize(whole, "shards")
    none = F.lit(None).cast("long")
    # The smallest vector of an id asks, from where it lies.
    asked = stored.where(is_query).groupBy("vec_id").agg(F.min(F.struct("x", "dim", "region", "shard")).alias("q")).select(
        F.col("vec_id").alias("id"), "q.*")
    cell = ["dim", "region", "shard"]

    def search(queries: DataFrame) -> DataFrame:
        kept = [*cell, "asks", "id", "x", "kth_score", "kth_id"]
        both = (stored.select(*cell, F.lit(False).alias("asks"), F.col("vec_id").alias("id"), "x",
                              none.alias("kth_score"), none.alias("kth_id"))
                .unionByName(queries.withColumn("asks", F.lit(True)).select(*kept)))
        return (both.repartition(*cell).sortWithinPartitions(*cell, "asks").mapInArrow(_search_cells(k), HITS))

    hits = materialize(search(asked.withColumns({"kth_score": none, "kth_id": none})), "hits")
    if large:
        kth = (hits.groupBy("query_id").agg(F.count("*").alias("n"), F.min(F.struct(
            "score", (-F.col("vec_id")).alias("below"))).alias("worst"))
            .where(F.col("n") >= k).select(F.col("query_id").alias("id"), F.col("worst.score").alias("kth_score"),
                                           (-F.col("worst.below")).alias("kth_id")))
        known = asked.join(kth, "id", "left").select(*cell, "id", "x", "kth_score", "kth_id")
        away = None
        for dim in large:
            own = known.where(F.col("dim") == dim).mapInArrow(_worth(regions[dim]), known.schema)
            away = own if away is None else away.unionByName(own)
        hits = hits.unionByName(search(away))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
