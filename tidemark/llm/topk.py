"""Exact top-k by inner product: ball-tree branch and bound per shard.

Vectors are dealt into shards of bounded size, queries into blocks of bounded
size.  A task has one shard and one block; it builds a ball tree and searches
it for each query, best bound first, until no node's upper bound reaches the
current k-th score.  In a first pass every query searches one shard only; its
k-th score then goes with it to all other shards, where most nodes fall to it.

Defined results: rows with a null id or a null, partly null or non-finite
vector take no part; shorter vectors count as filled up with zeros; a query
never meets rows of its own id; repeated rows are candidates each, but of one
row's copies no more than ``k`` can be among the best, so only these are kept; a
repeated query is asked once per distinct vector; equal scores go to the
smaller id; an empty table gives an empty result; other columns are ignored.
Scores are whole numbers of 64 bits: in real numbers while these are exact, up to
2^53, then in integers; a task whose vectors could exceed 64 bits ends with an
error that says so.
"""

from __future__ import annotations

import heapq
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import materialise

SHARD_ROWS = 8_192
BLOCK_QUERIES = 1_024
LEAF = 64
_RESULT = "query_id long, query_part long, vec_id long, score long"


class BallTree:
    """Centres and radii of nested halves of ``points``; leaves are ranges of ``order``."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        # whole numbers for scores, real ones for bounds
        self.whole, self.order = points, np.arange(len(points))
        self.points = points.astype(np.float64)
        points = self.points
        self.nodes: list[tuple[int, int, int, int]] = []
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        if len(points):
            self._build(leaf)
        self.centre = np.array(self.centres) if self.nodes else np.zeros((0, points.shape[1]))
        self.radius = np.array(self.radii)

    def _node(self, begin: int, end: int) -> int:
        inside = self.points[self.order[begin:end]]
        centre = inside.mean(0)
        self.centres.append(centre)
        self.radii.append(float(np.sqrt(((inside - centre) ** 2).sum(1).max())))
        self.nodes.append((begin, end, -1, -1))
        return len(self.nodes) - 1

    def _build(self, leaf: int) -> None:
        """Split at the median along the line between two far points, until leaves are small."""
        todo = [self._node(0, len(self.points))]
        while todo:
            node = todo.pop()
            begin, end, *_ = self.nodes[node]
            if end - begin <= leaf or self.radii[node] == 0:
                continue
            inside = self.points[self.order[begin:end]]
            one = inside[((inside - self.centres[node]) ** 2).sum(1).argmax()]
            other = inside[((inside - one) ** 2).sum(1).argmax()]
            along = inside @ (other - one)
            half = (end - begin) // 2
            self.order[begin:end] = self.order[begin:end][np.argpartition(along, half)]
            left, right = self._node(begin, begin + half), self._node(begin + half, end)
            self.nodes[node] = (begin, end, left, right)
            todo += [left, right]

    def search(self, query: np.ndarray, ids: np.ndarray, own_id: int, k: int, floor: float) -> list[tuple[int, int]]:
        """The ``k`` best (score, id) of at least ``floor``; nodes in order of their upper bounds."""
        if not self.nodes:
            return []
        # bounds are real numbers, scores whole ones: the slack, relative to all that is summed, outweighs rounding
        real = query.astype(np.float64)
        length = np.sqrt(real @ real)
        reach = length * self.radius
        bounds = self.centre @ real + reach + 1e-9 * (length * np.sqrt((self.centre**2).sum(1)) + reach) + 1e-3
        kept: list[tuple[int, int]] = []
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < floor:
                break
            begin, end, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    if bounds[child] >= floor:
                        heapq.heappush(queue, (-bounds[child], child))
                continue
            rows = self.order[begin:end]
            scores = self.whole[rows] @ query
            for place in np.flatnonzero(scores >= floor):
                row_id = int(ids[rows[place]])
                if row_id == own_id:
                    continue
                entry = (int(scores[place]), -row_id)
                if len(kept) < k:
                    heapq.heappush(kept, entry)
                elif entry > kept[0]:
                    heapq.heapreplace(kept, entry)
                if len(kept) == k:
                    floor = max(floor, kept[0][0])
        return [(score, -row_id) for score, row_id in sorted(kept, reverse=True)]


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of a matrix, filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _width(column: pa.ChunkedArray) -> int:
    return max(1, pc.max(pc.list_value_length(column)).as_py() or 0)


def _exact(points: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the type whose products and sums are exact."""
    largest = [int(max(m.max(initial=0), -int(m.min(initial=0)))) for m in (points, asked)]
    most = points.shape[1] * largest[0] * largest[1]
    if most < 1 << 53:
        return points.astype(np.float64), asked.astype(np.float64)
    if most >= 1 << 63:
        raise ValueError("inner products of these vectors may exceed 64 bits: scale them down")
    return points, asked


def _search_group(queries: pa.Table, shard: pa.Table, k: int) -> pa.Table:
    if not len(queries) or not len(shard):
        return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "query_part", "vec_id", "score")})
    width = max(_width(t["vector"]) for t in (queries, shard))
    points, asked = _exact(_matrix(shard["vector"], width), _matrix(queries["vector"], width))
    ids, tree = shard["vec_id"].to_numpy(), BallTree(points)
    rows: list[tuple[int, int, int, int]] = []
    heads = zip(queries["vec_id"].to_pylist(), queries["part"].to_pylist(), queries["floor"].to_pylist(), asked, strict=True)
    for query_id, part, floor, query in heads:
        least = -np.inf if floor is None else floor
        rows += [(query_id, part, row_id, score) for score, row_id in tree.search(query, ids, query_id, k, least)]
    names = ("query_id", "query_part", "vec_id", "score")
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def quantised(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component; null for a vector with a null or non-finite one."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(wide, lambda x: F.floor(scale * x).cast("long")))


def top_k(
    rows: DataFrame,
    is_query: Column,
    k: int,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """Per query its ``k`` best other rows: query_id, rank, vec_id, score.

    Rows are copied once per block of queries and queries once per shard, as an
    exact search of all against all has to; a task's share stays bounded.
    """
    points = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"), quantised(F.col(vector), scale).alias("vector"), is_query.alias("asks")
    ).where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    # copies of a row share id and vector, so their group is counted before it is shuffled
    told_apart = points.groupBy("vec_id", "vector", "asks").agg(F.count("*").alias("copies"))
    points = told_apart.select("vec_id", "vector", "asks", F.explode(F.sequence(F.lit(1), F.least(F.lit(k), F.col("copies")).cast("int"))).alias("copy"))
    points = materialise(points, "topk-points")
    n_points, n_queries = points.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = max(1, -(-n_points // shard_rows)), max(1, -(-n_queries // block_queries))
    spot, dealt = F.xxhash64("vec_id", F.col("vector")), F.xxhash64("vec_id", F.col("vector"), "copy")
    shard = points.select(
        "vec_id", "vector", F.pmod(dealt, F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    )
    asking = points.where("asks").dropDuplicates(["vec_id", "vector"]).select(
        "vec_id",
        "vector",
        spot.alias("part"),
        F.pmod(spot, F.lit(shards)).alias("home"),
        F.pmod(F.xxhash64(F.lit(1), spot), F.lit(blocks)).alias("block"),
    )
    queries = materialise(asking, "topk-queries")

    def search(asked: DataFrame) -> DataFrame:
        """Every asked query in the shard it names."""
        return (
            asked.groupBy("shard", "block")
            .cogroup(shard.groupBy("shard", "block"))
            .applyInArrow(lambda q, s: _search_group(q, s, k), _RESULT)
        )

    none = F.lit(None).cast("double")
    at_home = queries.select("vec_id", "vector", "part", "block", F.col("home").alias("shard"), none.alias("floor"))
    home = materialise(search(at_home), "topk-home")
    kth = home.groupBy("query_id", "query_part").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bound = kth.select(
        F.col("query_id").alias("_id"), F.col("query_part").alias("_part"), F.when(F.col("n") == k, F.col("least")).cast("double").alias("floor")
    )
    onward = queries.join(bound, (F.col("vec_id") == F.col("_id")) & (F.col("part") == F.col("_part")), "left")
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")), lambda s: s != F.col("home"))
    away = search(
        onward.select("vec_id", "vector", "part", "block", F.explode(others).alias("shard"), "floor")
    )
    order = W.partitionBy("query_id", "query_part").orderBy(F.col("score").desc(), F.col("vec_id"))
    found = home.unionByName(away) if shards > 1 else home
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
