"""Exact top-k by inner product: one ball tree per shard, branch and bound.

Vectors are dealt into shards by a hash of their id. A task builds the ball tree of its shard
(halved along the direction between two far points until leaves are small) and walks it for
many queries at once. For a node with centre c and radius r no member scores above
q.c + |q| r: level by level, a query leaves the nodes whose bound is below its current kth score.
It then takes its leaves in the order of that bound, the best few first, and raises its kth score
before it goes on; all queries that want a leaf share one matrix product with it.

The kth score is shared between shards: every query is first searched in one home shard, and
goes to the others with that shard's kth score as its floor. A vector below the floor can't
be among the k best; ties at the floor are kept. Each shard returns at most k rows per query.

How much the bound saves depends on the vectors: a query with near copies drops all leaves but a few,
and for one among vectors in random directions no bound on balls can drop any.

Queries meet shards in blocks of rows: a block of queries is sent to each shard, and the
number of rows sent is queries times shards, never queries times vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

SHARD_ROWS = 20_000
BLOCK_ROWS = 20_000
LEAF = 64
# Queries walked at once, and how many of its leaves a query takes in each round but the last.
BATCH = 1_000
ROUNDS = (2, 8)


class BallTree:
    """Nodes in arrays: centre, radius, slice of rows, children (-1: leaf)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.rows = np.argsort(ids, kind="stable")
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int]] = []
        stack = [(0, len(ids), -1, 0)]
        while stack:
            low, high, parent, side = stack.pop()
            node = len(self.radii)
            if parent >= 0:
                pair = list(self.children[parent])
                pair[side] = node
                self.children[parent] = (pair[0], pair[1])
            inside = vectors[self.rows[low:high]].astype(np.float64)
            centre = inside.mean(0)
            apart = np.sqrt(((inside - centre) ** 2).sum(1))
            self.centres.append(centre)
            self.radii.append(float(apart.max()))
            self.spans.append((low, high))
            self.children.append((-1, -1))
            if high - low > LEAF:
                far = inside[int(apart.argmax())]
                other = inside[int(((inside - far) ** 2).sum(1).argmax())]
                along = inside @ (other - far)
                middle = (high - low) // 2
                order = np.argpartition(along, middle)
                self.rows[low:high] = self.rows[low:high][order]
                stack += [(low, low + middle, node, 0), (low + middle, high, node, 1)]
        self.ids, self.vectors = ids[self.rows], vectors[self.rows]
        self.doubles = self.vectors.astype(np.float64)
        self.middle = np.array(self.centres).reshape(len(self.radii), -1)
        self.reach = np.array(self.radii)
        self.largest = float(np.abs(self.doubles).max(initial=0))


def products(queries: np.ndarray, tree: BallTree, low: int, high: int) -> np.ndarray:
    """Integer inner products: in doubles while every sum is exact there, else as integers."""
    if float(np.abs(queries).max(initial=0)) * tree.largest * queries.shape[1] < 2.0**52:
        return queries.astype(np.float64) @ tree.doubles[low:high].T
    return queries @ tree.vectors[low:high].T


def best_of(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best entries of each row, by score, ties to the smaller id; in that order."""
    order = np.lexsort((ids, -scores, rows))
    rows, scores, ids = rows[order], scores[order], ids[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], scores[place < k], ids[place < k]


def leaf_bounds(tree: BallTree, queries: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(leaves, bound of every query for each of them, -inf where a node above was dropped)."""
    norms = np.sqrt((queries**2).sum(1))
    nodes, alive, leaves, bounds = np.zeros(1, np.int64), np.ones((len(queries), 1), bool), [], []
    children = np.array(tree.children).reshape(-1, 2)
    while len(nodes):
        top = queries @ tree.middle[nodes].T + norms[:, None] * tree.reach[nodes]
        top += 1e-9 * (np.abs(top) + norms[:, None] * (tree.reach[nodes] + 1)) + 1e-6
        alive = alive & (top >= floors[:, None])
        ends = children[nodes, 0] < 0
        leaves.append(nodes[ends])
        bounds.append(np.where(alive[:, ends], top[:, ends], -np.inf))
        on = ~ends & alive.any(0)
        nodes, alive = children[nodes[on]].ravel(), np.repeat(alive[:, on], 2, axis=1)
    return np.concatenate(leaves), np.concatenate(bounds, axis=1)


def search(tree: BallTree, ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the query, score, id) of the k best of the shard at or above each query's floor."""
    none = np.zeros(0, np.int64)
    if not len(tree.ids) or not len(ids):
        return none, none, none
    least = floors.astype(np.float64)
    exact = queries.astype(np.float64)
    leaves, bounds = leaf_bounds(tree, exact, least)
    best = (none, none, none)
    for take in (*ROUNDS, len(leaves)):
        wanted = bounds >= np.maximum(least, -1e300)[:, None]
        if take < len(leaves):
            nth = np.partition(bounds, len(leaves) - take, axis=1)[:, len(leaves) - take]
            wanted &= bounds >= nth[:, None]
        bounds[wanted] = -np.inf
        parts, slack = [best], least - np.abs(least) * 1e-12  # whole numbers beyond doubles are rounded there
        for leaf in np.flatnonzero(wanted.any(0)):
            low, high = tree.spans[leaves[leaf]]
            rows = np.flatnonzero(wanted[:, leaf])
            scores = products(queries[rows], tree, low, high)
            found, at = np.nonzero(scores >= slack[rows, None])
            other = tree.ids[low + at] != ids[rows[found]]
            found, at = found[other], at[other]
            parts.append((rows[found], scores[found, at].astype(np.int64), tree.ids[low + at]))
        best = best_of(*(np.concatenate(column) for column in zip(*parts, strict=True)), k)
        counts = np.bincount(best[0], minlength=len(ids))
        kth = np.flatnonzero(counts == k)
        least[kth] = np.maximum(least[kth], best[1][np.cumsum(counts)[kth] - 1])
    return best


def whole_vectors(frame: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id`` and integer ``vector``; rows with a null or non-finite part are left out."""
    parts = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    sound = F.coalesce(
        F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False)
    )
    return frame.where(F.col(id_col).isNotNull() & sound).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(parts, lambda x: F.floor(x * scale).cast("long")).alias("vector")
    )


def top_k(frame: DataFrame, is_query: str, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows for each row that meets ``is_query``.

    ``is_query`` is a condition on ``vec_id``. All rows are candidates but those with the
    query's own id. Scores are inner products of floor(scale * x); only vectors of one length
    are compared. Ties go to the smaller id; with fewer than k candidates all are returned.
    Null vectors and those with null or non-finite parts take no part; a repeated row counts
    as often as it stands as a candidate and once as a query. Rows with one id but different vectors
    ask together: the best of all their hits make one list. Other columns are left out; an empty table
    gives no rows."""
    vectors = whole_vectors(frame, id_col, vector_col, scale)
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    dealt = vectors.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), "vec_id", "vector", F.size("vector").alias("dim")
    )
    queries = vectors.where(is_query).dropDuplicates(["vec_id", "vector"])
    asked = queries.select(
        F.col("vec_id").alias("query_id"),
        F.col("vector").alias("query"),
        F.size("vector").alias("dim"),
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("home"),
    )
    home = asked.select(F.col("home").alias("shard"), F.lit(0).alias("block"), "dim", "query_id", "query", F.lit(None).cast("long").alias("floor"))
    hits = _searched(dealt.withColumn("block", F.lit(0)), home, k)
    if shards > 1:
        first = _written(hits)
        blocks = max(1, -(-queries.count() // BLOCK_ROWS))
        floors = first.groupBy("query_id", "dim").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
        block = F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(blocks)).cast("int")
        others = (
            asked.join(floors, ["query_id", "dim"], "left")
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
            .where("shard != home")
            .select("shard", block.alias("block"), "dim", "query_id", "query", F.when(F.col("n") >= k, F.col("kth")).alias("floor"))
        )
        hits = first.unionByName(_searched(dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))), others, k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _written(frame: DataFrame) -> DataFrame:
    path = scratch_dir(frame.sparkSession, "topk")
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.parquet(path)


def _searched(dealt: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Hits of each block of queries in each shard it is sent to."""

    def searched(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        dim, parts = 0, []
        if vectors.num_rows and queries.num_rows:
            tree = BallTree(vectors.column("vec_id").to_numpy(), flat(vectors.column("vector")))
            floors = filled(queries.column("floor"))
            ids, asked_for = queries.column("query_id").to_numpy(), flat(queries.column("query"))
            dim = asked_for.shape[1]
            for at in range(0, len(ids), BATCH):
                some = slice(at, at + BATCH)
                rows, scores, found = search(tree, ids[some], asked_for[some], floors[some], k)
                parts.append((ids[some][rows], found, scores))
        columns = [pa.array(np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64), pa.int64()) for c in range(3)]
        return pa.table(
            {"query_id": columns[0], "dim": pa.array([dim] * len(columns[0]), pa.int32()), "vec_id": columns[1], "score": columns[2]}
        )

    pair = dealt.groupBy("shard", "block", "dim").cogroup(asked.groupBy("shard", "block", "dim"))
    return pair.applyInArrow(searched, "query_id long, dim int, vec_id long, score long")


def filled(floors: pa.ChunkedArray) -> np.ndarray:
    """Floors as numbers; none is far below any score."""
    return floors.fill_null(-(2**62)).to_numpy()


def flat(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length as a matrix."""
    values = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)
