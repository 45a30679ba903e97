"""Exact top-k inner products by branch and bound over a ball tree per shard.

Vectors are dealt into shards by a hash of their id; each shard is one row with its vectors. Queries are packed into
blocks; a block meets each shard once. A task takes a shard and up to BATCH blocks, builds the shard's ball tree once, and
walks it from the root with each block's queries: a node is left by each query whose kth score so far beats the
node's bound  q.c + |q| r; the child with the larger bound goes first. The kth score is shared: a first round visits one
shard per block, and its kth scores bound the search in all others.

Scores are integer inner products of floor(scale * x), exact in float64 while they stay below 2^53; bounds are
widened by a relative 1e-9, so rounding never prunes a row that belongs in the result. Where a vector's length times
a query's is 2^53 or more, the job stops with an error rather than give inexact scores.

A query is a row, told by its block and place; its id only says which rows are not its candidates.

Cases: null and empty vectors, and vectors with a null or non-finite component, take no part; queries meet vectors
of their own length only. Ties go to the smaller id. Rows with a null id take no part; equal ids are rows of their own:
each is a candidate, and each that is asked gets rows of its own (a query's own id is never its candidate). A query with fewer than k candidates gets all. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

K, SCALE, EVERY = 5, 256, 50
#: Vectors in a shard, queries in a block, vectors in a leaf.
SHARD, BLOCK, LEAF = 8192, 1024, 128
#: Blocks that a task takes to a shard at most.
BATCH = 64


class BallTree:
    """Nodes over rows of x: centre, radius and either two children or a range of ``rows``."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x, self.rows, self.leaf = x, np.arange(len(x)), leaf
        self.nodes: list[tuple] = []
        self.root = self.build(0, len(x))

    def build(self, a: int, b: int) -> int:
        mine = self.x[self.rows[a:b]]
        centre = mine.mean(0)
        away = np.sqrt(((mine - centre) ** 2).sum(1))
        children = None
        if b - a > self.leaf and away.max() > 0:
            far = mine[away.argmax()]
            other = mine[((mine - far) ** 2).sum(1).argmax()]
            side = mine @ (other - far)
            order = np.argsort(side, kind="stable")
            self.rows[a:b] = self.rows[a:b][order]
            middle = (a + b) // 2
            children = self.build(a, middle), self.build(middle, b)
        self.nodes.append((centre, away.max(), a, b, children))
        return len(self.nodes) - 1


class Best:
    """The k best (score, id) of each query, ordered by score down and id up."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.scores, self.ids = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
        self.floor = floor.copy()

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        k = self.scores.shape[1]
        s = np.concatenate([self.scores[queries], scores], 1)
        i = np.concatenate([self.ids[queries], np.broadcast_to(ids, scores.shape)], 1)
        order = np.lexsort((i, -s), axis=1)[:, :k]
        self.scores[queries], self.ids[queries] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
        self.floor[queries] = np.maximum(self.floor[queries], self.scores[queries, -1])


def search(tree: BallTree, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, best: Best) -> None:
    lengths = np.sqrt((queries**2).sum(1))

    def bound(node: int, of: np.ndarray) -> np.ndarray:
        centre, radius = tree.nodes[node][:2]
        value = queries[of] @ centre + lengths[of] * radius
        return value + 1e-9 * (1 + np.abs(value))

    stack = [(tree.root, np.arange(len(queries)), bound(tree.root, np.arange(len(queries))))]
    while stack:
        node, of, most = stack.pop()
        of = of[most >= best.floor[of]]  # a tie may still win by its id
        if not len(of):
            continue
        _, _, a, b, children = tree.nodes[node]
        if children is None:
            rows = tree.rows[a:b]
            scores = queries[of] @ tree.x[rows].T
            scores[query_ids[of][:, None] == ids[rows][None, :]] = -np.inf
            hit = (scores >= best.floor[of][:, None]).any(1)
            if hit.any():
                best.add(of[hit], scores[hit], np.where(np.isinf(scores[hit]), np.iinfo(np.int64).max, ids[rows][None, :]))
        else:
            bounds = [(bound(c, of), c) for c in children]
            bounds.sort(key=lambda x: x[0].mean())
            stack.extend((c, of, value) for value, c in bounds)


def packed(vectors: DataFrame, key: str, name: str) -> DataFrame:
    """One row per value of (key, width): its ids and its vectors as float64 bytes, vector by vector, ids ascending."""

    def pack(keys, table):
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)[order]
        own = [pa.array([k.as_py()], pa.int32()) for k in keys]
        return pa.table([*own, pa.array([ids[order].tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())], [key, "width", f"{name}_ids", name])

    return vectors.groupBy(key, "width").applyInArrow(pack, f"{key} int, width int, {name}_ids binary, {name} binary")


def visit(trees: DataFrame, pairs: DataFrame, k: int, batches: int) -> DataFrame:
    """Searches the shard of each row of pairs (shard_no, width, a block, floor): the k best of each query there, at or above its floor."""

    def run(keys, shard, blocks):
        found = {name: [] for name in ("block_no", "place", "query_id", "vec_id", "score")}
        if shard.num_rows and blocks.num_rows:
            width = keys[1].as_py()
            ids = np.frombuffer(shard.column("shard_ids")[0].as_buffer(), np.int64)
            tree = BallTree(np.frombuffer(shard.column("shard")[0].as_buffer(), np.float64).reshape(-1, width))
            longest = np.sqrt((tree.x**2).sum(1).max())
            for row in blocks.to_pylist():
                query_ids, q = np.frombuffer(row["block_ids"], np.int64), np.frombuffer(row["block"], np.float64).reshape(-1, width)
                if longest * np.sqrt((q**2).sum(1).max()) >= 2.0**53:
                    raise ValueError("scores of 2^53 or more: use a smaller scale")
                floor = np.frombuffer(row["floor"], np.float64) if row["floor"] else np.full(len(q), -np.inf)
                best = Best(len(q), k, floor)
                search(tree, ids, q, query_ids, best)
                at, rank = np.nonzero(np.isfinite(best.scores) & (best.scores >= floor[:, None]))
                for name, values in zip(found, (np.full(len(at), row["block_no"]), at, query_ids[at], best.ids[at, rank], best.scores[at, rank].astype(np.int64))):
                    found[name].append(values)
        one = {name: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for name, v in found.items()}
        return pa.table([one["block_no"].cast(pa.int32()), pa.array(np.full(len(one["score"]), keys[1].as_py()), pa.int32()), one["place"].cast(pa.int32()), one["query_id"], one["vec_id"], one["score"]], ["block_no", "width", "place", "query_id", "vec_id", "score"])

    pairs = pairs.withColumn("batch", F.floor(F.col("block_no") / BATCH).cast("int"))
    trees = trees.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    on = ("shard_no", "width", "batch")
    return trees.groupBy(*on).cogroup(pairs.groupBy(*on)).applyInArrow(run, "block_no int, width int, place int, query_id long, vec_id long, score long")


def with_floors(keys, blocks: pa.Table, floors: pa.Table) -> pa.Table:
    """A block with the kth score known so far of each of its queries."""
    floor = np.full(len(blocks.column("block_ids")[0].as_buffer()) // 8, -np.inf)
    floor[floors.column("place").to_numpy()] = floors.column("kth").to_numpy()
    return blocks.append_column("floor", pa.array([floor.tobytes()], pa.binary()))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """The k largest integer inner products of each query (vec_id, embedding) with the vectors (vec_id, embedding).

    Returns query_id, rank (from 1), vec_id, score.
    """

    def whole(df):
        x = F.transform("embedding", lambda v: F.floor(v.cast("double") * scale).cast("double"))
        fine = F.coalesce(F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
        fine = fine & F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
        return df.filter(fine).select(F.col("vec_id").cast("long").alias("id"), x.alias("x"), F.size("embedding").alias("width"))

    rows, asked = whole(vectors), whole(queries)
    shards, blocks = (max(1, -(-df.count() // size)) for df, size in ((rows, shard), (asked, block)))
    deal = lambda df, name, parts: df.withColumn(name, F.pmod(F.xxhash64("id", F.lit(7)), F.lit(parts)).cast("int"))
    trees = packed(deal(rows, "shard_no", shards), "shard_no", "shard")
    packs = packed(deal(asked, "block_no", blocks), "block_no", "block")

    first = packs.withColumn("shard_no", F.pmod("block_no", F.lit(shards))).withColumn("floor", F.lit(None).cast("binary"))
    batches = -(-blocks // BATCH)
    found = common.written(visit(trees, first, k, batches), "first-scores")
    kth = found.groupBy("block_no", "width", "place").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
    kth = kth.filter(F.col("n") >= k).drop("n")
    cogroup = packs.groupBy("block_no", "width").cogroup(kth.groupBy("block_no", "width"))
    bounded = cogroup.applyInArrow(with_floors, "block_no int, width int, block_ids binary, block binary, floor binary")
    pairs = bounded.withColumn("shard_no", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter(F.col("shard_no") != F.pmod("block_no", F.lit(shards)))
    found = found.unionByName(visit(trees, pairs, k, batches))
    order = W.partitionBy("block_no", "width", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))


ORACLE = f"""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x))
SELECT query_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= {K}
"""
