"""Hard-negative mining by segment summaries.

A vector's components are cut into SEGMENTS equal segments, and each segment's mean m and deviation d (the length of
what is left without the mean) are stored beside the vector. For a segment of w components the inner product of two
vectors lies between  w m m' - d d'  and  w m m' + d d'; sums over segments bound the score. Two neighbouring segments
are merged by their summaries alone, so the same stored figures give bounds with 1, 2, 4, ... segments: an anchor
drops rows by the coarsest bounds first, refines those that are left level by level, and scores exactly what no
level could decide.

Rows are dealt into shards of about SHARD, anchors into blocks of about BLOCK; each is one binary row, and every block
meets every shard once in each of two rounds:

1. positives: the ``positives`` best rows of the anchor's label. The kth largest lower bound is a floor for upper bounds.
2. negatives: for each positive, the ``negatives`` best rows of other labels whose score lies in the positive's window.
   Rows leave that are below or above the window for sure; the kth largest lower bound among those that are inside it
   for sure is a floor for the others.

A shard answers with a few rows per anchor and window; Spark ranks them (with a limit per task before the shuffle).

Scores are integer inner products of floor(scale * x), exact in float64 below 2^53; longer vectors stop the job with
an error. Bounds are widened by a relative 1e-9, so rounding never drops a row.

Cases: rows with a null vec_id, a null label, a null or empty vector or a null or non-finite component take no part;
vectors meet those of their own length only. Equal ids are rows of their own, each a candidate and an anchor, but a row
with the anchor's id is never its positive or negative. Ties go to the smaller id. A positive with a score below 0 has
no negatives (its window is empty). An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

SCALE, EVERY, POSITIVES, NEGATIVES = 256, 50, 5, 3
#: A negative's score is at least LOW and at most HIGH hundredths of the positive's.
LOW, HIGH = 50, 95
#: Rows in a shard, anchors in a block, segments of a vector at the finest level (a power of two).
SHARD, BLOCK, SEGMENTS = 4096, 512, 8
#: Anchors whose coarsest bounds are held at once; blocks that one task takes to a shard.
STRIP, BATCH = 64, 16


def summaries(x: np.ndarray, segments: int = SEGMENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Widths of the segments, and each row's means and deviations."""
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int) if x.shape[1] < segments or x.shape[1] % segments else np.arange(0, x.shape[1] + 1, x.shape[1] // segments)
    widths = np.diff(edges).astype(np.float64)
    means = np.add.reduceat(x, edges[:-1], axis=1) / widths
    away = x - np.repeat(means, np.diff(edges), axis=1)
    return widths, means, np.sqrt(np.add.reduceat(away * away, edges[:-1], axis=1))


def merged(widths: np.ndarray, means: np.ndarray, deviations: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Summaries of neighbouring segments two by two (an odd last one stays)."""
    at = np.arange(0, len(widths), 2)
    both = np.add.reduceat(widths, at)
    mean = np.add.reduceat(widths * means, at, axis=1) / both
    away = means - np.repeat(mean, np.diff(np.append(at, len(widths))), axis=1)
    return both, mean, np.sqrt(np.add.reduceat(deviations**2 + widths * away**2, at, axis=1))


class Pyramid:
    """Vectors with their summaries from one segment to the finest; levels[0] is the coarsest."""

    def __init__(self, x: np.ndarray, means: np.ndarray, deviations: np.ndarray, widths: np.ndarray):
        self.x, self.length = x, np.sqrt((x**2).sum(1))
        self.levels = [(widths, means, deviations)]
        while len(self.levels[0][0]) > 1:
            self.levels.insert(0, merged(*self.levels[0]))

    @classmethod
    def of(cls, x: np.ndarray) -> Pyramid:
        widths, means, deviations = summaries(x)
        return cls(x, means, deviations, widths)

    def bounds(self, level: int, rows, other: Pyramid, others) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner products of own rows with other's."""
        widths, m, d = self.levels[level]
        _, m2, d2 = other.levels[level]
        middle, spread = (widths * m[rows]) @ m2[others].T, d[rows] @ d2[others].T
        slack = 1e-9 * (1 + np.multiply.outer(self.length[rows], other.length[others]))
        return middle - spread - slack, middle + spread + slack


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def best_within(anchors: Pyramid, a: int, rows: Pyramid, alive: np.ndarray, lower: np.ndarray, upper: np.ndarray, windows: list[tuple[float, float]], k: int, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (low, high) the k best alive rows of anchor a with a score in it: places and scores.

    lower, upper: coarsest bounds of alive. A row is refined while any window may still need it.
    """
    for level in range(len(anchors.levels)):
        if level:
            lower, upper = _of(lambda some: np.stack(anchors.bounds(level, a, rows, some)), alive, len(rows.x))  # noqa: B023
        keep = np.zeros(len(alive), bool)
        for low, high in windows:
            floor = _kth(lower[(lower >= low) & (upper <= high)], k)
            keep |= (upper >= max(low, floor)) & (lower <= high)
        alive = alive[keep]
        if not len(alive):
            break
    scores = _of(lambda some: rows.x[some] @ anchors.x[a], alive, len(rows.x)) if len(alive) else np.zeros(0)
    out = []
    for low, high in windows:
        inside = np.flatnonzero((scores >= low) & (scores <= high))
        inside = inside[scores[inside] >= _kth(scores[inside], k)]
        best = inside[np.lexsort((ids[alive[inside]], -scores[inside]))[:k]]
        out.append((alive[best], scores[best]))
    return out


def _of(values, alive: np.ndarray, n: int) -> np.ndarray:
    """values of the alive rows; while most are alive, of all rows without moving them."""
    return values(alive) if 2 * len(alive) < n else values(slice(None))[..., alive]


def packed(rows: DataFrame, key: str) -> DataFrame:
    """One row per value of (key, width): ids, labels, vectors and the finest summaries as bytes, by label and id."""

    def pack(keys, table):
        ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
        order = np.lexsort((ids, labels))
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)[order]
        _, means, deviations = summaries(x)
        own = [pa.array([k.as_py()], pa.int32()) for k in keys]
        data = [pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (ids[order], labels[order], x, means, deviations)]
        return pa.table([*own, *data], [key, "width", *FIELDS])

    return rows.groupBy(key, "width").applyInArrow(pack, f"{key} int, width int, {', '.join(f'{f} binary' for f in FIELDS)}")


FIELDS = ("ids", "labels", "x", "means", "deviations")
FOUND = "block_no int, width int, place int, anchor_id long, of int, vec_id long, score long"


def _unpacked(row: dict, width: int, prefix: str) -> tuple[np.ndarray, np.ndarray, Pyramid]:
    ids, labels = (np.frombuffer(row[prefix + c], np.int64) for c in ("ids", "labels"))
    x = np.frombuffer(row[prefix + "x"], np.float64).reshape(len(ids), width)
    widths = summaries(np.zeros((1, width)))[0]
    means, deviations = (np.frombuffer(row[prefix + c], np.float64).reshape(len(ids), -1) for c in ("means", "deviations"))
    return ids, labels, Pyramid(x, means, deviations, widths)


def visit(pairs: DataFrame, k: int, other_labels: bool) -> DataFrame:
    """Searches the shard of each row of pairs for its block's anchors.

    windows: for each anchor a row of (of, low, high) in the block's order, as bytes; null: one open window for each.
    """

    def search(row: dict):
        width = row["width"]
        ids, labels, rows = _unpacked(row, width, "shard_")
        own_ids, own_labels, anchors = _unpacked(row, width, "block_")
        if rows.length.max() * anchors.length.max() >= 2.0**53:
            raise ValueError("scores of 2^53 or more: use a smaller scale")
        windows = np.frombuffer(row["windows"], np.float64).reshape(-1, 4) if row["windows"] is not None else np.array([[a, 0, -np.inf, np.inf] for a in range(len(own_ids))])
        cuts = np.searchsorted(windows[:, 0], np.arange(len(own_ids) + 1))
        low, high = np.searchsorted(labels, own_labels, "left"), np.searchsorted(labels, own_labels, "right")
        for begin in range(0, len(own_ids), STRIP):
            strip = np.arange(begin, min(begin + STRIP, len(own_ids)))
            lower, upper = anchors.bounds(0, strip, rows, slice(None))
            for a in strip[cuts[strip + 1] > cuts[strip]].tolist():
                part = np.r_[0 : low[a], high[a] : len(ids)] if other_labels else np.arange(low[a], high[a])
                part = part[ids[part] != own_ids[a]]
                own = windows[cuts[a] : cuts[a + 1]]
                found = best_within(anchors, a, rows, part, lower[a - begin, part], upper[a - begin, part], own[:, 2:].tolist(), k, ids)
                for of, (place, scores) in zip(own[:, 1], found):
                    if len(place):
                        yield np.full(len(place), a), np.full(len(place), own_ids[a]), np.full(len(place), of, np.int64), ids[place], scores.astype(np.int64)

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                found = list(zip(*search(row)))
                columns = [np.concatenate(c).astype(np.int64) for c in found] if found else [np.zeros(0, np.int64)] * 5
                own = [pa.array(np.full(len(columns[0]), row[c]), pa.int32()) for c in ("block_no", "width")]
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([*own, *[pa.array(c).cast(t) for c, t in zip(columns, kinds)]], ["block_no", "width", "place", "anchor_id", "of", "vec_id", "score"])

    return pairs.mapInArrow(run, FOUND)


def with_windows(low: int, high: int):
    """A block and its positives: the window of each, by anchor."""

    def run(keys, blocks: pa.Table, positives: pa.Table) -> pa.Table:
        if not blocks.num_rows or not positives.num_rows:
            return blocks.slice(0, 0).append_column("windows", pa.array([], pa.binary()))
        place, of, score = (positives.column(c).to_numpy().astype(np.int64) for c in ("place", "of", "score"))
        least, most = -(-low * score // 100), high * score // 100
        order = np.lexsort((of, place))
        return blocks.append_column("windows", pa.array([np.stack([place, of, least, most], 1)[order].astype(np.float64).tobytes()], pa.binary()))

    return run


def hard_negatives(vectors: DataFrame, anchors: DataFrame, label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """For each anchor and each of its best rows of the same label, the best rows of other labels within low to high percent of that score.

    vectors, anchors: vec_id, embedding, label; label: an expression in its place. Returns anchor_id, positive_id, rank
    (from 1), negative_id, positive_score, negative_score. With repeated anchor ids each anchor row has rows of its own.
    """
    spark = vectors.sparkSession
    common.small_batches(spark)

    def whole(df):
        own = F.col("label") if label is None else label
        x = F.transform("embedding", lambda v: F.floor(v.cast("double") * scale).cast("double"))
        fine = F.coalesce(F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
        fine = fine & F.col("vec_id").isNotNull() & own.isNotNull() & (F.size("embedding") > 0)
        return df.filter(fine).select(F.col("vec_id").cast("long").alias("id"), own.cast("long").alias("label"), x.alias("x"), F.size("embedding").alias("width"))

    rows, asked = whole(vectors), whole(anchors)
    shards, blocks = (max(1, -(-df.count() // size)) for df, size in ((rows, shard), (asked, block)))
    deal = lambda df, name, parts: df.withColumn(name, F.pmod(F.xxhash64("id", "x"), F.lit(parts)).cast("int"))
    stored = common.written(packed(deal(rows, "shard_no", shards), "shard_no"), "segment-summaries")
    packs = common.written(packed(deal(asked, "block_no", blocks), "block_no"), "anchor-blocks")
    batches = -(-blocks // BATCH)
    on, tasks = ["shard_no", "width", "batch"], min(2 * shards * batches, 1 << 15)
    left = stored.withColumnsRenamed({f: f"shard_{f}" for f in FIELDS}).withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1)))).repartition(tasks, *on)

    def met(blocks_: DataFrame) -> DataFrame:
        right = blocks_.withColumnsRenamed({f: f"block_{f}" for f in FIELDS}).withColumn("shard_no", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        return left.join(right.withColumn("batch", F.floor(F.col("block_no") / BATCH).cast("int")).repartition(tasks, *on), on)

    anchor = W.partitionBy("block_no", "width", "place")
    found = visit(met(packs.withColumn("windows", F.lit(None).cast("binary"))), positives, False)
    best = found.withColumn("of", F.row_number().over(anchor.orderBy(F.desc("score"), "vec_id"))).filter(F.col("of") <= positives)
    best = common.written(best, "positives")
    windowed = packs.groupBy("block_no", "width").cogroup(best.filter("score >= 0").groupBy("block_no", "width"))
    windowed = windowed.applyInArrow(with_windows(low, high), f"block_no int, width int, {', '.join(f'{f} binary' for f in FIELDS)}, windows binary")
    other = visit(met(windowed), negatives, True).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
    other = other.withColumn("rank", F.row_number().over(W.partitionBy("block_no", "width", "place", "of").orderBy(F.desc("negative_score"), "negative_id"))).filter(F.col("rank") <= negatives)
    out = other.drop("anchor_id").join(best, ["block_no", "width", "place", "of"])
    return out.select("anchor_id", F.col("vec_id").alias("positive_id"), "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score")


#: The query's labels: where vec_id is divisible by 7, the next of ten.
def noisy_label() -> Column:
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hard_negatives(vectors, vectors.filter(F.col("vec_id") % EVERY == 0), noisy_label())


def oracle(table: str = "embeddings") -> str:
    return f"""
    WITH v AS (
      SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS x FROM {table}
      WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.row, a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same, list_inner_product(a.x, c.x)::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id % {EVERY} = 0 AND a.vec_id <> c.vec_id AND len(a.x) = len(c.x)),
    p AS (SELECT row, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS place FROM s WHERE same QUALIFY place <= {POSITIVES})
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY row, place ORDER BY score DESC, vec_id)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (row, anchor_id) WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score QUALIFY rank <= {NEGATIVES}"""


ORACLE = oracle()
