"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the output's characters over its own characters. Each
document draws u in [0, 1) from a hash of (seed, doc_id) and appears as often as the inverse Poisson distribution
with that mean says; the copies are dealt out and sorted by a hash of (seed, doc_id, copy): a global shuffle that is
the same in every run. Everything is built-in column expressions.

The inverse is a table of intervals of u, one for each count that a source's documents may have: its rows grow with the root
of the rate, and a window sums them up. [0, 1) is cut into PARTS, and an interval stands under each part that it meets, so
documents find theirs by source and part. The table is broadcast while it takes up to MOST_BYTES (some 1,500 sources of
small rates), so documents move only once, for the global sort; a larger one is joined, a hot source being dealt into its parts.

Cases: a null source is a source of its own. Without targets, all sources have equal weight; with targets, a source
that is not named has weight 0 and goes. Null and empty texts count 0 characters; a source without any character has
rate 1. A null doc_id draws as the text "null". Repeated rows draw alike. Copies with equal keys are ordered by their
texts' hashes. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

SEED, EPOCHS = "mix-1", 1.0
#: The table of intervals is broadcast up to MOST_BYTES, at ROW_BYTES each. Parts of [0, 1) that a source is dealt into.
MOST_BYTES, ROW_BYTES, PARTS = 8 << 20, 64, 64
#: Deviations from the mean that the table covers: beyond them lies less than 2^-52, the resolution of a fraction. Rates from DENSE on start there.
SIGMAS, DENSE = 12.0, 1000.0
#: Fractions come from this many hex digits of an md5: exact in a double.
DIGITS = 13


def fraction(*parts: Column | str) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    text = F.concat_ws(":", *[F.coalesce((F.lit(p) if isinstance(p, str) else p).cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("long") / F.lit(float(16**DIGITS))


def cumulative(rate: DataFrame) -> DataFrame:
    """(of, count, low, high): a document of source ``of`` that draws u in [low, high) appears count times.

    Poisson probabilities P(X <= j), summed up by a window: from 0 on for rates below DENSE, else from SIGMAS deviations
    below the mean; up to where the rest is below any fraction drawn. Rows per source grow with the root of its rate. Terms
    are differences of logarithms; a large rate's first one is the saddle-point form, and its sums are divided by their last.
    """
    large = F.col("rate") >= DENSE
    wide = SIGMAS * F.sqrt("rate")
    rows = rate.filter("rate > 0").select(F.col("source").alias("of"), "rate", F.when(large, F.floor(F.col("rate") - wide)).otherwise(0).cast("long").alias("first"), F.ceil(F.col("rate") + wide + 30).cast("long").alias("last"))
    rows = rows.withColumn("count", F.explode(F.sequence("first", "last")))
    n = F.col("count").cast("double")
    away = (n - F.col("rate")) / F.col("rate")
    start = F.when(large, (n - F.col("rate")) - n * F.log1p(away) - 0.5 * F.log(2 * F.pi() * n) - 1 / (12 * n)).otherwise(-F.col("rate"))
    step = F.when(F.col("count") == F.col("first"), start).when(large, F.log1p((F.col("rate") - n) / n)).otherwise(F.log("rate") - F.log(n))
    source = W.partitionBy("of", "rate").orderBy("count")
    upto = source.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("log", F.sum(step).over(upto)).withColumn("high", F.sum(F.exp("log")).over(upto))
    total = F.when(large, F.max("high").over(W.partitionBy("of", "rate"))).otherwise(1.0)
    rows = rows.withColumn("high", F.col("high") / total).withColumn("low", F.coalesce(F.lag("high").over(source), F.lit(0.0)))
    rows = rows.withColumn("high", F.when(F.col("count") == F.col("last"), 2.0).otherwise(F.col("high")))
    return rows.filter("count > 0 AND low < high AND low < 1").select("of", "count", "low", "high")


def rates(docs: DataFrame, targets: dict[str, float] | None = None, epochs: float = EPOCHS) -> DataFrame:
    """source, rate: how often a document of each source is repeated on average. epochs: the output's size in inputs."""
    sizes = docs.groupBy("source").agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("size"))
    if targets is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        pairs = [x for k, v in sorted(targets.items()) for x in (F.lit(k), F.lit(float(v)))]
        sizes = sizes.withColumn("weight", F.coalesce(F.create_map(*pairs)[F.col("source")], F.lit(0.0)) if pairs else F.lit(0.0))
    sizes = common.written(sizes, "source-sizes")
    total = sizes.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    all_size, all_weight = F.lit(total["size"] or 0), F.lit(total["weight"] or 0.0)
    rate = F.when(F.col("size") > 0, F.try_divide("weight", all_weight) * F.lit(float(epochs)) * all_size / F.col("size")).otherwise(F.when(F.col("weight") > 0, 1.0).otherwise(0.0))
    return sizes.select("source", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def mixed(docs: DataFrame, targets: dict[str, float] | None = None, seed: str = SEED, epochs: float = EPOCHS) -> DataFrame:
    """All columns of docs (with doc_id, text and source), copy (from 1) and shuffle_key, sorted by shuffle_key.

    Columns of docs that are called copy or shuffle_key are replaced.
    """
    table = common.written(cumulative(rates(docs, targets, epochs)), "repetitions")
    row = docs.drop("copy", "shuffle_key").select(F.struct("*").alias("row"), fraction(seed, F.col("doc_id")).alias("u"))
    row = row.withColumn("part", F.floor(F.col("u") * PARTS).cast("int"))
    # each interval stands under every part of [0, 1) that it meets: a document finds its count among a few rows of its part
    table = table.withColumn("part", F.explode(F.sequence(F.floor(F.col("low") * PARTS).cast("int"), F.floor(F.least("high", F.lit(1.0 - 2.0**-53)) * PARTS).cast("int"))))
    if table.count() * ROW_BYTES <= MOST_BYTES:
        table = F.broadcast(table)
    met = F.col("row.source").eqNullSafe(F.col("of")) & (row["part"] == table["part"]) & (F.col("low") <= F.col("u")) & (F.col("u") < F.col("high"))
    row = row.join(table, met).withColumn("times", F.col("count"))
    copies = row.filter("times > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy"))
    return copies.withColumn("shuffle_key", fraction(seed, F.col("row.doc_id"), F.col("copy"))).orderBy("shuffle_key", F.xxhash64("row.text")).select("row.*", "copy", "shuffle_key")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(common.documents(spark, sf_dir)).select("doc_id", "source", "text", "copy", "shuffle_key")


def _fraction(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, {DIGITS}))::BIGINT / {float(16**DIGITS)!r})"


def oracle(table: str = "documents") -> str:
    """The mixture of a table for equal weights."""
    return f"""
    WITH sizes AS (SELECT source, coalesce(sum(length(text)), 0)::BIGINT AS size FROM {table} GROUP BY source),
    total AS (SELECT sum(size)::BIGINT AS all_size, count(*)::DOUBLE AS all_weight FROM sizes),
    rates AS (SELECT source, CASE WHEN size > 0 THEN 1.0::DOUBLE / all_weight * {EPOCHS}::DOUBLE * all_size / size ELSE 1.0::DOUBLE END AS rate FROM sizes, total),
    terms AS (
      SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::INT + 1)) AS j FROM rates),
    logs AS (SELECT source, j, -rate + sum(CASE WHEN j = 0 THEN 0 ELSE ln(rate) - ln(j) END) OVER (PARTITION BY source ORDER BY j) AS x FROM terms),
    sums AS (SELECT source, j, sum(exp(x)) OVER (PARTITION BY source ORDER BY j) AS p FROM logs),
    listed AS (SELECT source, list(p ORDER BY j) AS sums FROM sums GROUP BY source),
    drawn AS (
      SELECT d.*, len(list_filter(sums, lambda p: p <= {_fraction(f"'{SEED}:' || coalesce(d.doc_id::VARCHAR, 'null')")})) AS times
      FROM {table} d JOIN listed l ON d.source IS NOT DISTINCT FROM l.source),
    copies AS (SELECT *, unnest(range(1, times + 1))::INT AS copy FROM drawn)
    SELECT * EXCLUDE (times), {_fraction(f"'{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy")} AS shuffle_key FROM copies"""


ORACLE = f"SELECT doc_id, source, text, copy, shuffle_key FROM ({oracle()})"
