import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybridge.llm import negatives

from .oracle import same, sql

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, anchor_id string"


@pytest.mark.parametrize("shape", [(9, 64), (5, 3), (4, 10), (3, 1)])
def test_bounds_hold_at_every_level(shape):
    x = np.random.default_rng(7).integers(-400, 400, shape).astype(float)
    rows = negatives.Pyramid.of(x)
    for level in range(len(rows.levels)):
        low, high = rows.bounds(level, np.arange(len(x)), rows, np.arange(len(x)))
        assert (low <= x @ x.T).all() and (x @ x.T <= high).all()
    assert len(rows.levels[0][0]) == 1 and (high - low).sum() > 0


def test_equals_sql(spark):
    same(negatives.op11_negatives(spark, SF).toPandas(), sql(SF, negatives.ORACLE))


@pytest.fixture()
def odd(spark, tmp_path):
    """Ties, repeated rows and ids, nulls, other lengths, a label that is far more frequent, and a column that clashes."""
    random = np.random.default_rng(3)
    rows = [(k, random.integers(-3, 4, 6).astype(float).tolist(), 0 if k % 3 else int(random.integers(0, 4)), "x") for k in range(120)]
    rows += [(50, [1.0] * 6, 1, "x"), (50, [1.0] * 6, 1, "x"), (100, [2.0, 0.0, 0.0, 0.0, 0.0, 1.0], 2, "x")] + rows[7:12]
    rows += [(None, [1.0] * 6, 1, "x"), (150, None, 1, "x"), (200, [1.0] * 6, None, "x"), (250, [], 1, "x"), (300, [None] + [1.0] * 5, 1, "x"), (350, [float("nan")] + [1.0] * 5, 1, "x"), (400, [float("inf")] + [1.0] * 5, 1, "x")]
    rows += [(450 + k, [float(k), 1.0], k % 2, "x") for k in range(9)] + [(500, [-5.0, -5.0], 0, "x")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


@pytest.mark.parametrize(("shard", "block"), [(4096, 512), (10, 2)])
def test_odd_rows(spark, odd, shard, block):
    vectors = spark.read.parquet(f"{odd}/embeddings.parquet")
    got = negatives.hard_negatives(vectors, vectors.filter("vec_id % 50 = 0"), negatives.noisy_label(), shard=shard, block=block)
    same(got.toPandas(), sql(odd, negatives.ORACLE))


def test_empty_and_alone(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(empty, empty).count() == 0
    alone = spark.createDataFrame([(0, [1.0, 2.0], 1, "x")], SCHEMA)
    assert negatives.hard_negatives(alone, alone).count() == 0


def test_too_long(spark):
    long = spark.createDataFrame([(k, [1e30, 1.0], 1, "x") for k in range(3)], SCHEMA)
    with pytest.raises(Exception, match="2\\^53"):
        negatives.hard_negatives(long, long).count()


def test_most_rows_are_never_scored(monkeypatch):
    """Refinement decides: of clustered vectors few are scored exactly."""
    random = np.random.default_rng(5)
    centres = np.repeat(random.normal(0, 300, (40, 8)), 8, axis=1)  # level within a segment
    rows = negatives.Pyramid.of(np.floor(np.repeat(centres, 50, 0) + random.normal(0, 5, (2000, 64))))
    anchors, every = negatives.Pyramid.of(rows.x[:1]), np.arange(2000)
    scored = []
    of = lambda values, alive, n: scored.append(len(alive)) or values(alive)
    monkeypatch.setattr(negatives, "_of", of)
    low, high = anchors.bounds(0, 0, rows, every)
    (place, _), (other, _) = negatives.best_within(anchors, 0, rows, every, low, high, [(-np.inf, np.inf), (1e6, 2e6)], 5, every)
    scores = rows.x @ anchors.x[0]
    assert place.tolist() == np.lexsort((every, -scores))[:5].tolist() and ((scores[other] >= 1e6) & (scores[other] <= 2e6)).all()
    assert scored[-1] <= 300
