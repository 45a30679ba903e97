import random

import numpy as np
import pytest

from tallybridge.llm import topk

from .oracle import same, sql

SF = "/root/testdata/sf0.001"


def brute(rows, k):
    good = [(i, [np.floor(256 * float(np.float32(v))) for v in x]) for i, x in rows if i is not None and x and all(v is not None and np.isfinite(v) for v in x)]
    out = []
    for q, x in good:
        if q % 50 == 0:
            found = sorted((-int(np.dot(x, y)), i) for i, y in good if i != q and len(y) == len(x))[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    return sorted(out)


def test_equals_brute_force(spark):
    r = random.Random(3)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(30)] + [(500, None), (550, []), (600, [None] * 6), (650, [float("nan")] * 6), (None, rows[1][1]), (700, [0.5, 0.25]), (701, [0.5, -0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS part", "2 AS id")
    for shard, block in ((64, 4), (4096, 1024)):
        got = topk.top_k(df, df.filter("vec_id % 50 = 0"), shard=shard, block=block)
        assert sorted(map(tuple, got.collect())) == brute(rows, 5)


def test_large_components(spark):
    rows = [(0, [3000.0, -2.0]), (1, [1e6, 7.0]), (2, [-5e5, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(df, df.filter("vec_id = 0")).collect())) == [(0, 1, 1, 768000 * 256000000 - 512 * 1792), (0, 2, 2, -768000 * 128000000 - 512 * 512)]
    huge = spark.createDataFrame([(0, [1e12]), (1, [1e12])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="smaller scale"):
        topk.top_k(huge, huge).collect()


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, df).count() == 0


def test_sql(spark):
    same(topk.op6_topk(spark, SF).toPandas(), sql(SF, topk.ORACLE))


@pytest.mark.parametrize(("shard", "block"), [(4096, 1024), (7, 2)])
def test_repeated_ids_equal_sql(spark, tmp_path, shard, block):
    """Rows that share an id, with equal vectors and with others, as queries and as candidates."""
    r = random.Random(8)
    rows = [(i % 130, [float(r.randint(-2, 2)) for _ in range(5)]) for i in range(200)]
    rows += [(0, rows[0][1]), (50, rows[50][1]), (50, [2.0] * 5), (100, [1.0, 2.0]), (7, rows[7][1]), (None, [1.0] * 5), (100, None), (100, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    same(topk.top_k(df, df.filter("vec_id % 50 = 0"), shard=shard, block=block).toPandas(), sql(str(tmp_path), topk.ORACLE))


def test_two_equal_queries(spark):
    rows = [(0, [2.0, 1.0])] * 2 + [(k, [2.0, 1.0 - k]) for k in range(1, 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, df.filter("vec_id = 0")).collect()
    assert sorted((x.rank, x.vec_id) for x in got) == [(k, k) for k in range(1, 6) for _ in range(2)]
