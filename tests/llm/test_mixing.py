import math
import time

import numpy as np

from pyspark.sql import functions as F

from tallybridge.llm import mixing

from .conftest import frame
from .oracle import same, sql

SF = "/root/testdata/sf0.001"


def test_sql(spark):
    same(mixing.op2_mixing(spark, SF).toPandas(), sql(SF, mixing.ORACLE))


def test_order_and_clashing_names(spark):
    docs = frame(spark, ["abc"] * 90 + [None, ""], copy=9, shuffle_key="x", row=1, of=2, u=3, sums=4, times=5)
    got = mixing.mixed(docs, {"s0": 3.0, "s1": 1.0}).collect()
    assert [x.shuffle_key for x in got] == sorted(x.shuffle_key for x in got)
    assert {x.source for x in got} == {"s0", "s1"}
    assert all(x.row == 1 and x.times == 5 for x in got)
    assert len({(x.doc_id, x.copy) for x in got}) == len(got)


def test_rates_and_counts(spark):
    docs = frame(spark, ["abcd"] * 3000).withColumn("source", F.when(F.col("doc_id") < 1000, "a").when(F.col("doc_id") < 2900, "b"))
    rates = {x.source: x.rate for x in mixing.rates(docs).collect()}
    assert {k: round(v, 6) for k, v in rates.items()} == {"a": 1.0, "b": round(1000 / 1900, 6), None: 10.0}
    sizes = {x.source: x["count"] for x in mixing.mixed(docs).groupBy("source").count().collect()}
    assert all(abs(sizes[k] - 1000) < 4 * math.sqrt(1000 * max(1, rates[k])) for k in rates)


def test_many_sources_are_salted(spark, monkeypatch):
    docs = frame(spark, ["some text", "other", None] * 50)
    want = sorted(map(tuple, mixing.mixed(docs).collect()), key=repr)
    monkeypatch.setattr(mixing, "MOST_BYTES", 0)
    assert sorted(map(tuple, mixing.mixed(docs).collect()), key=repr) == want


def test_ties_are_in_one_order(spark):
    docs = frame(spark, [f"text {k}" for k in range(40)], ids=[7] * 40)
    got = [[x.text for x in mixing.mixed(d, epochs=3.0).collect()] for d in (docs, docs.repartition(7))]
    assert got[0] == got[1]


def test_large_rate(spark):
    docs = frame(spark, ["a"] + ["b" * 40_000] * 1).withColumn("source", F.col("doc_id").cast("string"))
    assert abs(mixing.mixed(docs).filter("doc_id = 0").count() - 20_000) < 700


def test_empty(spark):
    assert mixing.mixed(frame(spark, ["a"]).limit(0)).count() == 0
    copies = mixing.mixed(frame(spark, [None])).collect()
    u = mixing.fraction(mixing.SEED, F.lit(0))
    want = sum(math.exp(-1) * sum(1 / math.factorial(i) for i in range(j + 1)) <= spark.range(1).select(u).first()[0] for j in range(30))
    assert len(copies) == want and all(x.text is None for x in copies)  # rate 1


def test_any_rate_against_exact_quantiles(spark):
    """Rates from 10^-6 to 10^9, in time and rows that grow with their roots."""
    rates = [1e-6, 1.0, 999.0, 1001.0, 1e5, 1e9]
    began = time.time()
    table = mixing.cumulative(spark.createDataFrame([(str(r), r) for r in rates], "source string, rate double")).toPandas()
    assert time.time() - began < 60 and len(table) < 26 * sum(math.sqrt(r) + 2 for r in rates)
    for r in rates:
        own = table[table.of == str(r)].sort_values("count")
        low, high = int(r - 13 * math.sqrt(r) - 40) if r > 1e4 else 0, int(r + 13 * math.sqrt(r) + 40)
        mode = int(r)
        up = np.cumprod(np.longdouble(r) / np.arange(mode + 1, high + 1, dtype=np.longdouble))
        down = np.cumprod(np.arange(mode, low, -1, dtype=np.longdouble) / np.longdouble(r))
        weights = np.concatenate([down[::-1], [np.longdouble(1)], up])
        exact = np.cumsum(weights / weights.sum())
        at = own["count"].to_numpy() - low
        inner = own.high.to_numpy() < 2
        np.testing.assert_allclose(own.high.to_numpy()[inner], exact[at[inner]].astype(float), atol=2e-9 if r > 1e6 else 1e-12)
        np.testing.assert_allclose(own.low.to_numpy(), np.concatenate([[0.0], exact]).astype(float)[at], atol=2e-9 if r > 1e6 else 1e-12)
