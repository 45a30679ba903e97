import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybridge.llm import common, divergence

from .oracle import same, sql

SF = "/root/testdata/sf0.01"


def test_equals_sql(spark):
    same(divergence.op13_divergence(spark, SF).toPandas(), sql(SF, divergence.ORACLE))


def test_terms():
    text = pa.array(["x", "A-b\x00É\tß@Z[z`{~", None, "12 3", "日本 Q"]).slice(1)
    assert divergence.terms(text).to_pylist() == ["a b É ß z z   ", "", "    ", "日本 q"]


@pytest.fixture()
def odd(spark, tmp_path):
    """Nulls, texts without terms, a hot source, repeated rows, a language without kept terms, columns that clash."""
    texts = ["a b c a", "B c d", "", None, "12 . 3", "é É e", "a " * 40 + "long", "c b"]
    rows = [(k % 90, texts[k % 8] if k % 11 else "ö " + str(k), [None, "x", "y", ""][k % 4], ["hot", "hot", None, f"s{k % 5}"][k % 4], 1, 2, "t") for k in range(400)]
    rows += [(1, "alone here", "z", "s1", 1, 2, "t"), (2, None, "z", "s2", 1, 2, "t"), (3, "alone", "w", "s1", 1, 2, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, count int, digest int, term string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize(("bits", "least", "top"), [(64, 30, 50), (1, 30, 50), (3, 5, 2), (64, 1, 1), (2, 1, 50)])
def test_odd_rows_and_shared_digests(spark, odd, bits, least, top):
    """With digests of few bits many terms share one: they are split by their strings, and nothing changes."""
    got = divergence.audit(common.documents(spark, odd), least, top, bits)
    same(got.toPandas(), sql(odd, divergence.oracle(least=least, top=top)))


def test_small_buckets_and_flushes(spark, odd, monkeypatch):
    for name, value in (("BUCKET", 1), ("HELD", 3)):
        monkeypatch.setattr(divergence, name, value)
    same(divergence.audit(common.documents(spark, odd)).toPandas(), sql(odd, divergence.ORACLE))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.audit(df).count() == 0


def test_large_counts_are_exact(spark):
    df = spark.createDataFrame([(10**13, 10**15 + 7, 10**6)], "count long, total long, n_terms long")
    assert df.select(divergence.probability("count", "total").alias("p")).first().p == 1 + 10**9 * (10**13 + 5) // (10**15 + 7 + 5 * 10**6)
