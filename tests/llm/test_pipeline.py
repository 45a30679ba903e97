import hashlib

import duckdb
import pandas as pd
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tallybridge.llm import language, mixing
from tallybridge.llm.pieces import model_path

from . import test_lines, test_near_copies
from .conftest import frame

SF = "/root/testdata/sf0.001"


def test_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    kept = docs[[any(c.isalpha() for c in t) for t in docs.text]]  # all in known languages
    thin = pd.DataFrame(test_lines.brute(list(zip(kept.doc_id, kept.text))), columns=["doc_id", "n_lines", "n_removed", "text"])
    thin = thin[(thin.n_removed == 0) | thin.text.str.contains(r"[^\x20\x09-\x0D]")]
    named = dict(test_near_copies.brute(list(zip(thin.doc_id, thin.text))))
    one = thin[[named[i] == i for i in thin.doc_id]].merge(docs[["doc_id", "lang", "source"]], on="doc_id")
    con = duckdb.connect()
    con.register("one", one)
    mixed = con.sql(mixing.oracle("one")).df()
    model = sentencepiece.SentencePieceProcessor(model_file=model_path())
    want = sorted((int(r.doc_id), r.lang, r.source, model.encode(r.text), hashlib.sha256(model.decode(model.encode(r.text)).encode()).hexdigest()) for r in mixed.itertuples())
    got = corpus_pipeline.run(spark, SF).collect()
    assert all(r.n_tokens == len(r.ids) for r in got)
    assert sorted((r.doc_id, r.lang, r.source, list(r.ids), r.decoded_sha256) for r in got) == want


def test_language_rejects(spark):
    docs = frame(spark, ["the cat and the dog", "the dog", "", None, "123 !!", "中文字符测试"])
    kept = {r.doc_id for r in corpus_pipeline.identify(spark, docs, "").collect()}
    assert kept >= {0, 1} and not kept & {2, 3, 4}  # with one language, of two texts, foreign letters have no bound to fail


def test_language_rejects_foreign_letters(spark):
    learned = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    strange = frame(spark, ["中文字符测试" * 20, "Широкая электрификация южных губерний даст мощный толчок подъёму сельского хозяйства. " * 2], ids=[-1, -2]).select(*learned.columns)
    kept = {r.doc_id for r in corpus_pipeline.identify(spark, learned.unionByName(strange.withColumn("lang", F.lit(None).cast("string"))), "").collect()}
    assert not kept & {-1, -2} and len(kept) >= 0.99 * learned.count()


def test_clashing_columns(spark):
    """Extra columns with the operators' own names go through every stage as they are."""
    extra = {"rejected": 1, "score": 2, "lang_pred": "x", "n_lines": 77, "n_removed": 5, "copy": 7, "shuffle_key": 0.5, "row": "r", "grp": 3, "node": 4, "times": 6, "id": 8}
    docs = frame(spark, ["the cat and the dog of the house", "the cat sat\nthe cat sat", "the dog is in the house of the cat"], **extra)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *extra]
        rows = docs.collect()
        assert rows and all(getattr(r, k) == v for r in rows for k, v in extra.items() if k not in ("index", "count")), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == len(rows)


def test_odd_rows(spark):
    docs = frame(spark, ["same words in this one line of text", "same words in this one line of text", None, "", "x"], ids=[1, 1, None, 2, None])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        docs.collect()
    empty = frame(spark, ["a"]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
        assert empty.count() == 0


def test_language_held_out(spark):
    out = language.op4_language(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = out.join(truth, "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_clashing_columns(spark):
    docs = frame(spark, ["the cat and the dog", "", "the dog"], lang_pred="a", score=2, rejected=True, row=3)
    kept = corpus_pipeline.identify(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.lang_pred, r.score, r.rejected, r.row) for r in kept.collect()) == [(0, "a", 2, True, 3), (2, "a", 2, True, 3)]
