import random
import string

from pyspark.sql import functions as F

from tallybridge.llm import language

from .conftest import frame


def test_odd_rows(spark):
    texts = ["the cat and the dog of the house", "le chat et le chien de la maison", None, "", "12 !?", "x"]
    labelled = frame(spark, texts).selectExpr("doc_id", "text", "IF(doc_id = 1, 'fr', IF(doc_id = 0, 'en', NULL)) AS lang")
    model = language.fit(labelled)
    assert model[0] == ["en", "fr"]
    got = {r.doc_id: r for r in language.predicted(frame(spark, texts, score=1, rejected=2), model).collect()}
    assert [got[k].lang_pred for k in range(5)] == ["en", "fr", "und", "und", "und"]
    assert all(got[k].rejected and got[k].score == 0 for k in (2, 3, 4)) and got[5].lang_pred in ("en", "fr")


def test_the_sample_is_bounded(spark):
    """Half of the ids are null, one row holds a third of the table: a language's sample stays within its bound."""
    texts = [f"text {k}" for k in range(6000)] + ["the same"] * 3000
    ids = [None if k % 2 else k for k in range(6000)] + [None] * 3000
    rows = frame(spark, texts, ids=ids).withColumn("lang", F.lit("en"))
    some = language.sampled(rows, 100).collect()
    assert 40 <= len(some) <= 200 and len({r.text for r in some}) == len(some)
    assert sum(int(r.text.split()[-1]) % 2 for r in some if r.text != "the same") > 10  # null ids are drawn, too
    assert language.sampled(frame(spark, ["same"] * 900, ids=[None] * 900), 10).count() <= 1


def test_nothing_to_learn_from(spark):
    model = language.fit(frame(spark, ["a"]).limit(0))
    assert [r.lang_pred for r in language.predicted(frame(spark, ["a b", None]), model).collect()] == ["und", "und"]
    assert language.predicted(frame(spark, ["a"]).limit(0), model).count() == 0


def test_unlearned_and_gibberish(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs)
    r = random.Random(3)
    polish = "Wczoraj wieczorem poszliśmy do starego miasta, żeby zobaczyć nowe przedstawienie w teatrze. Było bardzo zimno, ale ludzie stali w długiej kolejce i czekali cierpliwie na otwarcie drzwi. Po spektaklu wróciliśmy do domu przez park i rozmawialiśmy o tym, co nas najbardziej zaskoczyło. Wszyscy zgodzili się, że muzyka była piękna."
    strange = [polish, polish * 3, "".join(r.choices("asdfghjkl ;", k=600)), "".join(r.choices(string.ascii_lowercase + "    ", k=600)), "".join(r.choices(string.ascii_letters + string.digits, k=600))]
    got = {x.doc_id: x.rejected for x in language.predicted(frame(spark, strange), model).collect()}
    assert all(got[k] for k in range(len(strange)))
    rows = language.predicted(docs, model).collect()
    assert sum(x.rejected for x in rows) <= 0.005 * len(rows)
    short = [x.text[:60] for x in docs.select("text").collect() if len(x.text) >= 60]
    rows = language.predicted(frame(spark, short), model).collect()
    assert sum(x.rejected for x in rows) <= 0.02 * len(rows)


def brute(texts, idf):
    """TF-IDF vectors from the definition, gram by gram."""
    import math
    import regex

    rows = []
    for t in texts:
        plain = " " + regex.sub(r"[^\p{L}]+", " ", (t or "").lower()) + " "
        x = [0.0] * language.DIMENSIONS
        for width in (2, 3):
            for k in range(len(plain) - width + 1):
                key = 0
                for c in plain[k : k + width]:
                    key = key * 0x110000 + ord(c)
                x[((key + width) * 0x9E3779B97F4A7C15 % 2**64) >> 52] += 1
        x = [(1 + math.log(v)) * w if v else 0.0 for v, w in zip(x, idf)]
        size = math.sqrt(sum(v * v for v in x)) or 1.0
        rows.append([v / size for v in x])
    return rows


def test_cosines_equal_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang").limit(60).collect()
    texts = [r.text[:400] for r in rows] + ["x" * 5000, "Straße ÉTÉ", "a"]
    model = language.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    langs, centres, idf, _ = model
    got = {r.doc_id: r for r in language.predicted(frame(spark, texts), model).collect()}
    for k, x in enumerate(brute(texts, idf)):
        cosines = [sum(a * b for a, b in zip(x, c)) for c in centres.tolist()]
        best = max(range(len(cosines)), key=lambda i: cosines[i])
        assert got[k].lang_pred == langs[best] and abs(got[k].score - max(0, min(1, cosines[best]))) < 1e-4


def test_null_ids_and_repeated_rows(spark, tmp_path):
    texts = ["the cat and the dog of the house"] * 30 + ["le chat et le chien de la maison"] * 30 + ["the dog"]
    docs = frame(spark, texts, ids=[*range(58), None, None, None]).selectExpr("doc_id", "text", "IF(text LIKE 'le%', 'fr', 'en') AS lang", "source")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = language.op4_language(spark, str(tmp_path)).collect()
    assert len(got) == 61 and sum(r.held_out is None for r in got) == 3
    assert all(r.lang_pred in ("en", "fr") for r in got)
