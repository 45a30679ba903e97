import random

import sentencepiece
from pyspark.sql import functions as F

from tallybridge.llm import pieces

from .conftest import frame

ALPHABET = [*"aabe  \n▁éЖ中😀\x00\tthing.1<s>", "the", "ing", "  ", "    ", " ▁", "　", "é"]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


def test_equals_the_library(spark):
    r, model = random.Random(1), library()
    texts = ["".join(r.choices(ALPHABET, k=r.randint(0, 40))) for _ in range(3000)] + [None, "", " ", "  ", "a" * 3000, "ab ab " * 500]
    docs = frame(spark, texts, row=1, n_tokens=2)
    got = pieces.encoded(docs, carry=["doc_id", "lang"]).orderBy("doc_id").collect()
    assert len(got) == len(texts)
    for row, text in zip(got, texts):
        ids = model.encode(text or "")
        assert (row.ids, row.n_tokens, row.decoded) == (",".join(map(str, ids)), len(ids), model.decode(ids)), text


def test_documents(spark):
    sf, model = "/root/testdata/sf0.001", library()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = spark.createDataFrame([(i, ",".join(map(str, model.encode(t))), model.decode(model.encode(t))) for i, t in texts.items()], "doc_id long, ids string, decoded string")
    want = want.select("doc_id", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
    got = pieces.op9_sentencepiece(spark, sf).select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_encode_and_decode_one_text():
    model, own = library(), pieces.Pieces.of(pieces.model_path())
    for text in ("", " a", "Thé 中 😀 x", "▁▁ a"):
        assert own.encode(text) == model.encode(text) and own.decode(own.encode(text)) == model.decode(model.encode(text))


def test_empty_table(spark):
    assert pieces.encoded(frame(spark, ["a"]).limit(0)).count() == 0
