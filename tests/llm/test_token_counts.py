import random
import time

import pyarrow as pa
import pytest
import sentencepiece

from tallybridge.llm import token_counts
from tallybridge.llm.pieces import model_path

from .conftest import frame


@pytest.mark.parametrize(("chunk", "overlap"), [(40, 8), (64, 3), (200, 40)])
def test_counts_equal_the_library(spark, chunk, overlap):
    r = random.Random(chunk)
    alphabet = [*"aabe  \n\t▁éЖ中😀\x00<>1", "the", "ing", "    ", " th", "strength"]
    texts = ["".join(r.choices(alphabet, k=r.randint(0, 300))) for _ in range(150)] + [None, "", " ", "a" * 700, "ab" * 400, "    " * 100, "😀" * 90]
    texts += texts[:20]
    docs = frame(spark, texts, ids=[None, *range(len(texts) - 1)], key="x", n=1, n_tokens=2)
    got = token_counts.counted(docs, long=60, chunk=chunk, overlap=overlap).collect()
    model = sentencepiece.SentencePieceProcessor(model_file=model_path())
    count = lambda x: (len((x or "").encode()), len(model.encode(x or "")))
    want = sorted([(-1 if i is None else i, *count(x)) for i, x in zip([None, *range(len(texts) - 1)], texts)])
    assert sorted((-1 if x.doc_id is None else x.doc_id, x.n_bytes, x.n_tokens) for x in got) == want


def test_empty_table(spark):
    assert token_counts.counted(frame(spark, ["a"]).limit(0)).count() == 0


def test_query_with_its_own_parameters(spark, tmp_path):
    r = random.Random(6)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(1, 9))) for _ in range(500)]
    long = " ".join(r.choices(words, k=12_000))
    assert len(long) > 2 * token_counts.LONG
    edge = "word " * 4096
    texts = [long, long, "z" * (token_counts.LONG + 5), edge, edge[:-6], "short", "", None, "null id"]
    frame(spark, texts, ids=[*range(8), None]).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((-1 if x.doc_id is None else x.doc_id, x.n_bytes, x.n_tokens, x.over_limit) for x in token_counts.op8_token_counts(spark, str(tmp_path)).collect())
    model = sentencepiece.SentencePieceProcessor(model_file=model_path())
    want = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in zip([*range(8), -1], texts)]
    assert got == sorted((*x, x[2] > 4096) for x in want)
    assert {x[3] for x in got} == {True, False}


def test_a_huge_text_is_cut_once():
    """50 MB in seconds: every character, in chunks that overlap."""
    text = "".join(chr(97 + k % 26) for k in range(1000)) * 50_000
    began, end, n = time.time(), 0, 0
    batch = pa.RecordBatch.from_arrays([pa.array(["k"]), pa.array([text])], ["key", "text"])
    for rows in token_counts.cutting(token_counts.CHUNK, token_counts.OVERLAP)([batch]):
        for place, start, part in zip(*(rows.column(c).to_pylist() for c in ("n", "start", "text"))):
            assert place == n and start == max(0, end - token_counts.OVERLAP) and part == text[start : start + token_counts.CHUNK]
            end, n = start + len(part), n + 1
    assert end == len(text) and time.time() - began < 10
