import hashlib
import random

import numpy as np
import pytest

from tallybridge.llm import groups, passages

from .conftest import frame
from .oracle import same, sql

SF = "/root/testdata/sf0.001"


def test_sql(spark):
    same(passages.op7_passages(spark, SF).toPandas(), sql(SF, passages.ORACLE))


def brute(rows, width):
    split = [(2**63 - 1 if i is None else i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, w), (doc, _) in zip(split, rows):
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((-1 if doc is None else doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("group_chars", [300, 10**7])
def test_brute_force(spark, group_chars, monkeypatch):
    r = random.Random(5)
    shared = [" ".join(r.choices("abcdef", k=12)) for _ in range(4)]
    texts = [" ".join(r.choice(shared) if r.random() < 0.3 else r.choice("abcdefgh") for _ in range(r.randint(0, 25))) for _ in range(120)] + [None, "", " \n\t", "x\x1cy z\x85", shared[0]]
    ids = [r.randint(-50, 50) for _ in texts[:-2]] + [None, None]
    rows = list(zip(ids, texts))
    monkeypatch.setattr(groups.grouped, "__defaults__", (group_chars,))
    monkeypatch.setattr(groups.bucket_bits, "__defaults__", (50,))
    docs = frame(spark, texts, ids=ids, grp=1, bucket=2, payload="x", kept=3)
    got = passages.deduplicated(docs, width=6).collect()
    assert sorted((-1 if x.doc_id is None else x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in got) == brute(rows, 6)


def test_many_null_ids(spark, monkeypatch):
    """Rows without an id fill several groups, but do not remove each other's windows."""
    r = random.Random(8)
    texts = [" ".join(r.choices("ab", k=r.randint(0, 30))) for _ in range(200)]
    ids = [k if k % 3 == 0 else None for k in range(200)]
    monkeypatch.setattr(groups.grouped, "__defaults__", (300,))
    docs = frame(spark, texts, ids=ids)
    assert groups.grouped(docs)[0].filter("doc_id IS NULL").select("grp").distinct().count() > 5
    got = passages.deduplicated(docs, width=6).collect()
    assert sorted((-1 if x.doc_id is None else x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in got) == brute(list(zip(ids, texts)), 6)


def test_checks_tell_equal_hashes_apart():
    replies = groups.replies(np.zeros(4, np.int64), np.array([1, 1, 1, 9], np.uint64), np.array([5, 6, 7, 5], np.uint32))
    values, checks = np.array([1, 1, 1, 9, 9, 2], np.uint64), np.array([5, 7, 8, 5, 6, 5], np.uint32)
    assert groups.member(values, checks, replies).tolist() == [True, True, False, True, False, False]


def test_empty(spark):
    assert passages.deduplicated(frame(spark, ["a"]).limit(0)).count() == 0
    assert passages.deduplicated(frame(spark, [None, ""])).count() == 2
