import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybridge.llm import groups, scoring

from .conftest import frame

SF = "/root/testdata/sf0.001"


def brute(rows, mass=scoring.MASS, d=scoring.DISCOUNT, train=lambda i: i is None or zlib.crc32(str(i).encode()) % 10, order=3):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(i, [*(t or "").translate(lower).encode().split(), None]) for i, t in rows]
    one, two, three, after = Counter(), Counter(), Counter(), Counter()
    for i, w in docs:
        if train(i):
            one.update(w)
            two.update(zip(["start", *w], w))
            three.update(zip(["start", *w], w, w[1:]))
    for u, v, _ in three:
        after[u, v] += 1
    n, v = sum(one.values()), len(one)
    p1 = lambda x: (one[x] + 0.1) / (n + 0.1 * (v + 1))
    p2 = lambda c, x: (two[c, x] + mass * p1(x)) / (one[None if c == "start" else c] + mass)

    def p3(b, c, x):
        if order == 2 or not two[b, c]:
            return p2(c, x)
        return (max(three[b, c, x] - d, 0) + d * after[b, c] * p2(c, x)) / two[b, c]

    out = []
    for i, w in docs:
        s = math.log10(p2("start", w[0])) + sum(math.log10(p3(b, c, x)) for b, c, x in zip(["start", *w], w, w[1:]))
        out.append((-1 if i is None else i, len(w), sum(one[x] > 0 for x in w), n, sum(math.log10(p1(x)) for x in w), s))
    return sorted(out)


def compare(got, rows, want=None, **how):
    got = sorted((-1 if x.doc_id is None else x.doc_id, x.n_tokens, x.n_known, x.train_tokens, x.base_score, x.score) for x in got)
    want = want or brute(rows, **how)
    assert [x[:4] for x in got] == [x[:4] for x in want]
    np.testing.assert_allclose([x[4] for x in got], [x[4] for x in want], rtol=1e-10)
    np.testing.assert_allclose([x[5] for x in got], [x[5] for x in want], rtol=2e-3, atol=2e-3)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = scoring.op5_scoring(spark, SF).collect()
    compare(got, rows)
    out = {x.doc_id: x for x in got if x.held_out}
    pairs_only = sum(x[5] for x in brute(rows, order=2) if x[0] in out)
    assert sum(x.score for x in out.values()) > pairs_only > sum(x.base_score for x in out.values())


@pytest.mark.parametrize("part_tokens", [3, 1 << 20])
def test_planted(spark, part_tokens, monkeypatch):
    monkeypatch.setattr(groups.grouped, "__defaults__", (500,))
    monkeypatch.setattr(groups.bucket_bits, "__defaults__", (200,))
    monkeypatch.setattr(scoring, "PART_TOKENS", part_tokens)
    r = random.Random(1)
    texts = [" ".join(r.choices(["the", "The", "a", "É", "é", *(f"w{k}" for k in range(30))], k=r.randint(0, 40))) for _ in range(100)] + [None, "", " \n"]
    ids = [*range(100), 3, None, 5]
    got = scoring.scored(frame(spark, texts, ids=ids, train=1, row=2, grp=3), ~scoring.held_out(10))
    compare(got.collect(), list(zip(ids, texts)))


def test_a_pair_with_very_many_followers(spark):
    """10^5 words after one pair: each is told from the others, and unseen ones from all."""
    n = 100_000
    texts = [" ".join(f"a b w{k}" for k in range(first, first + n // 20)) for first in range(0, n, n // 20)] + [" ".join(f"a b {x}{k}" for k in range(5000) for x in "wu")]
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10][:20] + [next(k for k in range(200) if not zlib.crc32(str(k).encode()) % 10)]
    compare(scoring.scored(frame(spark, texts, ids=ids), ~scoring.held_out(10)).collect(), list(zip(ids, texts)))


def test_empty(spark):
    assert scoring.scored(frame(spark, ["a"]).limit(0), ~scoring.held_out(10)).count() == 0


def test_model_is_kept(spark, tmp_path):
    texts = ["the cat sat", "the cat ran", "a dog ran the cat", "", None, "other words here"]
    first = frame(spark, texts[:4])
    compare(scoring.scored(first, F.lit(True), model_path=f"{tmp_path}/model").collect(), list(enumerate(texts[:4])), train=lambda i: True)
    got = scoring.scored_by(frame(spark, texts, ids=range(100, 106)), f"{tmp_path}/model").collect()
    want = brute([*enumerate(texts[:4]), *zip(range(100, 106), texts)], train=lambda i: i < 100)
    compare(got, None, want=[x for x in want if x[0] >= 100])
    assert scoring.scored_by(frame(spark, ["a"]).limit(0), f"{tmp_path}/model").count() == 0


def test_elias_fano():
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 63, 64, 65, 5000):
        for top in (1, 50, 1 << 20, 1 << 62):
            values = np.sort(r.integers(0, top, n)).astype(np.uint64)
            data = scoring.EliasFano.build(values)
            held = scoring.EliasFano(np.frombuffer(data, np.uint8))
            if n:
                assert (held.at(np.arange(n)) == values).all()
            targets = np.concatenate([values, values + np.uint64(1), r.integers(0, top + 5, 100).astype(np.uint64)])
            place, hit = held.search(targets, np.zeros(len(targets), np.int64), np.full(len(targets), n))
            assert (place == np.searchsorted(values, targets)).all() and (hit == np.isin(targets, values)).all()
            if n == 5000 and top > 1 << 10:
                assert held.ones.nbytes + held.zeros.nbytes <= 0.5 * len(data)


def test_trie():
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 50, 5000):
        keys = sorted({(int(a) << 1, int(b)) for a, b in zip(r.choice(r.integers(0, 2**63, 40), n), r.integers(0, 2**scoring.WORD_BITS, n))})
        first, word = np.array([k[0] for k in keys], np.uint64), np.array([k[1] for k in keys], np.uint64)
        code, weight = (r.integers(0, scoring.NONE, len(keys)).astype(np.uint16) for _ in range(2))
        under = sorted({(int(a), int(b)) for a, b in zip(r.integers(0, max(len(keys), 1), n), r.integers(0, 2**scoring.THIRD_BITS, n))})
        pair, third = np.array([k[0] for k in under], np.int64), np.array([k[1] for k in under], np.uint64)
        code3 = r.integers(0, scoring.NONE, len(under)).astype(np.uint16)
        trie = scoring.Trie(scoring.mapped(scoring.Trie.build(first, word, code, weight, pair, third, code3)))
        place, got, left = trie.lookup(first, word)
        assert (place == np.arange(len(keys))).all() and (got == code).all() and (left == weight).all()
        assert (trie.lookup3(pair, third) == code3).all()
        held, held3 = set(keys), set(under)
        assert all(m == scoring.NONE for m, (a, b) in zip(trie.lookup(first, word ^ np.uint64(1))[1], keys) if (a, b ^ 1) not in held)
        assert all(m == scoring.NONE for m, (a, b) in zip(trie.lookup3(pair, third ^ np.uint64(1)), under) if (a, b ^ 1) not in held3)
        assert (trie.lookup(first ^ np.uint64(2), word)[0] == -1).all() and (trie.lookup3(pair * 0 - 1, third) == scoring.NONE).all()


def test_steps():
    r = np.random.default_rng(5)
    starts = np.array([0, 3, 4, 50])
    values = np.concatenate([np.sort(r.integers(0, 2**63, n)) for n in (3, 1, 46, 10)]).astype(np.uint64)
    assert (scoring.summed(scoring.steps(values, starts), starts) == values).all()
    assert len(scoring.summed(np.zeros(0, np.uint64), np.zeros(0, np.int64))) == 0
    data = bytes(range(256)) * 9
    assert scoring.unsqueezed(pa.py_buffer(scoring.squeezed(data))).tobytes() == data


def test_words_are_told_by_exact_numbers():
    """Numbers ascend with hashes, are odd and distinct for trained words, and even for others; hash bits as such are not sent."""
    known = np.array([5, 9, 12], np.uint64)
    number, there = scoring.numbered(known, np.array([3, 5, 6, 9, 10, 11, 12, 13], np.uint64))
    assert number.tolist() == [0, 1, 2, 3, 4, 4, 5, 6] and there.tolist() == [False, True, False, True, False, False, True, False]
    assert scoring.numbered(known[:0], known)[0].tolist() == [0, 0, 0]
    count = np.arange(8, dtype=np.uint64)
    told = pa.table({"bucket": [1, 0], "payload": [scoring.told_words(count, number), scoring.told_words(count[:2], number[:2])]})
    group = type("G", (), {"start": 0, "end": 1})
    got, numbers = scoring.told_counts(group, told, 3)
    assert got[1:].tolist() == [1, 0, 1, 2, 3, 4, 5, 6, 7] and got[0] == 1
    assert numbers.tolist() == [0, 1, *((1 << scoring.WORD_BITS - 3) + number.astype(int)).tolist()]
