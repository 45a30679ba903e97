import random

from tallybridge.llm import repetition

from .conftest import frame
from .oracle import same, sql

SF = "/root/testdata/sf0.001"


def test_sql(spark):
    same(repetition.op1_repetition(spark, SF).toPandas(), sql(SF, repetition.ORACLE))


def brute(text, least, share, most):
    w = (text or "").encode().split()
    longest = [0] * len(w)
    for i in range(len(w)):
        for j in range(len(w)):
            if i != j:
                k = 0
                while max(i, j) + k < len(w) and w[i + k] == w[j + k]:
                    k += 1
                longest[i] = max(longest[i], k)
    cover = lambda n, width: {p for i, k in enumerate(longest) if k >= n for p in range(i, i + (width or k))}
    n_repeat, inside = len(cover(3, 3)), cover(least, None)
    failed = len(w) < 50 or 100 * n_repeat > 50 * len(w)
    kept = not failed and len(inside) <= share * len(w) and max(longest, default=0) <= most
    spans = [(a, next(b for b in range(a, len(w) + 1) if b not in inside)) for a in sorted(inside) if a - 1 not in inside]
    return len(w), n_repeat, failed, kept, len(inside), max(longest, default=0), spans


def test_brute_force(spark):
    r = random.Random(2)
    texts = [" ".join(r.choices("abcdefghijklmnopqrstuvwxyz"[: r.choice([1, 2, 8, 26])], k=r.randint(0, 90))) for _ in range(120)]
    texts += [f"{x} {x}" for x in texts[:20]] + [None, "", "\n \t", "a " * 200, texts[0], texts[0]]
    docs = frame(spark, texts, n_words=1, spans=2)
    got = repetition.repetition(docs, 4, 0.5, 30).orderBy("doc_id").collect()
    assert len(got) == len(texts)
    for row, text in zip(got, texts):
        have = (row.n_words, row.n_repeat_words, row.base_failed, row.kept, row.n_covered, row.longest_repeat, [(s.first, s.last) for s in row.spans])
        assert have == brute(text, 4, 0.5, 30), text


def test_empty(spark):
    assert repetition.repetition(frame(spark, ["a"]).limit(0)).count() == 0
