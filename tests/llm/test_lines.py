import random

import numpy as np
import pyarrow as pa
import pytest

from tallybridge.llm import groups, lines

from .conftest import frame

SF = "/root/testdata/sf0.001"


def shingles(x):
    return {x[i : i + lines.SHINGLE] for i in range(max(1, len(x) - lines.SHINGLE + 1))}


def brute(rows):
    """(doc_id, n_lines, n_removed, text), rows in the order (doc_id, text), nulls last."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, (r[1] or "").encode()))
    firsts = {}
    for _, t in rows:
        for x in (t or "").split("\n"):
            if len(x) >= lines.MIN_CHARS and x.strip(" \t\n\r\x0b\x0c"):
                firsts.setdefault(x, len(firsts))
    names, parent = list(firsts), list(range(len(firsts)))
    sets = [shingles(x) for x in names]

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(names)):
        for j in range(i):
            if 5 * min(len(sets[i]), len(sets[j])) >= 4 * max(len(sets[i]), len(sets[j])) and find(i) != find(j):
                both = len(sets[i] & sets[j])
                if both >= lines.LEAST * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                    a, b = sorted((find(i), find(j)))
                    parent[b] = a
    out, used = [], set()
    for i, t in rows:
        kept, own = [], (t or "").split("\n")
        for x in own:
            if x in firsts:
                if find(firsts[x]) != firsts[x] or x in used:
                    continue
                used.add(x)
            kept.append(x)
        out.append((-1 if i is None else i, 0 if t is None else len(own), 0 if t is None else len(own) - len(kept), "-" if t is None else "\n".join(kept)))
    return sorted(out)


def got(df):
    return sorted((-1 if x.doc_id is None else x.doc_id, x.n_lines, x.n_removed, "-" if x.text is None else x.text) for x in df.collect())


@pytest.mark.parametrize("group_chars", [2000, 10**8])
def test_documents(spark, group_chars, monkeypatch):
    monkeypatch.setattr(groups.grouped, "__defaults__", (group_chars,))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(lines.deduplicated(docs)) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("group_chars", [3000, 10**8])
def test_planted(spark, group_chars, monkeypatch):
    monkeypatch.setattr(groups.grouped, "__defaults__", (group_chars,))
    monkeypatch.setattr(groups.bucket_bits, "__defaults__", (50,))
    r = random.Random(4)
    base = ["".join(r.choices("abcdefgh éß", k=r.randint(30, 200))) for _ in range(40)]

    def line():
        x = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 5])):
            x[r.randrange(len(x))] = r.choice("xyz")
        return "".join(x)

    texts = ["\n".join(r.choice([line(), "short", "", " " * 30]) for _ in range(r.randint(1, 8))) for _ in range(80)] + [None, "", "\n", base[0], base[0], base[0] + "\n" + base[0]]
    ids = [r.randint(0, 60) for _ in texts[:-2]] + [None, None]
    docs = frame(spark, texts, ids=ids, grp=1, row=2, kind=3, payload=4, number=5, n_lines="x")
    out = lines.deduplicated(docs)
    assert set(out.columns) == set(docs.columns) | {"n_removed"}
    assert got(out) == brute(list(zip(ids, texts)))


def test_many_null_ids(spark, monkeypatch):
    """Rows without an id fill several groups; of each component one line stays."""
    r = random.Random(8)
    base = ["".join(r.choices("abcdefgh ", k=60)) for _ in range(20)]
    texts = ["\n".join(r.choices(base, k=3)) for _ in range(100)]
    monkeypatch.setattr(groups.grouped, "__defaults__", (500,))
    docs = frame(spark, texts, ids=[k if k % 3 == 0 else None for k in range(100)])
    assert groups.grouped(docs)[0].filter("doc_id IS NULL").select("grp").distinct().count() > 5
    out = [x.text for x in lines.deduplicated(docs).collect()]
    assert sorted(x for t in out for x in t.split("\n") if x) == sorted(set("\n".join(texts).split("\n")))


def test_empty(spark):
    assert lines.deduplicated(frame(spark, ["a"]).limit(0)).count() == 0


def test_short_lines(spark):
    texts = ["Of, edti oner.\nAnd ornd.\nx\nThe quick brown fo", "And ornd.\n\nOf, edti oner.\nown", "x\n--------\n \nAnd ornd.", "---------\nThe quick brown fox\n"]
    out = got(lines.deduplicated(frame(spark, texts)))
    assert out == [(0, 4, 0, texts[0]), (1, 4, 2, "\nown"), (2, 4, 2, "--------\n "), (3, 3, 2, "")]


def test_bands_of_the_same_lines():
    """Bands that the same lines share are one key of candidates, so each pair is proposed once."""
    r = random.Random(3)
    x = "".join(r.choices("abcdefgh ", k=120))
    texts = pa.array([x, x[:-1] + "z", x[:30] + "y" + x[31:], "".join(r.choices("abcdefgh ", k=120))])
    bands = lines.line_bands(texts, lines.BANDS, lines.ROWS)
    order = np.argsort(bands.ravel(), kind="stable")
    sent = groups.messages(7, 0, bands.ravel()[order], np.repeat(np.arange(4, dtype=np.uint32), lines.BANDS)[order])
    _, keys, number = groups.gathered(lines.shared_bands(None, sent), np.uint32)
    got = {k: frozenset(number[keys == k].tolist()) for k in keys.tolist()}
    sets = [frozenset(np.flatnonzero((bands == b).any(axis=1)).tolist()) for b in bands.ravel()]
    assert sorted(got.values(), key=sorted) == sorted({s for s in sets if len(s) > 1}, key=sorted)
    assert len({b for b, s in zip(bands.ravel().tolist(), sets) if len(s) > 1}) > len(got)
