import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallybridge.llm import components, near_copies

from .conftest import frame

SF = "/root/testdata/sf0.001"


def bag(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def brute(rows, least=0.8):
    """Smallest id of the component of each row."""
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j]:
                shared = sum((bags[i] & bags[j]).values())
                if shared >= least * (sum(bags[i].values()) + sum(bags[j].values()) - shared) - 1e-9:
                    parent[find(i)] = find(j)
    names = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            names[find(k)] = min(names.get(find(k), i), i)
    return sorted(((-1 if i is None else i), -1 if names.get(find(k)) is None else names[find(k)]) for k, (i, _) in enumerate(rows))


def got(df):
    return sorted((-1 if x.doc_id is None else x.doc_id, -1 if x.class_id is None else x.class_id) for x in df.collect())


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(near_copies.op3_near_copies(spark, SF)) == brute(rows)


def test_planted(spark):
    r = random.Random(11)
    base = [r.choice("abcdefghijklmnop") * r.randint(1, 4) for _ in range(300)]
    texts = []
    for share in (0.0, 0.004, 0.01, 0.015, 0.02, 0.03):
        for _ in range(12):
            texts.append(" ".join(x if r.random() >= share else "z" + str(r.random()) for x in base))
    texts += ["a a a a a a a a", "a a a a a a a", "a b", "a  b", "b a", "a", None, "", " \n", texts[3], texts[3]]
    ids = [r.randint(0, 1000) for _ in texts[:-1]] + [None]
    docs = frame(spark, texts, ids=ids, node=1, key=2, root=3, class_id=4)
    assert got(near_copies.classes(docs)) == brute(list(zip(ids, texts)))


def test_empty(spark):
    assert near_copies.classes(frame(spark, ["a"]).limit(0)).count() == 0
    assert near_copies.classes(frame(spark, [None, ""])).count() == 2


def test_signatures_are_unbiased():
    r, errors = np.random.default_rng(1), []
    for _ in range(150):
        e, a = r.integers(0, 2**63, 100).astype(np.uint64), r.integers(0, 12, 100)
        b = np.where(r.random(100) < 0.7, a, r.integers(0, 12, 100))
        owner = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        s = near_copies.signatures(owner, np.concatenate([e[a > 0], e[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, 256)
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 4 * np.std(errors) / np.sqrt(len(errors))


def test_components(spark):
    r = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(r.randint(200, 400), r.randint(200, 400)) for _ in range(90)] + [(7, 7)]
    found = dict(map(tuple, components.components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    parent = {x: x for p in pairs for x in p}
    for _ in parent:
        for a, b in pairs:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == {k: v for k, v in parent.items() if sum(k in p for p in pairs if p[0] != p[1])}


def test_units_that_agree_in_32_bits(spark):
    texts = ["a b c d e155185", "a b c d e173593", "a b c d e155185"]  # one shingle each
    sets = near_copies.packed_bags(spark.createDataFrame(list(enumerate(texts)), "node long, text string").withColumn("node", F.col("node").cast(near_copies.NODE)))
    pairs = spark.createDataFrame([(0, 1), (0, 2)], "a long, b long").selectExpr(f"CAST(a AS {near_copies.NODE}) AS a", f"CAST(b AS {near_copies.NODE}) AS b")
    assert [(r.a, r.b) for r in components.similar(components.with_sets(pairs, sets), near_copies.bag_units, 0.8).collect()] == [(0, 2)]


def sets_of(rows):
    """Things are lists of numbers as text."""

    def decode(things):
        each = [np.array(sorted(map(int, t.split())), np.uint64) for t in things.to_pylist()]
        return np.concatenate([*each, np.zeros(0, np.uint64)]), np.cumsum([0, *map(len, each)])

    return decode


def test_family_of_many_variants(spark):
    """One bucket of variants of one set, too many for its pairs: links equal those of all pairs, and few are verified."""
    r, base, sets = random.Random(5), list(range(1000, 1100)), {}
    for k in range(400):
        changes = r.choice([1, 4, 8, 12, 16])
        own = sorted(set(r.sample(base, 100 - changes)) | {r.randint(2000, 60000) for _ in range(changes)})
        sets[k] = own
        if k % 40 == 0:
            sets[1000 + k] = sorted({*own[3:], 5000 + k})
    same = spark.createDataFrame([(k, " ".join(map(str, v))) for k, v in sets.items()], "node long, thing string")
    members = spark.createDataFrame([(key, k, len(v)) for k, v in sets.items() for key in (1, 2)] + [(3, 0, len(sets[0])), (3, 1000, len(sets[1000]))], "key long, node long, size long")
    names, parent = list(sets), {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    alike = {(a, b) for a in names for b in names if a < b and 10 * len(set(sets[a]) & set(sets[b])) >= 8 * len(set(sets[a]) | set(sets[b]))}
    for a, b in alike:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    found = dict(map(tuple, components.linked(members, same, sets_of(sets), 0.8).collect()))
    assert found == {k: find(k) for k in names if any(k in p for p in alike)}
    near = {k for k, v in sets.items() if 10 * len(set(v) & set(base)) >= 8 * len(set(v) | set(base))}  # round one links these
    with_base = same.unionByName(spark.createDataFrame([(9999, " ".join(map(str, base)))], same.schema))
    families = spark.createDataFrame([(k, 9999 if k in near else k, 9999) for k in names], "node long, root long, centre long")
    proposed = {(x.a, x.b) for x in components.indexed_pairs(families, with_base, sets_of(sets), 0.8).collect()}
    assert {p for p in alike if not near.issuperset(p)} <= proposed
    assert not any(near.issuperset(p) for p in proposed) and len(proposed) < 10 * len(names)


def test_lacking_elements_are_told_by_slices(spark, monkeypatch):
    """A row for each slice of nodes and not for each element; what is shared equals a count over all sets."""
    r, rows, written = random.Random(7), [], components.written
    monkeypatch.setattr(components, "written", lambda df, name: (out := written(df, name), rows.append((name, out.count())))[0])
    sets = {k: sorted(set(r.sample(range(100), 80)) | {r.choice([200 + r.randint(0, 30), 10_000 + k]) for _ in range(20)}) for k in range(300)}
    sets |= {1000: list(range(100)), **{2000 + k: [*range(90), 200 + k] for k in range(40)}}
    same = spark.createDataFrame([(k, " ".join(map(str, v))) for k, v in sets.items()], "node long, thing string").coalesce(1)
    families = spark.createDataFrame([(k, 1000, k < 300) for k in sets if k != 1000], "node long, centre long, minor boolean").coalesce(1)
    got = {x.node: x.shared for x in components.lacking_elements(families, same, sets_of(sets)).collect()}
    lacks = {k: set(v) - set(range(100)) for k, v in sets.items() if k != 1000}
    often = {e: sum(e in v for v in lacks.values()) for e in {e for k, v in lacks.items() if k < 300 for e in v}}
    want = {k: sorted(often[e] for e in v if often.get(e, 0) > 1) for k, v in lacks.items()}
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in want.items() if v}
    key, name = {}, components._family_names(pa.array([1000]))[0]
    for e in often:
        key[int(components.mix(np.array([e], np.uint64) ^ name).view(np.int64)[0])] = often[e]
    assert all([key[x] for x in got[k]] == want[k] for k in got)
    told = [n for what, n in rows if what == "lacking"]
    assert len(told) == 2 and sum(told) < 340 < sum(map(len, lacks.values()))


def test_lists_that_no_minor_node_meets_are_left_out(spark, monkeypatch):
    """Nodes of the main component are listed only where a node outside it is, too; the similar pairs across components stay."""
    r, rows, written = random.Random(11), [], components.written
    monkeypatch.setattr(components, "written", lambda df, name: (out := written(df, name), rows.append((name, out)))[0])
    sets = {k: sorted({*r.sample(range(100), 95), *r.sample(range(200, 230), 3)}) for k in range(300)}
    sets |= {1000: list(range(100)), 2000: [*range(6, 100), 200, 201], 2001: [*range(500, 590), *range(10)]}
    same = spark.createDataFrame([(k, " ".join(map(str, v))) for k, v in sets.items()], "node long, thing string")
    families = spark.createDataFrame([(k, k if k >= 2000 else 0, 1000) for k in sets if k != 1000], "node long, root long, centre long")
    proposed = {(x.a, x.b) for x in components.indexed_pairs(families, same, sets_of(sets), 0.8).collect()}
    alike = {(a, b) for a in sets for b in (2000, 2001) if a < b and a != 1000 and 10 * len(set(sets[a]) & set(sets[b])) >= 8 * len(set(sets[a]) | set(sets[b]))}
    assert alike and alike <= proposed
    listed = [x for name, out in rows if name == "listings" for x in out.collect()]
    few, many = [x for x in listed if x.minor], [x for x in listed if not x.minor]
    met = {(x.key, side) for x in few for side in ("larger", "smaller") if x["smaller" if side == "larger" else "larger"]}
    assert 2000 in {x.node for x in few} and many
    assert sum(any(x[side] and (x.key, side) in met for side in ("larger", "smaller")) for x in many) > 0.99 * len(many)
