import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tallybridge.llm import identifiers

from .conftest import frame

SF = "/root/testdata/sf0.01"
KINDS = ["email", "ip", "card", "phone"]
# the contract's patterns as they stand
PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    own = [int(d) for d in digits[::-1]]
    return (sum(own[::2]) + sum(sum(divmod(2 * d, 10)) for d in own[1::2])) % 10 == 0


def fine(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return [True, all(int(p) <= 255 for p in value.split(".")) if kind == 1 else None, 12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15][kind]


def base(text):
    found = [(m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if fine(k, m[0])]
    return sorted(found)


def shown(found, kinds=KINDS):
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in found)


def got(df):
    return {r.doc_id: [(s.start, s.kind, s.end, s.value, s.base) for s in r.spans] for r in identifiers.spans(df).collect()}


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = identifiers.op12_identifiers(spark, SF).collect()
    assert len(rows) == len(docs)
    secrets = 0
    for r in rows:
        want = base(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in want) for kind in range(4)]
        assert r.base_sha256 == hashlib.sha256(shown(want).encode()).hexdigest()
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if not s.startswith("secret")] == [s for s in shown(want).split(",") if s]
        own = {tuple(map(int, s.split(":")[1:])) for s in spans if s.startswith("secret")}
        tokens = {m.span(1) for m in re.finditer(r'token = "([0-9a-f]{40})"', docs[r.doc_id])}
        assert own == tokens  # nothing else in these texts
        secrets += len(own)
    assert secrets > 0


ODD = [
    "a@b.c+d@e.f.g x..y@z.w. @q.r a@b a@b.c.. é%+-@-.-", "1.2.3.4.5.6.7.8 300.1.1.1 001.2.3.0255 1.2.3 1.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 5 12 3-4 -5 4111111111111111-",
    "+1 (555) 123-4567 +44 20 7946 0958. +1 2 +123456789 ++12345678901 +1--------2 +1(234)567-8901)", "", None, "é1é +49 151 23456789 日本 x@y.z", "a@b.c,d@e.f;4111111111111111@x.y 1.1.1.1@x.y", "0" * 30 + " 000000000000",
    "+1.2.3.4.5.6.7.8.9 10.10.10.10-5500-0000-0000-0004",
]


def test_odd_texts(spark):
    random.seed(4)
    texts = ODD + ["".join(random.choice("01 -.+@a(é)\n4=:\"") for _ in range(60)) for _ in range(400)] + ODD
    df = frame(spark, texts, ids=[None if k == 3 else k % 380 for k in range(len(texts))], row=1, hits=2, value="x", kind=3, spans="s")
    rows = identifiers.spans(df).collect()
    assert len(rows) == len(texts)
    want = sorted(((None if k == 3 else k % 380), shown(base(t))) for k, t in enumerate(texts) if k != 3)
    assert sorted((r.doc_id, shown([s[:3] for s in r.spans if s.base])) for r in rows if r.doc_id is not None) == want
    for r in rows:
        taken = [range(s.start, s.end) for s in r.spans if s.base]
        assert not [s for s in r.spans if not s.base and any(s.start < t.stop and t.start < s.end for t in taken)]


def test_empty(spark):
    assert identifiers.spans(frame(spark, ["x"]).limit(0)).count() == 0


def secret(k, n=18):
    return hashlib.sha256(str(k).encode()).hexdigest()[:n]


@pytest.mark.parametrize("few", [100_000, 0])
def test_patterns_find_unseen_identifiers(spark, monkeypatch, few):
    """From seeds that look random, contexts and affixes lead to values that do not; a value found leads on to another context."""
    monkeypatch.setattr(identifiers, "FEW_PATTERNS", few)
    texts = [f"some words here key: {secret(k, 40)} and more" for k in range(12)]  # seeds: 'key: ' is trusted
    texts += ["we set key: hunter2x today", "the key: aaaaaaa1 is old", "key: correcthorse"]  # unseen, by their context
    texts += [f"key: pass{k:03d} then" for k in range(8)] + [f"login code pass{k:03d} now" for k in range(8)]  # values of both contexts
    texts += ["login code q7q7q7 now"]  # by the context that the second round trusts
    texts += [f"id AKIA{'ABCDEFGHIJKLMNOP'[k:]}{'ABCDEFGHIJKLMNOP'[:k]} w" for k in range(2)]  # by the affix, though they have no digit
    texts += [f"id AKIA{k}A{k}B{k}C{k}DEFGHIJKL w" for k in range(8)]
    texts += [f"page {1000000 + k} of sheet {k}" for k in range(30)] + ["the word code and no more"]
    texts += [f"mail of the one user{k}@x.org" for k in range(30)] + [f"the one thing the one more number {k}12345" for k in range(40)]
    out = got(frame(spark, texts))
    values = {k: {v for _, _, _, v, is_base in spans if not is_base} for k, spans in out.items()}
    assert [values[k] for k in (12, 13, 14)] == [{"hunter2x"}, {"aaaaaaa1"}, {"correcthorse"}]
    assert all(f"pass{k:03d}" in values[15 + k] and f"pass{k:03d}" in values[23 + k] for k in range(8))
    assert values[31] == {"q7q7q7"}
    assert all(values[32 + k] for k in range(10))
    assert not any(values[k] for k in range(42, len(texts)))
    kinds = {kind for spans in out.values() for _, kind, _, _, is_base in spans if not is_base}
    assert kinds == {identifiers.SECRET}


def test_kind_of_the_seeds_goes_to_what_they_find(spark):
    texts = [f"call tel: +1 555 01{k:02d} 4{k:02d}9 now" for k in range(10)] + ["call tel: 0612-34567 now"]
    (found,) = got(frame(spark, texts))[10]
    assert found[1] == 3 and found[3] == "0612-34567" and not found[4]


# spans of a unit that is repeated: the first kind, start and end, and their number
LONG = {"a": None, "1": None, "1.": (1, 0, 7), "1-": None, "a@b.": None, "+1 ": None, "x=": None, "é": None, ": ": None, "1.2.3.4 ": (1, 0, 7), "k@l.m ": (0, 0, 5)}


@pytest.mark.parametrize("unit", LONG)
def test_very_long_texts(spark, unit):
    """A million characters of anything: in time, without recursion."""
    began = time.time()
    ((_, spans),) = got(frame(spark, [unit * (1_000_000 // len(unit))])).items()
    assert time.time() - began < 60
    if LONG[unit]:
        assert (spans[0][1], spans[0][0], spans[0][2]) == LONG[unit] and len(spans) >= 1_000_000 // len(unit) // 4
