"""Language-model scoring with a sharded Elias-Fano trie of words, word pairs and word triples.

The model is interpolated. A word w after v has p2(w | v) = (n(v, w) + MASS * p1(w)) / (n(v) + MASS), with p1(w) = (n(w) + 0.1) /
(N + 0.1 (V + 1)). After u and v it has p3(w | u, v) = (max(n(u, v, w) - DISCOUNT, 0) + DISCOUNT * t(u, v) * p2(w | v)) / n(u, v), where
t is the number of different words seen after u and v; if u, v was not seen, p2. The first token of a text has p2 after
a start mark, which also comes before the first word for the second token.

Groups of documents send their distinct words with training counts to hash buckets, which sum and number them. Then
they send their distinct pairs, each with the words that follow it, to the shard of the pair's first word. A shard sums
the training counts, builds its part of the trie, and answers every pair and triple of every group; so each shard is
built and read once, and no task holds more than one shard. A word that is very frequent is split into parts by the
hashes of the words after it, so no shard has it alone.

A shard's trie has three levels in one memory-mapped file: first words (hashes), pairs (the place of the first word,
then the second word's number) and triples (the place of the pair, then the third word's number); all are
monotone and kept as Elias-Fano sequences, as are the pointers from each level to where its successors start in the
next. Beside pairs and triples lie 16-bit codes of their shares, and beside pairs the weight that is left to shorter
contexts. A lookup goes down by first word, pair and triple, each time among the successors of the context it has found.
Opened, a sequence takes its file's size and two 32-bit counts for each 64 bits of its unary part.

``scored`` can keep the shards as a table (one row each), which ``scored_by`` reads to score other documents later.

A word's number is its bucket, then how many trained words of the bucket have smaller hashes, doubled, and one if it is trained
itself. Numbers are exact for trained words and ascend with the hashes; words that training lacks have even numbers, which no
pair of the trie has. They have a few bits more than the trained words' count needs, where hashes that tell words
apart would be twice as long. Words themselves are told by 64 bits of their hashes, first words by 63.

Cases: a null text is empty: one end token after the start. Rows with a null doc_id are scored, and train. Without
training tokens only the unknown-word share is left (N = 0, V = 0). Repeated rows count and score one by one.
"""

from __future__ import annotations

import mmap
import tempfile
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, groups
from .language import held_out

MASS, ADDED, DISCOUNT = 60.0, 0.1, 0.75
#: Training tokens after which a context gets another part.
PART_TOKENS = 1 << 20
#: Code of a share p: STEP * -log10 p. NONE: no such successor. WHOLE: code of the weight 1.
STEP, NONE, WHOLE = 4096, 65535, 65535
WORD_BITS, THIRD_BITS = 38, 38
END, START = xxhash.xxh3_64_intdigest(b""), xxhash.xxh3_64_intdigest(b"\n")


def select(words: np.ndarray, before: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The place of the k-th set bit; before: set bits ahead of each 64-bit word."""
    at = np.searchsorted(before, k, side="right") - 1
    word, k, place = words[at], k - before[at], at.astype(np.int64) << 6
    for shift in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count(word & np.uint64((1 << shift) - 1)).astype(np.int64)
        up = k >= low
        k = k - low * up
        word = np.where(up, word >> np.uint64(shift), word)
        place += shift * up
    return place


class EliasFano:
    """A monotone sequence of integers below 2^63: low bits packed, high bits in unary."""

    @staticmethod
    def build(values: np.ndarray) -> bytes:
        n = len(values)
        top = int(values[-1]) if n else 0
        low = min(56, max(0, (top // max(n, 1)).bit_length() - 1))
        bits = np.unpackbits(np.ascontiguousarray(values).view(np.uint8).reshape(n, 8), axis=1, bitorder="little")[:, :low]
        ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        high = np.zeros(-(-(int(ones[-1]) + 2) // 64) * 64 if n else 64, np.uint8)
        high[ones] = 1
        packed, unary = (np.packbits(x.ravel(), bitorder="little").tobytes() for x in (bits, high))
        packed += bytes(-len(packed) % 8)
        return b"".join([np.array([n, low, len(packed), len(unary), int(ones[-1]) + 1 - n if n else 0], np.int64).tobytes(), packed, bytes(16), unary])

    def __init__(self, data: np.ndarray):
        self.n, self.low, size, unary, self.top = (int(x) for x in data[:40].view(np.int64))
        self.packed = data[40 : 40 + size + 16]
        self.unary = data[56 + size : 56 + size + unary].view(np.uint64)
        ones = np.cumsum(np.bitwise_count(self.unary), dtype=np.uint32)
        self.ones = np.concatenate([np.zeros(1, np.uint32), ones[:-1]])
        self.zeros = (np.arange(len(self.unary)) * 64 - self.ones).astype(np.uint32)

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.int64) * self.low
        words = self.packed[(bit >> 3)[:, None] + np.arange(8)].view(np.uint64).ravel()
        return words >> (bit & 7).astype(np.uint64) & np.uint64((1 << self.low) - 1)

    def at(self, i: np.ndarray) -> np.ndarray:
        return (select(self.unary, self.ones, i.astype(np.int64)) - i).astype(np.uint64) << np.uint64(self.low) | self.lows(i)

    def upto(self, high: np.ndarray) -> np.ndarray:
        """How many values have at most these high bits."""
        out = np.full(len(high), self.n, np.int64)
        out[high < 0] = 0
        some = np.flatnonzero((high >= 0) & (high <= self.top))
        flipped = ~self.unary
        out[some] = select(flipped, self.zeros, high[some]) - high[some]
        return out

    def search(self, target: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first place in [start, end) whose value is target or more (end: none), and whether it is the target.

        The unary part gives the run of equal high bits; within it, low bits are compared by halving.
        """
        high, low = (target >> np.uint64(self.low)).astype(np.int64), target & np.uint64((1 << self.low) - 1)
        place = np.minimum(np.maximum(self.upto(high - 1), start), end)
        stop = np.minimum(self.upto(high), end)
        last = stop.copy()
        while len(open_ := np.flatnonzero(place < last)):
            middle = (place[open_] + last[open_]) >> 1
            less = self.lows(middle) < low[open_]
            place[open_[less]] = middle[less] + 1
            last[open_[~less]] = middle[~less]
        hit = place < stop
        hit[hit] = self.lows(place[hit]) == low[hit]
        return place, hit


class Trie:
    """One shard: first words, pairs and triples with pointers, codes and weights."""

    @staticmethod
    def build(first: np.ndarray, word: np.ndarray, code: np.ndarray, weight: np.ndarray, pair: np.ndarray, third: np.ndarray, code3: np.ndarray) -> bytes:
        """Pairs: first (hashes) and word (WORD_BITS bits), sorted by both and distinct. Triples: place of the pair and third (THIRD_BITS bits), likewise."""
        starts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else np.zeros(0, int)
        place = np.repeat(np.arange(len(starts)), np.diff([*starts, len(first)])).astype(np.uint64)
        below = np.searchsorted(pair, np.arange(len(first) + 1)).astype(np.uint64)
        levels = [
            EliasFano.build(first[starts] >> np.uint64(1)), EliasFano.build(np.array([*starts, len(first)], np.uint64)), EliasFano.build(place << np.uint64(WORD_BITS) | word), EliasFano.build(below),
            EliasFano.build(pair.astype(np.uint64) << np.uint64(THIRD_BITS) | third), code.tobytes(), weight.tobytes(), code3.tobytes(),
        ]
        pad = lambda x: x + bytes(-len(x) % 8)
        return b"".join(np.int64(len(pad(x))).tobytes() + pad(x) for x in levels)

    def __init__(self, data: np.ndarray):
        parts, at = [], 0
        while at < len(data):
            size = int(data[at : at + 8].view(np.int64)[0])
            parts.append(data[at + 8 : at + 8 + size])
            at += 8 + size
        self.firsts, self.pointers, self.pairs, self.pointers3, self.triples = (EliasFano(p) for p in parts[:5])
        self.codes, self.weights = (p[: 2 * self.pairs.n].view(np.uint16) for p in parts[5:7])
        self.codes3 = parts[7][: 2 * self.triples.n].view(np.uint16)

    def lookup(self, first: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of (first, word) pairs or -1, their codes (NONE: not there) and weights (WHOLE: not there)."""
        place = np.full(len(first), -1, np.int64)
        if self.firsts.n:
            distinct, back = np.unique(first >> np.uint64(1), return_inverse=True)
            at, some = self.firsts.search(distinct, np.zeros(len(distinct), np.int64), np.full(len(distinct), self.firsts.n))
            start, end = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            start[some], end[some] = (self.pointers.at(at[some] + k).astype(np.int64) for k in (0, 1))
            found, hit = self.pairs.search(at.astype(np.uint64)[back] << np.uint64(WORD_BITS) | word, start[back], end[back])
            place[hit] = found[hit]
        there = place >= 0
        code, weight = np.full(len(first), NONE, np.uint16), np.full(len(first), WHOLE, np.uint16)
        code[there], weight[there] = self.codes[place[there]], self.weights[place[there]]
        return place, code, weight

    def lookup3(self, place: np.ndarray, third: np.ndarray) -> np.ndarray:
        """Codes of the words third after pairs at these places (-1: no such pair); NONE where there is no such triple."""
        out = np.full(len(place), NONE, np.uint16)
        some = np.flatnonzero(place >= 0)
        place, third = place[some], third[some]
        if len(some):
            start, end = (self.pointers3.at(place + k).astype(np.int64) for k in (0, 1))
            found, hit = self.triples.search(place.astype(np.uint64) << np.uint64(THIRD_BITS) | third, start, end)
            out[some[hit]] = self.codes3[found[hit]]
        return out


def mapped(data: bytes) -> np.ndarray:
    """The bytes as a memory-mapped file, which goes when it is no longer used."""
    with tempfile.TemporaryFile() as file:
        file.write(data)
        file.flush()
        return np.frombuffer(mmap.mmap(file.fileno(), len(data), access=mmap.ACCESS_READ), np.uint8)


class Group:
    """The tokens of a group: distinct words with hashes, and (context, word) pairs."""

    def __init__(self, table: pa.Table):
        self.table = groups.rows_of(table)
        codes, distinct, bounds = common.split_words(pc.ascii_lower(self.table.column("text").combine_chunks()))
        self.n_docs, n = len(bounds) - 1, len(distinct)
        self.tokens = np.insert(codes, bounds[1:], n)  # an end after each text
        self.bounds = bounds + np.arange(self.n_docs + 1)
        self.owner = common.owners(self.bounds)
        self.train = pc.fill_null(self.table.column("train"), True).to_numpy().astype(bool)[self.owner]
        hashes = np.concatenate([common.hashes(distinct), np.array([END, START], np.uint64)])
        self.order = np.argsort(hashes)  # codes become ranks of hashes
        rank = np.empty(len(hashes), np.int64)
        rank[self.order] = np.arange(len(hashes))
        self.hashes, self.start, self.end, self.tokens = hashes[self.order], int(rank[n + 1]), int(rank[n]), rank[self.tokens]

    def counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.train], minlength=len(self.hashes)).astype(np.uint64)

    def grams(self, n_of: np.ndarray) -> Grams:
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.bounds[:-1]] = self.start
        keys, back = np.unique(before * len(self.hashes) + self.tokens, return_inverse=True)
        first, word = np.divmod(keys, len(self.hashes))
        parts = n_of // np.uint64(PART_TOKENS) + np.uint64(1)
        part = common.mix(self.hashes[word]) % parts[first]
        part = common.mix(self.hashes[first] + part * np.uint64(0x9E3779B97F4A7C15)) & ~np.uint64(1)
        order = np.argsort(part, kind="stable")  # words are in the order of their hashes already
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        back = place[back]
        second = np.ones(len(self.tokens), bool)  # all tokens but a text's first end a triple
        second[self.bounds[:-1]] = False
        at = np.flatnonzero(second)
        keys, back3 = np.unique(back[at - 1] * len(self.hashes) + self.tokens[at], return_inverse=True)
        pair, third = np.divmod(keys, len(self.hashes))
        return Grams(part[order], first[order], word[order], back, pair, third, at, back3)


@dataclass
class Grams:
    """The distinct pairs and triples of a group.

    Pairs are sorted by part (of the first word; names the shard) and word; back: each token's pair. Triples are sorted
    by pair (the place of their first two words) and third word; at: the tokens that end one, back3: their triples.
    """

    part: np.ndarray
    first: np.ndarray
    word: np.ndarray
    back: np.ndarray
    pair: np.ndarray
    third: np.ndarray
    at: np.ndarray
    back3: np.ndarray


def planes(*columns: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.dtype.itemsize).T.tobytes() for c in columns)


def of_planes(data: np.ndarray, n: int, *kinds) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(data[at : at + n * size].reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    return out


def squeezed(data: bytes) -> bytes:
    return np.int64(len(data)).tobytes() + pa.compress(data, codec="zstd", asbytes=True)


def unsqueezed(data) -> np.ndarray:
    """The bytes that squeezed took."""
    size = int(np.frombuffer(data, np.int64, 1)[0])
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), np.uint8)


def steps(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Differences of values that ascend within runs; a run's first value stays."""
    out = np.diff(values, prepend=np.uint64(0))
    out[starts] = values[starts]
    return out


def summed(out: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The values that steps took."""
    sums = np.cumsum(out, dtype=np.uint64)
    starts = starts.astype(np.int64)
    return sums - np.repeat(sums[starts] - out[starts], np.diff(np.append(starts, len(out))))


def send_words(bits: int):
    def run(keys, table):
        group = Group(table)
        return groups.messages(keys[0].as_py(), bits, group.hashes, group.counts())

    return run


def numbered(known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes' numbers within their bucket, and which of them are known; known: the bucket's trained hashes, ascending."""
    at = np.searchsorted(known, hashes)
    there = at < len(known)
    there[there] = known[at[there]] == hashes[there]
    return (2 * at + there).astype(np.uint64), there


def told_words(count: np.ndarray, number: np.ndarray) -> bytes:
    """Counts and numbers of a group's words in a bucket, in the order of their hashes: numbers ascend."""
    return planes(count, np.diff(number, prepend=np.uint64(0)).astype(np.uint32))


def answer_words(keys, table):
    """Each group's hashes' total counts and numbers, in its order; and a row of group -1 with the bucket's tokens and types."""
    of, hashes, counts = groups.gathered(table, np.uint64)
    distinct, back = np.unique(hashes, return_inverse=True)
    total = np.zeros(len(distinct), np.uint64)
    np.add.at(total, back, counts)
    number, _ = numbered(distinct[total > 0], distinct)
    cuts = [0, *(np.flatnonzero(np.diff(of)) + 1), len(of)] if len(of) else [0]
    rows = [(int(of[a]), told_words(total[back[a:b]], number[back[a:b]]), 0, 0) for a, b in zip(cuts[:-1], cuts[1:])]
    rows.append((-1, b"", int(total.sum()), int((total > 0).sum())))
    columns = list(zip(*rows))
    bucket = [keys[0].as_py()] * len(rows)
    return pa.table([pa.array(bucket, pa.int32()), pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], ["bucket", "grp", "payload", "tokens", "types"])


def told_counts(group: Group, told: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The training counts and numbers of a group's words, from its answers; the start counts as often as the end."""
    told, counts, numbers = told.sort_by("bucket"), [], []
    for bucket, payload in zip(told.column("bucket").to_pylist(), told.column("payload")):
        data = np.frombuffer(payload.as_buffer(), np.uint8)
        count, gap = of_planes(data, len(data) // 12, np.uint64, np.uint32)
        counts.append(count)
        number = np.cumsum(gap, dtype=np.uint64)
        if len(number) and int(number[-1]) >> WORD_BITS - bits:
            raise OverflowError(f"bucket {bucket} has more words than {WORD_BITS - bits} bits can number")
        numbers.append(np.uint64(bucket << WORD_BITS - bits) + number)
    n_of = np.concatenate(counts)
    n_of[group.start] = n_of[group.end]
    return n_of, np.concatenate(numbers)


def share(n_of: np.ndarray, tokens: int, types: int) -> np.ndarray:
    return (n_of + ADDED) / (tokens + ADDED * (types + 1))


def send_grams(bits: int, counting: bool = True):
    """Rows (bucket, grp, payload) of a group's pairs and triples, with training counts or (counting = False) without any."""

    def run(keys, table, told):
        group = Group(table)
        n_of, number = told_counts(group, told, bits)
        g = group.grams(n_of)
        train = group.train & counting
        counts = np.bincount(g.back[train], minlength=len(g.part)).astype(np.uint32)
        counts3 = np.bincount(g.back3[train[g.at]], minlength=len(g.pair)).astype(np.uint32)
        word, third = number[g.word], number[g.third]
        below = np.searchsorted(g.pair, np.arange(len(g.part) + 1))
        followers = np.diff(below).astype(np.uint32)
        bucket = (g.part >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(g.part), np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1), len(g.part)]
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            some = a + np.flatnonzero(np.concatenate([[True], g.part[a + 1 : b] != g.part[a : b - 1]]))
            head = groups.pack(g.part[some], n_of[g.first[some]], np.diff([*some, b]).astype(np.uint32))
            lo, hi = below[a], below[b]
            rows.append(squeezed(np.array([b - a, len(head), hi - lo], np.int64).tobytes() + head + planes(steps(word[a:b], some - a), counts[a:b], followers[a:b]) + planes(third[lo:hi], counts3[lo:hi])))
        return pa.table([pa.array(bucket[cuts[:-1]], pa.int32()), pa.array([keys[0].as_py()] * len(rows), pa.int32()), pa.array(rows, pa.binary())], ["bucket", "grp", "payload"])

    return run


@dataclass
class Sent:
    """What the groups have sent to a shard, one after the other."""

    sizes: list[tuple[int, int]]
    first: np.ndarray
    n_first: np.ndarray
    word: np.ndarray
    count: np.ndarray
    pair: np.ndarray
    third: np.ndarray
    count3: np.ndarray

    @staticmethod
    def of(payloads: pa.ChunkedArray) -> Sent:
        sizes, parts, pairs = [], [], 0
        for payload in payloads:
            data = unsqueezed(payload.as_buffer())
            n, size, n3 = (int(x) for x in data[:24].view(np.int64))
            first, n_first, successors = groups.unpack(data[24 : 24 + size], np.uint64, np.uint32)
            word, count, followers = of_planes(data[24 + size :], n, np.uint64, np.uint32, np.uint32)
            word = summed(word, np.cumsum(successors) - successors)
            third, count3 = of_planes(data[24 + size + 16 * n :], n3, np.uint64, np.uint32)
            parts.append((np.repeat(first, successors), np.repeat(n_first, successors), word, count, np.repeat(np.arange(pairs, pairs + n), followers), third, count3))
            sizes.append((n, n3))
            pairs += n
        return Sent(sizes, *(np.concatenate(c) for c in zip(*parts)))


def shard_of(sent: Sent, mass: float) -> bytes:
    """The trie of a shard's training counts."""
    order = np.lexsort((sent.word, sent.first))
    first, word = sent.first[order], sent.word[order]
    fresh = np.concatenate([[True], (first[1:] != first[:-1]) | (word[1:] != word[:-1])])
    starts = np.flatnonzero(fresh)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(fresh) - 1
    total = np.add.reduceat(sent.count[order].astype(np.float64), starts)
    seen = total > 0
    rank = np.cumsum(seen) - 1
    # triples whose pair was seen in training, by the pair's place among those
    some = np.flatnonzero(sent.count3 > 0)
    key = rank[number[sent.pair[some]]].astype(np.uint64) << np.uint64(THIRD_BITS) | sent.third[some]
    by = np.argsort(key, kind="stable")
    key, count3 = key[by], sent.count3[some][by].astype(np.float64)
    fresh3 = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
    count3 = np.add.reduceat(count3, fresh3) if len(key) else count3
    key = key[fresh3]
    pair, third = (key >> np.uint64(THIRD_BITS)).astype(np.int64), key & np.uint64((1 << THIRD_BITS) - 1)
    first, word, total = first[starts][seen], word[starts][seen], total[seen]
    after = np.maximum(np.bincount(pair, weights=count3, minlength=len(total)), 1)
    code = coded(total / (sent.n_first[order][starts][seen] + mass))
    weight = np.bincount(pair, minlength=len(total)) * DISCOUNT / after
    weight = np.where(weight > 0, np.round(weight * WHOLE), WHOLE).astype(np.uint16)  # nothing follows an end
    return Trie.build(first, word, code, weight, pair, third, coded((count3 - DISCOUNT) / after[pair]))


def coded(share_of: np.ndarray) -> np.ndarray:
    return np.round(-np.log10(share_of) * STEP).clip(0, NONE - 1).astype(np.uint16)


def answers(sent: Sent, trie: Trie) -> list[bytes]:
    """For each group the codes and weights of its pairs, and the codes of its triples."""
    place, code, weight = trie.lookup(sent.first, sent.word)
    code3 = trie.lookup3(place[sent.pair], sent.third)
    rows, at, at3 = [], 0, 0
    for n, n3 in sent.sizes:
        rows.append(squeezed(np.array([n, n3], np.int64).tobytes() + planes(code[at : at + n], weight[at : at + n]) + planes(code3[at3 : at3 + n3])))
        at, at3 = at + n, at3 + n3
    return rows


def answer_grams(mass: float, keep: bool):
    """Builds a bucket's shard and answers all groups; with ``keep`` the shard itself is a row of group -1."""

    def run(keys, table):
        sent = Sent.of(table.column("payload"))
        data = shard_of(sent, mass)
        rows, of = answers(sent, Trie(mapped(data))), table.column("grp").to_pylist()
        if keep:
            rows, of = [*rows, data], [*of, -1]
        return pa.table([pa.array([keys[0].as_py()] * len(rows), pa.int32()), pa.array(of, pa.int32()), pa.array(rows, pa.binary())], ["bucket", "grp", "payload"])

    return run


def answer_by(keys, table, shard):
    """Answers all groups by a shard that was kept (none: nothing of it was seen)."""
    if not table.num_rows:
        return pa.table([pa.array([], pa.int32()), pa.array([], pa.int32()), pa.array([], pa.binary())], ["bucket", "grp", "payload"])
    sent, nothing = Sent.of(table.column("payload")), np.zeros(0, np.uint64)
    data = shard.column("payload")[0].as_buffer().to_pybytes() if shard.num_rows else Trie.build(nothing, nothing, *[np.zeros(0, np.uint16)] * 2, np.zeros(0, np.int64), nothing, np.zeros(0, np.uint16))
    return pa.table([table.column("bucket"), table.column("grp"), pa.array(answers(sent, Trie(mapped(data))), pa.binary())], ["bucket", "grp", "payload"])


def score_group(mass: float, tokens: int, types: int, bits: int):
    def run(keys, table, told):
        group = Group(table)
        kind = told.column("kind").to_numpy()
        n_of, _ = told_counts(group, told.filter(pa.array(kind == 0)), bits)
        g = group.grams(n_of)
        got = []
        for payload in told.filter(pa.array(kind == 1)).sort_by("bucket").column("payload"):
            data = unsqueezed(payload.as_buffer())
            n, n3 = (int(x) for x in data[:16].view(np.int64))
            got.append((*of_planes(data[16:], n, np.uint16, np.uint16), *of_planes(data[16 + 4 * n :], n3, np.uint16)))
        code, weight, code3 = (np.concatenate(c) for c in zip(*got))
        base = share(n_of, tokens, types)
        part = lambda c: np.where(c == NONE, 0.0, 10.0 ** (c / -float(STEP)))
        p2 = part(code) + mass * base[g.word] / (n_of[g.first] + mass)
        p = p2[g.back]
        p[g.at] = part(code3)[g.back3] + weight[g.back[g.at - 1]] / WHOLE * p[g.at]
        add = lambda x: np.bincount(group.owner, weights=x, minlength=group.n_docs)
        sizes, known = np.diff(group.bounds), add(n_of[group.tokens] > 0).astype(np.int64)
        return pa.table([common.loose(group.table.column("row")), pa.array(sizes), pa.array(known), pa.array(np.full(group.n_docs, tokens)), pa.array(add(np.log10(base)[group.tokens])), pa.array(add(np.log10(p)))], ["row", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def scored(docs: DataFrame, train, mass: float = MASS, carry: list[str] | None = None, model_path: str | None = None) -> DataFrame:
    """Scores every row of docs by a model of the rows where train (a boolean column; null counts as true) holds.

    Returns carry's columns (doc_id by default), n_tokens, n_known, train_tokens, base_score and score (log10). With
    model_path the model is kept there, for scored_by.
    """
    base, by_group, chars = _dealt(docs, train, carry)
    bits = groups.bucket_bits(chars // 6)
    counted = by_group.applyInArrow(send_words(bits), groups.MESSAGE).groupBy("bucket").applyInArrow(answer_words, "bucket int, grp int, payload binary, tokens long, types long")
    counted = common.written(counted, "word-counts")
    sizes = counted.filter("grp = -1").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).first()
    tokens, types = sizes["tokens"] or 0, sizes["types"] or 0
    words = counted.filter("grp >= 0").select("grp", "bucket", "payload", F.lit(0).alias("kind"))
    sent = by_group.cogroup(words.groupBy("grp")).applyInArrow(send_grams(bits), groups.MESSAGE)
    told = sent.groupBy("bucket").applyInArrow(answer_grams(mass, bool(model_path)), groups.MESSAGE)
    if model_path:
        told = common.written(told, "gram-codes")
        told.filter("grp = -1").select("bucket", "payload").write.parquet(f"{model_path}/shards")
        _words(by_group, bits).write.parquet(f"{model_path}/words")
        docs.sparkSession.createDataFrame([(bits, tokens, types, mass)], "bits int, tokens long, types long, mass double").write.parquet(f"{model_path}/sizes")
        told = told.filter("grp >= 0")
    return _scores(base, by_group, words, told, mass, tokens, types, bits)


def scored_by(docs: DataFrame, model_path: str, carry: list[str] | None = None) -> DataFrame:
    """The columns of scored for docs by a model that was kept before; docs teach it nothing."""
    base, by_group, _ = _dealt(docs, F.lit(False), carry)
    read = lambda name: docs.sparkSession.read.parquet(f"{model_path}/{name}")
    bits, tokens, types, mass = read("sizes").first()
    asked = by_group.applyInArrow(send_words(bits), groups.MESSAGE)
    words = asked.groupBy("bucket").cogroup(read("words").groupBy("bucket")).applyInArrow(answer_words_by, "bucket int, grp int, payload binary")
    words = common.written(words, "word-counts").select("grp", "bucket", "payload", F.lit(0).alias("kind"))
    sent = by_group.cogroup(words.groupBy("grp")).applyInArrow(send_grams(bits, False), groups.MESSAGE)
    told = sent.groupBy("bucket").cogroup(read("shards").groupBy("bucket")).applyInArrow(answer_by, groups.MESSAGE)
    return _scores(base, by_group, words, told, mass, tokens, types, bits)


def _dealt(docs: DataFrame, train, carry: list[str] | None) -> tuple[DataFrame, DataFrame, int]:
    common.small_batches(docs.sparkSession)
    base = docs.select(F.struct(*(carry or ["doc_id"])).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", train.alias("train"))
    base, chars, _ = groups.grouped(base)
    return base, groups.packed_rows(base).groupBy("grp"), chars


def _scores(base: DataFrame, by_group, words: DataFrame, told: DataFrame, mass: float, tokens: int, types: int, bits: int) -> DataFrame:
    told = words.unionByName(told.select("grp", "bucket", "payload", F.lit(1).alias("kind")))
    kind = base.schema["row"].dataType.simpleString()
    out = by_group.cogroup(told.groupBy("grp")).applyInArrow(score_group(mass, tokens, types, bits), f"row {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.select("row.*", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _words(by_group, bits: int) -> DataFrame:
    """(bucket, payload): each bucket's words with their training counts."""

    def run(keys, table):
        _, hashes, counts = groups.gathered(table, np.uint64)
        distinct, back = np.unique(hashes, return_inverse=True)
        total = np.zeros(len(distinct), np.uint64)
        np.add.at(total, back, counts)
        return pa.table([pa.array([keys[0].as_py()], pa.int32()), pa.array([groups.pack(distinct[total > 0], total[total > 0])], pa.binary())], ["bucket", "payload"])

    return by_group.applyInArrow(send_words(bits), groups.MESSAGE).groupBy("bucket").applyInArrow(run, "bucket int, payload binary")


def answer_words_by(keys, table, kept):
    """Each group's words' counts and numbers in a model that was kept, in the group's order."""
    known, total = groups.unpack(kept.column("payload")[0].as_buffer(), np.uint64) if kept.num_rows else (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    rows = []
    for payload in table.column("payload"):
        hashes, _ = groups.unpack(payload.as_buffer(), np.uint64)
        number, there = numbered(known, hashes)
        count = np.zeros(len(hashes), np.uint64)
        count[there] = total[number[there] >> np.uint64(1)]
        rows.append(told_words(count, number))
    return pa.table([table.column("bucket"), table.column("grp"), pa.array(rows, pa.binary())], ["bucket", "grp", "payload"])


def op5_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    out = scored(docs, ~held_out(10))
    return out.select("doc_id", held_out(10).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
