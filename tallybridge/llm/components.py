"""Classes of similar sets, wholly in Spark: which pairs of candidate buckets to verify, and union-find over them.

``components`` is distributed union-find by alternating large and small stars: only minima per node are aggregated
(with map-side combining) and joined back, so a node with very many links never gathers them in one task.

``linked`` verifies what buckets propose without proposing all pairs of a bucket:

1. Every bucket has a centre, its node with the fullest buckets: of a family of copies that is the original or near it.
   Pairs of a node and a centre are verified, at most one per bucket membership, and merged.
2. Buckets with nodes of one component are done. Of the others, those of up to SMALL nodes propose their pairs across
   components: fewer than SMALL per membership.
3. Larger ones propose pairs by a prefix index. All nodes of one centre are a family; its sets are ordered alike, what the
   centre lacks first, the rarest in the family ahead, and what the centre has, too, last. Two sets of N and M elements are similar only if they share
   t / (1 + t) * (N + M) elements, so their first common element has at least so many from there on in either set. A set
   is listed under its first elements only, for each class of partner sizes just as far as that allows. Elements that
   a whole family shares therefore are not listed for the few sets that are far from the centre. Two sets that meet
   in a list can share no more than what either has left of the elements that the centre lacks, and what either has of
   the centre's; pairs for which that is too little are not proposed.

So a pair of one bucket is either verified, or its nodes are in one component already, or it is not similar: the
components are those of all similar pairs of the buckets.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import groups
from .common import mix, slices, written
from .divergence import MAP_BITS, bit_map

#: Nodes of a bucket whose pairs are proposed at once.
SMALL = 16
#: Nodes of a family beside one copy of its centre, about.
PART = 64
#: The next class of sizes begins at so many times the size of the one before.
SIZE_CLASS = 1.12

#: Turns an Arrow column of texts or packed sets into the elements of all sets and their bounds; elements of a set ascend.
Decode = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b): root is the smallest node of its component."""
    stars = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "stars")
    while not _is_forest(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _is_forest(stars: DataFrame) -> bool:
    """Whether every node points to one root only, and no root points on."""
    ends = stars.select(F.col("u").alias("node"), F.lit(1).alias("points"), F.lit(0).alias("root")).unionByName(stars.select(F.col("v").alias("node"), F.lit(0).alias("points"), F.lit(1).alias("root")))
    return ends.groupBy("node").agg(F.sum("points").alias("points"), F.max("root").alias("root")).filter("points + root > 1").isEmpty()


def linked(members: DataFrame, sets: DataFrame, decode: Decode, least: float) -> DataFrame:
    """(node, root) of the nodes that similar pairs link.

    members: (key, node, size), a bucket's nodes, two or more; size: elements of the node's set. sets: (node, thing), each
    node once; decode turns things into sets. Similar pairs have a Jaccard similarity of ``least`` or more.
    """
    counted = members.join(members.groupBy("key").agg(F.count("*").alias("n")), "key")
    counted = written(counted.join(counted.groupBy("node").agg(F.sum("n").alias("fullness")), "node"), "bucket-members")
    centre = counted.groupBy("key").agg(F.max(F.struct("fullness", "node", "size")).alias("c"))
    centre = centre.select("key", F.col("c.node").alias("centre"), F.col("c.size").alias("centre_size"))
    placed = written(counted.drop("fullness").join(centre, "key"), "bucket-centres")
    first = placed.filter((F.col("node") != F.col("centre")) & _sizes_allow("size", "centre_size", least))
    first = beside_centres(first.select("node", "centre").distinct(), sets)
    labels = components(written(similar(first, decode, least).toDF("a", "b"), "links"))

    rooted = written(placed.drop("centre_size").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node")), "bucket-roots")
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("key")
    rooted = written(rooted.join(mixed, "key"), "mixed-buckets")
    few = rooted.filter(F.col("n") <= SMALL)
    other = few.select("key", F.col("node").alias("other"), F.col("root").alias("other_root"), F.col("size").alias("other_size"))
    few = few.join(other, "key").filter((F.col("root") != F.col("other_root")) & (F.col("node") < F.col("other")) & ~F.col("centre").isin(F.col("node"), F.col("other")) & _sizes_allow("size", "other_size", least))
    few = few.select(F.col("node").alias("a"), F.col("other").alias("b"), F.col("root").alias("root_a"), F.col("other_root").alias("root_b"))
    families = rooted.filter((F.col("n") > SMALL) & (F.col("node") != F.col("centre"))).select("node", "root", "centre").distinct()
    second = written(few.unionByName(indexed_pairs(families, sets, decode, least)).distinct(), "pairs")
    more = components(written(similar(with_sets(second, sets), decode, least).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), "links"))
    merged = labels.join(more.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return written(merged.unionByName(more.join(labels, "node", "left_anti").select("node", "root")), "labels")


def _sizes_allow(a: str, b: str, least: float):
    return F.least(a, b) >= least * F.greatest(a, b) - 1e-9


def with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs with the things x and y of their nodes a and b."""
    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("thing").alias("x")), "a")
    return one.join(sets.select(F.col("node").alias("b"), F.col("thing").alias("y")), "b").select(*pairs.columns, "x", "y")


def beside_centres(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (node, centre, and further columns) with the things x and y of both.

    A family of many nodes is dealt into parts of about PART nodes, and its centre is repeated for each, so that no
    task has it alone.
    """
    parts = pairs.groupBy("centre").agg(F.floor(F.count("*") / PART).cast("int").alias("last"))
    centres = parts.join(sets.select(F.col("node").alias("centre"), F.col("thing").alias("y")), "centre").withColumn("part", F.explode(F.sequence(F.lit(0), "last"))).drop("last")
    dealt = pairs.join(parts, "centre").withColumn("part", F.pmod(F.xxhash64("node"), F.col("last") + 1).cast("int")).drop("last")
    dealt = dealt.join(sets.select("node", F.col("thing").alias("x")), "node")
    return dealt.join(centres, ["centre", "part"]).select(*pairs.columns, "x", "y")


def _decoded(column: pa.Array, decode: Decode) -> list[np.ndarray]:
    """The set of each row; equal things are decoded once."""
    coded = column.dictionary_encode()
    values, bounds = decode(coded.dictionary)
    each = [values[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    return [each[k] for k in coded.indices.to_pylist()]


def similar(pairs: DataFrame, decode: Decode, least: float) -> DataFrame:
    """The rows of pairs whose sets x and y have a Jaccard similarity of ``least`` or more, without x and y."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "x", 1 << 20):
                good = np.zeros(part.num_rows, bool)
                for k, (x, y) in enumerate(zip(_decoded(part.column("x"), decode), _decoded(part.column("y"), decode))):
                    if min(len(x), len(y)) >= least * max(len(x), len(y)) - 1e-9:
                        both = np.concatenate([x, y])
                        both.sort(kind="stable")
                        shared = int(np.count_nonzero(both[1:] == both[:-1]))
                        good[k] = shared >= least * (len(both) - shared) - 1e-9
                yield part.drop_columns(["x", "y"]).filter(pa.array(good))

    return pairs.mapInArrow(run, pairs.drop("x", "y").schema)


def size_class(sizes: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(sizes, 1.0)) / np.log(SIZE_CLASS)).astype(np.int64)


def listings(x: np.ndarray, centre: np.ndarray, name: np.uint64, shared: np.ndarray, least: float) -> tuple[np.ndarray, ...]:
    """Where the prefix index lists a set.

    shared: keys of the elements that the centre lacks and a pair in question may share, rarest first; the others that it
    lacks come before them and are not listed. Returns keys, what is left from there on of their kind (lacking
    or the centre's), what follows of the other kind, classes of partner sizes, and the set's own class.
    """
    n, ratio, own = len(x), (1 + least) / least, np.isin(x, centre, assume_unique=True)
    lacking = n - int(own.sum())
    keys = np.concatenate([shared, mix(x[own] ^ name)])
    place = np.concatenate([np.arange(lacking - len(shared), lacking), np.arange(lacking, n)])
    place = place[place <= n - least * n + 1e-6]  # later on no partner of least * n elements or more is similar
    low, high = size_class(np.full(len(place), least * n - 1e-6)), size_class(ratio * (n - place) - n + 1e-6)
    times = np.maximum(high - low + 1, 0)
    of = np.repeat(np.arange(len(place)), times)
    partner = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
    left, after = np.where(place < lacking, lacking - place, n - place), np.where(place < lacking, n - lacking, 0)
    return keys[of], left[of], after[of], partner, size_class(np.full(len(of), float(n)))


def _family_names(column: pa.Array) -> np.ndarray:
    """64 bits for each row's centre."""
    coded = column.dictionary_encode()
    return np.frombuffer(b"".join(_digest(v) for v in coded.dictionary.to_pylist()), np.uint64)[coded.indices.to_numpy()]


def lacking_elements(families: DataFrame, sets: DataFrame, decode: Decode) -> DataFrame:
    """(node, centre, shared): keys of the elements that the centre lacks and two or more sets of the family have, one of them of a minor node; rarest first.

    Minor nodes' elements are told first. Those of the others are told only where a bounded bit map of the former has
    them, so a large family of one component and a few more sends little. What is told is one row for each slice of nodes; a
    slice asks each hash bucket with one binary row of distinct keys how often they occur, and is answered likewise.
    """
    kind = families.schema["node"].dataType.simpleString()

    def told(known):
        def run(batches):
            bits = None if known is None else np.unpackbits(np.frombuffer(known.value, np.uint8), bitorder="little")
            for batch in batches:
                for part in slices(batch, "x", 1 << 18):
                    name, keys = _family_names(part.column("centre")), []
                    for k, (x, y) in enumerate(zip(_decoded(part.column("x"), decode), _decoded(part.column("y"), decode))):
                        own = mix(np.setdiff1d(x, y, assume_unique=True) ^ name[k])
                        keys.append(own if bits is None else own[bits[_place(own)] > 0])
                    some = pa.array([k for k, own in enumerate(keys) if len(own)], pa.int64())
                    if len(some):
                        of = lambda c: pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), c.take(some))
                        distinct = len(np.unique(np.concatenate(keys)))
                        yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), of(part.column("node")), of(part.column("centre")), of(pa.array([own.tobytes() for own in keys], pa.binary())), pa.array([distinct], pa.int64())], ["slice", "nodes", "centres", "keys", "n"])

        return run

    def of(minor: bool, known) -> DataFrame:
        some = families.filter(F.col("minor") == minor).select("node", "centre")
        rows = beside_centres(some, sets).mapInArrow(told(known), f"slice string, nodes array<{kind}>, centres array<{kind}>, keys array<binary>, n long")
        return written(rows.withColumn("minor", F.lit(minor)), "lacking")

    few = of(True, None)
    lacking = few.unionByName(of(False, families.sparkSession.sparkContext.broadcast(_map_of(few))))
    answers = _asked(lacking).groupBy("bucket").applyInArrow(_answered, "slice string, payload binary")

    def run(own, answer):
        told = [groups.unpack(x.as_buffer(), np.uint32) for x in answer.column("payload")] if own.num_rows else []
        known, n = (np.concatenate(c) for c in zip(*told)) if told else (np.zeros(0, np.uint64), np.zeros(0, np.uint32))
        order = np.argsort(known)
        known, n = known[order], n[order]
        at, shared = [], []
        for k, keys in enumerate(own.column("keys").combine_chunks().flatten() if len(known) else []):
            keys = np.frombuffer(keys.as_buffer(), np.uint64)
            place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = known[place] == keys
            keys, times = keys[hit].view(np.int64), n[place[hit]]
            if len(keys):
                at.append(k)
                shared.append(keys[np.lexsort((keys, times))])
        names = [own.column(c).combine_chunks().flatten().take(pa.array(at, pa.int64())) for c in ("nodes", "centres")]
        return pa.table([*names, pa.array(shared, pa.list_(pa.int64()))], ["node", "centre", "shared"])

    return lacking.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(run, f"node {kind}, centre {kind}, shared array<long>")


def _place(keys: np.ndarray) -> np.ndarray:
    """Where the bit map has keys."""
    return (keys & np.uint64((1 << MAP_BITS) - 1)).astype(np.int64)


def _entry(keys: np.ndarray, side: int) -> np.ndarray:
    """What the map of listings has for a list and the side of its rows: 0 for the smaller set of a pair, 1 for the larger one."""
    return keys & ~np.uint64(1) | np.uint64(side)


def _bits(lacking: DataFrame) -> int:
    """So many leading bits of a key's place in the map name its bucket."""
    return min(groups.bucket_bits(lacking.agg(F.sum("n").alias("n")).first()["n"] or 0), MAP_BITS - 8)


def _asked(lacking: DataFrame, bits: int | None = None) -> DataFrame:
    """(bucket, slice, minor, payload): a slice's distinct keys in each bucket, ascending, and how many of its nodes have them."""
    bits = _bits(lacking) if bits is None else bits

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                keys, counts = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("keys")[k].values]), return_counts=True)
                bucket = _place(keys) >> MAP_BITS - bits
                order = np.argsort(bucket, kind="stable")
                keys, counts, bucket = keys[order], counts[order].astype(np.uint32), bucket[order]
                cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(keys)]
                rows = [groups.pack(keys[a:b], counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
                own = lambda c: pa.array([batch.column(c)[k].as_py()] * len(rows))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]], pa.int32()), own("slice"), own("minor"), pa.array(rows, pa.binary())], ["bucket", "slice", "minor", "payload"])

    return lacking.select("slice", "minor", "keys").mapInArrow(run, "bucket int, slice string, minor boolean, payload binary")


def _answered(keys, table):
    """Tells each slice which of its keys two or more nodes have, one of them minor, and how many."""
    told = [groups.unpack(x.as_buffer(), np.uint32) for x in table.column("payload")]
    values, counts = (np.concatenate(c) for c in zip(*told))
    sizes = np.array([len(x) for x, _ in told])
    minor = np.repeat(table.column("minor").to_numpy().astype(bool), sizes)
    _, back = np.unique(values, return_inverse=True)
    times = np.bincount(back, weights=counts).astype(np.uint32)[back]
    good = (times > 1) & (np.bincount(back, weights=minor) > 0)[back]
    ends = np.cumsum(sizes)
    rows = [(name, groups.pack(values[a:b][good[a:b]], times[a:b][good[a:b]])) for name, a, b in zip(table.column("slice").to_pylist(), ends - sizes, ends) if good[a:b].any()]
    return pa.table([pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.binary())], ["slice", "payload"])


def _map_of(lacking: DataFrame) -> bytes:
    """A map of MAP_BITS bits with those of the keys set; each bucket fills its own range of it."""
    bits = _bits(lacking)
    width = 1 << MAP_BITS - bits

    def run(keys, table):
        part = np.zeros(width, np.uint8)
        for payload in table.column("payload"):
            part[_place(groups.unpack(payload.as_buffer(), np.uint32)[0]) - (keys[0].as_py() << MAP_BITS - bits)] = 1
        return pa.table([pa.array([keys[0].as_py()], pa.int32()), pa.array([np.packbits(part, bitorder="little").tobytes()], pa.binary())], ["bucket", "bits"])

    found = {x.bucket: x.bits for x in _asked(lacking, bits).groupBy("bucket").applyInArrow(run, "bucket int, bits binary").collect()}
    return b"".join(bytes(found.get(k, bytes(width // 8))) for k in range(1 << bits))


def indexed_pairs(families: DataFrame, sets: DataFrame, decode: Decode, least: float) -> DataFrame:
    """Pairs (a, b, root_a, root_b) of families (node, root, centre) that a family's prefix index proposes: all similar ones are among them.

    Minor nodes are listed first. A list is met from the nodes outside the main component only, so the others are listed just
    where a bounded bit map has an entry of a minor node that they meet.
    """
    kind = families.schema["node"].dataType.simpleString()

    def run_with(known):
        def run(batches):
            bits = None if known is None else np.unpackbits(np.frombuffer(known.value, np.uint8), bitorder="little")
            for batch in batches:
                for part in slices(batch, "x", 1 << 18):
                    columns: list[list[np.ndarray]] = [[] for _ in range(7)]
                    name, shared = _family_names(part.column("centre")), part.column("shared")
                    for k, (x, y) in enumerate(zip(_decoded(part.column("x"), decode), _decoded(part.column("y"), decode))):
                        own_shared = shared[k].values.to_numpy().view(np.uint64) if shared[k].is_valid else np.zeros(0, np.uint64)
                        key, left, after, partner, own = listings(x, y, name[k], own_shared, least)
                        key = key + mix(np.minimum(own, partner).astype(np.uint64) * np.uint64(4096) + np.maximum(own, partner).astype(np.uint64))
                        some = (key, left, after, own <= partner, own >= partner)
                        if bits is not None:  # smaller ones meet larger ones
                            met = some[3] & (bits[_place(_entry(key, 1))] > 0) | some[4] & (bits[_place(_entry(key, 0))] > 0)
                            some = [c[met] for c in some]
                        for column, values in zip(columns, (np.full(len(some[0]), k), *some, np.full(len(some[0]), len(x)))):
                            column.append(values)
                    at, key, left, after, smaller, larger, size = (np.concatenate(c) for c in columns)
                    at, counts = pa.array(at), [pa.array(c.astype(np.int32)) for c in (size, left, after)]
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), part.column("node").take(at), part.column("root").take(at), part.column("minor").take(at), *counts, pa.array(smaller), pa.array(larger)], ["key", "node", "root", "minor", "size", "left", "after", "smaller", "larger"])

        return run

    kinds = families.groupBy("centre", "root").agg(F.count("*").alias("n")).groupBy("centre").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots"))
    # a family of one component proposes nothing; in the others only pairs with a node outside its main component are open
    families = written(families.join(kinds.filter("roots > 1"), "centre").select("node", "root", "centre", (F.col("root") != F.col("main")).alias("minor")), "families")
    ordered = written(families.join(lacking_elements(families, sets, decode), ["node", "centre"], "left").select("node", "root", "centre", "minor", "shared"), "ordered")

    def of(minor: bool, known) -> DataFrame:
        rows = beside_centres(ordered.filter(F.col("minor") == minor), sets)
        return written(rows.mapInArrow(run_with(known), f"key long, node {kind}, root {kind}, minor boolean, size int, left int, after int, smaller boolean, larger boolean"), "listings")

    few = of(True, None)
    sides = F.array_compact(F.array(F.when(F.col("smaller"), 0), F.when(F.col("larger"), 1)))
    entries = few.select("key", F.explode(sides).alias("side")).select(F.col("key").bitwiseAND(F.lit(-2)).bitwiseOR(F.col("side").cast("long")).alias("digest"))
    listed = few.unionByName(of(False, families.sparkSession.sparkContext.broadcast(bit_map(entries))))
    left = listed.filter("smaller")
    right = listed.filter("larger").select(F.col("minor").alias("other_minor"), "key", F.col("node").alias("other"), F.col("root").alias("other_root"), F.col("size").alias("other_size"), F.col("left").alias("other_left"), F.col("after").alias("other_after"), F.col("smaller").alias("level"))
    enough = F.least("left", "other_left") + F.least("after", "other_after") >= least / (1 + least) * (F.col("size") + F.col("other_size")) - 1e-6
    open_ = (F.col("root") != F.col("other_root")) & enough & (~(F.col("larger") & F.col("level")) | (F.col("node") < F.col("other")))
    # lists without a minor node are met by nothing, however long they are
    pairs = left.filter("minor").join(right, "key").filter(open_).unionByName(left.filter("NOT minor").join(right.filter("other_minor"), "key").filter(open_))
    flip = F.col("node") > F.col("other")
    a, b = (F.struct(F.col(n).alias("node"), F.col(r).alias("root")) for n, r in (("node", "root"), ("other", "other_root")))
    pairs = pairs.select(F.when(flip, b).otherwise(a).alias("a"), F.when(flip, a).otherwise(b).alias("b"))
    return pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.root").alias("root_a"), F.col("b.root").alias("root_b")).distinct()


def _digest(value) -> bytes:
    return hashlib.blake2b(str(value).encode(), digest_size=8).digest()
