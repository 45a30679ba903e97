"""Near-duplicate documents by BagMinHash over word shingles.

A document is the multiset of its runs of five words. Its signature has BANDS * ROWS components: each element
carries Poisson processes over its weight axis, whose points fall on random components; a component keeps its first
point. The weight axis is cut into dyadic intervals [0, 1), [1, 2), [2, 4), ...; a point of an interval's process
is passed down by halving the interval until one unit of weight is left, and counts if that unit is below the
element's weight. So equal units of two bags have equal points, and two components agree with just the weighted
Jaccard similarity. Points come in ascending order, and a process stops at the signature's largest component.

Documents that agree in a band are candidates; pairs are verified by the similarity of the two whole multisets, and the
components of all pairs at or above LEAST are classes. Units are 64-bit hashes: in a pair of bags of n and m units,
about n * m / 2^64 unequal ones are taken for equal, 5e-8 for a million words each. Equal texts are one node, told by
126 bits of hashes; their signature is computed once in each slice that a task works on.

Missed pairs: a pair of similarity 0.8 shares no band with probability below 1e-5, less above.

Cases: texts of one to four words are one shingle. Null texts and texts without a word are no one's near copy: each is
its own class. A class is named by its smallest doc_id (null if all are null). Equal rows are in one class. Other
columns of docs are not touched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import linked

SHINGLE, LEAST, BANDS, ROWS = 5, 0.8, 32, 5
#: Stands for a null doc_id.
NO_ID = (1 << 63) - 1
#: Wide enough for 126 bits.
NODE = "decimal(38,0)"


def shingles(text: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of every shingle, sorted by (owner, hash)."""
    codes, distinct, bounds = common.split_words(text)
    values = common.hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
    starts, found = common.windows(values, bounds, width)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    sizes = np.diff(bounds)
    for n in range(1, width):  # texts that are shorter than a shingle
        mine = np.flatnonzero(sizes == n)
        if len(mine):
            at = bounds[:-1][mine][:, None] + np.arange(n)
            rest, own = common.windows(values[at].ravel(), np.arange(len(mine) + 1) * n, n)
            owner, found = np.concatenate([owner, mine[rest // n]]), np.concatenate([found, own])
    order = np.argsort(found)
    small = owner[order].astype(np.uint16) if len(sizes) < 1 << 16 else owner[order]  # 16 bits are sorted by counting
    order = order[np.argsort(small, kind="stable")]
    return owner[order], found[order]


def bags(owner: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each bag with their weights."""
    if not len(found):
        return owner, found, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])]))
    return owner[first], found[first], np.diff([*first, len(found)])


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, size: int) -> np.ndarray:
    """BagMinHash signatures of n bags: the first point on each component (inf for an empty bag)."""
    signature = np.full(n * size, np.inf)
    own, of, low, width = [], [], [], []
    at, start, step = np.arange(len(element)), 0, 1
    while len(at):  # the dyadic interval [start, start + step) of all elements that reach into it
        own.append(owner[at])
        of.append(at)
        low.append(np.full(len(at), start))
        width.append(np.full(len(at), step))
        start, step = start + step, max(start + step, 1)
        at = at[weight[at] > start]
    if not own:
        return signature.reshape(n, size)
    own, of, low, width = (np.concatenate(x) for x in (own, of, low, width))
    seeds = common.mix(element[of] + low.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    now, turn = np.zeros(len(of)), 0
    while len(of):
        turn += 1
        draw = common.mix(seeds + np.uint64(turn * 0xD1B54A32D192ED03 & (1 << 64) - 1))
        now = now - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / width
        draw = common.mix(draw ^ np.uint64(0xA0761D6478BD642F))
        component = (draw >> np.uint64(32)).astype(np.int64) * size >> 32
        unit, half = low.copy(), width.copy()
        if turn == 1:
            nested = np.flatnonzero(width > 1)
        good = np.ones(len(of), bool)
        if len(nested):
            coins = common.mix(draw[nested] ^ np.uint64(0xE7037ED1A0B428DB))
            place, left = unit[nested], half[nested]
            while (left > 1).any():
                left = np.maximum(left >> 1, 1)
                place = place + np.where(half[nested] > 1, (coins & np.uint64(1)).astype(np.int64) * left, 0)
                half[nested] = left
                coins = coins >> np.uint64(1)
            good[nested] = place < weight[of[nested]]
        np.minimum.at(signature, (own * size + component)[good], now[good])
        most = signature.reshape(n, size).max(1)
        live = now < most[own]
        own, of, low, width, seeds, now = own[live], of[live], low[live], width[live], seeds[live], now[live]
        nested = np.flatnonzero(width > 1)
    return signature.reshape(n, size)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), bits.shape[:2]).copy()
    for k in range(rows):
        keys = common.mix(keys * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, k])
    return keys.view(np.int64)


def banded(texts: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(node, keys, size) of each row of texts (node, text) that has a word; size: its shingles."""

    def run(batches):
        for batch in batches:
            for part in common.slices(batch):
                part = once(part)
                owner, element, weight = bags(*shingles(part.column("text")))
                keys = band_keys(signatures(owner, element, weight, part.num_rows, bands * rows), bands, rows)
                some = np.unique(owner)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(keys[some].ravel()), bands).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("node").take(pa.array(some)), lists, pa.array(np.bincount(owner, weights=weight).astype(np.int64)[some])], ["node", "keys", "size"])

    return texts.mapInArrow(run, f"node {NODE}, keys array<long>, size long")


def once(part: pa.RecordBatch) -> pa.RecordBatch:
    """The first row of each node: copies within a slice are worked on once."""
    return part.take(pa.array(np.unique(part.column("node").dictionary_encode().indices.to_numpy(), return_index=True)[1]))


def packed_bags(texts: DataFrame) -> DataFrame:
    """(node, thing): the units of each multiset as sorted 64-bit hashes, so that pairs can be shuffled with both bags."""

    def run(batches):
        for batch in batches:
            for part in common.slices(batch):
                owner, found = shingles(part.column("text"))
                place = np.arange(len(found))
                fresh = np.concatenate([[True], (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])]) if len(found) else np.zeros(0, bool)
                again = place - np.maximum.accumulate(np.where(fresh, place, 0)) if len(found) else place
                units = common.mix(found + again.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                cuts = np.searchsorted(owner, np.arange(part.num_rows + 1))
                rows = [np.sort(units[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(rows, pa.binary())], ["node", "thing"])

    return texts.mapInArrow(run, f"node {NODE}, thing binary")


def bag_units(bags: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The units of packed bags and each bag's bounds."""
    bags = pa.concat_arrays([bags.cast(pa.large_binary())])
    bounds = np.frombuffer(bags.buffers()[1], np.int64)[: len(bags) + 1] // 8
    return np.frombuffer(bags.buffers()[2] or b"", np.uint64), bounds


def node_of(text: str) -> Column:
    """126 bits of hashes of a text: what tells it from others."""
    high = F.xxhash64(text).cast(NODE) * F.lit(1 << 62).cast(NODE)
    return (high + F.xxhash64(F.lit(1), text).bitwiseAND(F.lit((1 << 62) - 1)).cast(NODE)).cast(NODE)


def links(docs: DataFrame, least: float = LEAST, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(node, root) of the texts of docs that are linked to another; node: node_of a text."""
    common.small_batches(docs.sparkSession)
    texts = docs.select(node_of("text").alias("node"), "text").filter("text IS NOT NULL")
    signed = common.written(banded(texts, bands, rows).dropDuplicates(["node"]), "bands")
    keyed = signed.select(F.explode("keys").alias("key"), "node", "size")
    full = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high").select("key")
    members = common.written(keyed.join(full, "key", "left_semi"), "band-members")
    wanted = members.select("node").distinct()
    sets = common.written(packed_bags(texts.join(wanted, "node", "left_semi").dropDuplicates(["node"])), "bags")
    return linked(members, sets, bag_units, least)


def keyed_rows(docs: DataFrame, *carry: str) -> tuple[DataFrame, DataFrame]:
    """(row, id, node) of the rows with a word, and of those without; a null id is the largest."""
    some = F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    rows = docs.select(F.struct(*carry).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), node_of("text").alias("node"), some.alias("some"))
    return rows.filter("some").drop("some"), rows.filter("NOT some").drop("some")


def classes(docs: DataFrame, least: float = LEAST, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id and class_id of every row of docs (doc_id, text)."""
    some, alone = keyed_rows(docs, "doc_id")
    rooted = some.join(links(docs, least, bands, rows), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min("id").alias("name"))
    named = rooted.join(named, "root").select("row.*", "name").unionByName(alone.select("row.*", F.col("id").alias("name")))
    return named.select("doc_id", F.when(F.col("name") != NO_ID, F.col("name")).alias("class_id"))


def representatives(docs: DataFrame, least: float = LEAST, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One whole row of docs for each class: that of the smallest doc_id, then of the text that hashes lowest."""
    some, alone = keyed_rows(docs, *docs.columns)
    rooted = some.select("id", "node").join(links(docs, least, bands, rows), "node", "left")
    first = rooted.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min(F.struct("id", "node")).alias("first")).select("first.*")
    return some.join(first, ["id", "node"], "left_semi").dropDuplicates(["id", "node"]).select("row.*").unionByName(alone.select("row.*"))


def op3_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(common.documents(spark, sf_dir))
