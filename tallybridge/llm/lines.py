"""Line dedup: equal and nearly equal lines, one line of each component stays.

All lines that are not blank take part, however short. Groups of documents (ranges of doc_id) first settle equal
lines: each group sends hashes of its distinct lines to hash buckets, which tell all but the smallest group. Each
line's first occurrence then gets a MinHash signature of its character shingles (one permutation with bins; empty bins
borrow from full ones), cut into bands. Lines that share a band are candidates; their Jaccard similarity is verified
on whole shingle sets, and distributed union-find makes components of the pairs at or above LEAST. Bands that the same
lines share propose them once. Of a component the first line by (doc_id, place) stays.

Missed pairs: a pair of similarity 0.8 shares no band with probability of about 4e-4, less above.

Cases: null and empty texts have no lines that take part. A line that is repeated within its own text goes, too. A
null doc_id is larger than all others; rows of one doc_id go by their texts, those without one by groups of texts' hashes and
then by texts. Lines are equal if 96 bits of their hashes are. Columns of docs other than text are kept as they are.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, groups
from .components import linked

SHINGLE, LEAST, BANDS, ROWS = 8, 0.8, 20, 5
#: One: every line takes part that is not blank.
MIN_CHARS = 1
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Odd factors of the steps of a shingle's hash.
FACTORS = {1: np.uint64(0x9E3779B97F4A7C15), 2: np.uint64(0xA0761D6478BD642F), 4: np.uint64(0xE7037ED1A0B428DB)}


def lines_of(text: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array, np.ndarray]:
    """All lines, each text's bounds in them, the distinct lines that take part, and each line's number there or -1."""
    lists = pc.split_pattern(pc.fill_null(text, "").cast(pa.large_string()), "\n")
    flat = lists.flatten()
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    long = pc.and_(pc.greater_equal(pc.utf8_length(flat), MIN_CHARS), pc.not_equal(pc.ascii_trim_whitespace(flat), "")).to_numpy(zero_copy_only=False)
    coded = flat.filter(pa.array(long)).dictionary_encode()
    number = np.full(len(flat), -1, np.int64)
    number[long] = coded.indices.to_numpy(zero_copy_only=False)
    return flat, bounds, coded.dictionary, number


def line_hashes(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    digest = xxhash.xxh3_128_digest
    both = np.frombuffer(b"".join([digest(x) for x in lines.cast(pa.large_binary()).to_pylist()]), ">u8").reshape(-1, 2).astype(np.uint64)
    return both[:, 1].copy(), (both[:, 0] >> np.uint64(32)).astype(np.uint32)


def characters(lines: pa.Array) -> np.ndarray:
    """The code points of all lines, one after the other."""
    lines = pa.concat_arrays([lines.cast(pa.large_string())])  # a copy where it is a slice of something larger
    offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
    data = lines.buffers()[2]
    held = memoryview(data)[offsets[0] : offsets[-1]] if data is not None and len(lines) else b""
    return np.frombuffer(str(held, "utf-8").encode("utf-32-le"), np.uint32).astype(np.uint64)


def line_shingles(lines: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Line and hash of each run of ``width`` characters (a power of two), in order; a shorter line is one shingle."""
    sizes = pc.utf8_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    padded = np.maximum(sizes, width)
    if (sizes < width).any():
        lines = pc.utf8_rpad(lines, width, "\n")
    found, step = characters(lines), 1
    while step < width:  # runs of twice as many characters from two neighbours
        found = found[:-step] * FACTORS[step] + found[step:]
        found ^= found >> np.uint64(32)
        step *= 2
    inside = np.ones(len(found), bool)
    inside[(np.cumsum(padded)[:-1, None] - np.arange(1, width)).ravel()] = False  # runs that reach into the next line
    return np.repeat(np.arange(len(lines)), padded - width + 1), common.mix(found[inside])


@functools.lru_cache(1 << 12)
def drawn(size: int, turn: int) -> np.ndarray:
    """The bin that each of so many bins draws in a turn."""
    draws = common.mix(np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn))
    return ((draws >> np.uint64(40)) * np.uint64(size) >> np.uint64(24)).astype(np.int64)


def line_bands(lines: pa.Array, bands: int, rows: int) -> np.ndarray:
    """Band keys (lines x bands) of one-permutation MinHash signatures."""
    size, n = bands * rows, len(lines)
    owner, found = line_shingles(lines)
    signature = np.full(n * size, EMPTY)
    bins = ((found >> np.uint64(40)) * np.uint64(size) >> np.uint64(24)).astype(np.int64)
    np.minimum.at(signature, owner * size + bins, found)
    empty = np.flatnonzero(signature == EMPTY)
    slot = empty % size
    start, was, turn = empty - slot, signature.copy(), 0
    while len(start):  # an empty bin takes the value of a bin drawn by its own number, until that one is full
        turn += 1
        taken = was[start + drawn(size, turn)[slot]]
        good = taken != EMPTY
        signature[start[good] + slot[good]] = common.mix(taken[good] + np.uint64(turn))
        start, slot = start[~good], slot[~good]
    parts = signature.reshape(n, bands, rows)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (n, bands)).copy()
    for k in range(rows):
        keys += parts[:, :, k] * common.powers(0xD6E8FEB86659FD93, rows + 1)[k + 1]
    return common.mix(keys)


def send_lines(bits: int):
    def run(keys, table):
        _, _, distinct, _ = lines_of(groups.rows_of(table).column("text").combine_chunks())
        hashes, checks = line_hashes(distinct)
        order = np.argsort(hashes, kind="stable")
        return groups.messages(keys[0].as_py(), bits, hashes[order], checks[order])

    return run


def firsts(distinct: pa.Array, told: pa.Table) -> np.ndarray:
    """Which distinct lines of a group no smaller group has."""
    return ~groups.member(*line_hashes(distinct), told)


def send_bands(bits: int, bands: int, rows: int):
    def run(keys, table, told):
        _, _, distinct, _ = lines_of(groups.rows_of(table).column("text").combine_chunks())
        mine = np.flatnonzero(firsts(distinct, told))
        batch, found = pa.RecordBatch.from_arrays([distinct.take(pa.array(mine))], ["text"]), []
        for part in common.slices(batch, most=1 << 18):  # arrays hold eight bytes or more for each character
            found.append(line_bands(part.column("text"), bands, rows))
        hashes = np.concatenate(found).ravel() if found else np.zeros(0, np.uint64)
        number = np.repeat(mine.astype(np.uint32), bands)
        order = np.argsort(hashes, kind="stable")
        return groups.messages(keys[0].as_py(), bits, hashes[order], number[order])

    return run


def shared_bands(keys, table):
    """Of a bucket's (band key, line) messages: tells each group which of its lines share a band with another line.

    What is told is a hash of all lines that have the band key: bands that the same lines share are one key of candidates.
    """
    of, hashes, number = groups.gathered(table, np.uint32)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    same = hashes[1:] == hashes[:-1]
    some = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(hashes) else np.zeros(0, bool)
    of, hashes, number = of[order][some], hashes[some], number[order][some]
    if len(hashes):
        starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        names = common.mix(np.add.reduceat(common.mix(of.astype(np.uint64) << np.uint64(32) | number), starts))
        hashes = np.repeat(names, np.diff(starts, append=len(hashes)))
    return groups.replies(of, hashes, number)


def candidates(keys, table, told):
    """(node, line, size, keys) of the lines of a group that share a band; node: group and number of the line; size: its shingles; keys: distinct."""
    if not told.num_rows:
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.string()), pa.array([], pa.int64()), pa.array([], pa.list_(pa.int64()))], ["node", "line", "size", "keys"])
    _, _, distinct, _ = lines_of(groups.rows_of(table).column("text").combine_chunks())
    _, hashes, number = groups.gathered(told, np.uint32)
    order = np.lexsort((hashes, number))
    number, hashes = number[order], hashes[order]
    new = np.concatenate([[True], (number[1:] != number[:-1]) | (hashes[1:] != hashes[:-1])])
    number, hashes = number[new], hashes[new]
    starts = np.flatnonzero(np.diff(number.astype(np.int64), prepend=-1))
    lists = pa.ListArray.from_arrays(pa.array([*starts, len(number)], pa.int32()), pa.array(hashes.view(np.int64)))
    nodes = (np.int64(keys[0].as_py()) << 32) + number[starts].astype(np.int64)
    lines = distinct.take(pa.array(number[starts].astype(np.int64)))
    sizes = [np.diff(line_sets(part.column("text"))[1]) for part in common.slices(pa.RecordBatch.from_arrays([lines], ["text"]), most=1 << 18)]
    return pa.table([pa.array(nodes), lines.cast(pa.string()), pa.array(np.concatenate(sizes)), lists], ["node", "line", "size", "keys"])


def line_sets(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each line in ascending order, and each line's bounds in them."""
    owner, found = line_shingles(lines.cast(pa.large_string()))
    cuts, sets = np.searchsorted(owner, np.arange(len(lines) + 1)).tolist(), [np.zeros(0, np.uint64)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        one = np.sort(found[a:b])
        sets.append(one[np.concatenate([[True], one[1:] != one[:-1]])])
    return np.concatenate(sets), np.cumsum([len(x) for x in sets])


def rebuild(keys, table, told):
    """Rows of a group without the lines that go; told: hashes that a smaller group has (kind 0), numbers of near copies (1)."""
    table = groups.rows_of(table)
    flat, bounds, distinct, number = lines_of(table.column("text").combine_chunks())
    kind = told.column("kind").to_numpy()
    keep = firsts(distinct, told.filter(pa.array(kind == 0)))
    near = told.filter(pa.array(kind == 1)).column("number").to_numpy()
    keep[near.astype(np.int64)] = False
    at = np.flatnonzero(number >= 0)
    stays = np.ones(len(number), bool)
    stays[at] = keep[number[at]]
    first = np.zeros(len(number), bool)
    first[at[np.unique(number[at], return_index=True)[1]]] = True
    stays[at] &= first[at]
    cuts = np.concatenate([[0], np.cumsum(stays)])[bounds]
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat.filter(pa.array(stays)).cast(pa.string())), "\n")
    text = pc.if_else(pc.is_null(table.column("text")), None, pa.chunked_array([text]))
    n_lines = np.where(pc.is_null(table.column("text")).to_numpy(), 0, np.diff(bounds))
    return pa.table([common.loose(table.column("row")), text, pa.array(n_lines), pa.array(np.where(n_lines > 0, np.diff(bounds) - np.diff(cuts), 0))], ["row", "text", "n_lines", "n_removed"])


def deduplicated(docs: DataFrame, least: float = LEAST, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """All columns of docs, text without the lines that go, n_lines and n_removed (these two replace columns of their names)."""
    common.small_batches(docs.sparkSession)
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    base = docs.select(F.struct(*others).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    base, chars, _ = groups.grouped(base)
    by_group = groups.packed_rows(base).groupBy("grp")
    exact = common.written(by_group.applyInArrow(send_lines(groups.bucket_bits(chars // 300)), groups.MESSAGE).groupBy("bucket").applyInArrow(groups.later_groups(), groups.REPLY), "equal-lines")
    banded = by_group.cogroup(exact.groupBy("grp")).applyInArrow(send_bands(groups.bucket_bits(chars // 300 * bands), bands, rows), groups.MESSAGE)
    shared = banded.groupBy("bucket").applyInArrow(shared_bands, groups.REPLY)
    found = by_group.cogroup(shared.groupBy("grp")).applyInArrow(candidates, "node long, line string, size long, keys array<long>")
    found = common.written(found, "line-candidates")

    labels = linked(found.select(F.explode("keys").alias("key"), "node", "size"), found.select("node", F.col("line").alias("thing")), line_sets, least).filter("node <> root")
    near = labels.select(F.shiftright("node", 32).cast("int").alias("grp"), F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("payload"), F.col("node").bitwiseAND(F.lit((1 << 32) - 1)).alias("number"))
    told = exact.select("grp", F.lit(0).alias("kind"), "payload", F.lit(None).cast("long").alias("number")).unionByName(near)
    kind = base.schema["row"].dataType.simpleString()
    return by_group.cogroup(told.groupBy("grp")).applyInArrow(rebuild, f"row {kind}, text string, n_lines long, n_removed long").select("row.*", "text", "n_lines", "n_removed")


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(common.documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
