"""Documents dealt into groups that are ranges of doc_id, and packed messages between groups and hash buckets.

A group is some thousand documents, a bucket a range of 64-bit hashes. A group sends each bucket its distinct hashes
as one binary row, so the shuffle moves a few bytes for each hash, and a hash that a third of all documents share
counts once per group. Because groups are ranges of doc_id, "a document with a smaller id" in another group is just
"a smaller group"; ids need not travel.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Characters of text in a group, about; hashes in a bucket, about.
GROUP_CHARS, BUCKET_HASHES = 8 << 20, 1 << 20
#: Range borders that are looked up by their place; a wider table is cut evenly within them.
BORDERS = 4096

REPLY = "grp int, payload binary"
MESSAGE = "bucket int, grp int, payload binary"


def group_of(doc_id: Column, borders: list[int], parts: int, top: int) -> Column:
    """The group of an id: its range among borders (binary search), times parts, plus its place within the range."""
    if not borders:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in borders])
    steps = [1 << k for k in range(len(borders).bit_length() - 1, -1, -1)]
    place = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when((at + s <= len(borders)) & (F.get(table, at + s - 1) <= doc_id), at + s).otherwise(at))
    if parts > 1:
        low, high = F.get(table, place - 1), F.coalesce(F.get(table, place), F.lit(top + 1))
        inner = F.coalesce(F.least(F.floor((doc_id - low).cast("double") / (high - low).cast("double") * parts), F.lit(parts - 1)), F.lit(0))
        place = place * parts + F.greatest(inner, F.lit(0)).cast("int")
    return place.cast("int")


def grouped(docs: DataFrame, group_chars: int = GROUP_CHARS) -> tuple[DataFrame, int, int]:
    """docs with a column grp, the number of characters in all, and the first group of null ids.

    Groups are ranges of doc_id. Null ids come last, as they are not smaller than any other: they are dealt by their
    texts into as many groups as they fill.
    """
    sizes = docs.agg(F.count("doc_id").alias("n"), F.sum(F.length("text")).alias("chars"), F.sum(F.when(F.col("doc_id").isNull(), F.length("text"))).alias("loose"), F.min("doc_id").alias("low"), F.max("doc_id").alias("top")).first()
    chars, loose = sizes["chars"] or 0, sizes["loose"] or 0
    count = max(1, -(-chars // group_chars))
    borders: list[int] = []
    if count > 1 and sizes["n"]:
        coarse = min(count, BORDERS)
        shares = [k / coarse for k in range(1, coarse)]
        borders = sorted({sizes["low"], *docs.agg(F.percentile_approx("doc_id", shares, 10 * BORDERS).alias("b")).first()["b"]})
    parts = -(-count // BORDERS)
    last = (len(borders) + 1) * parts
    by_text = F.pmod(F.xxhash64("text"), F.lit(max(1, -(-loose // group_chars)))).cast("int") + last
    return docs.withColumn("grp", F.when(F.col("doc_id").isNull(), by_text).otherwise(group_of(F.col("doc_id"), borders, parts, sizes["top"] or 0))), chars, last


def bucket_bits(hashes: int, per_bucket: int = BUCKET_HASHES) -> int:
    """So many leading bits of a hash name its bucket."""
    return max(0, (max(1, hashes) // per_bucket)).bit_length()


def pack(sorted_hashes: np.ndarray, *more: np.ndarray) -> bytes:
    """Sorted 64-bit hashes as differences, and further columns, all by byte planes: zero bytes lie together."""
    first = np.diff(sorted_hashes, prepend=np.uint64(0))
    planes = [np.int64(len(first)).tobytes()]
    for column in (first, *more):
        planes.append(np.ascontiguousarray(column).view(np.uint8).reshape(len(first), -1).T.tobytes())
    return b"".join(planes)


def unpack(payload, *kinds: type) -> list[np.ndarray]:
    data = np.frombuffer(payload, np.uint8)
    n, at, out = int(data[:8].view(np.int64)[0]), 8, []
    for kind in (np.uint64, *kinds):
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(data[at : at + n * size].reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def messages(group: int, bits: int, hashes: np.ndarray, *more: np.ndarray) -> pa.Table:
    """Rows (bucket, grp, payload) for a group's hashes, which must be sorted."""
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    starts, ends = np.concatenate([[0], cuts]).astype(int), np.concatenate([cuts, [len(hashes)]]).astype(int)
    if not len(hashes):
        starts = ends = np.zeros(0, int)
    rows = [pack(hashes[a:b], *[x[a:b] for x in more]) for a, b in zip(starts, ends)]
    return pa.table([pa.array(bucket[starts], pa.int32()), pa.array([group] * len(rows), pa.int32()), pa.array(rows, pa.binary())], ["bucket", "grp", "payload"])


def gathered(table: pa.Table, *kinds: type) -> list[np.ndarray]:
    """All messages of a bucket (or replies of a group): their groups, hashes and further columns, one after the other."""
    parts = [unpack(x.as_buffer(), *kinds) for x in table.column("payload")]
    sizes = [len(p[0]) for p in parts]
    columns = [np.concatenate(c) if parts else np.zeros(0, k) for c, k in zip(zip(*parts) if parts else [()] * (1 + len(kinds)), (np.uint64, *kinds))]
    return [np.repeat(table.column("grp").to_numpy().astype(np.int64), sizes), *columns]


def later_groups(last: int | None = None):
    """Of the messages (hash, 32-bit check) of a bucket: tells each group which of its hashes a smaller group has, too.

    With ``last`` all groups from there on count as one: none of them is smaller than another.
    """

    def run(keys, table):
        groups, hashes, checks = gathered(table, np.uint32)
        order = np.lexsort((groups, checks, hashes))
        groups, hashes, checks = groups[order], hashes[order], checks[order]
        same = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (checks[1:] == checks[:-1])]) if len(hashes) else np.zeros(0, bool)
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(same)))) if len(same) else np.zeros(0, int)
        rank = groups if last is None else np.minimum(groups, last)
        later = rank > rank[first]
        return replies(groups[later], hashes[later], checks[later])

    return run


def replies(groups: np.ndarray, hashes: np.ndarray, *more: np.ndarray) -> pa.Table:
    """Rows (grp, payload), one per group; hashes ascend within a group."""
    order = np.lexsort((hashes, groups))
    groups, hashes = groups[order], hashes[order]
    cuts = np.flatnonzero(np.diff(groups)) + 1
    ends = [*cuts, len(groups)] if len(groups) else []
    rows = [(int(groups[a]), pack(hashes[a:b], *[x[order][a:b] for x in more])) for a, b in zip([0, *cuts], ends)]
    return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["grp", "payload"])


def member(values: np.ndarray, checks: np.ndarray, told: pa.Table) -> np.ndarray:
    """Which hashes with their checks are among those of replies."""
    _, among, other = gathered(told, np.uint32)
    found = np.zeros(len(values), bool)
    if not len(among):
        return found
    order = np.argsort(among, kind="stable")
    among, other = among[order], other[order]
    at = np.searchsorted(among, values)
    while len(open_ := np.flatnonzero(~found & (at < len(among)) & (among[np.minimum(at, len(among) - 1)] == values))):
        found[open_] = other[at[open_]] == checks[open_]
        at[open_] += 1
    return found


#: UTF-8 bytes of text that a task collects before it packs them by group.
PACK_BYTES = 16 << 20


def packed_rows(df: DataFrame) -> DataFrame:
    """Rows of df (with grp and text) as compressed Arrow data, (grp, rows): what a shuffle by grp has to move."""

    def flush(parts):
        table = pa.Table.from_batches(parts).sort_by("grp").combine_chunks()
        grp = table.column("grp").to_numpy()
        cuts = np.flatnonzero(np.diff(grp)) + 1
        names, blobs = [], []
        for a, b in zip([0, *cuts], [*cuts, len(grp)]):
            sink = pa.BufferOutputStream()
            own = table.slice(a, b - a).drop_columns(["grp"])
            with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(own)
            names.append(int(grp[a]))
            blobs.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["grp", "rows"])

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            for part in slices(batch):
                parts.append(part)
                size += part.nbytes if part.num_rows == batch.num_rows else batch.nbytes * part.num_rows // batch.num_rows
                if size > PACK_BYTES:
                    yield flush(parts)
                    parts, size = [], 0
        if parts:
            yield flush(parts)

    return df.mapInArrow(run, "grp int, rows binary")


def rows_of(table: pa.Table) -> pa.Table:
    """The rows of a group, by doc_id (null last) and text; other columns do not matter for their order."""
    pa.default_memory_pool().release_unused()  # what the group before has left
    parts = [pa.ipc.open_stream(x.as_buffer()).read_all() for x in table.column("rows")]
    return pa.concat_tables(parts).sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
