"""Substring dedup: repeated windows of a fixed number of words, merged into maximal removal intervals.

Every window of every document gets a Rabin-Karp hash over its words' hashes. Groups of documents (ranges of doc_id)
send their distinct window hashes to hash buckets; a bucket counts each hash's groups and tells all but the smallest.
A group then hashes its windows again: a window goes where a smaller group has it, or a smaller doc_id in the group.
The words that such windows cover are maximal intervals, and are removed.

Two windows are the same if 96 bits of two independent rolling hashes are: among n windows some pair of different
ones is taken for equal with probability about n^2 / 2^97.

Cases: null and empty texts have no words. Rows of the same doc_id do not remove each other's windows; a null doc_id
is larger than all others and not smaller than another null. Windows are judged on the input. Other columns of
docs are not touched.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common, groups

WIDTH = 50
#: The second rolling hash, of which a window sends 32 bits.
CHECK_BASE = 0xC2B2AE3D27D4EB4F
LAST = np.iinfo(np.int64).max


def text_windows(text: pa.Array, width: int):
    """Slices of texts as (first text, words' bounds, window starts, hashes, checks, distinct words, codes)."""
    batch = pa.RecordBatch.from_arrays([text], ["text"])
    at = 0
    for part in common.slices(batch):
        codes, distinct, bounds = common.split_words(part.column("text"))
        values = common.hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
        starts, found = common.windows(values, bounds, width)
        _, second = common.windows(values, bounds, width, CHECK_BASE)
        yield at, bounds, starts, found, (second >> np.uint64(32)).astype(np.uint32), distinct, codes
        at += part.num_rows


def send(width: int, bits: int):
    def run(keys, table):
        parts = [(found, checks) for _, _, _, found, checks, _, _ in text_windows(groups.rows_of(table).column("text").combine_chunks(), width)]
        hashes, checks = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        order = np.argsort(hashes, kind="stable")
        hashes, checks = hashes[order], checks[order]
        fresh = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1])]) if len(hashes) else np.zeros(0, bool)
        return groups.messages(keys[0].as_py(), bits, hashes[fresh], checks[fresh])

    return run


def remove(width: int):
    def run(keys, table, told):
        table = groups.rows_of(table)
        ids = table.column("doc_id").combine_chunks().cast(pa.int64())
        doc_ids = ids.fill_null(LAST).to_numpy()
        parts = list(text_windows(table.column("text").combine_chunks(), width))
        hashes, checks = (np.concatenate([p[k] for p in parts]) for k in (3, 4))
        owner = np.concatenate([doc_ids[p[0] + np.searchsorted(p[1], p[2], side="right") - 1] for p in parts])
        gone = groups.member(hashes, checks, told)
        order = np.lexsort((checks, hashes))
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(hashes[order]) != 0) | (np.diff(checks[order]) != 0)])) if len(hashes) else np.zeros(0, int)
        if len(hashes):
            least = np.minimum.reduceat(owner[order], starts)
            gone[order] |= owner[order] > np.repeat(least, np.diff([*starts, len(hashes)]))
        n_words, n_removed, spans, kept, at = [], [], [], [], 0
        for _, bounds, begins, found, _, distinct, codes in parts:
            mine = begins[gone[at : at + len(begins)]]
            at += len(begins)
            edges = np.zeros(len(codes) + 1, np.int64)
            np.add.at(edges, mine, 1)
            np.add.at(edges, mine + width, -1)
            out = np.cumsum(edges[:-1]) > 0
            words = np.array(distinct.to_pylist(), object)[codes] if len(codes) else np.zeros(0, object)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                own = out[a:b]
                n_words.append(b - a)
                n_removed.append(int(own.sum()))
                steps = np.diff(own.astype(np.int8), prepend=0, append=0)
                spans.append([{"first": int(x), "last": int(y)} for x, y in zip(np.flatnonzero(steps == 1), np.flatnonzero(steps == -1))] if n_removed[-1] else [])
                kept.append(b" ".join((words[a:b][~own] if n_removed[-1] else words[a:b]).tolist()).decode())
        span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        return pa.table([ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.string()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in kept], pa.string())], ["doc_id", "n_words", "n_removed", "spans", "kept", "kept_sha256"])

    return run


def deduplicated(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, spans (words first to last, last excluded), kept (the words left) and its sha256."""
    common.small_batches(docs.sparkSession)
    base, chars, last = groups.grouped(docs.select("doc_id", "text"))
    by_group = groups.packed_rows(base).groupBy("grp")
    sent = by_group.applyInArrow(send(width, groups.bucket_bits(chars // 6)), groups.MESSAGE)
    told = sent.groupBy("bucket").applyInArrow(groups.later_groups(last), groups.REPLY)
    schema = "doc_id long, n_words long, n_removed long, spans array<struct<first: int, last: int>>, kept string, kept_sha256 string"
    return by_group.cogroup(told.groupBy("grp")).applyInArrow(remove(width), schema)


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(common.documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE = f"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - {WIDTH} + 2)) AS pos,
    unnest(list_transform(range(1, len(w) - {WIDTH} + 2), lambda i: md5(array_to_string(w[i:i + {WIDTH} - 1], ' ')))) AS x
  FROM words WHERE len(w) >= {WIDTH}),
firsts AS (SELECT x, min(doc_id) AS first FROM windows GROUP BY x HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(pos, pos + {WIDTH})))) AS p
  FROM windows JOIN firsts USING (x) WHERE doc_id > first GROUP BY doc_id),
left_over AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(p), 0)::BIGINT AS n_removed,
    CASE WHEN p IS NULL THEN w ELSE list_filter(w, lambda v, i: NOT list_contains(p, i)) END AS kept
  FROM words LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM left_over
"""
