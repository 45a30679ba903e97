"""Quality rule: how much of a text its maximal repeated substrings cover.

A generalised suffix array over the words of many texts is built by prefix doubling (only suffixes whose
prefix is not unique yet go on). The longest common prefix of neighbours comes from the ranks of each
doubling. A suffix's deepest LCP interval is as long as the larger of its two neighbouring LCP values, so
the union of the spans of all maximal repeats of at least ``min_repeat`` words is the union of
[p, p + longest[p]) over the positions p where longest[p] >= min_repeat.

Cases: a null or empty text has no words, fails the base rule and is not kept. Equal words in different
texts never match. Repeated rows are judged one by one. Other input columns are not touched or returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Production parameters.
MIN_REPEAT, MAX_COVERED, MAX_LONGEST = 8, 0.3, 100

SYMBOLS = "[#*$%&|<>]"
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_covered long, longest_repeat long, spans array<struct<first: int, last: int>>"
)


def longest_repeats(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each word position, the length of the longest run from there that starts elsewhere in its text too."""
    n = len(codes)
    if n < 2:
        return np.zeros(n, np.int64)
    texts = common.owners(bounds)
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
    keys = texts * (int(codes.max()) + 1) + codes
    order = np.argsort(keys, kind="stable")
    first = np.concatenate([[True], np.diff(keys[order]) != 0])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    levels, width = [rank.astype(np.int32)], 1
    slots = open_slots(first)
    while len(slots):
        active = order[slots]
        after = np.where(left[active] > width, rank[np.minimum(active + width, n - 1)] + 1, 0)
        keys = rank[active] * (n + 1) + after
        inner = np.argsort(keys, kind="stable")
        order[slots] = active = active[inner]
        fresh = np.concatenate([[True], np.diff(keys[inner]) != 0])
        rank = rank.copy()
        rank[active] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        levels.append(rank.astype(np.int32))
        first[slots] = fresh
        width *= 2
        slots = slots[open_slots(fresh)]
    common_prefix = np.zeros(n + 1, np.int64)
    near = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b, at = order[near - 1], order[near], np.zeros(len(near), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + at, b + at
        inside = (at < left[a]) & (at < left[b])
        same = inside & (levels[level][np.minimum(x, n - 1)] == levels[level][np.minimum(y, n - 1)])
        at += same * (1 << level)
    common_prefix[near] = at
    longest = np.empty(n, np.int64)
    longest[order] = np.maximum(common_prefix[:-1], common_prefix[1:])
    return longest


def open_slots(first: np.ndarray) -> np.ndarray:
    """The slots of groups of two or more, where ``first`` marks each group's first slot."""
    alone = first & np.concatenate([first[1:], [True]])
    return np.flatnonzero(~alone)


def covered(longest: np.ndarray, least: int, width: int | None = None) -> np.ndarray:
    """Marks the words in [p, p + longest[p]) (or [p, p + width)) of every p with longest[p] >= least."""
    at = np.flatnonzero(longest >= least)
    edges = np.zeros(len(longest) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + (longest[at] if width is None else width), -1)
    return np.cumsum(edges[:-1]) > 0


def repeated_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def judge(batch: pa.RecordBatch, min_repeat: int, max_covered: float, max_longest: int) -> pa.RecordBatch:
    codes, distinct, bounds = common.split_words(batch.column("text"))
    words = distinct.cast(pa.large_string())
    of_word = lambda x: common.per_text(x.to_numpy(zero_copy_only=False).astype(np.int64)[codes], bounds)
    n_words, longest = np.diff(bounds), longest_repeats(codes, bounds)
    n_repeat = common.per_text(covered(longest, 3, 3), bounds)
    inside = covered(longest, min_repeat)
    n_inside = common.per_text(inside, bounds)
    most = np.zeros(len(n_words), np.int64)
    if len(codes):
        np.maximum.at(most, common.owners(bounds), longest)
    failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    kept = ~failed & (n_inside <= max_covered * n_words) & (most <= max_longest)
    starts = inside & ~np.concatenate([[False], inside[:-1]])
    starts[bounds[:-1][n_words > 0]] = inside[bounds[:-1][n_words > 0]]
    ends = inside & ~np.concatenate([inside[1:], [False]])
    ends[bounds[1:][n_words > 0] - 1] = inside[bounds[1:][n_words > 0] - 1]
    a, b = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    base = bounds[np.searchsorted(bounds, a, side="right") - 1]
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(a, bounds), pa.int32()),
        pa.StructArray.from_arrays([pa.array(a - base, pa.int32()), pa.array(b - base, pa.int32())], ["first", "last"]),
    )
    columns = [
        batch.column("doc_id").cast(pa.int64()), n_words, of_word(pc.utf8_length(words)), of_word(pc.count_substring_regex(words, SYMBOLS)),
        np.array([repeated_lines(x) for x in batch.column("text").to_pylist()], np.int64), n_repeat, failed, kept, n_inside, most, spans,
    ]
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered", "longest_repeat", "spans"]
    return pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, np.ndarray) else x for x in columns], names)


def repetition(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """Judges each text: one row per row of docs, with the spans of its maximal repeats (in words, last excluded).

    kept: the base rule holds, maximal repeats of min_repeat words or more cover at most the share
    max_covered of the words, and the longest has at most max_longest words.
    """
    common.small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in common.slices(batch):
                yield judge(part, min_repeat, max_covered, max_longest)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repetition(common.documents(spark, sf_dir))
    return out.withColumn("too_long", F.col("longest_repeat") > MAX_LONGEST).drop("spans", "longest_repeat")


def _windows(width: str, name: str) -> str:
    return f"""{name} AS (
      SELECT doc_id, unnest(list(pos)) AS pos, count(*) AS times FROM (
        SELECT doc_id, unnest(range(1, len(w) - {width} + 2)) AS pos,
          unnest(list_transform(range(1, len(w) - {width} + 2), lambda i: md5(array_to_string(w[i:i + {width} - 1], ' ')))) AS x
        FROM words WHERE len(w) >= {width})
      GROUP BY doc_id, x HAVING count(*) > 1)"""


def _covered(name: str, width: str) -> str:
    return f"""SELECT doc_id, count(DISTINCT p) AS n FROM (
      SELECT doc_id, unnest(range(pos, pos + {width})) AS p FROM {name} WHERE times > 1) GROUP BY doc_id"""


#: Repeats of k or more words cover what repeated k-word windows cover; a longest repeat over k shows as a repeated window of k + 1.
ORACLE = f"""
WITH words AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
{_windows("3", "w3")}, {_windows(str(MIN_REPEAT), "wm")}, {_windows(str(MAX_LONGEST + 1), "wl")},
c3 AS ({_covered("w3", "3")}), cm AS ({_covered("wm", str(MIN_REPEAT))}),
cl AS (SELECT DISTINCT doc_id FROM wl WHERE times > 1),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
dup AS (SELECT doc_id, sum(n - 1) AS n FROM (
  SELECT doc_id, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY ALL) GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(c3.n, 0)::BIGINT AS n_repeat_words, coalesce(cm.n, 0)::BIGINT AS n_covered,
    cl.doc_id IS NOT NULL AS too_long
  FROM words LEFT JOIN dup USING (doc_id) LEFT JOIN c3 USING (doc_id) LEFT JOIN cm USING (doc_id) LEFT JOIN cl USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_covered <= {MAX_COVERED}::DOUBLE * n_words AND NOT too_long AS kept,
  n_covered, too_long
FROM base
"""
