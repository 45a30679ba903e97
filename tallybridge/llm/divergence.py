"""Source divergence audit with late string materialisation.

For each language the terms of at least LEAST documents are kept; each source's distribution over them is compared with
every other source's (part ``pair``) and, term by term, with the language's (part ``term``).

Text is read once. A task turns its documents into rows (lang, source, term digest, occurrences, documents), summed over
up to HELD rows before they leave it, and writes its distinct (digest, term) pairs to a table on the side that is not
shuffled. Shuffles move 64-bit digests only: documents of a digest decide what is kept, and all figures come from digests.

Strings come back late. The side table is cut down to kept digests (a bounded bit map drops most others before the
shuffle, the join drops the rest), and each digest's smallest and largest string are taken: where they differ, different
terms share a digest, and the terms of that digest are counted by their strings, from the texts of documents that have it.
A kept term's text then joins its rows only where a rank needs it: rows that may be among the first TOP of a group.

Pair values are summed over buckets of terms: a bucket of a language is a small matrix (terms by sources), whatever
the number of documents; its sums of differences are added up in Spark. Everything is whole numbers. The matrix and the
result grow with the square of a language's sources, as every two sources are compared.

Cases: null text, language and source are ''. Groups without terms have count 0 for each kept term. A language without
kept terms has pairs with value 0 and no terms. Repeated rows count as often as they occur. Ties in value go to the
smaller item by UTF-8 bytes. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

LEAST, TOP, SCALE, PRIOR = 30, 50, 1_000_000_000, 5
#: Rows that a task holds before it sums them up, and bits of the map that kept digests leave in (2 MB).
HELD, MAP_BITS = 1 << 20, 24
#: Terms of a language in a bucket, about.
BUCKET = 2048

# Bytes of a term are letters and all beyond ASCII; A-Z are lower-cased, all others separate.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: pa.Array) -> pa.Array:
    """Texts with only terms left, lower-cased, between single or several spaces."""
    text = pc.fill_null(text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text, "").cast(pa.large_string())
    _, offsets, data = text.buffers()
    return pa.Array.from_buffers(pa.large_string(), len(text), [None, offsets, pa.py_buffer((data.to_pybytes() if data else b"").translate(LETTERS))], offset=text.offset)


def digests(values: pa.Array, bits: int) -> np.ndarray:
    """The leading ``bits`` bits of a 64-bit hash of each value."""
    return (common.hashes(values, 13) >> np.uint64(64 - bits)).view(np.int64)


def summed(columns: list[np.ndarray], keys: int) -> list[np.ndarray]:
    """Rows with equal first ``keys`` columns as one, the others added up."""
    order = np.lexsort(columns[:keys][::-1])
    columns = [c[order] for c in columns]
    new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns[:keys]], axis=0)]) if len(order) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return [c[at] for c in columns[:keys]] + [np.add.reduceat(c, at) if len(at) else c for c in columns[keys:]]


COUNTS = "lang string, source string, digest long, count long, docs long, term string"


def counted(docs: DataFrame, bits: int) -> DataFrame:
    """Rows (lang, source, digest, count, docs) and, with null lang and source, rows (digest, term), as tasks give them."""

    def run(batches):
        groups: dict[tuple[str, str], int] = {}
        held: list[list[np.ndarray]] = [[], [], [], []]
        told = np.zeros(0, np.uint64)

        def flush():
            rows = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in held]
            for c in held:
                c.clear()
            of, digest, count, n = summed(rows, 2)
            for c, values in zip(held, (of, digest, count, n)):
                c.append(values)

        def leave():
            flush()
            of, digest, count, n = (c.pop() for c in held)
            names = list(groups)
            for a in range(0, len(of), 1 << 16):
                part = slice(a, a + (1 << 16))
                lang, source = (pa.array([g[k] for g in names]).take(pa.array(of[part])) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([lang, source, pa.array(digest[part]), pa.array(count[part]), pa.array(n[part]), pa.nulls(len(lang), pa.string())], NAMES)

        for batch in batches:
            for part in common.slices(batch):
                codes, words, bounds = common.split_words(terms(part.column("text")))
                own = digests(words, bits)
                group = np.array([groups.setdefault(g, len(groups)) for g in zip(part.column("lang").to_pylist(), part.column("source").to_pylist())], np.int64)
                if not len(codes):
                    continue
                pairs, times = np.unique(common.owners(bounds) * len(words) + codes, return_counts=True)
                doc, digest = pairs // len(words), own[pairs % len(words)]
                if len(np.unique(own)) < len(own):
                    doc, digest, times = summed([doc, digest, times], 2)  # terms of one digest count a document once
                for c, values in zip(held, summed([group[doc], digest, times, np.ones(len(doc), np.int64)], 2)):
                    c.append(values)
                strings = common.hashes(words, 29)  # not the digest: another term with it is told, too
                fresh = np.flatnonzero(~np.isin(strings, told))
                told = np.concatenate([told if len(told) < HELD else told[:0], strings[fresh]])
                if len(fresh):
                    none = pa.nulls(len(fresh), pa.string())
                    zero = pa.array(np.zeros(len(fresh), np.int64))
                    yield pa.RecordBatch.from_arrays([none, none, pa.array(own[fresh]), zero, zero, words.take(pa.array(fresh)).cast(pa.string())], NAMES)
                if sum(map(len, held[0])) > HELD:
                    flush()
                    if len(held[0][0]) > HELD // 2:
                        yield from leave()
        if held[0]:
            yield from leave()

    return docs.mapInArrow(run, COUNTS)


NAMES = ["lang", "source", "digest", "count", "docs", "term"]


def bit_map(kept: DataFrame) -> bytes:
    """A map of MAP_BITS bits with those of kept digests set: of one size for any number of digests."""
    place = F.pmod("digest", F.lit(1 << MAP_BITS))
    words = kept.groupBy(F.floor(place / 64).cast("int").alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(digest, {1 << MAP_BITS}) % 64 AS int))")).alias("bits")).toArrow()
    table = np.zeros(1 << (MAP_BITS - 6), np.int64)
    table[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return table.tobytes()


def texts_of(side: DataFrame, kept: DataFrame) -> DataFrame:
    """(digest, low, high): the smallest and largest string of each kept digest."""
    known = side.sparkSession.sparkContext.broadcast(bit_map(kept.select("digest").distinct()))

    def run(batches):
        bits = np.unpackbits(np.frombuffer(known.value, np.uint8), bitorder="little")
        for batch in batches:
            yield batch.filter(pa.array(bits[batch.column("digest").to_numpy() & ((1 << MAP_BITS) - 1)].astype(bool)))

    some = side.mapInArrow(run, "digest long, term string").groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high"))
    return some.join(kept.select("digest").distinct(), "digest", "left_semi")


def recounted(docs: DataFrame, mixed: DataFrame, bits: int) -> DataFrame:
    """(lang, source, digest, term, count, docs) of the terms of digests that several terms share, by their strings."""

    def run(batches):
        for batch in batches:
            for part in common.slices(batch):
                codes, words, bounds = common.split_words(terms(part.column("text")))
                if not len(codes):
                    continue
                pairs, times = np.unique(common.owners(bounds) * len(words) + codes, return_counts=True)
                doc, code = pa.array(pairs // len(words)), pairs % len(words)
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang").take(doc), part.column("source").take(doc), pa.array(digests(words, bits)[code]), words.take(pa.array(code)).cast(pa.string()), pa.array(times)], ["lang", "source", "digest", "term", "count"]
                )

    rows = docs.mapInArrow(run, "lang string, source string, digest long, term string, count long")
    return rows.join(mixed, "digest", "left_semi").groupBy("lang", "source", "digest", "term").agg(F.sum("count").alias("count"), F.count("*").alias("docs"))


def probability(count: str, total: str, terms_: str = "n_terms") -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exactly."""
    return F.expr(f"1 + (cast({SCALE} AS decimal(10,0)) * cast({count} + {PRIOR} AS decimal(19,0))) div (cast({total} AS decimal(19,0)) + {PRIOR} * cast({terms_} AS decimal(17,0)))")


def pair_sums(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): sums of differences of each two sources of a language, over buckets of its terms."""

    def run(keys, own, there):
        names = there.column("source").to_pylist()
        place = {s: k for k, s in enumerate(names)}
        term, at = np.unique(own.column("digest").to_numpy(), return_inverse=True)
        if own.column("term").null_count < own.num_rows:  # digests that several terms share
            term, at = np.unique([f"{d}:{t or ''}" for d, t in zip(own.column("digest").to_pylist(), own.column("term").to_pylist())], return_inverse=True)
        sums = np.zeros((len(names), len(names)), np.int64)
        p = np.repeat(there.column("p_none").to_numpy().astype(np.int64)[:, None], len(term), axis=1)
        if own.num_rows:
            p[[place[s] for s in own.column("source").to_pylist()], at] = own.column("p").to_numpy()
        for k in range(len(names)):
            sums[k] = np.abs(p - p[k]).sum(1)
        a, b = np.nonzero(~np.eye(len(names), dtype=bool))
        source = pa.array(names, pa.string())
        return pa.table([pa.array([keys[0].as_py()] * len(a), pa.string()), source.take(pa.array(a)), source.take(pa.array(b)), pa.array(sums[a, b])], ["lang", "source", "item", "value"])

    groups = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)))
    both = rows.groupBy("lang", "bucket").cogroup(groups.groupBy("lang", "bucket"))
    sums = both.applyInArrow(run, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, bits: int = 64) -> DataFrame:
    """lang, source, part, item, value, rank. bits: of a digest; fewer make more terms share one, the result stays the same."""
    common.small_batches(docs.sparkSession)
    docs = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])
    whole = common.written(counted(docs, bits), "term-counts")
    side = whole.filter("term IS NOT NULL").select("digest", "term")
    counts = whole.filter("term IS NULL").groupBy("lang", "source", "digest").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    counts = common.written(counts, "digest-counts")
    kept = common.written(counts.groupBy("lang", "digest").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least).select("lang", "digest"), "kept-digests")

    texts = common.written(texts_of(side, kept), "kept-texts")
    rows = counts.join(kept, ["lang", "digest"], "left_semi").select("lang", "source", "digest", F.lit(None).cast("string").alias("term"), "count")
    mixed = texts.filter("low <> high").select("digest")
    if not mixed.isEmpty():
        again = common.written(recounted(docs, mixed, bits), "recounted-terms")
        enough = again.groupBy("lang", "digest", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least).drop("docs")
        again = again.join(enough, ["lang", "digest", "term"], "left_semi").select("lang", "source", "digest", "term", "count")
        rows = rows.join(mixed, "digest", "left_anti").select(*again.columns).unionByName(again)
    term_totals = rows.groupBy("lang", "digest", "term").agg(F.sum("count").alias("lang_count"))
    rows = common.written(rows, "kept-counts")
    term_totals = common.written(term_totals, "kept-terms")

    groups = docs.select("lang", "source").distinct()
    langs = groups.select("lang").distinct().join(term_totals.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("lang_count").alias("lang_total")), "lang", "left").fillna(0)
    sizes = rows.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = groups.join(sizes, ["lang", "source"], "left").fillna(0, "total").join(langs, "lang")
    groups = groups.withColumns({"p_none": F.when(F.col("n_terms") > 0, probability("0", "total")).otherwise(F.lit(0)), "buckets": F.ceil(F.greatest("n_terms", F.lit(1)) / BUCKET).cast("int")})
    groups = common.written(groups, "groups")

    shown = rows.join(groups, ["lang", "source"]).withColumn("p", probability("count", "total"))
    bucketed = shown.select("lang", "source", F.pmod(F.xxhash64("digest"), "buckets").cast("int").alias("bucket"), "digest", "term", "p")
    pairs = pair_sums(bucketed, groups.select("lang", "source", "p_none", "buckets"))
    group = W.partitionBy("lang", "source")
    pairs = pairs.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "item"))).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")

    above = shown.select("lang", "source", "digest", F.coalesce("term", F.lit("")).alias("own"), "p", "n_terms", "lang_total").join(term_totals.select("lang", "digest", F.coalesce("term", F.lit("")).alias("own"), "lang_count"), ["lang", "digest", "own"])
    above = above.withColumn("value", F.col("p") - probability("lang_count", "lang_total")).filter("value > 0")
    near = above.withColumn("place", F.rank().over(group.orderBy(F.desc("value")))).filter(F.col("place") <= top)
    named = near.join(texts.select("digest", "low"), "digest").withColumn("item", F.when(F.col("own") == "", F.col("low")).otherwise(F.col("own")))
    named = named.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "item"))).filter(F.col("rank") <= top)
    return pairs.unionByName(named.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(common.documents(spark, sf_dir))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def oracle(table: str = "documents", least: int = LEAST, top: int = TOP) -> str:
    p = lambda count, total: f"1 + ({SCALE}::HUGEINT * ({count} + {PRIOR})) // ({total} + {PRIOR} * n_terms)"
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS row, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM {table}),
    t AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    k AS (SELECT lang, term, count(*)::HUGEINT AS lang_count FROM t GROUP BY ALL HAVING count(DISTINCT row) >= {least}),
    v AS (SELECT l.lang, count(term) AS n_terms, coalesce(sum(lang_count), 0)::HUGEINT AS lang_total FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN k ON l.lang = k.lang GROUP BY ALL),
    g AS (SELECT DISTINCT lang, source FROM d),
    c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
    a AS (SELECT g.lang, g.source, k.term, coalesce(n, 0)::HUGEINT AS n, lang_count FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    s AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM a GROUP BY ALL),
    p AS (SELECT a.lang, a.source, term, n, {p('n', 'total')} AS p, {p('lang_count', 'lang_total')} AS q FROM a JOIN s ON a.lang = s.lang AND a.source = s.source JOIN v ON a.lang = v.lang),
    f AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
    pair AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source),
    term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
    r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
    SELECT * FROM r WHERE part = 'pair' OR rank <= {top}"""


ORACLE = oracle()
