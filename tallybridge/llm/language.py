"""Language identification by the nearest of several centroids per language.

A text is a vector over hashed character 2- and 3-grams (lower case; everything but letters is one space): term
frequencies 1 + ln(tf) times idf, divided by the length. Each language has up to ``clusters`` centroids, found by
spherical k-means over its training vectors. The language of the nearest centroid by cosine wins; a text whose best
cosine is below ``least`` or below that language's bound for texts of its length is rejected. Bounds are calibrated
on the sample: centroids of one half of it score the other half, whole and cut short, and a band of lengths (by
letters, doubling) gets MARGIN times the QUANTILE of those cosines. Bands with fewer than ENOUGH texts have no bound
but ``least``.

The model is fitted on a bounded sample of labelled rows: about SAMPLE per language, those whose id and text hash
lowest (equal rows count once), and MOST times as many at most.
k-means runs in one Spark task per language over that sample, and the model (languages x clusters x DIMENSIONS
floats) is bounded too. Prediction is a map over all rows.

Cases: a null text or one without a letter is ``und`` with score 0 and is rejected. Without any training row, every
text is. Ties of cosines go to the language that sorts first. Rows with a null lang or text teach nothing. In
op4_language rows with a null doc_id teach nothing either, and their held_out is null. Very long texts are taken whole; a text
with one n-gram more than 65,535 times teaches that count. Repeated rows and ids are predicted row by row. Other input
columns are carried only on request.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

DIMENSIONS, CLUSTERS, LEAST = 4096, 4, 0.05
#: Labelled rows per language that the model is fitted on, about.
SAMPLE, MOST = 1500, 2
#: Of the cosines of a language's own texts in a band of lengths, this share may lie below the bound over MARGIN.
QUANTILE, MARGIN, ENOUGH = 0.01, 0.75, 50
#: Bands are [EDGES[i], EDGES[i + 1]) letters; texts shorter than the first edge have no bound but ``least``.
EDGES = (16, 32, 64, 128, 256, 512, 1024)
#: Characters that a word n-gram ends at.
BLANK = 32


def grams(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams, one row per text, and each text's number of letters."""
    text = pc.fill_null(text, "")
    letters = pc.utf8_length(pc.replace_substring_regex(text, r"[^\p{L}]+", "")).to_numpy(zero_copy_only=False)
    plain = pc.binary_join_element_wise("", pc.replace_substring_regex(pc.utf8_lower(text), r"[^\p{L}]+", " "), "", " ")
    sizes = pc.utf8_length(plain).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = np.frombuffer("".join(plain.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.uint64)
    of = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros(len(sizes) * DIMENSIONS, np.int64)
    for width in (2, 3):
        if len(codes) < width:
            continue
        key = codes[: len(codes) - width + 1].copy()
        for k in range(1, width):
            key = key * np.uint64(0x110000) + codes[k : len(codes) - width + 1 + k]
        inside = of[: len(key)] == of[width - 1 :]
        slot = ((key + np.uint64(width)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - DIMENSIONS.bit_length() + 1)
        out += np.bincount((of[: len(key)] * DIMENSIONS + slot.astype(np.int64))[inside], minlength=len(out))
    return out.reshape(len(sizes), DIMENSIONS), letters


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.zeros(counts.shape, np.float32)
    np.log(counts, out=x, where=counts > 0, dtype=np.float32, casting="unsafe")
    x = (x + (counts > 0)) * idf.astype(np.float32)
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.maximum(length, 1e-12)[:, None]


def centroids(x: np.ndarray, clusters: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; the first centres are spread out by taking the farthest row each time."""
    centre = x.mean(0)
    chosen = [centre / max(np.linalg.norm(centre), 1e-12)]
    while len(chosen) < min(clusters, len(x)):
        chosen.append(x[np.argmin((x @ np.array(chosen).T).max(1))])
    chosen = np.array(chosen)
    for _ in range(rounds):
        near = (x @ chosen.T).argmax(1)
        for k in range(len(chosen)):
            if (mine := x[near == k]).size:
                centre = mine.sum(0)
                chosen[k] = centre / max(np.linalg.norm(centre), 1e-12)
    return chosen


def bands_of(letters: np.ndarray) -> np.ndarray:
    """Each text's band of lengths; 0 is below the first edge."""
    return np.searchsorted(EDGES, letters, side="right")


def calibrated(score: np.ndarray, band: np.ndarray) -> list[float]:
    """Each band's bound on the cosine, 0 where too few texts are in it."""
    bounds = [0.0] * (len(EDGES) + 1)
    for k in range(1, len(bounds)):
        mine = score[band == k]
        if len(mine) >= ENOUGH:
            bounds[k] = MARGIN * float(np.quantile(mine, QUANTILE))
    return bounds


def bounded_slices(batch: pa.RecordBatch):
    """Slices of few bytes and few rows: a row is DIMENSIONS counts."""
    for part in common.slices(batch, most=1 << 20):
        for a in range(0, part.num_rows, 512):
            yield part.slice(a, 512)


def sampled(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame | None:
    """(lang, text, half): about ``sample`` rows of each language, MOST times as many at most, whatever their ids; None without any row.

    Rows (doc_id, text, lang) are drawn by a hash of id and text; those that are alike draw alike and count once.
    """
    half = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text")), F.lit("half")), F.lit(2)).cast("int")
    rows = labelled.select("doc_id", "text", "lang", half.alias("half")).filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    share = F.create_map(*[F.lit(v) for k, n in sorted(sizes.items()) for v in (k, min(1.0, sample / n))])
    rows = rows.withColumn("drawn", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)).filter(F.col("drawn") < share[F.col("lang")])
    order = W.partitionBy("lang").orderBy("drawn", "doc_id", "text")
    return rows.dropDuplicates(["lang", "drawn", "doc_id", "text"]).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= MOST * sample).select("lang", "text", "half")


def fit(labelled: DataFrame, clusters: int = CLUSTERS, sample: int = SAMPLE) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Fits on a sample (doc_id, text, lang) of each language: the centroids' languages, centroids, idf, and bounds by band."""
    rows = sampled(labelled, sample)
    if rows is None:
        return [], np.zeros((0, DIMENSIONS), np.float32), np.ones(DIMENSIONS), np.zeros((0, len(EDGES) + 1))

    def count(batches):
        for batch in batches:
            for part in bounded_slices(batch):
                text, half = part.column("text"), part.column("half")
                yield packed(part.column("lang"), text, half)
                for edge in EDGES:  # what the second half scores when it is cut to about so many letters; half 2
                    most = edge * 5 // 4
                    cut = part.filter(pc.and_(pc.equal(half, 1), pc.greater(pc.utf8_length(text), most)))
                    yield packed(cut.column("lang"), pc.utf8_slice_codeunits(cut.column("text"), 0, most), pa.array(np.full(cut.num_rows, 2), pa.int32()))

    def packed(lang, text, half):
        counts, letters = grams(text)
        keep = np.flatnonzero(letters > 0)
        bags = [np.minimum(counts[k], 65535).astype(np.uint16).tobytes() for k in keep]
        return pa.RecordBatch.from_arrays([lang.take(pa.array(keep)), pa.array(bags, pa.binary()), pa.array(letters[keep], pa.int64()), half.take(pa.array(keep))], ["lang", "counts", "letters", "half"])

    picked = common.written(rows.mapInArrow(count, "lang string, counts binary, letters long, half int"), "language-sample")

    def frequencies(batches):  # texts in all as slot -1
        seen = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in batches:
            for row in batch.column("counts"):
                seen[1:] += np.frombuffer(row.as_buffer(), np.uint16) > 0
                seen[0] += 1
        slots = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(slots - 1, pa.int64()), pa.array(seen[slots])], ["slot", "texts"])

    sums = picked.filter("half < 2").mapInArrow(frequencies, "slot long, texts long").groupBy("slot").agg(F.sum("texts").alias("texts"))
    texts = {r["slot"]: r["texts"] for r in sums.collect()}  # DIMENSIONS + 1 rows at most
    n, seen = texts.get(-1, 0), np.array([texts.get(k, 0) for k in range(DIMENSIONS)])
    idf = np.log((1 + n) / (1 + seen)) + 0.1

    def cluster(key, table):
        half, letters = table.column("half").to_numpy(), table.column("letters").to_numpy()
        rows_at = lambda among: np.stack([np.frombuffer(row.as_buffer(), np.uint16) for row in table.column("counts").take(pa.array(among))])
        counts = rows_at(np.flatnonzero(half < 2))
        order = np.lexsort(counts.T[:8])
        x, first = vectors(counts[order], idf), (half[half < 2] == 0)[order]
        found, bounds = centroids(x, clusters), [0.0] * (len(EDGES) + 1)
        if first.any() and not first.all():
            centres, others = centroids(x[first], clusters), np.flatnonzero(half > 0)
            score = [(vectors(rows_at(others[a : a + 512]), idf) @ centres.T).max(1) for a in range(0, len(others), 512)]
            bounds = calibrated(np.concatenate(score), bands_of(letters[others]))
        kind = pa.schema([("lang", pa.string()), ("centroid", pa.list_(pa.float32())), ("bounds", pa.list_(pa.float64()))])
        return pa.table({"lang": [key[0].as_py()] * len(found), "centroid": [x.tolist() for x in found.astype(np.float32)], "bounds": [bounds] * len(found)}, schema=kind)

    found = picked.groupBy("lang").applyInArrow(cluster, "lang string, centroid array<float>, bounds array<double>").collect()
    found.sort(key=lambda r: r["lang"])
    bounds = np.array([r["bounds"] for r in found], np.float64).reshape(len(found), len(EDGES) + 1)
    return [r["lang"] for r in found], np.array([r["centroid"] for r in found], np.float32).reshape(len(found), DIMENSIONS), idf, bounds


def predicted(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray, np.ndarray], least: float = LEAST, carry: list[str] | None = None) -> DataFrame:
    """carry's columns (doc_id by default) with lang_pred, score (cosine, 0 to 1) and rejected (boolean) of each row."""
    return judged(docs, model, least, carry or ["doc_id"]).select("row.*", "lang_pred", "score", "rejected")


def kept(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray, np.ndarray], least: float = LEAST) -> DataFrame:
    """The rows of docs that are not rejected, whatever their columns are called."""
    return judged(docs, model, least, docs.columns).filter("NOT rejected").select("row.*")


def judged(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray, np.ndarray], least: float, carry: list[str]) -> DataFrame:
    """carry's columns as a struct row, with lang_pred, score and rejected."""
    common.small_batches(docs.sparkSession)
    langs, centres, idf, bounds = model
    made = docs.select(F.struct(*carry).alias("row"), "text")

    def run(batches):
        names = pa.array([*langs, "und"], pa.string())
        for batch in batches:
            for part in bounded_slices(batch):
                counts, letters = grams(part.column("text"))
                near = vectors(counts, idf) @ centres.T if langs else np.zeros((len(counts), 1), np.float32)
                best = near.argmax(1)
                score = np.clip(near.max(1).astype(np.float64), 0, 1)
                most = np.maximum(least, bounds[best, bands_of(letters)]) if langs else least
                none = (letters == 0) | (not langs)
                best[none], score[none] = len(langs), 0
                yield pa.RecordBatch.from_arrays([common.loose(part.column("row")), names.take(pa.array(best)), pa.array(score), pa.array(none | (score < most))], ["row", "lang_pred", "score", "rejected"])

    kind = made.schema["row"].dataType.simpleString()
    return made.mapInArrow(run, f"row {kind}, lang_pred string, score double, rejected boolean")


def held_out(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n)) == 0


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    model = fit(docs.filter(~F.coalesce(held_out(5), F.lit(True))))
    return predicted(docs, model).select("doc_id", held_out(5).alias("held_out"), "lang_pred", "score", "rejected")
