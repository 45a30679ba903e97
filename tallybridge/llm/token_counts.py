"""Token counts, with overlap resynchronisation for huge texts.

Short texts are counted whole. A long text is cut into chunks that overlap; chunks are rows, so they spread over
tasks. Each is encoded with the offsets of its tokens. Two neighbouring chunks are spliced at the first token that
both have at the same place in their overlap. Such a border is proven stable for merge-type models: a sequence of
tokens is the encoding of its text just when every two neighbours are what merging those two gives, and each pair
of the spliced sequence stands side by side in one of the two chunks. Where an overlap has no common token, the
text goes on to the next pass with overlap and chunks twice as long; a chunk as long as the text ends this.

Cases: a null or empty text has 0 bytes and 0 tokens. A null doc_id is kept. Repeated rows and ids are counted row by row; equal long texts
are encoded once. Other input columns are not touched.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common
from .pieces import model_path

#: Characters: longer texts are cut into chunks of CHUNK that share OVERLAP.
LONG, CHUNK, OVERLAP = 32_768, 16_384, 256
LIMIT = 4096
#: Chunks of one text that leave a task at once.
ROWS = 64

_open: dict[str, sentencepiece.SentencePieceProcessor] = {}
TOKEN = "struct<first: int, last: int, id: int>"


def model_of(path: str) -> sentencepiece.SentencePieceProcessor:
    if path not in _open:
        _open[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _open[path]


def offsets(model: sentencepiece.SentencePieceProcessor, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """First and last (excluded) character of each token; the mark put before the text is at -1.

    A character of several bytes may be several tokens: these have no extent and are no place to splice at.
    """
    sizes, extents, left = [], [], 0
    for i in ids:
        if model.is_byte(i):
            value = int(model.id_to_piece(i)[3:5], 16)
            if value & 0xC0 != 0x80:
                left = 1 if value < 0x80 else 2 if value < 0xE0 else 3 if value < 0xF0 else 4
            left -= 1
            sizes.append(int(not left))
            extents.append(int(value < 0x80))
        else:
            sizes.append(len(model.id_to_piece(i)))
            extents.append(sizes[-1])
    first = np.cumsum(np.array(sizes, np.int64)) - 1 - np.array(sizes, np.int64)
    return first, first + np.array(extents, np.int64)


def chunk_counts(chunks: DataFrame, path: str, overlap: int) -> DataFrame:
    """Encodes chunk rows (key, n, start, text): n_tokens, and the tokens that lie within either overlap."""
    token = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("id", pa.int32())])
    schema = pa.schema([("key", pa.string()), ("n", pa.int32()), ("n_tokens", pa.int64()), ("head", pa.list_(token)), ("tail", pa.list_(token))])

    def run(batches):
        model = model_of(path)
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                ids = model.encode(row["text"])
                first, last = offsets(model, ids)
                own = lambda mask: [{"first": int(first[k] + row["start"]), "last": int(last[k] + row["start"]), "id": ids[k]} for k in np.flatnonzero(mask)]
                rows.append({"key": row["key"], "n": row["n"], "n_tokens": len(ids), "head": own(last <= overlap), "tail": own(first >= len(row["text"]) - overlap)})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return chunks.mapInArrow(run, f"key string, n int, n_tokens long, head array<{TOKEN}>, tail array<{TOKEN}>")


def cutting(chunk: int, overlap: int):
    """Cuts texts (key, text) into chunk rows (key, n, start, text), each character once or twice: in time that grows with the text."""

    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
                text = text.as_py()
                starts = range(0, max(len(text) - overlap - 1, 0) + 1, chunk - overlap)
                for a in range(0, len(starts), ROWS):
                    some = starts[a : a + ROWS]
                    columns = [pa.array([key] * len(some), pa.string()), pa.array(range(a, a + len(some)), pa.int32()), pa.array(some, pa.int32()), pa.array([text[s : s + chunk] for s in some], pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "n", "start", "text"])

    return run


def spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Counts of distinct texts (key, text): key, n_tokens; null where an overlap had no common token."""
    rows = texts.select("key", "text").mapInArrow(cutting(chunk, overlap), "key string, n int, start int, text string").repartition("key", "n").dropDuplicates(["key", "n"])
    before = F.lag("tail").over(W.partitionBy("key").orderBy("n"))
    seams = chunk_counts(rows, path, overlap).withColumn("before", before)
    seams = seams.withColumn("at", F.when(F.col("n") > 0, F.array_min(F.expr("transform(array_intersect(filter(head, x -> x.last > x.first), before), x -> x.first)"))))
    twice = F.expr("size(filter(head, x -> x.first < at)) + size(filter(before, x -> x.first >= at))")
    missed = F.when(F.col("n") > 0, F.col("at").isNull()).otherwise(F.lit(False))
    return seams.groupBy("key").agg(F.when(~F.max(missed), F.sum(F.col("n_tokens") - F.when(F.col("n") > 0, twice).otherwise(0))).alias("n_tokens"))


def counted(docs: DataFrame, path: str | None = None, long: int = LONG, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens of each row of docs, as the sentencepiece library counts the whole text."""
    spark, path = docs.sparkSession, path or model_path()
    common.small_batches(spark)
    base = docs.select("doc_id", "text")
    is_long = F.coalesce(F.char_length("text") > long, F.lit(False))

    def run(batches):
        model = model_of(path)
        for batch in batches:
            for part in common.slices(batch, most=1 << 20):
                sizes = [len(x) for x in model.encode(pc.fill_null(part.column("text"), "").to_pylist(), num_threads=1)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64()), pa.array(sizes, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    short = base.filter(~is_long).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    texts = base.filter(is_long).withColumn("key", F.sha2("text", 256))
    found, open_texts = None, texts.select("key", "text")
    for k in itertools.count():
        counts = common.written(spliced(open_texts, path, chunk << k, overlap << k), "token-counts")
        done = counts.filter("n_tokens IS NOT NULL")
        found = done if found is None else found.unionByName(done)
        missed = counts.filter("n_tokens IS NULL")
        if missed.isEmpty():
            break
        open_texts = open_texts.join(missed.select("key"), "key", "left_semi")
    sizes = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "key", F.octet_length("text").cast("long").alias("n_bytes"))
    return short.unionByName(sizes.join(found, "key").select("doc_id", "n_bytes", "n_tokens"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(common.documents(spark, sf_dir)).withColumn("over_limit", F.col("n_tokens") > LIMIT)
