"""A corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

language (documents without a language go), lines (repeated and nearly repeated lines go; a document that loses all
its words goes), near_copies (one document of each group of near copies stays), mixture (documents are replicated to
equal source weights and shuffled), tokens (SentencePiece ids of each text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.llm import common, language, lines, mixing, near_copies, pieces


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification does not reject."""
    model = language.fit(docs)
    return language.kept(docs, model)


def wrapped(docs: DataFrame, *own: str) -> DataFrame:
    """The columns that an operator uses, and all others as a struct ``row``, so that no name clashes with what it adds."""
    return docs.select(*own, F.struct(F.lit(0).alias("_"), *[c for c in docs.columns if c not in own]).alias("row"))


def unwrapped(out: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of docs again, in their order; changed: expressions that replace some."""
    own = [c for c in OWN if c in out.columns]
    return out.select(*[(changed[c] if c in changed else F.col(c) if c in own else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


#: Columns of documents that operators work on.
OWN = ("doc_id", "text", "source")


def thin_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are copies; those that lose all their words go. n_chars follows the text."""
    out = lines.deduplicated(wrapped(docs, "doc_id", "text")).filter("n_removed = 0 OR text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'")
    return unwrapped(out, docs, n_chars=F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_copies.representatives(docs).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated so that all sources have equal weight."""
    return unwrapped(mixing.mixed(wrapped(docs, *OWN)), docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and a digest of what they decode to."""
    out = pieces.encoded(docs, carry=["doc_id", "lang", "source"])
    ids = F.when(F.col("n_tokens") == 0, F.array().cast("array<int>")).otherwise(F.split("ids", ",").cast("array<int>"))
    return out.select("doc_id", "lang", "source", "n_tokens", ids.alias("ids"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language", identify), ("lines", thin_lines), ("near_copies", one_of_each), ("mixture", mix), ("tokens", tokenise)]

#: Fitted centroids, MinHash classes and merges are not SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
