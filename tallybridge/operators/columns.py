"""Projections, keys and deduplication."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text

#: Key: (event date, coverage, name cut) parts besides person and birth date.
KEYS = {
    "key_strict": (True, True, False),
    "key_no_date": (False, True, False),
    "key_strict_trunc": (True, True, True),
    "key_no_date_trunc": (False, True, True),
    "key_no_coverage": (True, False, False),
}


def select_and_rename(df: DataFrame, mapping: Mapping[str, str], required: Iterable[str] = ()) -> DataFrame:
    """The columns of mapping that df has, under their new names. A required one that is missing, or none at all, is an error."""
    missing = [c for c in required if c not in df.columns]
    found = [F.col(f"`{old}`").alias(new) for old, new in mapping.items() if old in df.columns]
    if missing or not found:
        raise ValueError(f"missing columns: {missing or list(mapping)}; there are {df.columns}")
    return df.select(*found)


def prefixed(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    keep = set(keep)
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def without_duplicate_names(df: DataFrame) -> DataFrame:
    """Of columns with equal names the first."""
    names = [f"c{k}" for k in range(len(df.columns))]
    first = {name: k for k, name in reversed(list(enumerate(df.columns)))}
    return df.toDF(*names).select(*[F.col(f"c{k}").alias(name) for name, k in sorted(first.items(), key=lambda x: x[1])])


def tagged(df: DataFrame, **values: str) -> DataFrame:
    """Constant columns first."""
    return df.select(*[F.lit(v).alias(k) for k, v in values.items()], *[c for c in df.columns if c not in values])


def optional(df: DataFrame, name: str) -> list[str]:
    return [name] if name in df.columns else []


def keep_latest(df: DataFrame, keys: list[str], order: str, *ties: str) -> DataFrame:
    """For each key the row with the largest ``order``; ties by the other columns, smallest first (nulls last)."""
    by = [F.col(order).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]
    ranked = df.withColumn("_latest", F.row_number().over(W.partitionBy(*keys).orderBy(*by)))
    return ranked.filter("_latest = 1").drop("_latest")


def matching_keys(df: DataFrame, truncate: int = 20, null_parts: str = "null") -> DataFrame:
    """Adds the five composite keys of person_id, birth_date, event_date, coverage and full_name.

    null_parts: "null" gives no key where person, birth date or name is null; "skip" leaves null parts out.
    """
    for needed in ("person_id", "birth_date", "event_date", "coverage", "full_name"):
        if needed not in df.columns:
            raise ValueError(f"keys need column {needed}")
    date = lambda c: F.date_format(c, "yyyyMMdd")
    whole = F.col("person_id").isNotNull() & F.col("birth_date").isNotNull() & F.col("full_name").isNotNull()

    def key(with_event: bool, with_coverage: bool, cut: bool) -> Column:
        parts = [F.col("person_id").cast("string"), date("birth_date")]
        parts += [date("event_date")] if with_event else []
        parts += [F.col("coverage").try_cast("int").cast("string")] if with_coverage else []
        parts += [text.truncated_name(F.col("full_name"), truncate) if cut else text.full_name(F.col("full_name"))]
        joined = F.concat_ws("", *parts)
        return F.when(whole, joined) if null_parts == "null" else joined

    return df.withColumns({name: key(*parts) for name, parts in KEYS.items()})


def derive_clause(df: DataFrame, default_type: str | None = None) -> DataFrame:
    """clause: the inventory's, else the ledger's number; type: the inventory's, else the default."""
    own = [F.col(c) for c in optional(df, "inv_clause")] + [text.clause_number(F.col(c)) for c in optional(df, "led_clause")]
    kind = [F.col(c) for c in optional(df, "inv_type")] + [F.lit(default_type).cast("string")]
    return df.withColumns({"clause": F.coalesce(*own), "type": F.coalesce(*kind)})
