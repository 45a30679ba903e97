"""One step of the cascade: candidates by key, a condition, and who leaves."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Recon


def days_apart() -> Column:
    return F.abs(F.datediff("event_date", "inv_event_date"))


@dataclass(frozen=True)
class Rule:
    """What a pair has to fulfil besides the key; called, a condition on a ledger row and its inventory row.

    days: at most so many days apart; strict: not on the same day, and of the same coverage. offset: coverages differ by it,
    signed: ledger minus inventory.
    """

    days: int | None = None
    strict: bool = False
    offset: int | None = None
    signed: bool = False

    def __call__(self) -> Column:
        if self.offset is not None:
            gap = F.col("coverage") - F.col("inv_coverage")
            return (gap if self.signed else F.abs(gap)) == self.offset
        near = days_apart() <= self.days
        return near & (days_apart() > 0) & (F.col("coverage") == F.col("inv_coverage")) if self.strict else near


Condition = Rule


def within_window(days: int) -> Rule:
    """Both dates known and at most so many days apart."""
    return Rule(days=days)


def relapse(days: int) -> Rule:
    """The same coverage, another day, at most so many days apart."""
    return Rule(days=days, strict=True)


def transition(offset: int, signed: bool = False) -> Rule:
    """Coverages that differ by the offset."""
    return Rule(offset=offset, signed=signed)


def representatives(inventory: DataFrame, key: str) -> DataFrame:
    """One inventory row per key: the first by (event date, id), null dates last. A minimum, so it combines map-side."""
    order = F.struct(F.col("event_date").isNull().alias("unknown"), "event_date", "id", "coverage")
    chosen = inventory.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("rep"))
    return chosen.select(key, F.col("rep.id").alias("inv_id"), F.col("rep.event_date").alias("inv_event_date"), F.col("rep.coverage").alias("inv_coverage"))


def matched(ledger: DataFrame, inventory: DataFrame, key: str, condition: Rule | None) -> DataFrame:
    """The ledger's rows, each with the inv_id that a step gives it or null: pairs and what is left, in one pass."""
    joined = ledger.join(representatives(inventory, key), key, "left")
    found = F.when(condition(), F.col("inv_id")) if condition else F.col("inv_id")
    return joined.select(*ledger.columns, found.alias("inv_id"))


def remaining(annotated: DataFrame, inventory: DataFrame, key: str, consume: str) -> tuple[DataFrame, DataFrame]:
    """What a step leaves: rows that it did not match, or (consume="key") rows of keys that it did not match."""
    pairs, ledger = annotated.filter("inv_id IS NOT NULL"), annotated.filter("inv_id IS NULL").drop("inv_id")
    if consume == "key":
        taken = pairs.select(key).distinct()
        return ledger.join(taken, key, "left_anti"), inventory.join(taken, key, "left_anti")
    return ledger, inventory.join(pairs.select(F.col("inv_id").alias("id")).distinct(), "id", "left_anti")


def split_deletes(inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(DELETE, the rest); a null action goes on."""
    delete = F.coalesce(F.col("action") == "DELETE", F.lit(False))
    return inventory.filter(delete), inventory.filter(~delete)
