"""Amounts, dates, ratios and bins; bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import MONTHS, UNKNOWN_BIN, UNKNOWN_RANK

MONEY = "decimal(18,2)"


def amount(text: Column) -> Column:
    """A decimal comma, and spaces (also non-breaking) between thousands."""
    return F.regexp_replace(F.regexp_replace(text, "[\\s\\u00A0\\u202F]", ""), ",", ".").try_cast(MONEY)


def day(text: Column, pattern: str = "dd/MM/yyyy") -> Column:
    return F.try_to_date(text, pattern)


def rounded(x: Column, places: int = 2) -> Column:
    """Half away from zero on decimal digits, as a double; null for null."""
    return F.round(x.cast("double"), places)


def percent(part: Column, whole: Column, places: int = 2, empty: float | None = None) -> Column:
    """100 * part / whole, rounded from unrounded input; ``empty`` where whole is 0 or null."""
    ratio = rounded(F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double")), places)
    return ratio if empty is None else F.coalesce(ratio, F.lit(empty))


def money(x: Column) -> Column:
    """A sum of decimals as a double."""
    return x.cast("double")


def _bins(value: Column, bins, results: list, unknown) -> Column:
    out = None
    for (low, high, _), result in zip(bins, results):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (value >= low)
        if high is not None:
            inside = inside & (value < high)
        out = F.when(value.isNotNull() & inside, result) if out is None else out.when(value.isNotNull() & inside, result)
    return out.otherwise(unknown)


def bin_label(value: Column, bins) -> Column:
    return _bins(value, bins, [b[2] for b in bins], UNKNOWN_BIN)


def bin_rank(value: Column, bins) -> Column:
    return _bins(value, bins, list(range(len(bins))), UNKNOWN_RANK)


def month_label(month: Column) -> Column:
    return F.get(F.array(*[F.lit(m) for m in MONTHS]), month - 1)


def category(inventory: Column, ledger: Column, null_as_zero: bool) -> Column:
    """UNDER, OVER or CONFORM by the ledger's reserve against the inventory's."""
    if null_as_zero:
        inventory, ledger = F.coalesce(inventory, F.lit(0)), F.coalesce(ledger, F.lit(0))
    return F.when(ledger < inventory, "UNDER").when(ledger > inventory, "OVER").otherwise("CONFORM")
