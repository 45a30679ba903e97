"""Second chance in later inventories, and flags of explainable orphans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import LEDGER_LATE, LEDGER_LATE_OBS, LEDGER_ONLY, Recon
from ..functions import text


def recover_late(result: DataFrame, inventories: Sequence[tuple[str, DataFrame]], cfg: Recon = Recon(), key: str = "key_no_date") -> DataFrame:
    """LEDGER_ONLY rows that an inventory of the ordered list has by key become LEDGER_LATE; the first hit wins.

    late_source names the inventory, and the row takes its inv_* columns (representative: first by event date and
    id). cfg.late_days bounds the days between the events, if set. Rows and their number stay as they are. However
    many inventories there are, they are stacked with their places in the list and reduced to one row a key, so that
    orphans are joined once; other rows are not shuffled.
    """
    if "late_source" not in result.columns:
        result = result.withColumn("late_source", F.lit(None).cast("string"))
    if not inventories:
        return result
    orphan = F.coalesce((F.col("recon_label") == LEDGER_ONLY) & F.col("late_source").isNull() & F.col(key).isNotNull(), F.lit(False))
    settled, orphans = result.filter(~orphan), result.filter(orphan)
    later = stacked(inventories, key, [c for c in result.columns if c.startswith("inv_")])
    own = [c for c in later.columns if c.startswith("inv_")]
    order = F.struct("place", F.col("inv_event_date").isNull().alias("unknown"), "inv_event_date", "inv_id", *[c for c in own if c not in ("inv_event_date", "inv_id")], "late_name")
    if cfg.late_days is None:
        found = later.groupBy("late_key").agg(F.min(order).alias("late_row"))
    else:  # which inventory wins depends on the ledger row: one representative of each, as many as the list is long
        found = later.groupBy("late_key", "place").agg(F.min(order).alias("late_row")).groupBy("late_key").agg(F.array_sort(F.collect_list("late_row")).alias("late_rows"))
    joined = orphans.join(found, F.col(key) == F.col("late_key"), "left")
    if cfg.late_days is not None:
        near = F.filter("late_rows", lambda x: F.abs(F.datediff(F.col("led_event_date"), x["inv_event_date"])) <= cfg.late_days)
        joined = joined.withColumn("late_row", F.get(near, 0))
    hit = F.col("late_row").isNotNull()
    changed = {c: F.when(hit, F.col(f"late_row.{c}")).otherwise(F.col(c)) for c in own}
    changed |= {"recon_label": F.when(hit, LEDGER_LATE).otherwise(F.col("recon_label")), "late_source": F.when(hit, F.col("late_row.late_name")).otherwise(F.col("late_source"))}
    return settled.unionByName(joined.withColumns(changed).select(*result.columns))


def stacked(inventories: Sequence[tuple[str, DataFrame]], key: str, columns: Sequence[str]) -> DataFrame:
    """The inventories' rows with a key, one under the other: late_key, place in the list, late_name and the inv_* columns among ``columns`` that any has."""
    out = None
    for place, (name, inventory) in enumerate(inventories):
        one = inventory.filter(F.col(key).isNotNull()).select(F.col(key).alias("late_key"), F.lit(place).alias("place"), F.lit(name).alias("late_name"), *[c for c in inventory.columns if c in columns])
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def flag_late_observations(result: DataFrame, cfg: Recon) -> DataFrame:
    """LEDGER_ONLY of the late coverage and the last months of the inventory year: LEDGER_LATE_OBS. Without a year, none."""
    if "late_source" not in result.columns:
        result = result.withColumn("late_source", F.lit(None).cast("string"))
    if cfg.inventory_year is None:
        return result
    hit = (F.col("recon_label") == LEDGER_ONLY) & (F.col("led_coverage") == cfg.late_coverage) & F.month("led_event_date").isin(list(cfg.late_months)) & (F.year("led_event_date") == cfg.inventory_year)
    hit = F.coalesce(hit, F.lit(False))
    return result.withColumns({"recon_label": F.when(hit, LEDGER_LATE_OBS).otherwise(F.col("recon_label")), "late_source": F.when(hit, "LATE_OBSERVATION").otherwise(F.col("late_source"))})


def orphan_tag(cfg: Recon) -> Column:
    """Why a LEDGER_ONLY row may be alone: year end, then a high reserve, else to be analysed; null for others."""
    late = F.month("led_event_date").isin(list(cfg.tag_months))
    late = late & (F.year("led_event_date") == cfg.inventory_year) if cfg.inventory_year is not None else late
    return F.when(F.col("recon_label") == LEDGER_ONLY, F.when(late, "PROBABLY_LATE").when(F.col("led_reserve") > cfg.high_reserve, "HIGH_RESERVE").otherwise("TO_ANALYSE"))


def with_tags(result: DataFrame, cfg: Recon) -> DataFrame:
    return with_action(result).withColumn("orphan_tag", orphan_tag(cfg))


def with_action(df: DataFrame, column: str = "inv_instruction") -> DataFrame:
    return df.withColumn("action", text.action(F.col(column)))


def inventory_date(result: DataFrame, fixed: str | None = None, column: str = "inv_inventory_date") -> DataFrame:
    """One row with inventory_date: given, else the latest of the current inventory (late rows excluded) as dd/MM/yyyy, else n/d."""
    if fixed:
        return result.sparkSession.createDataFrame([(fixed,)], "inventory_date string")
    if column not in result.columns:
        return result.sparkSession.createDataFrame([("n/d",)], "inventory_date string")
    latest = F.max(F.when(~F.col("recon_label").isin(LEDGER_LATE), F.col(column)))
    return result.agg(F.coalesce(F.date_format(latest, "dd/MM/yyyy"), F.lit("n/d")).alias("inventory_date"))


