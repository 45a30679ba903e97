"""Aggregate tables over the labelled result (recon_label, action, clause, type, led_*, inv_*).

All come from one pre-aggregation, ``facts``: counts and sums by every dimension that a table asks for, each dimension
only for the labels whose tables need it, so that its rows are bounded by clauses, bins and months and not by the result.
A table takes rows or facts; the collections compute facts once, and the wide result is scanned once for all
their tables. Shares are window totals over the few aggregated rows. Money is summed as decimal and shown as double; rates come
from unrounded sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import ACTION_ORDER, INV_DELETE, INV_MISSING, KEPT_ACTIONS, LEDGER_LATE, LEDGER_LATE_OBS, LEDGER_ONLY, MATCHED, Recon
from ..functions.numbers import bin_label, bin_rank, category, money, month_label, percent, rounded
from ..operators.columns import derive_clause, optional, tagged
from ..operators.enrich import with_action
from .cut import cut

INV, LED = "inv_reserve", "led_reserve"


def matched(late: bool = False) -> Column:
    return F.col("recon_label").isin([*MATCHED, *([LEDGER_LATE] if late else [])])


def kept_action() -> Column:
    return F.col("action").isin(list(KEPT_ACTIONS))


def total(column: Column | str) -> Column:
    return money(F.sum(column))


def _mean(total_: str, n: str) -> Column:
    total_, n = f"cast({total_} * 100 AS decimal(38,0))", f"cast({n} AS decimal(20,0))"
    return F.expr(f"CASE WHEN {n} > 0 THEN CASE WHEN {total_} < 0 THEN -1 ELSE 1 END * ((2 * abs({total_}) + {n}) div (2 * {n})) / 100D END")


def mean(column: str) -> Column:
    """Of decimals with two digits, in whole cents, half away from zero: exact for any number of rows."""
    return _mean(f"sum({column})", f"count({column})")


def mean_of(total_: str, n: str) -> Column:
    """The same over facts: of sums and counts."""
    return _mean(f"sum({total_})", f"sum({n})")


def share(df: DataFrame, of: str, name: str, *within: str, places: int = 2) -> DataFrame:
    """name: percent of the column's total within the groups, over aggregated rows."""
    return df.withColumn(name, percent(F.col(of), F.sum(of).over(W.partitionBy(*within)), places))


def gap() -> Column:
    return F.col(INV) - F.col(LED)


#: What facts are told by where a table has it; other columns of a row do not matter.
PLAIN = ("clause", "type", "inv_status", "action", "recon_label")
#: Dimensions that only some labels have: of reconciled rows, of ledger rows alone, of missing inventory rows.
OF_MATCHED = ("category", "category0", "gap_bin", "gap_rank")
OF_LEDGER = ("led_bin", "led_rank", "led_year", "led_month", "led_day", "coverage")
OF_INVENTORY = ("inv_year", "inv_month")


def facts(df: DataFrame, cfg: Recon = Recon()) -> DataFrame:
    """Counts and sums of rows by all dimensions of the tables below; facts stay as they are.

    nb rows; inv, led: sums of reserves; n_inv, n_led, nonzero: rows with one, and with one of the inventory that is not
    0; gap, gap_abs, gap_max, n_gap: of rows with both reserves; gap0, gap0_abs, gap0_max: a missing one counted as 0.
    """
    if "gap0_abs" in df.columns:
        return df
    label, inv, led = F.col("recon_label"), F.coalesce(INV, F.lit(0)), F.coalesce(LED, F.lit(0))
    year, month = (lambda c: F.year(c)), (lambda c: F.month(c))
    dims = {
        "category": category(F.col(INV), F.col(LED), False), "category0": category(F.col(INV), F.col(LED), True), "gap_bin": bin_label(F.abs(gap()), cfg.gap_bins), "gap_rank": bin_rank(F.abs(gap()), cfg.gap_bins),
        "led_bin": bin_label(F.col(LED), cfg.reserve_bins), "led_rank": bin_rank(F.col(LED), cfg.reserve_bins), "led_year": year("led_event_date"), "led_month": month("led_event_date"),
        "led_day": F.dayofmonth("led_event_date"), "coverage": F.col("led_coverage"), "inv_year": year("inv_event_date"), "inv_month": month("inv_event_date"),
    }
    own = {**dict.fromkeys(OF_MATCHED, label.isin(*MATCHED, LEDGER_LATE)), **dict.fromkeys(OF_LEDGER, label.isin(LEDGER_ONLY, LEDGER_LATE_OBS)), **dict.fromkeys(OF_INVENTORY, label == INV_MISSING)}
    keys = [c for c in PLAIN if c in df.columns]
    named = [F.when(own[name], x).alias(name) for name, x in dims.items()]
    bins = [bin_label(F.col(INV), cfg.reserve_bins).alias("bin"), bin_rank(F.col(INV), cfg.reserve_bins).alias("bin_rank"), bin_label(inv, cfg.reserve_bins).alias("bin0"), bin_rank(inv, cfg.reserve_bins).alias("bin0_rank")]
    gap0 = inv - led
    return df.groupBy(*keys, *named, *bins).agg(
        F.count("*").alias("nb"), F.sum(INV).alias("inv"), F.sum(LED).alias("led"), F.count(INV).alias("n_inv"), F.count(LED).alias("n_led"), F.count_if(inv != 0).alias("nonzero"),
        F.sum(gap()).alias("gap"), F.sum(F.abs(gap())).alias("gap_abs"), F.max(F.abs(gap())).alias("gap_max"), F.count(gap()).alias("n_gap"),
        F.sum(gap0).alias("gap0"), F.sum(F.abs(gap0)).alias("gap0_abs"), F.max(F.abs(gap0)).alias("gap0_max"),
    )


def rows(condition: Column | None = None) -> Column:
    """How many rows facts stand for."""
    return F.coalesce(F.sum("nb" if condition is None else F.when(condition, F.col("nb"))), F.lit(0))


def total_or_0(column: Column | str) -> Column:
    return F.coalesce(total(column), F.lit(0.0))


def sums(null_as_zero: bool = False) -> list[Column]:
    """nb, inv_reserve and led_reserve."""
    of = total_or_0 if null_as_zero else total
    return [rows().alias("nb"), of("inv").alias("inv_reserve"), of("led").alias("led_reserve")]


def audited(df: DataFrame) -> DataFrame:
    """Rows with an action and whether it was followed: kept actions want a match, DELETE wants none."""
    followed = matched() == (F.col("action") != "DELETE")
    return df.filter("action IS NOT NULL").withColumn("audit", F.when(followed, "CONFORM").otherwise("NON_CONFORM"))


def audit_detail(df: DataFrame) -> DataFrame:
    """The audited rows themselves."""
    return audited(df)


def audit_summary(df: DataFrame) -> DataFrame:
    df = facts(df)
    dims = ["clause", "type", *optional(df, "inv_status"), "action"]
    out = audited(df).groupBy(*dims, "audit").agg(rows().alias("nb"), total("inv").alias("inv_reserve"))
    return share(share(out, "nb", "pct_nb", *dims), "inv_reserve", "pct_reserve", *dims)


def instruction_ratios(df: DataFrame) -> DataFrame:
    out = facts(df).filter("action <> 'DELETE'").groupBy("clause", "type", "action", "recon_label").agg(rows().alias("nb"), total("inv").alias("inv_reserve"))
    return share(share(out, "nb", "ratio_nb", "clause", "type"), "inv_reserve", "ratio_reserve", "clause", "type")


def instruction_reserve(df: DataFrame, cfg: Recon = Recon(), null_as_zero: bool = True) -> DataFrame:
    zero = "0" if null_as_zero else ""
    df = facts(df, cfg).filter(matched(late=True) & kept_action())
    out = df.groupBy("action", F.col(f"category{zero}").alias("category"), F.col(f"bin{zero}").alias("bin"), F.col(f"bin{zero}_rank").alias("bin_rank")).agg(*sums(null_as_zero), total(f"gap{zero}").alias("gap"))
    out = out.withColumn("shortfall_rate", percent(F.col("gap"), F.col("inv_reserve")))
    return share(out, "nb", "pct_nb", "action").orderBy("action", "category", "bin_rank")


def instruction_global(df: DataFrame) -> DataFrame:
    m = matched()
    df = facts(df).filter(F.col("action").isNotNull() & (m | F.col("recon_label").isin(INV_MISSING, INV_DELETE)))
    out = df.groupBy("action").agg(
        rows().alias("nb_total"), rows(m).alias("nb_matched"), F.coalesce(F.sum(F.when(m, F.col("nonzero"))), F.lit(0)).alias("nb_nonzero"),
        total_or_0(F.when(m, F.col("inv"))).alias("inv_reserve"), total_or_0(F.when(m, F.col("led"))).alias("led_reserve"),
    )
    rank = F.array_position(F.array(*[F.lit(a) for a in ACTION_ORDER]), F.col("action")).cast("int")
    delete = F.col("action") == "DELETE"
    out = out.withColumns({"rank": rank, "nb_orphan": F.col("nb_total") - F.col("nb_matched"), "nb_zero": F.col("nb_matched") - F.col("nb_nonzero"), "gap": rounded(F.col("inv_reserve") - F.col("led_reserve"))})
    out = out.withColumn("nb_conform", F.when(delete, F.col("nb_orphan")).otherwise(F.col("nb_matched")))
    out = out.withColumns({"pct_conform": percent(F.col("nb_conform"), F.col("nb_total")), "shortfall_rate": F.when(~delete, percent(F.col("inv_reserve") - F.col("led_reserve"), F.col("inv_reserve")))})
    return out.orderBy("rank")


def delete_not_followed(df: DataFrame, cfg: Recon = Recon()) -> DataFrame:
    out = facts(df, cfg).filter(matched() & (F.col("action") == "DELETE")).groupBy("bin", "bin_rank").agg(*sums())
    return share(out, "nb", "pct_nb").orderBy("bin_rank")


def _shortfall(df: DataFrame, dims: list[str], null_as_zero: bool) -> DataFrame:
    zero = "0" if null_as_zero else ""
    of = lambda name: F.col(f"category{zero}") == name
    size = f"gap{zero}_abs"
    out = df.groupBy(*dims).agg(
        *sums(null_as_zero), *[rows(of(name)).alias(f"nb_{name.lower()}") for name in ("UNDER", "OVER", "CONFORM")],
        total(f"gap{zero}").alias("gap"), total(size).alias("gap_abs"), total_or_0(F.when(of("UNDER"), F.col(size))).alias("gap_under"), total_or_0(F.when(of("OVER"), F.col(size))).alias("gap_over"),
    )
    return out.withColumn("shortfall_rate", percent(F.col("gap"), F.col("inv_reserve")))


def shortfall_by_clause(df: DataFrame, null_as_zero: bool = False) -> DataFrame:
    out = _shortfall(facts(df).filter(matched() & kept_action()), ["clause", "type", "action"], null_as_zero)
    out = share(share(out, "nb", "weight_nb", "clause", "type"), "inv_reserve", "weight_reserve", "clause", "type")
    return out.withColumns({f"pct_{c}": percent(F.col(f"nb_{c}"), F.col("nb")) for c in ("under", "over", "conform")})


def shortfall_by_action(df: DataFrame, null_as_zero: bool = True) -> DataFrame:
    out = _shortfall(facts(df).filter(matched(late=True) & kept_action()), ["action"], null_as_zero)
    return out.drop("gap_abs", "gap_under", "gap_over").orderBy(F.desc("nb"), "action")


def provision_by_clause(df: DataFrame, null_as_zero: bool = False) -> DataFrame:
    zero, dims = "0" if null_as_zero else "", ["clause", "type", "action"]
    out = facts(df).filter(matched() & kept_action()).groupBy(*dims, F.col(f"category{zero}").alias("category")).agg(*sums(), total("gap_abs").alias("gap_abs"))
    return share(out, "nb", "pct_nb", *dims)


def gap_bins(df: DataFrame, cfg: Recon = Recon()) -> DataFrame:
    dims = ["clause", "type", "action", "category"]
    df = facts(df, cfg).filter(matched() & kept_action() & (F.col("category") != "CONFORM"))
    out = df.groupBy(*dims, F.col("gap_bin").alias("bin"), F.col("gap_rank").alias("bin_rank")).agg(*sums(), total("gap_abs").alias("gap_total"), mean_of("gap_abs", "n_gap").alias("gap_mean"), money(F.max("gap_max")).alias("gap_max"))
    return share(share(out, "nb", "pct_nb", *dims), "gap_total", "pct_gap", *dims).orderBy(*dims, "bin_rank")


def provision_study(df: DataFrame, null_as_zero: bool = True) -> DataFrame:
    zero = "0" if null_as_zero else ""
    df = facts(df).filter(matched(late=True) & (F.col("action").isNull() | (F.col("action") != "DELETE")))
    out = df.groupBy(F.col(f"category{zero}").alias("category")).agg(
        *sums(null_as_zero), total(f"gap{zero}").alias("gap"), total(f"gap{zero}_abs").alias("gap_abs"), mean_of(f"gap{zero}_abs", "nb" if null_as_zero else "n_gap").alias("gap_mean"), money(F.max(f"gap{zero}_max")).alias("gap_max")
    )
    out = share(share(out, "nb", "pct_nb", places=1), "inv_reserve", "pct_reserve", places=1)
    return out.withColumn("shortfall_rate", percent(F.col("gap"), F.col("inv_reserve"))).orderBy(F.desc("nb"), "category")


def _by_month(df: DataFrame, side: str, bins: tuple[str, str], extra: list[str], cfg: Recon) -> DataFrame:
    month = F.col(f"{side}_month")
    dims = ["clause", "type", *extra, F.col(f"{side}_year").alias("year"), month.alias("month"), month_label(month).alias("month_label"), month.isin(list(cfg.year_end_months)).alias("year_end"), F.col(bins[0]).alias("bin"), F.col(bins[1]).alias("bin_rank")]
    out = df.groupBy(*dims).agg(rows().alias("nb"), total(side).alias("reserve"), mean_of(side, f"n_{side}").alias("reserve_mean"))
    return out.orderBy("clause", "type", *extra, "year", "month", "bin_rank")


def ledger_only_by_month(df: DataFrame, cfg: Recon = Recon()) -> DataFrame:
    return _by_month(facts(df, cfg).filter(F.col("recon_label") == LEDGER_ONLY), "led", ("led_bin", "led_rank"), [], cfg)


def inv_missing_by_month(df: DataFrame, cfg: Recon = Recon()) -> DataFrame:
    df = facts(df, cfg).filter((F.col("recon_label") == INV_MISSING) & (F.col("action") != "DELETE"))
    return _by_month(df, "inv", ("bin", "bin_rank"), [*optional(df, "inv_status"), "action"], cfg)


def _breakdown(df: DataFrame, label: str, days: bool) -> DataFrame:
    dims = ["year", "month", "coverage"]
    df = facts(df).filter(F.col("recon_label") == label).withColumnsRenamed({"led_year": "year", "led_month": "month"})
    out = df.groupBy(*dims).agg(rows().alias("nb"), total("led").alias("reserve"), mean_of("led", "n_led").alias("reserve_mean"), *([F.min("led_day").alias("first_day")] if days else []))
    if days:  # the day of most rows, the first of several
        by_day = df.groupBy(*dims, "led_day").agg(F.sum("nb").alias("n"))
        modal = by_day.groupBy(*dims).agg(F.max(F.when(F.col("led_day").isNotNull(), F.struct("n", (-F.col("led_day")).alias("day")))).alias("most"))
        same = [F.col(f"o.{c}").eqNullSafe(F.col(f"m.{c}")) for c in dims]
        out = out.alias("o").join(modal.alias("m"), same).select("o.*", (-F.col("m.most.day")).alias("modal_day"))
    return out.orderBy(F.desc("reserve"), *dims)


def ledger_only_breakdown(df: DataFrame) -> DataFrame:
    return _breakdown(df, LEDGER_ONLY, True)


def late_obs_breakdown(df: DataFrame) -> DataFrame:
    return _breakdown(df, LEDGER_LATE_OBS, False)


def identity() -> Column:
    """Who an inventory row is, nulls included; the spelling of the name does not count."""
    return F.struct("inv_person_id", "inv_birth_date", "inv_event_date", "inv_coverage")


def fanout_detail(df: DataFrame, top: int | None = None) -> DataFrame:
    """Inventory identities that several ledger rows match: how often, in which steps, with the largest reserve and the first name; all or the top ones."""
    out = df.filter(matched()).groupBy(identity().alias("who")).agg(
        F.count("*").alias("nb_ledger"), money(F.max(INV)).alias("inv_reserve"), F.array_join(F.array_sort(F.collect_set("recon_label")), ",").alias("steps"), F.min("inv_full_name").alias("full_name")
    )
    out = out.filter("nb_ledger > 1").select("who.*", "nb_ledger", "inv_reserve", "steps", "full_name")
    order = [F.desc("nb_ledger"), F.desc_nulls_last("inv_reserve"), "inv_person_id", "inv_birth_date", "inv_event_date", "inv_coverage"]
    return top_rows(out, top, *order) if top else out.orderBy(*order)


def top_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows of an order, which should be total; Spark keeps n rows per partition, not a sorted whole."""
    return df.orderBy(*order).limit(n)


def fanout_summary(df: DataFrame, inventory: DataFrame) -> DataFrame:
    own = df.filter(matched()).agg(F.count("*").alias("matched_rows"), F.count_distinct(identity()).alias("matched_identities"))
    source = inventory.agg(F.count("*").alias("input_rows"), F.count_distinct(identity()).alias("input_identities"))
    out = own.withColumn("one", F.lit(1)).join(source.withColumn("one", F.lit(1)), "one")
    return out.select("matched_rows", "matched_identities", F.expr("matched_rows - matched_identities").alias("overcount"), "input_rows", "input_identities")


def identity_sketches(df: DataFrame, *by: str, precision: int = 14) -> DataFrame:
    """For each group a HyperLogLog sketch of the identities of matched rows: stored by run, sketches merge into those of several runs."""
    who = F.to_json(identity(), {"ignoreNullFields": "false"})
    return df.filter(matched()).groupBy(*by).agg(F.hll_sketch_agg(who, precision).alias("sketch"))


def merged_identities(sketches: DataFrame, *by: str) -> DataFrame:
    """Approximate distinct identities over all sketches of a group (relative error about 1.04 / sqrt(2^precision): 0.8 % at 14).

    A sketch that was filled in one go estimates by the order of its rows. United with itself it goes by its registers alone, so
    equal sets have equal estimates, however their rows were dealt, ordered and merged.
    """
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, F.hll_sketch_estimate(F.hll_union("sketch", "sketch")).alias("identities"))


def orphan_tag_distribution(df: DataFrame) -> DataFrame:
    return df.filter(F.col("recon_label") == LEDGER_ONLY).groupBy("orphan_tag").agg(F.count("*").alias("nb"), total(LED).alias("reserve")).orderBy(F.desc("nb"), "orphan_tag")


def prepared(df: DataFrame, default_type: str | None = None) -> DataFrame:
    """The columns that analyses need: action, clause, type."""
    return derive_clause(with_action(df), default_type)


def full_analysis(df: DataFrame, cfg: Recon = Recon()) -> dict[str, DataFrame]:
    """By clause; all from one scan of df, which writes their facts."""
    df = cut(facts(prepared(df), cfg), "facts")
    return {
        "audit_summary": audit_summary(df), "instruction_ratios": instruction_ratios(df), "shortfall_by_clause": shortfall_by_clause(df), "provision_by_clause": provision_by_clause(df),
        "gap_bins": gap_bins(df, cfg), "ledger_only_by_month": ledger_only_by_month(df, cfg), "inv_missing_by_month": inv_missing_by_month(df, cfg),
    }


def collected_analyses(df: DataFrame, cfg: Recon = Recon(), **tags: str) -> dict[str, DataFrame]:
    """Over all clauses, with constant columns (client, clause, type) first; all from one scan of df, which writes their facts."""
    df = cut(facts(prepared(df), cfg), "facts")
    found = {
        "instruction_global": instruction_global(df), "shortfall_by_action": shortfall_by_action(df), "instruction_reserve": instruction_reserve(df, cfg), "delete_not_followed": delete_not_followed(df, cfg),
        "provision_study": provision_study(df), "ledger_only_breakdown": ledger_only_breakdown(df), "late_obs_breakdown": late_obs_breakdown(df),
    }
    return {name: tagged(table, **tags) for name, table in found.items()}
