"""Key figures of a reconciliation, from one pre-aggregation by label and action."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ACTION_ORDER, INV_DELETE, INV_MISSING, KEPT_ACTIONS, KNOWN, LEDGER_LATE, LEDGER_LATE_OBS, LEDGER_ONLY, MATCHED, PRINCIPAL, RECOVERED, REFINED
from ..functions.numbers import money, percent, rounded
from ..operators.enrich import inventory_date

#: Sums that the figures are made of: name, labels, actions (None: all). Each has _nb, _inv and _led.
SUMS = {
    "p": (PRINCIPAL, None), "r": (REFINED, None), "v": (RECOVERED, None), "m": (MATCHED, None), "d": ((INV_DELETE,), None), "x": ((INV_MISSING,), None),
    "o": ((LEDGER_ONLY,), None), "l": ((LEDGER_LATE,), None), "t": ((LEDGER_LATE_OBS,), None), "u": ((*MATCHED, LEDGER_LATE), None), "known": (KNOWN, None),
    "xk": ((INV_MISSING,), ("KEEP",)), "xs": ((INV_MISSING,), ("STUDY",)), "xa": ((INV_MISSING,), ("ADD",)),
    "uk": ((*MATCHED, LEDGER_LATE), KEPT_ACTIONS), "mk": (MATCHED, KEPT_ACTIONS), "ck": ((*MATCHED, INV_MISSING), KEPT_ACTIONS),
}

#: Figures over those sums.
FIGURES = {
    "inv_nb": "m_nb + d_nb + x_nb", "inv_reserve": "m_inv + d_inv + x_inv", "to_delete_nb": "d_nb", "to_delete_reserve": "d_inv",
    "to_compare_nb": "m_nb + x_nb", "to_compare_reserve": "m_inv + x_inv", "principal_nb": "p_nb", "principal_reserve": "p_inv", "refined_nb": "r_nb", "refined_reserve": "r_inv",
    "recovered_nb": "v_nb", "recovered_reserve": "v_inv", "missing_nb": "x_nb", "missing_reserve": "x_inv", "missing_keep_nb": "xk_nb", "missing_keep_reserve": "xk_inv",
    "missing_study_nb": "xs_nb", "missing_study_reserve": "xs_inv", "missing_add_nb": "xa_nb", "missing_add_reserve": "xa_inv",
    "matched_nb": "m_nb", "matched_inv": "m_inv", "matched_led": "m_led", "matched_gap": "m_inv - m_led", "led_nb": "m_nb + o_nb + l_nb + t_nb", "led_reserve": "m_led + o_led + l_led + t_led",
    "found_nb": "m_nb + l_nb", "late_nb": "l_nb", "late_led": "l_led", "late_inv": "l_inv", "late_obs_nb": "t_nb", "late_obs_led": "t_led", "only_nb": "o_nb", "only_led": "o_led",
    "metrics_nb": "u_nb", "metrics_inv": "u_inv", "metrics_led": "u_led", "metrics_gap": "u_inv - u_led", "total_rows": "all_nb", "classified_rows": "known_nb",
}

#: Rates in percent, one decimal, 0 where nothing is below.
RATES = {
    "coverage_inv": ("m_nb", "m_nb + x_nb"), "coverage_led": ("m_nb", "m_nb + l_nb + o_nb"), "recovery_late": ("l_nb", "l_nb + o_nb"), "recovery_all": ("m_nb + l_nb", "m_nb + l_nb + o_nb"),
    "shortfall": ("uk_inv - uk_led", "uk_inv"), "conformity": ("mk_nb", "ck_nb"), "metrics_gap_pct": ("u_inv - u_led", "u_inv"),
}


def pre_aggregate(df: DataFrame) -> DataFrame:
    """Counts and sums by label, action and late source: what all figures are made of."""
    if "late_source" not in df.columns:
        df = df.withColumn("late_source", F.lit(None).cast("string"))
    zero = F.lit(0).cast("decimal(28,2)")
    sums = {c: F.coalesce(F.sum(f"{c}_reserve").cast("decimal(28,2)"), zero).alias(c) for c in ("inv", "led")}
    return df.groupBy("recon_label", "action", "late_source").agg(F.count("*").alias("nb"), *sums.values(), F.count_if(F.coalesce(F.col("inv_reserve"), F.lit(0)) != 0).alias("inv_nonzero"))


def kpi_wide(df: DataFrame) -> DataFrame:
    """One row of all figures, and unknown_labels (comma-joined)."""
    base, picks = pre_aggregate(df), [F.coalesce(F.sum("nb"), F.lit(0)).cast("double").alias("all_nb")]
    for name, (labels, actions) in SUMS.items():
        mine = F.col("recon_label").isin(list(labels))
        mine = mine if actions is None else mine & F.col("action").isin(list(actions))
        picks += [F.coalesce(money(F.sum(F.when(mine, F.col(c)))), F.lit(0.0)).alias(f"{name}_{c}") for c in ("nb", "inv", "led")]
    unknown = F.array_join(F.array_sort(F.collect_set(F.when(~F.col("recon_label").isin(list(KNOWN)), F.col("recon_label")))), ",").alias("unknown_labels")
    sums = base.agg(*picks, unknown)
    figures = [rounded(F.expr(e)).alias(n) for n, e in FIGURES.items()] + [percent(F.expr(a), F.expr(b), 1, 0.0).alias(n) for n, (a, b) in RATES.items()]
    return sums.select(*figures, F.expr("all_nb = known_nb").alias("coherent"), "unknown_labels")


def kpi_header(df: DataFrame, fixed: str | None = None) -> DataFrame:
    """What stands above the figures: the inventory's date (given or found), whether every row has a known label, unknown labels."""
    sums = kpi_wide(df).select("coherent", "unknown_labels", F.lit(1).alias("one"))
    return inventory_date(df, fixed).withColumn("one", F.lit(1)).join(sums, "one").drop("one")


def kpi_summary(df: DataFrame) -> DataFrame:
    """The figures as rows (metric, value)."""
    wide = kpi_wide(df)
    names = [*FIGURES, *RATES]
    return wide.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])).alias("r")).select("r.*")


def kpi_by_action(df: DataFrame) -> DataFrame:
    """How each instruction fared: matched rows and residuals of the current inventory only."""
    m = F.col("recon_label").isin(list(MATCHED))
    rest = F.when(F.col("action") == "DELETE", INV_DELETE).otherwise(INV_MISSING)
    base = pre_aggregate(df).filter(F.col("action").isin(list(ACTION_ORDER)) & (m | (F.col("recon_label") == rest)))
    add = lambda c, only=None: F.coalesce(money(F.sum(F.when(m, F.col(c)) if only else F.col(c))), F.lit(0.0))
    out = base.groupBy("action").agg(add("nb").cast("long").alias("nb"), add("nb", 1).cast("long").alias("nb_matched"), add("inv_nonzero", 1).cast("long").alias("nb_nonzero"), add("inv", 1).alias("inv_reserve"), add("led", 1).alias("led_reserve"))
    delete = F.col("action") == "DELETE"
    out = out.withColumns({"nb_conform": F.when(delete, F.col("nb") - F.col("nb_matched")).otherwise(F.col("nb_matched")), "nb_zero": F.col("nb_matched") - F.col("nb_nonzero"), "gap": rounded(F.col("inv_reserve") - F.col("led_reserve")), "relevant": ~delete})
    return out.withColumns({
        "pct_conform": percent(F.col("nb_conform"), F.col("nb"), 1, 0.0), "pct_nonzero": percent(F.col("nb_nonzero"), F.col("nb_matched"), 1, 0.0),
        "pct_zero": percent(F.col("nb_zero"), F.col("nb_matched"), 1, 0.0), "shortfall_rate": percent(F.col("inv_reserve") - F.col("led_reserve"), F.col("inv_reserve"), 1, 0.0),
    })
