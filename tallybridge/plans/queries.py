"""One query per operator, over sources derived from orders and customer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LEDGER_LATE, LEDGER_ONLY, Recon, year_of
from ..functions import numbers, text
from ..operators import columns, enrich
from ..sources import sinks, tables
from . import analyses, fixtures, kpi, waterfall
from .cut import cut, shared_path

CFG = Recon(inventory_year=year_of(f"31/12/{fixtures.YEAR}"))


def recovered(spark: SparkSession, sf_dir: str, cfg: Recon = CFG) -> DataFrame:
    wide = cut(waterfall.reconcile(fixtures.ledger(spark, sf_dir), fixtures.inventory(spark, sf_dir), cfg), "reconciled")
    return enrich.recover_late(wide, [("N1", fixtures.inventory(spark, sf_dir, fixtures.NEXT))], cfg)


def result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled, tagged result, lazy; who reads it several times cuts it first."""
    return columns.derive_clause(enrich.with_tags(enrich.flag_late_observations(recovered(spark, sf_dir), CFG), CFG))


def load_filter_ledger(spark, sf_dir):
    cfg = Recon(clauses=("1000", "1002"))
    return tables.load_ledger(fixtures.raw_ledger(spark, sf_dir), cfg).select("led_id", "clause", "n_rpp", numbers.money(F.col("pm_au_31_12")).alias("reserve"))


def _csv(spark, sf_dir, cfg=Recon()):
    path = shared_path(spark, "inventory-csv")
    sinks.to_path(fixtures.csv_inventory(spark, sf_dir), path, "csv")
    return tables.load_inventory(spark, path, cfg)


def load_inventory_csv(spark, sf_dir):
    out = enrich.with_action(tables.clean_inventory(_csv(spark, sf_dir, Recon(statuses=("OUI",))), CFG))
    plain = ["person_id", "full_name", "birth_date", "event_date", "coverage"]
    return out.select("inv_id", *[F.col(f"inv_{c}").alias(c) for c in plain], numbers.money(F.col("inv_reserve")).alias("reserve"), "action")


def load_prefix_ledger(spark, sf_dir):
    """Two types, told by their prefixes."""
    cfg = Recon(types=("A", "B"), type_prefixes={"A": "CPB_1000", "B": "CPB_1002"})
    return tables.load_ledger(fixtures.raw_ledger(spark, sf_dir), cfg).groupBy("clause", "vision").agg(F.count("*").alias("nb"))


def load_inventory_clauses(spark, sf_dir):
    return _csv(spark, sf_dir, Recon(statuses=("NON",), clauses=("1000", "1001"))).groupBy("n_clause_ratta1", "Statut_INV").agg(F.count("*").alias("nb"))


def perimeter_counts(spark, sf_dir):
    out = tables.count_perimeter(fixtures.csv_inventory(spark, sf_dir), Recon(statuses=("OUI",), clauses=("1002",)))
    return out.withColumnsRenamed({c: c.lower() for c in out.columns})


def clean_ledger(spark, sf_dir):
    """Perimeter, latest versions, texts to dates and amounts, keys."""
    out = tables.clean_ledger(tables.load_ledger(fixtures.text_ledger(spark, sf_dir), CFG), CFG)
    plain = ["person_id", "full_name", "birth_date", "event_date", "coverage"]
    return out.select("led_id", *[F.col(f"led_{c}").alias(c) for c in plain], numbers.money(F.col("led_reserve")).alias("reserve"), "key_strict", "key_no_date_trunc")


def rename_prefix(spark, sf_dir):
    mapping = {"led_id": "led_id", "n_rpp": "person_id", "nom_prenom": "full_name", "terme_de_garantie": "coverage", "not_there": "other"}
    return columns.prefixed(columns.select_and_rename(fixtures.raw_ledger(spark, sf_dir), mapping), "led_", ["led_id"])


def keep_latest(spark, sf_dir):
    df = fixtures.raw_ledger(spark, sf_dir).filter(F.col("vision") == Recon.vision)
    return columns.keep_latest(df, tables.LEDGER_KEYS, tables.VERSION, "led_id").select("led_id", numbers.money(F.col("pm_au_31_12")).alias("reserve"), "tech_day")


def parse_amounts_dates(spark, sf_dir):
    df = fixtures.csv_inventory(spark, sf_dir)
    return df.select(F.col("inv_id").cast("long").alias("inv_id"), numbers.money(numbers.amount(F.col("PM_BASE_Revue_INV"))).alias("reserve"), numbers.day(F.col("DDSIA4")).alias("event_date"))


def parse_rejects(spark, sf_dir):
    raw = fixtures.csv_inventory(spark, sf_dir)
    lost = tables.rejects(raw, {"PM_BASE_Revue_INV": numbers.amount(F.col("PM_BASE_Revue_INV")), "DDSIA4": numbers.day(F.col("DDSIA4"))})
    return lost.select(F.col("PM_BASE_Revue_INV").alias("reserve"), F.col("DDSIA4").alias("event_date"))


def normalize_names(spark, sf_dir):
    df = fixtures.plain_ledger(spark, sf_dir)
    return df.select("id", text.full_name(F.col("full_name")).alias("full_name"), text.truncated_name(F.col("full_name")).alias("cut_name"))


def matching_keys(spark, sf_dir):
    return columns.matching_keys(fixtures.plain_ledger(spark, sf_dir)).select("id", *columns.KEYS)


def classify_instruction(spark, sf_dir):
    return fixtures.plain_inventory(spark, sf_dir).withColumn("action", text.action(F.col("instruction"))).groupBy("instruction", "action").agg(F.count("*").alias("nb"))


def bin_reserve(spark, sf_dir):
    df = fixtures.plain_inventory(spark, sf_dir)
    df = df.withColumns({"bin": numbers.bin_label(F.col("reserve"), CFG.reserve_bins), "bin_rank": numbers.bin_rank(F.col("reserve"), CFG.reserve_bins)})
    return df.groupBy("bin", "bin_rank").agg(F.count("*").alias("nb"), numbers.money(F.sum("reserve")).alias("reserve"))


def _cascade(spark, sf_dir, cfg=CFG, last=None):
    return waterfall.cascade(fixtures.ledger(spark, sf_dir), fixtures.inventory(spark, sf_dir), cfg, last)


def step(label: str):
    def query(spark, sf_dir):
        return _cascade(spark, sf_dir, last=label).pairs.filter(F.col("recon_label") == label).select("led_id", "inv_id")

    return query


def waterfall_labels(consume: str):
    def query(spark, sf_dir):
        return waterfall.labels(_cascade(spark, sf_dir, Recon(consume=consume))).groupBy("recon_label").agg(F.count("*").alias("nb"))

    return query


def waterfall_with(cfg: Recon):
    def query(spark, sf_dir):
        return waterfall.labels(_cascade(spark, sf_dir, cfg))

    return query


def waterfall_pairs(spark, sf_dir):
    return waterfall.labels(_cascade(spark, sf_dir))


def conservation_audit(spark, sf_dir):
    ledger, inventory = fixtures.ledger(spark, sf_dir), fixtures.inventory(spark, sf_dir)
    both = [waterfall.cascade(ledger, inventory, Recon(consume=c)).audit().withColumn("consume", F.lit(c)) for c in ("row", "key")]
    return both[0].unionByName(both[1])


def late_recovery_days(spark, sf_dir):
    """Only where the later event is at most 30 days away."""
    df = recovered(spark, sf_dir, Recon(late_days=30)).filter(F.col("recon_label").isin(LEDGER_ONLY, LEDGER_LATE))
    return df.select("led_id", "inv_id", "recon_label", "late_source")


def late_recovery(spark, sf_dir):
    df = recovered(spark, sf_dir).filter(F.col("recon_label").isin(LEDGER_ONLY, LEDGER_LATE))
    return df.select("led_id", "inv_id", "recon_label", "late_source", numbers.money(F.col("inv_reserve")).alias("inv_reserve"))


def late_recovery_list(spark, sf_dir):
    """Three later inventories: rows of the third appear in the first two, too, by parts; the first that fits within 60 days wins."""
    later = fixtures.inventory(spark, sf_dir, fixtures.NEXT)
    moved = lambda days: later.withColumn("inv_event_date", F.date_add("inv_event_date", days))
    lists = [("N1", moved(100).filter("inv_id % 2 = 0")), ("N2", moved(-20).filter("inv_id % 3 = 0").drop("inv_reserve")), ("N3", later)]
    df = enrich.recover_late(cut(waterfall.reconcile(fixtures.ledger(spark, sf_dir), fixtures.inventory(spark, sf_dir))), lists, Recon(late_days=60))
    df = df.filter(F.col("recon_label").isin(LEDGER_ONLY, LEDGER_LATE))
    return df.select("led_id", "inv_id", "recon_label", "late_source", "inv_event_date", numbers.money(F.col("inv_reserve")).alias("inv_reserve"))


def flag_late_obs(spark, sf_dir):
    return result(spark, sf_dir).groupBy("recon_label", "late_source").agg(F.count("*").alias("nb"))


def orphan_tags(spark, sf_dir):
    return result(spark, sf_dir).filter("orphan_tag IS NOT NULL").select("led_id", "orphan_tag")


def label_coherence(spark, sf_dir):
    wide = kpi.kpi_wide(result(spark, sf_dir))
    return wide.select(F.col("total_rows").cast("long").alias("total_rows"), F.col("classified_rows").cast("long").alias("classified_rows"))


def fanout_summary(spark, sf_dir):
    return analyses.fanout_summary(result(spark, sf_dir), fixtures.inventory(spark, sf_dir))


def export_roundtrip(spark, sf_dir):
    """Every collected analysis, written as CSV and Parquet and read again: rows, and the sum of their counts."""
    found = analyses.collected_analyses(cut(result(spark, sf_dir)), CFG, client="C1", scope="ALL")
    base = shared_path(spark, "export")
    status = sinks.export(spark, found, base)
    read = lambda fmt, name: spark.read.option("header", True).option("sep", ";").format(fmt).load(sinks.folder(base, fmt, name))
    return status.join(_sizes({(name, fmt): read(fmt, name) for name in found for fmt in ("csv", "parquet")}, ["table", "format"]), ["table", "format"])


def _sizes(found: dict[tuple[str, ...], DataFrame], names: list[str]) -> DataFrame:
    """Rows of each table and the sum of its counts."""
    out = None
    for keys, df in found.items():
        count = "nb_total" if "nb_total" in df.columns else "nb"
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(count).cast("long")).alias("nb")).select(*[F.lit(k).alias(n) for n, k in zip(names, keys)], "rows", "nb")
        out = one if out is None else out.unionByName(one)
    return out


def full_analysis(spark, sf_dir):
    return _sizes({(name,): df for name, df in analyses.full_analysis(cut(result(spark, sf_dir)), CFG).items()}, ["table"])


def catalog_tables(spark, sf_dir):
    """Counts by label in catalog tables: written over, and appended by two runs to a history; then read again."""
    counts, base = cut(flag_late_obs(spark, sf_dir)), shared_path(spark, "catalog")
    names = {"labels": f"labels_{base[-32:]}", "history": f"history_{base[-32:]}"}
    sinks.to_table(counts.limit(0), names["labels"], path=sinks.folder(base, names["labels"]))
    for run in ("run1", "run2", "run1"):  # a run that is repeated replaces its own rows
        unknown = sinks.export_mapped({"labels": counts, "history": counts, "other": counts}, names, ("history",), run, base=base)
    out = spark.table(names["labels"]).withColumn("run_id", F.lit("current")).unionByName(spark.table(names["history"]).drop("run_ts"))
    out = cut(out.withColumn("unknown", F.lit(",".join(unknown))))
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")
    return out


def catalog_evolution(spark, sf_dir):
    """A catalog table by label that is widened by the second append and lacks a column in the third."""
    df, base = fixtures.plain_inventory(spark, sf_dir), shared_path(spark, "evolution")
    name = f"evolution_{base[-32:]}"
    by = lambda *more: df.groupBy("clause").agg(F.count("*").alias("nb"), *more)
    sinks.to_table(by(), name, "append", path=sinks.folder(base, name))
    sinks.to_table(by(numbers.money(F.sum("reserve")).alias("reserve")), name, "append", merge_schema=True)
    sinks.to_table(by().select("clause"), name, "append", merge_schema=True)
    out = cut(spark.table(name))
    spark.sql(f"DROP TABLE {name}")
    return out


def export_tables(spark, sf_dir):
    """Collected analyses as catalog tables <schema>.<name>_<clause>, with the constant columns first; one is read again by value."""
    base = shared_path(spark, "schema")
    schema = f"recon_{base[-32:]}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{base}'")
    found = analyses.collected_analyses(cut(result(spark, sf_dir)), CFG, client="C1", scope="ALL")
    status = sinks.export(spark, {k: found[k] for k in ("instruction_global", "late_obs_breakdown")}, base, ("table",), schema, "1000")
    assert {tuple(r) for r in status.select("status", "detail").collect()} == {("written", "")}, status.collect()
    names = sorted(t.name for t in spark.catalog.listTables(schema))
    table_ = spark.table(f"{schema}.instruction_global_1000")
    out = cut(table_.withColumns({"tables": F.lit(",".join(names)), "first_columns": F.lit(",".join(table_.columns[:2]))}))
    spark.sql(f"DROP DATABASE {schema} CASCADE")
    return out


def inventory_quarantine(spark, sf_dir):
    """Files with columns in other orders, torn rows and no header: rows read, in quarantine, and names under the right column, by folder."""
    base = shared_path(spark, "inventory-files")
    fixtures.broken_files(spark, sf_dir, base)
    rows = cut(tables.read_inventory(spark, base), "inventory-rows")
    folder = F.regexp_extract(F.col(tables.FILE), "/([^/]+)/[^/]+$", 1).alias("folder")
    counts = tables.file_counts(rows).groupBy(folder).agg(F.sum("rows_read").alias("rows_read"), F.sum("rows_broken").alias("rows_broken"))
    good = rows.filter(F.col(tables.BROKEN).isNull())
    sums = good.groupBy(folder).agg(F.sum(F.col("IDCORP").cast("long")).alias("persons"), F.min("NOM_PRENOM").alias("first_name"), F.count("Statut_INV").alias("statuses"))
    return counts.join(sums, "folder", "left")


def fanout_sketch(spark, sf_dir):
    """Sketches of matched identities, stored by label and merged: as the sketch of all rows, and near the exact number."""
    df = cut(result(spark, sf_dir))
    stored = cut(analyses.identity_sketches(df, "recon_label"), "sketches")
    whole = analyses.merged_identities(analyses.identity_sketches(df)).withColumnRenamed("identities", "whole")
    exact = analyses.fanout_summary(df, fixtures.inventory(spark, sf_dir)).select(F.col("matched_identities").alias("exact"))
    both = analyses.merged_identities(stored).crossJoin(whole).crossJoin(exact)  # three rows of one
    return both.select("exact", (F.col("identities") == F.col("whole")).alias("merged_is_whole"), (F.abs(F.col("identities") - F.col("exact")) <= 0.03 * F.col("exact")).alias("is_near"))


def inventory_date(spark, sf_dir):
    return enrich.inventory_date(result(spark, sf_dir))


def kpi_header(spark, sf_dir):
    return kpi.kpi_header(cut(result(spark, sf_dir)))


def audit_detail(spark, sf_dir):
    df = analyses.audit_detail(result(spark, sf_dir))
    return df.select("led_id", "inv_id", "clause", "type", "action", "recon_label", "audit")


def table(of: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: of(result(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "load_filter_ledger": load_filter_ledger, "load_inventory_csv": load_inventory_csv, "rename_prefix": rename_prefix, "keep_latest": keep_latest,
    "parse_amounts_dates": parse_amounts_dates, "parse_rejects": parse_rejects, "normalize_names": normalize_names, "matching_keys": matching_keys,
    "load_prefix_ledger": load_prefix_ledger, "load_inventory_clauses": load_inventory_clauses, "perimeter_counts": perimeter_counts, "clean_ledger": clean_ledger,
    "classify_instruction": classify_instruction, "bin_reserve": bin_reserve,
    "step_exact": step("MATCH_EXACT"), "step_window": step("MATCH_WINDOW"), "step_truncated": step("MATCH_TRUNC"), "step_truncated_window": step("MATCH_TRUNC_WINDOW"),
    "step_transition": step("MATCH_TRANSITION"), "step_relapse": step("MATCH_RELAPSE"), "step_relapse_truncated": step("MATCH_RELAPSE_TRUNC"),
    "waterfall_labels_row": waterfall_labels("row"), "waterfall_labels_key": waterfall_labels("key"), "waterfall_pairs": waterfall_pairs, "conservation_audit": conservation_audit,
    "waterfall_nearest": waterfall_with(Recon(pick="nearest")), "waterfall_one_to_one": waterfall_with(Recon(one_to_one=True)), "waterfall_no_transition": waterfall_with(Recon(transition_offset=None)),
    "late_recovery": late_recovery, "late_recovery_days": late_recovery_days, "late_recovery_list": late_recovery_list, "flag_late_obs": flag_late_obs, "orphan_tags": orphan_tags, "orphan_tag_distribution": table(analyses.orphan_tag_distribution),
    "audit_summary": table(analyses.audit_summary), "instruction_ratios": table(analyses.instruction_ratios), "instruction_reserve": table(analyses.instruction_reserve),
    "instruction_global": table(analyses.instruction_global), "delete_not_followed": table(analyses.delete_not_followed),
    "shortfall_by_clause": table(analyses.shortfall_by_clause), "shortfall_by_action": table(analyses.shortfall_by_action), "provision_by_clause": table(analyses.provision_by_clause),
    "gap_bins": table(analyses.gap_bins), "provision_study": table(analyses.provision_study), "ledger_only_by_month": table(analyses.ledger_only_by_month),
    "inv_missing_by_month": table(analyses.inv_missing_by_month), "ledger_only_breakdown": table(analyses.ledger_only_breakdown), "late_obs_breakdown": table(analyses.late_obs_breakdown),
    "audit_detail": audit_detail, "fanout_detail": table(analyses.fanout_detail), "fanout_top": table(lambda df: analyses.fanout_detail(df, 30)), "fanout_summary": fanout_summary, "kpi_summary": table(kpi.kpi_summary), "kpi_by_action": table(kpi.kpi_by_action),
    "label_coherence": label_coherence, "inventory_date": inventory_date, "kpi_header": kpi_header, "full_analysis": full_analysis, "export_roundtrip": export_roundtrip,
    "catalog_tables": catalog_tables, "catalog_evolution": catalog_evolution, "export_tables": export_tables, "inventory_quarantine": inventory_quarantine,
    "fanout_first": table(lambda df: analyses.fanout_detail(df, 3)), "fanout_sketch": fanout_sketch,
}
