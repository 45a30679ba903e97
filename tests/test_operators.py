import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallybridge.config import LEDGER_ONLY, Recon, year_of
from tallybridge.functions import numbers, text
from tallybridge.operators import columns, enrich, matching
from tallybridge.plans import analyses, fixtures, kpi, waterfall
from tallybridge.sources import sinks, tables

DAY = dt.date(1999, 3, 1)


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


def test_names(spark):
    assert one(spark, text.full_name(F.lit(" jean  Dupont "))) == "JEANDUPONT"
    assert one(spark, text.truncated_name(F.lit("REICHENAUER CHRISTELLE"))) == "REICHENAUERCHRISTEL"
    assert one(spark, text.truncated_name(F.lit("MOURA PINTO ANA ADELAIDE"))) == "MOURAPINTOANAADEL"
    assert one(spark, text.full_name(F.lit("Élo ïse"), strip_accents=True)) == "ELOISE"
    assert one(spark, text.full_name(F.lit("a b"), unicode_spaces=True)) == "AB"
    assert one(spark, text.full_name(F.lit(None).cast("string"))) is None


def test_amounts_and_dates(spark):
    amounts = [float(one(spark, numbers.amount(F.lit(x)))) for x in ("12,34", "1 234,5", "1 234,5", "-3")]
    assert amounts == [12.34, 1234.5, 1234.5, -3.0]
    assert one(spark, numbers.amount(F.lit("n/a"))) is None
    assert [one(spark, numbers.day(F.lit(x))) for x in ("31/12/2023", "31/02/2023", "2023-02-01")] == [dt.date(2023, 12, 31), None, None]


def test_classifier(spark):
    say = lambda x: one(spark, text.action(F.lit(x).cast("string")))
    assert [say(x) for x in ("PSAP à conserver et PM MRM à supprimer", "PM MRM à conserver ", "x", None)] == ["DELETE", "KEEP", None, None]
    assert say("PM dont l'ajout est à étudier") == "ADD"


def test_bins_percent_and_months(spark):
    bins = Recon().reserve_bins
    found = [one(spark, numbers.bin_label(F.lit(x).cast("double"), bins)) for x in (4999.99, 5000, 100000, None)]
    assert found == ["< 5K", "5K – 20K", "> 100K", "UNKNOWN"]
    assert one(spark, numbers.bin_rank(F.lit(None).cast("double"), bins)) == 99
    assert one(spark, numbers.percent(F.lit(5), F.lit(0), empty=0.0)) == 0.0
    assert one(spark, numbers.percent(F.lit(1), F.lit(8), 1)) == 12.5
    assert one(spark, numbers.month_label(F.lit(None).cast("int"))) is None
    category = lambda zero: one(spark, numbers.category(F.lit(None).cast("double"), F.lit(10.0), zero))
    assert (category(False), category(True)) == ("CONFORM", "OVER")


def test_projections(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert columns.select_and_rename(df, {"a": "x", "z": "y"}).columns == ["x"]
    for mapping, required in (({"z": "y"}, []), ({"a": "x", "z": "y"}, ["z"])):
        with pytest.raises(ValueError):
            columns.select_and_rename(df, mapping, required)
    assert columns.prefixed(df, "p_", ["b"]).columns == ["p_a", "b", "p_c"]
    assert columns.without_duplicate_names(df.toDF("a", "b", "a")).first().asDict() == {"a": 1, "b": 2}
    assert columns.tagged(df, client="C", a="new").columns == ["client", "a", "b", "c"]
    with pytest.raises(ValueError):
        columns.matching_keys(df)


def test_null_keys(spark):
    df = spark.createDataFrame([("p", None, DAY, DAY, 60), (None, "n", DAY, DAY, 60)], "person_id string, full_name string, birth_date date, event_date date, coverage int")
    assert [r.key_strict for r in columns.matching_keys(df).collect()] == [None, None]
    assert [r.key_strict for r in columns.matching_keys(df, null_parts="skip").collect()] == ["p199903011999030160", "199903011999030160N"]


def test_unknown_type_is_an_error(spark):
    with pytest.raises(ValueError):
        tables.load_ledger(spark.createDataFrame([("2023", "CPB_1")], "vision string, clause string"), Recon(types=("HPB",)))
    with pytest.raises(ValueError):
        tables.load_inventory(spark, None, Recon())
    with pytest.raises(ValueError):
        sinks.to_path(spark.range(1), "/tmp/never", "xls")


def sources(spark, ledger, inventory):
    """Rows (id, event day offset, coverage, name) of one person."""
    schema = "id long, person_id string, full_name string, birth_date date, event_date date, coverage int, reserve double, clause string, instruction string"
    day = lambda n: None if n is None else DAY + dt.timedelta(days=n)
    make = lambda rows: [(i, "p", name, DAY, day(n), cov, 1.0, "1", None) for i, n, cov, name in rows]
    frame = lambda rows, p: columns.prefixed(columns.matching_keys(spark.createDataFrame(make(rows), schema)), p, columns.KEYS)
    return frame(ledger, "led_"), frame(inventory, "inv_")


def found(spark, ledger, inventory, cfg=Recon()):
    out = waterfall.labels(waterfall.cascade(*sources(spark, ledger, inventory), cfg))
    return sorted(map(str, (tuple(r) for r in out.collect())))


@pytest.mark.parametrize(("days", "label"), [(0, "MATCH_EXACT"), (7, "MATCH_WINDOW"), (8, "MATCH_RELAPSE"), (30, "MATCH_RELAPSE"), (31, None), (None, None)])
def test_windows(spark, days, label):
    got = found(spark, [(1, 0, 60, "n")], [(9, days, 60, "n")])
    assert got == ([str((1, 9, label))] if label else sorted([str((1, None, LEDGER_ONLY)), str((None, 9, "INV_MISSING"))]))


def test_transition(spark):
    for led, inv, hit in ((64, 60, True), (60, 64, True), (65, 60, False)):
        assert ("MATCH_TRANSITION" in str(found(spark, [(1, 0, led, "n")], [(9, 0, inv, "n")]))) is hit
    assert "TRANSITION" not in str(found(spark, [(1, 0, 64, "n")], [(9, 0, 60, "n")], Recon(transition_offset=None)))
    assert "TRANSITION" not in str(found(spark, [(1, 0, 60, "n")], [(9, 0, 64, "n")], Recon(transition_signed=True)))


def test_consumption_fanout_and_nearest(spark):
    ledger, inventory = [(1, 3, 60, "n"), (2, 400, 60, "n")], [(9, 0, 60, "n")]
    assert found(spark, ledger, inventory) == sorted([str((1, 9, "MATCH_WINDOW")), str((2, None, LEDGER_ONLY))])
    assert found(spark, ledger, inventory, Recon(consume="key")) == [str((1, 9, "MATCH_WINDOW"))]
    twice = [(1, 0, 60, "n"), (2, 0, 60, "n")]
    assert len([x for x in found(spark, twice, inventory) if "EXACT" in x]) == 2
    assert len([x for x in found(spark, twice, inventory, Recon(one_to_one=True)) if "EXACT" in x]) == 1
    two = [(8, -7, 60, "n"), (9, 1, 60, "n")]
    assert str((1, 8, "MATCH_WINDOW")) in found(spark, [(1, 0, 60, "n")], two)
    assert str((1, 9, "MATCH_WINDOW")) in found(spark, [(1, 0, 60, "n")], two, Recon(pick="nearest"))


def test_delete_split_keeps_unknown(spark):
    df = spark.createDataFrame([(1, "DELETE"), (2, None), (3, "KEEP")], "id long, action string")
    delete, rest = matching.split_deletes(df)
    assert [r.id for r in delete.collect()] == [1] and sorted(r.id for r in rest.collect()) == [2, 3]


def test_orphan_tags(spark):
    rows = [(dt.date(1999, 11, 5), 50_000.0), (dt.date(1999, 3, 5), 20_000.0), (dt.date(1999, 3, 5), 20_000.01)]
    df = spark.createDataFrame([(LEDGER_ONLY, d, r) for d, r in rows], "recon_label string, led_event_date date, led_reserve double")
    assert [r.t for r in df.select(enrich.orphan_tag(Recon(inventory_year=1999)).alias("t")).collect()] == ["PROBABLY_LATE", "TO_ANALYSE", "HIGH_RESERVE"]


def test_late_recovery_takes_the_first_inventory(spark):
    led, inv = sources(spark, [(1, 0, 60, "n"), (2, 0, 70, "other")], [(9, 0, 99, "x")])
    wide = waterfall.reconcile(led, inv)
    later = [sources(spark, [], [(k, n, 60, "n")])[1] for k, n in ((20, 500), (30, 1))]
    got = {r.led_id: (r.recon_label, r.late_source, r.inv_id) for r in enrich.recover_late(wide, [("A", later[0]), ("B", later[1])]).collect()}
    assert got[1] == ("LEDGER_LATE", "A", 20) and got[2][0] == LEDGER_ONLY
    got = {r.led_id: r.late_source for r in enrich.recover_late(wide, [("A", later[0]), ("B", later[1])], Recon(late_days=30)).collect()}
    assert got[1] == "B"


def test_late_recovery_is_one_join_of_any_list(spark):
    led, inv = sources(spark, [(1, 0, 60, "n")], [(9, 0, 99, "x")])
    wide, later = waterfall.reconcile(led, inv), sources(spark, [], [(20, 5, 60, "n")])[1]
    joins = lambda n, cfg: enrich.recover_late(wide, [(f"N{k}", later) for k in range(n)], cfg)._jdf.queryExecution().optimizedPlan().toString().count("Join")
    for cfg in (Recon(), Recon(late_days=9)):
        assert joins(1, cfg) == joins(10, cfg)


def test_expected_counts(spark):
    expected = {
        "MATCH_EXACT": 5628, "MATCH_WINDOW": 826, "MATCH_TRUNC": 937, "MATCH_TRUNC_WINDOW": 887, "INV_DELETE": 1493,
        "MATCH_TRANSITION": 802, "MATCH_RELAPSE": 793, "MATCH_RELAPSE_TRUNC": 847, "LEDGER_ONLY": 2406, "INV_MISSING": 919,
    }
    sf = "/root/testdata/sf0.01"
    out = waterfall.labels(waterfall.cascade(fixtures.ledger(spark, sf), fixtures.inventory(spark, sf)))
    assert {r.recon_label: r["count"] for r in out.groupBy("recon_label").count().collect()} == expected


def test_key_figures_are_coherent(spark):
    df = spark.createDataFrame([("MATCH_EXACT", "KEEP", 10.0, 8.0), ("ODD", None, None, 1.0)], "recon_label string, action string, inv_reserve double, led_reserve double")
    row = kpi.kpi_wide(df.withColumns({c: F.col(c).cast(numbers.MONEY) for c in ("inv_reserve", "led_reserve")})).first()
    assert (row.total_rows, row.classified_rows, row.coherent, row.unknown_labels, row.shortfall) == (2, 1, False, "ODD", 20.0)


def test_export_status(spark, tmp_path):
    good = spark.createDataFrame([(1, "x")], "a int, b string")
    bad = spark.createDataFrame([(1,)], "a int").select(F.array("a").alias("a"))
    rows = {(r.table, r.format): r.status for r in sinks.export(spark, {"good": good, "bad": bad}, str(tmp_path), ("csv", "parquet", "table")).collect()}
    assert rows == {("good", "csv"): "written", ("bad", "csv"): "failed", ("good", "parquet"): "written", ("bad", "parquet"): "written", ("good", "table"): "skipped", ("bad", "table"): "skipped"}


def test_full_analysis_is_lazy_and_complete(spark):
    led, inv = fixtures.ledger(spark, "/root/testdata/sf0.001"), fixtures.inventory(spark, "/root/testdata/sf0.001")
    found = analyses.full_analysis(waterfall.reconcile(led, inv).withColumn("late_source", F.lit(None).cast("string")))
    assert len(found) == 7 and all(t.count() > 0 for t in found.values())


def test_rounding(spark):
    assert [one(spark, numbers.rounded(F.lit(x), p)) for x, p in ((-2.5, 0), (2.5, 0), (1.005, 2), (-1.005, 2), (0.125, 2))] == [-3.0, 3.0, 1.01, -1.01, 0.13]
    assert one(spark, numbers.rounded(F.lit(None).cast("double"))) is None


def test_year_of_a_date():
    assert [year_of(x) for x in ("31/12/2023", "2022", "auto", "", None)] == [2023, 2022, None, None, None]


def test_two_spellings_are_one_identity(spark):
    rows = [("MATCH_EXACT", "1", name, DAY, DAY, 60, reserve) for name, reserve in (("A B", 5.0), ("A  B", 7.0))] + [("MATCH_TRUNC", "2", "C", DAY, DAY, 60, 1.0)]
    df = spark.createDataFrame(rows, "recon_label string, inv_person_id string, inv_full_name string, inv_birth_date date, inv_event_date date, inv_coverage int, inv_reserve double")
    df = df.withColumn("inv_reserve", F.col("inv_reserve").cast("decimal(18,2)"))
    found = analyses.fanout_detail(df, 1).collect()
    assert [(r.inv_person_id, r.nb_ledger, r.inv_reserve, r.full_name) for r in found] == [("1", 2, 7.0, "A  B")]


def test_counts_are_observed_by_the_way(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([("OUI", "PB", "1"), ("NON", "PB", "1"), (None, "PB", "1"), ("OUI", "X", "1")], "Statut_INV string, TYPE_CLAUSE string, n_clause_ratta1 string")
    counts = Observation("perimeter")
    assert tables.inventory_perimeter(df, Recon(statuses=("OUI",)), counts).count() == 1
    assert counts.get == {"rows_in": 4, "kept_Statut_INV": 2, "kept_TYPE_CLAUSE": 1}


def test_prefixes_clauses_and_types(spark):
    raw = spark.createDataFrame([("2023", "CPB_1"), ("2023", "X_1"), ("2022", "CPB_1"), ("2023", None)], "vision string, clause string")
    assert tables.load_ledger(raw, Recon()).collect() == [("2023", "CPB_1")]
    with pytest.raises(ValueError):
        tables.load_ledger(raw, Recon(types=("HPB",)))


def test_history_keeps_other_runs_and_replaces_its_own(spark, tmp_path):
    name = "history_of_runs"
    make = lambda *rows: spark.createDataFrame(list(rows), "label string, nb long")
    for run, df in (("r'1", make(("a", 1), ("b", 2))), ("r2", make(("a", 3))), ("r'1", make(("c", 9)))):
        sinks.export_mapped({"h": df}, {"h": name}, ("h",), run, base=str(tmp_path))
    assert sorted(map(tuple, spark.table(name).select("run_id", "label", "nb").collect())) == [("r'1", "c", 9), ("r2", "a", 3)]
    sinks.to_history(make(("d", 4)).withColumn("more", F.lit(True)), name, "r3")  # a new column widens the history
    assert sorted(map(tuple, spark.table(name).select("run_id", "nb", "more").collect())) == [("r'1", 9, None), ("r2", 3, None), ("r3", 4, True)]
    spark.sql(f"DROP TABLE {name}")


def test_append_of_other_columns(spark, tmp_path):
    name = "append_target"
    sinks.to_table(spark.createDataFrame([(1, "x")], "a int, b string"), name, path=f"{tmp_path}/t")
    wider = spark.createDataFrame([(True, 2)], "c boolean, A int")
    with pytest.raises(ValueError):
        sinks.to_table(wider, name, "append")
    sinks.to_table(wider, name, "append", merge_schema=True)
    sinks.to_table(spark.createDataFrame([("y", 3, None)], "b string, a int, c boolean"), name, "append")
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "x", None), (2, None, True), (3, "y", None)]
    spark.sql(f"DROP TABLE {name}")


def test_inventory_files_of_other_layouts(spark, tmp_path):
    """By name whatever the order; torn rows and files without a header go to quarantine, quoted delimiters do not."""
    for k, text in enumerate(["IDCORP;NOM_PRENOM\n1;ANNA\n2;\"A;B\"\n3;C;D\n", "NOM_PRENOM;IDCORP\r\nBERT;4\r\nX\r\n", "﻿NOM_PRENOM;CDGRCA;IDCORP\nCARL;60;5\n", "6;DORA\n"]):
        (tmp_path / f"f{k}.csv").write_text(text)
    rows = tables.read_inventory(spark, str(tmp_path))
    assert sorted(map(tuple, tables.accepted(rows).select("IDCORP", "NOM_PRENOM", "CDGRCA").collect())) == [("1", "ANNA", None), ("2", "A;B", None), ("4", "BERT", None), ("5", "CARL", "60")]
    lost = {(r[tables.FILE].rsplit("/", 1)[1], r[tables.BROKEN].strip()) for r in tables.quarantined(rows).collect()}
    assert lost == {("f0.csv", "3;C;D"), ("f1.csv", "X"), ("f3.csv", "6;DORA")}
    counts = {r[tables.FILE].rsplit("/", 1)[1]: (r.rows_read, r.rows_broken) for r in tables.file_counts(rows).collect()}
    assert counts == {"f0.csv": (3, 1), "f1.csv": (2, 1), "f2.csv": (1, 0), "f3.csv": (1, 1)}
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "f.csv").write_text("a;b\n1;2\n")
    with pytest.raises(ValueError):
        tables.read_inventory(spark, str(tmp_path / "only"))


def test_means_are_exact(spark):
    """Half away from zero for either sign; more rows than a ten-digit count holds."""
    rows = [("a", "0.01"), ("a", "0.02"), ("b", "-0.01"), ("b", "-0.02"), ("c", None), ("d", "5.00"), ("d", None)]
    df = spark.createDataFrame(rows, "k string, x string").withColumn("x", F.col("x").cast(numbers.MONEY))
    assert {r.k: r.m for r in df.groupBy("k").agg(analyses.mean("x").alias("m")).collect()} == {"a": 0.02, "b": -0.02, "c": None, "d": 5.0}
    many = analyses.mean("x")._jc.toString()
    assert "decimal(20,0)" in many.lower()


def test_top_rows_cut(spark):
    rows = [("MATCH_EXACT", str(k), "n", DAY, DAY, 60, float(k)) for k in range(5) for _ in range(2 + k % 2)]
    df = spark.createDataFrame(rows, "recon_label string, inv_person_id string, inv_full_name string, inv_birth_date date, inv_event_date date, inv_coverage int, inv_reserve double")
    df = df.withColumn("inv_reserve", F.col("inv_reserve").cast("decimal(18,2)"))
    assert [r.inv_person_id for r in analyses.fanout_detail(df, 3).collect()] == ["3", "1", "4"]
    assert len(analyses.fanout_detail(df).collect()) == 5


def test_all_tables_come_from_one_scan(spark):
    """Tables of a collection read facts only, which are written from one scan of the result."""
    sf = "/root/testdata/sf0.001"
    wide = waterfall.reconcile(fixtures.ledger(spark, sf), fixtures.inventory(spark, sf)).withColumn("late_source", F.lit(None).cast("string"))
    for found in (analyses.full_analysis(wide), analyses.collected_analyses(wide)):
        for table in found.values():
            assert {x.rsplit("/", 2)[-2].rsplit("-", 1)[0] for x in table.inputFiles()} == {"facts"}


def test_sketch_estimates_do_not_depend_on_orders_and_parts(spark):
    """One whole sketch, in two orders, and parts of it that are merged; sketches of few rows among them."""
    ids = spark.range(20_000).select(
        F.col("id").cast("string").alias("inv_person_id"), F.lit(DAY).alias("inv_birth_date"), F.lit(DAY).alias("inv_event_date"), F.lit(60).alias("inv_coverage"),
        F.lit("MATCH_EXACT").alias("recon_label"), F.when(F.col("id") < 30, "few").when(F.col("id") < 700, "some").otherwise((F.col("id") % 3).cast("string")).alias("run"),
    )
    whole = [ids.coalesce(1).sort(order) for order in ("inv_person_id", F.desc("inv_person_id"))]
    found = [analyses.merged_identities(x).first().identities for x in (*[analyses.identity_sketches(df) for df in whole], analyses.identity_sketches(ids, "run"), analyses.identity_sketches(ids.repartition(7)))]
    assert len(set(found)) == 1 and abs(found[0] - 20_000) <= 600
