"""The cascade's modes on rows that share keys on both sides, against SQL; its plan; and persons with very many rows."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tallybridge.config import Recon
from tallybridge.plans import fixtures, oracles, waterfall

from .test_operators import DAY, sources

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def crowded():
    """Rows of one person: (id, day, coverage, name), many with equal keys, some without a date, a coverage or a name."""
    random.seed(11)
    names = ["n", "m", "a name of twenty letters", "a name of twenty letters and more", None]
    make = lambda n, first: [(first + k, random.choice([None, *range(0, 60, random.choice([1, 5]))]), random.choice([60, 60, 64, 68, None]), random.choice(names)) for k in range(n)]
    return make(160, 1), make(150, 1000)


def want(ledger, inventory, **how):
    con, out = duckdb.connect(), []
    for table, rows in (("led_in", ledger), ("inv_in", inventory)):
        con.execute(f"CREATE TABLE {table} (id BIGINT, person_id VARCHAR, full_name VARCHAR, birth_date DATE, event_date DATE, coverage INT, action VARCHAR)")
        con.executemany(f"INSERT INTO {table} VALUES (?, 'p', ?, DATE '{DAY}', DATE '{DAY}' + CAST(? AS INT), ?, NULL)", [[i, name, n, cov] for i, n, cov, name in rows])
        # the key's null parts are left out, but there is none without a name
        date = lambda c: f"coalesce(strftime({c}, '%Y%m%d'), '')"
        keys = {k: f"person_id || {date('birth_date')} || " + (f"{date('event_date')} || " if e else "") + ("coalesce(CAST(coverage AS VARCHAR), '') || " if c else "") + (oracles.CUT if t else oracles.FULL) for k, (e, c, t) in oracles.KEYS.items()}
        out.append(f"SELECT *, {', '.join(f'{sql} AS {k}' for k, sql in keys.items())} FROM {table}")
    cte = f"ledger AS MATERIALIZED ({out[0]}), inventory AS MATERIALIZED ({out[1]})"
    return sorted(con.execute(f"{oracles.cascade(sources=cte, **how)} SELECT * FROM labels").fetchall(), key=str)


MODES = {"row": {}, "key": {"consume": "key"}, "nearest": {"pick": "nearest"}, "nearest_key": {"pick": "nearest", "consume": "key"}, "one": {"one_to_one": True}, "one_key": {"one_to_one": True, "consume": "key"}}


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("hot", [1 << 20, 0])
def test_modes_equal_sql(spark, crowded, monkeypatch, mode, hot):
    """Also where the person is treated as one with too many rows for a task."""
    monkeypatch.setattr(waterfall, "HOT", hot)
    run = waterfall.cascade(*sources(spark, *crowded), Recon(**MODES[mode]))
    got = sorted(map(tuple, waterfall.labels(run).collect()), key=str)
    assert got == want(*crowded, **MODES[mode])
    counts = {r.side: r.rows_consumed for r in run.audit().collect()}
    assert counts == {"ledger": 160 - len({x[0] for x in got} - {None}), "inventory": 150 - len({x[1] for x in got} - {None})}


def test_one_to_one_uses_rows_once_and_leaves_none_beside_a_fitting_orphan(spark, crowded):
    got = waterfall.labels(waterfall.cascade(*sources(spark, *crowded), Recon(one_to_one=True))).collect()
    pairs = [(r.led_id, r.inv_id) for r in got if r.led_id and r.inv_id]
    assert len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs) > 20
    orphans = [[row for row in side if row[0] in {r[k] for r in got if r[1 - k] is None}] for k, side in enumerate(crowded)]
    assert not [(a, b) for a in orphans[0] for b in orphans[1] if a[1:] == b[1:] and a[3]]


def test_three_face_three(spark):
    rows = lambda first: [(first + k, 0, 60, "n") for k in range(3)]
    got = waterfall.labels(waterfall.cascade(*sources(spark, rows(1), rows(7)), Recon(one_to_one=True)))
    assert sorted((r.led_id, r.inv_id, r.recon_label) for r in got.collect()) == [(1, 7, "MATCH_EXACT"), (2, 8, "MATCH_EXACT"), (3, 9, "MATCH_EXACT")]


def test_nearest_of_very_many_rows_of_one_key(spark):
    """10^4 x 10^4 rows of one key: rows are carried along, no pairs are formed."""
    n = 10_000
    side = lambda p, first: spark.range(n).select(
        (F.col("id") + first).alias(f"{p}id"), F.lit("p").alias(f"{p}person_id"), F.lit("n").alias(f"{p}full_name"), F.lit(DAY).alias(f"{p}birth_date"),
        F.date_add(F.lit(DAY), (F.col("id") * 20 + (3 if first else 0)).cast("int")).alias(f"{p}event_date"), F.lit(60).alias(f"{p}coverage"), F.lit(None).cast("string").alias("inv_instruction"),
    )
    run = waterfall.cascade(side("led_", 0), side("inv_", n), Recon(pick="nearest"), last="MATCH_WINDOW")
    assert run.pairs.filter("inv_id = led_id + 10000 AND recon_label = 'MATCH_WINDOW'").count() == n


def test_one_exchange(spark, monkeypatch):
    """Both sides are dealt once, by person and birth date; the seven steps need no further exchange and no join."""
    seen = {}
    cut = waterfall.cut
    monkeypatch.setattr(waterfall, "cut", lambda df, name="cut": (seen.setdefault(name, df._jdf.queryExecution().executedPlan().toString()), cut(df, name))[1])
    waterfall.cascade(fixtures.ledger(spark, SF), fixtures.inventory(spark, SF))
    plan = seen["cascade"]
    assert plan.count("Exchange") == 1 and "Join" not in plan and plan.count("Window [") == 14


def test_sketch_finds_hot_persons(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("p"))
    found = df.select(F.call_function("approx_top_k", F.col("p"), F.lit(8), F.lit(64)).alias("x")).first().x
    assert found[0]["item"] == "hot" and found[0]["count"] >= 10_000


@pytest.mark.parametrize("mode", ["row", "nearest", "one"])
def test_rows_are_dealt_into_parts_by_their_number(spark, monkeypatch, mode):
    """A task's rows do not grow with the input, whatever number of shuffle partitions is set, and adaptive execution joins none."""
    monkeypatch.setattr(waterfall, "TASK_ROWS", 100, raising=False)
    plans, cut = [], waterfall.cut
    monkeypatch.setattr(waterfall, "cut", lambda df, name="cut": (plans.append(df._jdf.queryExecution().executedPlan().toString()), cut(df, name))[1])
    run = waterfall.cascade(fixtures.ledger(spark, SF), fixtures.inventory(spark, SF), Recon(**MODES[mode]))
    parts = -(-sum(n for _, n, _ in run.counts) // 100)
    dealt = [re.findall(r"hashpartitioning\(person#\d+, birth#\d+, (\d+)\), (\w+)", plan) for plan in plans[1:]]
    assert parts > 20 and all(found == [(str(parts), "REPARTITION_BY_NUM")] for found in dealt)


def test_slim_rows_lie_in_small_files(spark, monkeypatch, tmp_path):
    """A task that deals slim rows sorts what it reads; files of bounded rows bound that, as a task reads 32 of them at most."""
    monkeypatch.setattr(waterfall, "TASK_ROWS", 100)
    monkeypatch.setattr("tallybridge.plans.cut.shared_path", lambda _, name: f"{tmp_path}/{name}")
    waterfall.cascade(fixtures.ledger(spark, SF), fixtures.inventory(spark, SF), last="MATCH_EXACT")
    files = spark.read.parquet(f"{tmp_path}/slim-rows").groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count")).first()[0] <= 100 and files.count() > 8
    assert spark.conf.get("spark.sql.files.maxRecordsPerFile") == "0"
