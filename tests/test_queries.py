"""Every query against its SQL, on the smallest tables."""

import duckdb
import pytest

from tallybridge.functions import numbers
from tallybridge.plans import kpi, oracles, queries
from tallybridge.plans.cut import cut

SF = "/root/testdata/sf0.001"


def plain(df, columns):
    """Rows with nulls as None, dates as text, in an order of their own."""
    rows = df[columns].astype(object).where(df[columns].notna(), None).values.tolist()
    return sorted(([str(v)[:10] if hasattr(v, "year") else v for v in r] for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("orders", "customer"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.fixture(scope="module", autouse=True)
def one_result(spark):
    """The labelled result is computed once for all analyses."""
    made, kept = queries.result, {}
    queries.result = lambda spark, sf_dir: kept.get(sf_dir) or kept.setdefault(sf_dir, cut(made(spark, sf_dir)))
    yield
    queries.result = made


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_equals_sql(spark, duck, name):
    got, want = queries.QUERIES[name](spark, SF).toPandas(), duck.sql(oracles.ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert plain(got, columns) == plain(want, columns)


def test_independent_sql(spark, duck, monkeypatch):
    """SQL does not take its values from the code under test: a wrong month, bin or formula shows."""
    monkeypatch.setattr(numbers, "MONTHS", ("Juin",) * 12)
    monkeypatch.setitem(kpi.FIGURES, "matched_gap", "m_led - m_inv")
    for name in ("ledger_only_by_month", "kpi_summary"):
        got, want = queries.QUERIES[name](spark, SF).toPandas(), duck.sql(oracles.ORACLES[name]).df()
        assert plain(got, sorted(want.columns)) != plain(want, sorted(want.columns))
