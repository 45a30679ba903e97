"""Runs a registered query and its SQL on the same tables and compares whole results."""

import glob
import os

import duckdb
import pandas as pd


def sql(sf_dir: str, text: str) -> pd.DataFrame:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con.sql(text).df()


def same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    a, b = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)
