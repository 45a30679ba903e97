"""Writing results: CSV, Parquet or any other format by path, and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def to_path(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", delimiter: str = ";", single: bool = False) -> None:
    """single: one file, for small tables only; otherwise Spark's partitions are written in parallel."""
    if fmt not in ("csv", "parquet", "orc", "json", "delta"):
        raise ValueError(f"unknown format {fmt}")
    writer = (df.coalesce(1) if single else df).write.mode(mode).format(fmt)
    (writer.option("header", True).option("sep", delimiter) if fmt == "csv" else writer).save(path)


def to_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet", merge_schema: bool = False, path: str | None = None, partition: str | None = None) -> None:
    """overwrite also replaces the schema. append keeps it: a frame with other columns is an error, unless merge_schema
    adds those that are new to the table (older rows have nulls) and fills those that the frame lacks with nulls.
    With a path the table's files lie there."""
    spark = df.sparkSession
    if mode == "append" and spark.catalog.tableExists(name):
        df = aligned(df, name, merge_schema)
        df.write.mode("append").insertInto(name)
        return
    writer = df.write.mode(mode).format(fmt)
    writer = writer.option("path", path) if path else writer
    writer = writer.partitionBy(partition) if partition else writer
    (writer.option("overwriteSchema", "true") if mode == "overwrite" else writer).saveAsTable(name)


def aligned(df: DataFrame, name: str, merge_schema: bool) -> DataFrame:
    """df with the columns of table ``name``, in its order; with merge_schema the table gets df's new ones first."""
    spark = df.sparkSession
    have, there = {c.lower(): f for c, f in zip(df.columns, df.schema)}, [c.lower() for c in spark.table(name).columns]
    new = [f for c, f in have.items() if c not in there]
    if not merge_schema and (new or set(there) - set(have)):
        raise ValueError(f"{name} has columns {there}, the rows have {list(have)}; merge_schema widens the table")
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    table = spark.table(name).schema
    return df.select(*[(F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in table])


def to_history(df: DataFrame, name: str, run_id: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Rows of one run in a table of all runs, partitioned by run_id, with run_ts. A run that is repeated replaces its own
    rows and no others; new columns widen the table."""
    spark = df.sparkSession
    df = df.withColumns({"run_ts": F.current_timestamp(), "run_id": F.lit(run_id)})
    if not spark.catalog.tableExists(name):
        to_table(df, name, "append", fmt, path=path, partition="run_id")
    else:
        own = run_id.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (run_id = '{own}') SELECT * FROM {{rows}}", rows=aligned(df, name, True).drop("run_id"))


def folder(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *[str(p).replace("/", "_") for p in parts if p]])


def export(spark: SparkSession, tables: dict[str, DataFrame], base: str, formats=("csv", "parquet"), schema: str | None = None, suffix: str = "", fmt: str = "parquet", delimiter: str = ";", single: bool = False) -> DataFrame:
    """All tables in all formats ("table": catalog tables in ``schema``). One failure does not stop the others.

    Returns (table, format, status, detail); tables without a schema are "skipped".
    """
    done = []
    for kind in formats:
        for name, df in tables.items():
            try:
                if kind == "table" and not schema:
                    done.append((name, kind, "skipped", "no schema"))
                    continue
                if kind == "table":
                    to_table(df, f"{schema}.{name}{'_' + suffix if suffix else ''}", fmt=fmt)
                else:
                    to_path(df, folder(base, kind, name), kind, delimiter=delimiter, single=single)
                done.append((name, kind, "written", ""))
            except Exception as e:  # noqa: BLE001  reported in the status
                done.append((name, kind, "failed", str(e).split("\n")[0][:200]))
    return spark.createDataFrame(done, "table string, format string, status string, detail string")


def export_mapped(tables: dict[str, DataFrame], names: dict[str, str], history=(), run_id: str | None = None, fmt: str = "parquet", base: str | None = None) -> list[str]:
    """Writes each table under its mapped name (files below base, if given); those in ``history`` keep the rows of other runs. Returns unknown keys."""
    for key, df in tables.items():
        if key in names:
            path = folder(base, names[key]) if base else None
            if key in history:
                to_history(df, names[key], run_id or "", fmt, path)
            else:
                to_table(df, names[key], fmt=fmt, path=path)
    return [k for k in tables if k not in names]
