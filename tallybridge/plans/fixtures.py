"""The test sources, derived from orders and customer by SQL that reads the same in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import columns

YEAR = 1999

BASE = """
SELECT o.o_orderkey AS k, o.o_orderkey % 16 AS cls, CAST(o.o_custkey * 10 + o.o_orderkey % 5 AS STRING) AS person_id,
  concat(c.c_mktsegment, ' ', c.c_name) AS name, DATE '1950-01-01' + CAST((o.o_custkey * 37) % 18250 AS INT) AS birth_date,
  CAST(o.o_orderdate AS DATE) AS event, CASE o.o_orderstatus WHEN 'F' THEN 60 WHEN 'O' THEN 64 ELSE 70 END AS cov,
  CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,2)) AS amount, CAST(1000 + c.c_nationkey % 3 AS STRING) AS clause_no,
  CAST(floor(o.o_orderkey / 16) AS BIGINT) % 5 AS m5, CAST(floor(o.o_orderkey / 16) AS BIGINT) % 7 AS m7
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey"""

LEDGER = """
SELECT k AS id, person_id, CASE WHEN cls IN (7, 8, 12) THEN substr(name, 1, 20) ELSE name END AS full_name, birth_date, event AS event_date,
  cov AS coverage, amount AS reserve, concat('CPB_', clause_no) AS clause
FROM ({base}) b WHERE cls NOT IN (13, 14)"""

INVENTORY = """
SELECT k AS id, person_id, name AS full_name, birth_date,
  event + CASE WHEN cls IN (6, 8) THEN 3 WHEN cls IN (10, 12) THEN 20 WHEN cls = 15 THEN 40 ELSE 0 END AS event_date,
  cov + CASE WHEN cls = 9 THEN 4 ELSE 0 END AS coverage,
  CASE WHEN k % 97 = 0 THEN NULL ELSE CAST(amount * CASE m5 WHEN 0 THEN CAST(1.00 AS DECIMAL(3,2)) WHEN 1 THEN CAST(1.10 AS DECIMAL(3,2))
    WHEN 2 THEN CAST(0.95 AS DECIMAL(3,2)) WHEN 3 THEN CAST(1.80 AS DECIMAL(3,2)) ELSE CAST(0.60 AS DECIMAL(3,2)) END AS DECIMAL(18,2)) END AS reserve,
  CASE WHEN cls = 14 OR m7 = 4 THEN 'PM MRM à supprimer' WHEN m7 < 2 THEN 'PM MRM à conserver' WHEN m7 = 2 THEN 'PM à ajouter'
    WHEN m7 = 3 THEN 'PM MRM à étudier' WHEN m7 = 5 THEN 'Autre' END AS instruction,
  clause_no AS clause, 'PB' AS type, CASE WHEN k % 3 = 0 THEN 'OUI' ELSE 'NON' END AS status,
  CASE WHEN cls = 15 THEN DATE '2000-12-31' ELSE DATE '1999-12-31' - CAST(k % 31 AS INT) END AS inventory_date
FROM ({base}) b WHERE cls {which}"""

NOW, NEXT = "NOT IN (11, 15)", "= 15"

#: With older versions (half the reserve) and a second vision, under the source's own names.
RAW_LEDGER = """
SELECT k + v.n * 1000000000 AS led_id, CASE WHEN v.n = 2 THEN '2022' ELSE '2023' END AS vision, concat('CPB_', clause_no) AS clause, person_id AS n_rpp,
  name AS nom_prenom, birth_date AS date_de_naissance_de_l_assure, event AS date_de_l_arret_de_travail, CAST(year(event) AS INT) AS exercice_de_survenance,
  CASE WHEN v.n = 1 THEN CAST(amount * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,2)) ELSE amount END AS pm_au_31_12, cov AS terme_de_garantie,
  DATE '2024-01-31' + CAST(-31 * v.n AS INT) AS tech_day
FROM ({base}) b JOIN (SELECT 0 AS n UNION ALL SELECT 1 UNION ALL SELECT 2) v
  ON v.n = 0 OR (v.n = 1 AND k % 10 = 0) OR (v.n = 2 AND k % 20 = 19)
WHERE cls NOT IN (13, 14)"""


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    base = BASE.format(orders="{orders}", customer="{customer}")
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(text.replace("{base}", base), orders=read("orders"), customer=read("customer"))


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, RAW_LEDGER)


def plain_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, LEDGER)


def plain_inventory(spark: SparkSession, sf_dir: str, which: str = NOW) -> DataFrame:
    return _sql(spark, sf_dir, INVENTORY.replace("{which}", which))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.prefixed(columns.matching_keys(plain_ledger(spark, sf_dir)), "led_", columns.KEYS)


def inventory(spark: SparkSession, sf_dir: str, which: str = NOW) -> DataFrame:
    return columns.prefixed(columns.matching_keys(plain_inventory(spark, sf_dir, which)), "inv_", columns.KEYS)


def csv_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory as its file has it: all text, dd/MM/yyyy, a decimal comma; every 50th amount and date is bad."""
    df = plain_inventory(spark, sf_dir)
    reserve = F.regexp_replace(F.col("reserve").cast("string"), "\\.", ",")
    return df.select(
        F.col("id").cast("string").alias("inv_id"), F.col("instruction").alias("CONCLUSION_SYNTHESE"), F.col("person_id").alias("IDCORP"), F.col("full_name").alias("NOM_PRENOM"),
        F.date_format("birth_date", "dd/MM/yyyy").alias("DNASS0"), F.when(F.col("id") % 50 == 1, "31/02/1999").otherwise(F.date_format("event_date", "dd/MM/yyyy")).alias("DDSIA4"),
        F.col("coverage").cast("string").alias("CDGRCA"), F.col("status").alias("Statut_INV"), F.when(F.col("id") % 50 == 2, "n/a").otherwise(reserve).alias("PM_BASE_Revue_INV"),
        F.col("clause").alias("n_clause_ratta1"), F.col("type").alias("TYPE_CLAUSE"),
    )


def text_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw ledger with dates and amounts as text; every 50th event and amount is bad."""
    df, bad = raw_ledger(spark, sf_dir), F.col("led_id") % 50
    return df.withColumns({
        "date_de_naissance_de_l_assure": F.col("date_de_naissance_de_l_assure").cast("string"),
        "date_de_l_arret_de_travail": F.when(bad == 1, "1999-02-31").otherwise(F.col("date_de_l_arret_de_travail").cast("string")),
        "pm_au_31_12": F.when(bad == 2, "n/a").otherwise(F.col("pm_au_31_12").cast("string")), "terme_de_garantie": F.col("terme_de_garantie").cast("string"),
    })


def broken_files(spark: SparkSession, sf_dir: str, base: str) -> None:
    """The inventory as files of three kinds below base: ``a`` as it is, ``b`` with its columns in reverse order, a name with a
    delimiter in every 40th row and no status, ``c`` without a header."""
    df = csv_inventory(spark, sf_dir)
    number = F.col("inv_id").cast("long")
    torn = df.withColumn("NOM_PRENOM", F.when(number % 40 == 7, F.concat_ws(";", "NOM_PRENOM", F.lit("x"))).otherwise(F.col("NOM_PRENOM"))).drop("Statut_INV")
    plain = lambda x, name, header=True: x.write.option("header", header).option("sep", ";").option("quote", "\u0000").csv(f"{base}/{name}")
    plain(df.filter(number % 3 == 0), "a")
    plain(torn.filter(number % 3 == 1).select(*torn.columns[::-1]), "b")
    plain(df.filter(number % 300 == 2), "c", False)
