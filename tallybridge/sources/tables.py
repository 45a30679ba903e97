"""Loading and cleaning the two sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Recon
from ..functions import numbers
from ..operators import columns

# Source columns and their names here.
LEDGER_COLUMNS = {
    "led_id": "id", "vision": "vision", "clause": "clause", "n_rpp": "person_id", "nom_prenom": "full_name",
    "date_de_naissance_de_l_assure": "birth_date", "date_de_l_arret_de_travail": "event_date", "exercice_de_survenance": "year",
    "pm_au_31_12": "reserve", "psap_au_31_12": "claims_reserve", "terme_de_garantie": "coverage",
    "date_de_mise_en_invalidite": "disability_date", "categorie_d_invalidite": "disability_category", "etat_de_dossier_a_l_extraction": "state",
}
INVENTORY_COLUMNS = {
    "inv_id": "id", "CONCLUSION_SYNTHESE": "instruction", "SINISTRE_MRM": "claim", "SINISTRE_DSN": "claim_dsn", "IDCORP": "person_id", "IDPMUN": "person_unit",
    "RPP_JURIDIQUE": "legal_person", "NOM_PRENOM": "full_name", "DNASS0": "birth_date", "DDSIA4": "event_date", "CDGRCA": "coverage", "Statut_INV": "status",
    "PM_BASE_Revue_INV": "reserve", "PM_Exo_INV": "exempt_reserve", "PSAP_TOTAL": "claims_reserve", "n_clause_ratta1": "clause", "TYPE_CLAUSE": "type",
    "IDSIX": "claim_no", "DTIRDI": "inventory_date", "DDRIAT": "disability_date",
}
LEDGER_KEYS = ["n_rpp", "exercice_de_survenance", "nom_prenom", "date_de_naissance_de_l_assure", "date_de_l_arret_de_travail", "terme_de_garantie"]
VERSION = "tech_day"


def prefixes(cfg: Recon) -> list[str]:
    unknown = [t for t in cfg.types if t not in cfg.type_prefixes]
    if unknown:
        raise ValueError(f"no ledger prefix for types {unknown}")
    return [cfg.type_prefixes[t] for t in cfg.types]


def ledger_perimeter(df: DataFrame, cfg: Recon) -> DataFrame:
    """One vision; the types' clauses, named or all that begin with a type's prefix."""
    own = prefixes(cfg)
    if cfg.clauses:
        inside = F.col("clause").isin([p + c for p in own for c in cfg.clauses])
    else:
        inside = F.lit(False)
        for p in own:
            inside = inside | F.col("clause").startswith(p)
    return df.filter((F.col("vision") == cfg.vision) & inside)


def load_ledger(source: DataFrame | str, cfg: Recon, spark: SparkSession | None = None) -> DataFrame:
    """The ledger (a frame, or the name of a table) within its perimeter; the filters reach the scan."""
    return ledger_perimeter(spark.table(source) if isinstance(source, str) else source, cfg)


#: Columns of inventory files that say where a row is from, and the text of a row that does not fit its file's header.
FILE, BROKEN = "_file", "_corrupt_record"


def layouts(spark: SparkSession, path: str, delimiter: str = ";", required: tuple[str, ...] = ("IDCORP", "NOM_PRENOM")) -> DataFrame:
    """(file, header) of each file below path; header is null where no line names the required columns. One row a file."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "[\\uFEFF\\r]", "").alias("value"))
    names = F.split("value", f"\\Q{delimiter}\\E")
    is_header = F.forall(F.array(*[F.lit(c) for c in required]), lambda c: F.array_contains(names, c))
    return lines.groupBy("file").agg(F.min(F.when(is_header, F.col("value"))).alias("header"))


def read_inventory(spark: SparkSession, path: str | None, delimiter: str = ";") -> DataFrame:
    """Inventory files, all columns text, plus _file and _corrupt_record.

    Every file is read by its own header, so files may have their columns in different orders or lack some (null).
    A row with more or fewer fields than its header, and every line of a file without a header, has _corrupt_record
    set and must not be used (see accepted and quarantined). No path is an error; no file with a header, too.
    """
    if not path:
        raise ValueError("no path for this inventory")
    kinds: dict[str | None, list[str]] = {}
    for file, header in layouts(spark, path, delimiter).collect():  # one row a file
        kinds.setdefault(header, []).append(file)
    lost = kinds.pop(None, [])
    if not kinds:
        raise ValueError(f"no inventory with a header below {path}")
    out = None
    for header, files in sorted(kinds.items()):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header.split(delimiter), BROKEN]])
        one = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("sep", delimiter).option("encoding", "UTF-8").option("nullValue", "").option("mode", "PERMISSIVE")
        one = one.option("columnNameOfCorruptRecord", BROKEN).option("columnPruning", False).csv(files).withColumn(FILE, F.col("_metadata.file_path"))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if lost:
        out = out.unionByName(spark.read.text(lost).select(F.col("value").alias(BROKEN), F.col("_metadata.file_path").alias(FILE)), allowMissingColumns=True)
    return out


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(BROKEN).isNull()).drop(BROKEN, FILE)


def quarantined(rows: DataFrame) -> DataFrame:
    """(_file, _corrupt_record, IDCORP as far as it was read) of rows that do not fit their file's header."""
    return rows.filter(F.col(BROKEN).isNotNull()).select(FILE, BROKEN, "IDCORP")


def file_counts(rows: DataFrame) -> DataFrame:
    """For each file: rows read, rows in quarantine, and accepted rows that name a person."""
    named = F.col(BROKEN).isNull() & F.col("IDCORP").isNotNull()
    return rows.groupBy(FILE).agg(F.count("*").alias("rows_read"), F.count(BROKEN).alias("rows_broken"), F.count_if(named).alias("rows_named"))


def load_inventory(spark: SparkSession, path: str | None, cfg: Recon, delimiter: str = ";") -> DataFrame:
    """The accepted rows of inventory files within their perimeter; which inventory (this or a later one) is the path's choice."""
    return inventory_perimeter(accepted(read_inventory(spark, path, delimiter)), cfg)


def _inventory_conditions(df: DataFrame, cfg: Recon) -> dict[str, Column]:
    wanted = {"Statut_INV": cfg.statuses, "TYPE_CLAUSE": cfg.types, "n_clause_ratta1": cfg.clauses}
    there = {c: values for c, values in wanted.items() if values and (c in df.columns or c == "n_clause_ratta1")}
    return {c: F.col(c).isin(list(values)) for c, values in there.items()}


def inventory_perimeter(df: DataFrame, cfg: Recon, counts: Observation | None = None) -> DataFrame:
    """Status, type and clause. counts, if given, gets rows_in and the rows that each condition lets through, by the way."""
    conditions = _inventory_conditions(df, cfg)
    if counts is not None:
        df = df.observe(counts, *perimeter_counts(conditions))
    for condition in conditions.values():
        df = df.filter(condition)
    return df


def perimeter_counts(conditions: dict[str, Column]) -> list[Column]:
    """Aggregates: rows_in, then kept_<column>, the rows left after that and the conditions before it."""
    out, so_far = [F.count(F.lit(1)).alias("rows_in")], F.lit(True)
    for name, condition in conditions.items():
        so_far = so_far & condition
        out.append(F.count_if(so_far).alias(f"kept_{name}"))
    return out


def count_perimeter(df: DataFrame, cfg: Recon) -> DataFrame:
    """The same counts as a row."""
    return df.agg(*perimeter_counts(_inventory_conditions(df, cfg)))


def clean_ledger(df: DataFrame, cfg: Recon) -> DataFrame:
    """Latest version of each record, our names, dates, keys; columns led_*, keys as they are."""
    if VERSION in df.columns:
        df = columns.keep_latest(df, LEDGER_KEYS, VERSION, *[c for c in ("led_id",) if c in df.columns])
    df = columns.select_and_rename(df, LEDGER_COLUMNS, ["n_rpp", "nom_prenom"])
    dates = [c for c in ("birth_date", "event_date", "disability_date") if c in df.columns]
    df = df.withColumns({c: F.col(c).try_cast("date") for c in dates} | {"reserve": F.col("reserve").try_cast(numbers.MONEY), "coverage": F.col("coverage").try_cast("int")})
    return columns.prefixed(columns.matching_keys(df, cfg.truncate), "led_", columns.KEYS)


def clean_inventory(df: DataFrame, cfg: Recon) -> DataFrame:
    """Our names, parsed dates and amounts, keys; columns inv_*, keys as they are. Duplicates stay (see keep_latest)."""
    df = columns.select_and_rename(df, INVENTORY_COLUMNS, ["IDCORP", "NOM_PRENOM"])
    has = lambda *names: [c for c in names if c in df.columns]
    parsed = {c: numbers.day(F.col(c)) for c in has("birth_date", "event_date", "inventory_date", "disability_date")}
    parsed |= {c: numbers.amount(F.col(c)) for c in has("reserve", "exempt_reserve", "claims_reserve")} | {"coverage": F.col("coverage").try_cast("int")}
    parsed |= {c: F.col(c).try_cast("long") for c in has("id")}
    return columns.prefixed(columns.matching_keys(df.withColumns(parsed), cfg.truncate), "inv_", columns.KEYS)


def rejects(raw: DataFrame, cleaned: dict) -> DataFrame:
    """For each parsed column the number of rows that had a value and lost it."""
    lost = [F.count_if(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "") & parsed.isNull()).alias(c) for c, parsed in cleaned.items()]
    return raw.agg(*lost)
