"""SQL for every query: the fixture, the cascade as chained CTEs, and a SELECT for each table.

Labels, phrases, bins and formulas are written out here, so that a slip in the code under test shows.
"""

from __future__ import annotations

from . import fixtures

FULL = "regexp_replace(upper(trim(full_name)), '\\s+', '', 'g')"
CUT = "regexp_replace(substr(upper(trim(full_name)), 1, 20), '\\s+', '', 'g')"
# Labels, months, bins (low, high, label), order of actions.
MATCH = "'MATCH_EXACT', 'MATCH_WINDOW', 'MATCH_TRUNC', 'MATCH_TRUNC_WINDOW', 'MATCH_TRANSITION', 'MATCH_RELAPSE', 'MATCH_RELAPSE_TRUNC'"
KNOWN = f"{MATCH}, 'INV_DELETE', 'INV_MISSING', 'LEDGER_ONLY', 'LEDGER_LATE', 'LEDGER_LATE_OBS'"
MONTHS = "['Jan', 'Fév', 'Mar', 'Avr', 'Mai', 'Jun', 'Jul', 'Aoû', 'Sep', 'Oct', 'Nov', 'Déc']"
RESERVE_BINS = [(None, 5000, "< 5K"), (5000, 20000, "5K – 20K"), (20000, 50000, "20K – 50K"), (50000, 100000, "50K – 100K"), (100000, None, "> 100K")]
GAP_BINS = [(None, 1000, "< 1K"), (1000, 5000, "1K – 5K"), (5000, 10000, "5K – 10K"), (10000, 50000, "10K – 50K"), (50000, 100000, "50K – 100K"), (100000, None, "> 100K")]
ACTIONS = "['KEEP', 'STUDY', 'ADD', 'DELETE']"
KAS = "action IN ('KEEP', 'ADD', 'STUDY')"


def _key(event: bool, cov: bool, cut: bool) -> str:
    date = lambda c: f"strftime({c}, '%Y%m%d')"
    parts = ["person_id", date("birth_date"), *([date("event_date")] if event else []), *(["CAST(coverage AS VARCHAR)"] if cov else []), CUT if cut else FULL]
    return " || ".join(parts)


KEYS = {"key_strict": (True, True, False), "key_no_date": (False, True, False), "key_strict_trunc": (True, True, True), "key_no_date_trunc": (False, True, True), "key_no_coverage": (True, False, False)}
KEY_COLUMNS = ", ".join(f"{_key(*parts)} AS {name}" for name, parts in KEYS.items())
ACTION = """CASE WHEN contains(lower(trim(instruction)), 'pm mrm à conserver') THEN 'KEEP' WHEN contains(lower(trim(instruction)), 'pm à ajouter') THEN 'ADD'
  WHEN contains(lower(trim(instruction)), 'pm dont l''ajout est à étudier') THEN 'ADD' WHEN contains(lower(trim(instruction)), 'pm mrm à étudier') THEN 'STUDY'
  WHEN contains(lower(trim(instruction)), 'psap à conserver et pm mrm à supprimer') THEN 'DELETE' WHEN contains(lower(trim(instruction)), 'pm mrm à supprimer') THEN 'DELETE' END"""


def base(sql: str, which: str = fixtures.NOW) -> str:
    return sql.replace("{base}", fixtures.BASE.format(orders="orders", customer="customer")).replace("{which}", which)


SOURCES = f"""
ledger AS MATERIALIZED (SELECT *, {KEY_COLUMNS} FROM ({base(fixtures.LEDGER)}) s),
inventory AS MATERIALIZED (SELECT *, {ACTION} AS action, {KEY_COLUMNS} FROM ({base(fixtures.INVENTORY)}) s),
later AS MATERIALIZED (SELECT *, {ACTION} AS action, {KEY_COLUMNS} FROM ({base(fixtures.INVENTORY, fixtures.NEXT)}) s)"""

NEAR = "abs(date_diff('day', r.event_date, l.event_date))"
STEPS = [
    ("MATCH_EXACT", "key_strict", "true"),
    ("MATCH_WINDOW", "key_no_date", f"{NEAR} <= 7"),
    ("MATCH_TRUNC", "key_strict_trunc", "true"),
    ("MATCH_TRUNC_WINDOW", "key_no_date_trunc", f"{NEAR} <= 7"),
    ("MATCH_TRANSITION", "key_no_coverage", "abs(l.coverage - r.coverage) = 4"),
    ("MATCH_RELAPSE", "key_no_date", f"l.coverage = r.coverage AND {NEAR} BETWEEN 1 AND 30"),
    ("MATCH_RELAPSE_TRUNC", "key_no_date_trunc", f"l.coverage = r.coverage AND {NEAR} BETWEEN 1 AND 30"),
]


def cascade(consume: str = "row", steps: int = len(STEPS), pick: str = "first", one_to_one: bool = False, leave_out: str = "", sources: str = "") -> str:
    """CTEs up to ``labels`` (led_id, inv_id, recon_label)."""
    out = [sources or SOURCES, "led0 AS (SELECT * FROM ledger)", "inv0 AS (SELECT * FROM inventory)", "inv_delete AS (SELECT * FROM inventory WHERE false)"]
    done = []
    for n, (label, key, condition) in enumerate(STEPS[:steps], 1):
        before = f"inv{n - 1}"
        if label == "MATCH_TRANSITION":
            out[3] = ""
            out += [f"inv_delete AS MATERIALIZED (SELECT * FROM {before} WHERE coalesce(action = 'DELETE', false))", f"inv{n - 1}k AS MATERIALIZED (SELECT * FROM {before} WHERE NOT coalesce(action = 'DELETE', false))"]
            before = f"inv{n - 1}k"
        if label == leave_out:
            out += [f"led{n} AS (SELECT * FROM led{n - 1})", f"inv{n} AS (SELECT * FROM {before})"]
            continue
        done.append(n)
        reps = f"(SELECT * FROM {before} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY event_date, id) = 1)" if pick == "first" else before
        best = "" if pick == "first" else f"QUALIFY row_number() OVER (PARTITION BY l.id ORDER BY {NEAR}, r.id) = 1"
        pairs = f"SELECT l.id AS led_id, r.id AS inv_id, '{label}' AS recon_label, l.{key} AS key FROM led{n - 1} l JOIN {reps} r ON l.{key} = r.{key} WHERE {condition} {best}"
        out.append(f"pairs{n} AS MATERIALIZED ({assignment(label, key, condition, f'led{n - 1}', before) if one_to_one else pairs})")
        gone = (lambda col: f"({key} IS NULL OR {key} NOT IN (SELECT key FROM pairs{n}))") if consume == "key" else (lambda col: f"id NOT IN (SELECT {col} FROM pairs{n})")  # noqa: B023
        out += [f"led{n} AS MATERIALIZED (SELECT * FROM led{n - 1} WHERE {gone('led_id')})", f"inv{n} AS MATERIALIZED (SELECT * FROM {before} WHERE {gone('inv_id')})"]
    parts = [f"SELECT led_id, inv_id, recon_label FROM pairs{n}" for n in done]
    parts += ["SELECT NULL::BIGINT, id, 'INV_DELETE' FROM inv_delete", f"SELECT id, NULL::BIGINT, 'LEDGER_ONLY' FROM led{steps}", f"SELECT NULL::BIGINT, id, 'INV_MISSING' FROM inv{steps}"]
    out.append(f"labels AS MATERIALIZED ({' UNION ALL '.join(parts)})")
    return "WITH " + ",\n".join(x for x in out if x)


def assignment(label: str, key: str, condition: str, ledger: str, inventory: str) -> str:
    """One to one: of a key's fitting pairs, by days apart and ids, each whose rows no earlier pair has taken."""
    free = "list_contains(list_transform(taken, lambda p: p.l), x[1].l) OR list_contains(list_transform(taken, lambda p: p.i), x[1].i)"
    listed = f"list([{{'l': l.id, 'i': r.id}}] ORDER BY coalesce({NEAR}, 0), r.id, l.id)"
    return f"""SELECT p.l AS led_id, p.i AS inv_id, '{label}' AS recon_label, key FROM (SELECT key, unnest(list_reduce(pairs, lambda taken, x: CASE WHEN {free} THEN taken ELSE taken || x END)) AS p
      FROM (SELECT l.{key} AS key, {listed} AS pairs FROM {ledger} l JOIN {inventory} r ON l.{key} = r.{key} WHERE {condition} GROUP BY l.{key}))"""


def _side(prefix: str, alias: str, names: str) -> str:
    return ", ".join(f"{alias}.{c} AS {prefix}_{c}" for c in names.split())


LED, INV = "person_id full_name birth_date event_date coverage reserve clause", "person_id full_name birth_date event_date coverage reserve instruction clause type status inventory_date"
LATE_ROW = "late_reps AS MATERIALIZED (SELECT * FROM later QUALIFY row_number() OVER (PARTITION BY key_no_date ORDER BY event_date, id) = 1)"
RESULT = f"""{cascade()},
{LATE_ROW},
recovered AS MATERIALIZED (
  SELECT s.led_id, coalesce(s.inv_id, n.id) AS inv_id, CASE WHEN n.id IS NOT NULL THEN 'LEDGER_LATE' ELSE s.recon_label END AS recon_label, CASE WHEN n.id IS NOT NULL THEN 'N1' END AS late_source
  FROM labels s LEFT JOIN ledger l ON s.led_id = l.id LEFT JOIN late_reps n ON s.recon_label = 'LEDGER_ONLY' AND l.key_no_date = n.key_no_date),
wide AS MATERIALIZED (
  SELECT r.led_id, r.inv_id, r.recon_label AS first_label, r.late_source AS first_source, {_side("led", "l", LED)}, {_side("inv", "i", INV)}, i.action
  FROM recovered r LEFT JOIN ledger l ON r.led_id = l.id
  LEFT JOIN (SELECT *, false AS is_later FROM inventory UNION ALL SELECT *, true FROM later) i ON r.inv_id = i.id AND i.is_later = (r.recon_label = 'LEDGER_LATE')),
result AS MATERIALIZED (
  SELECT * EXCLUDE (first_label, first_source),
    CASE WHEN first_label = 'LEDGER_ONLY' AND led_coverage = 60 AND month(led_event_date) IN (11, 12) AND year(led_event_date) = {fixtures.YEAR} THEN 'LEDGER_LATE_OBS' ELSE first_label END AS recon_label,
    CASE WHEN first_label = 'LEDGER_ONLY' AND led_coverage = 60 AND month(led_event_date) IN (11, 12) AND year(led_event_date) = {fixtures.YEAR} THEN 'LATE_OBSERVATION' ELSE first_source END AS late_source,
    coalesce(inv_clause, regexp_replace(led_clause, '^[A-Za-z]+_', '')) AS clause, inv_type AS type,
    recon_label IN ({MATCH}) AS m, coalesce(inv_reserve, 0) AS inv0, coalesce(led_reserve, 0) AS led0,
    CASE WHEN led_reserve < inv_reserve THEN 'UNDER' WHEN led_reserve > inv_reserve THEN 'OVER' ELSE 'CONFORM' END AS category,
    CASE WHEN led0 < inv0 THEN 'UNDER' WHEN led0 > inv0 THEN 'OVER' ELSE 'CONFORM' END AS category0,
    CASE WHEN recon_label = 'LEDGER_ONLY' THEN CASE WHEN month(led_event_date) IN (11, 12) AND year(led_event_date) = {fixtures.YEAR} THEN 'PROBABLY_LATE' WHEN led_reserve > 20000 THEN 'HIGH_RESERVE' ELSE 'TO_ANALYSE' END END AS orphan_tag
  FROM wide)
"""


def d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def r(x: str, places: int = 2) -> str:
    """Rounded from eight decimal digits: of 15 that a double holds, amounts of up to 10^7 leave eight behind the point; more would show its binary tail."""
    return f"CAST(round(CAST(CAST({x} AS DOUBLE) AS DECIMAL(38, 8)), {places}) AS DOUBLE)"


def pct(a: str, b: str, places: int = 2, empty: str = "NULL") -> str:
    return f"CASE WHEN ({b}) IS NULL OR CAST({b} AS DOUBLE) = 0 OR ({a}) IS NULL THEN {empty} ELSE {r(f'CAST({a} AS DOUBLE) * 100.0::DOUBLE / CAST({b} AS DOUBLE)', places)} END"


def share(col: str, *within: str, places: int = 2) -> str:
    over = f"PARTITION BY {', '.join(within)}" if within else ""
    return pct(col, f"sum({col}) OVER ({over})", places)


def mean(x: str) -> str:
    """Of amounts that are not negative, as all reserves and absolute gaps here are (half up is half away from zero for them), by whole numbers: cents."""
    return f"CASE WHEN count({x}) = 0 THEN NULL ELSE CAST((2 * CAST(sum({x}) * 100 AS HUGEINT) + count({x})) // (2 * count({x})) AS DOUBLE) / 100 END"


def bins(x: str, table, rank: bool) -> str:
    out = [f"WHEN {x} >= {low} AND {x} < {high}" if low is not None and high is not None else f"WHEN {x} < {high}" if low is None else f"WHEN {x} >= {low}" for low, high, _ in table]
    what = [str(k) if rank else f"'{row[2]}'" for k, row in enumerate(table)]
    return "CASE " + " ".join(f"{o} THEN {w}" for o, w in zip(out, what)) + (" ELSE 99 END" if rank else " ELSE 'UNKNOWN' END")


def both_bins(x: str, table=RESERVE_BINS) -> str:
    return f"{bins(x, table, False)} AS bin, CAST({bins(x, table, True)} AS INT) AS bin_rank"


def n_if(condition: str) -> str:
    return f"CAST(count(*) FILTER ({condition}) AS BIGINT)"


def total_if(x: str, condition: str) -> str:
    return f"coalesce({d(f'sum({x}) FILTER ({condition})')}, 0)"


U = f"(m OR recon_label = 'LEDGER_LATE')"
SUMS = f"count(*) AS nb, {d('sum(inv_reserve)')} AS inv_reserve, {d('sum(led_reserve)')} AS led_reserve"
SUMS0 = f"count(*) AS nb, {d('sum(inv0)')} AS inv_reserve, {d('sum(led0)')} AS led_reserve"


def _shortfall(inv: str, led: str, category: str) -> str:
    return f"""count(*) AS nb, {n_if(f"{category} = 'UNDER'")} AS nb_under, {n_if(f"{category} = 'OVER'")} AS nb_over, {n_if(f"{category} = 'CONFORM'")} AS nb_conform,
      {d(f'sum({inv})')} AS inv_reserve, {d(f'sum({led})')} AS led_reserve, {d(f'sum({inv} - {led})')} AS gap, {d(f'sum(abs({inv} - {led}))')} AS gap_abs,
      {total_if(f'abs({inv} - {led})', f"{category} = 'UNDER'")} AS gap_under, {total_if(f'abs({inv} - {led})', f"{category} = 'OVER'")} AS gap_over"""


def _by_month(date: str, reserve: str, extra: str, where: str) -> str:
    return f"""{RESULT} SELECT clause, type, {extra} CAST(year({date}) AS INT) AS year, CAST(month({date}) AS INT) AS month, {MONTHS}[month({date})] AS month_label, month({date}) IN (10, 11, 12) AS year_end,
    {both_bins(reserve)}, count(*) AS nb, {d(f'sum({reserve})')} AS reserve, {mean(reserve)} AS reserve_mean FROM result WHERE {where} GROUP BY ALL"""


def _breakdown(label: str, days: bool) -> str:
    grouped = f"SELECT year(led_event_date)::INT AS year, month(led_event_date)::INT AS month, led_coverage AS coverage, count(*) AS nb, {d('sum(led_reserve)')} AS reserve, {mean('led_reserve')} AS reserve_mean"
    if not days:
        return f"{RESULT} {grouped} FROM result WHERE recon_label = '{label}' GROUP BY 1, 2, 3"
    return f"""{RESULT}, g AS ({grouped}, min(day(led_event_date))::INT AS first_day FROM result WHERE recon_label = '{label}' GROUP BY 1, 2, 3),
    days AS (SELECT year(led_event_date)::INT AS year, month(led_event_date)::INT AS month, led_coverage AS coverage, day(led_event_date)::INT AS modal_day FROM result WHERE recon_label = '{label}'
      GROUP BY 1, 2, 3, 4 QUALIFY row_number() OVER (PARTITION BY year(led_event_date)::INT, month(led_event_date)::INT, led_coverage ORDER BY count(*) DESC, day(led_event_date)::INT) = 1)
    SELECT g.*, modal_day FROM g JOIN days USING (year, month, coverage)"""


METRICS = f"{MATCH}, 'LEDGER_LATE'"
MISSING_KEEP, MISSING_STUDY, MISSING_ADD = ("recon_label = 'INV_MISSING' AND action = '" + a + "'" for a in ("KEEP", "STUDY", "ADD"))


def _figures() -> list[tuple[str, str]]:
    """Each figure as SQL over result."""
    one = lambda *labels: "recon_label IN (" + ", ".join(f"'{x}'" for x in labels) + ")"
    nb = lambda where: f"CAST(count(*) FILTER ({where}) AS DOUBLE)"
    inv, led = (lambda where, c=c: total_if(c, where) for c in ("inv_reserve", "led_reserve"))
    matched, metrics = f"recon_label IN ({MATCH})", f"recon_label IN ({METRICS})"
    principal, refined, recovered = one("MATCH_EXACT", "MATCH_WINDOW"), one("MATCH_TRUNC", "MATCH_TRUNC_WINDOW", "MATCH_TRANSITION"), one("MATCH_RELAPSE", "MATCH_RELAPSE_TRUNC")
    out = []
    for name, where in [
        ("to_delete", one("INV_DELETE")), ("principal", principal), ("refined", refined), ("recovered", recovered), ("missing", one("INV_MISSING")),
        ("missing_keep", MISSING_KEEP), ("missing_study", MISSING_STUDY), ("missing_add", MISSING_ADD),
    ]:
        out += [(f"{name}_nb", nb(where)), (f"{name}_reserve", inv(where))]
    whole, compared = f"({matched} OR recon_label IN ('INV_DELETE', 'INV_MISSING'))", f"({matched} OR recon_label = 'INV_MISSING')"
    books = f"({matched} OR recon_label IN ('LEDGER_ONLY', 'LEDGER_LATE', 'LEDGER_LATE_OBS'))"
    out += [("inv_nb", nb(whole)), ("inv_reserve", inv(whole)), ("to_compare_nb", nb(compared)), ("to_compare_reserve", inv(compared)), ("led_nb", nb(books)), ("led_reserve", led(books))]
    out += [("matched_nb", nb(matched)), ("matched_inv", inv(matched)), ("matched_led", led(matched)), ("matched_gap", f"{inv(matched)} - {led(matched)}"), ("found_nb", nb(metrics))]
    late, obs, only = one("LEDGER_LATE"), one("LEDGER_LATE_OBS"), one("LEDGER_ONLY")
    out += [("late_nb", nb(late)), ("late_led", led(late)), ("late_inv", inv(late)), ("late_obs_nb", nb(obs)), ("late_obs_led", led(obs)), ("only_nb", nb(only)), ("only_led", led(only))]
    out += [("metrics_nb", nb(metrics)), ("metrics_inv", inv(metrics)), ("metrics_led", led(metrics)), ("metrics_gap", f"{inv(metrics)} - {led(metrics)}")]
    return [*out, ("total_rows", "CAST(count(*) AS DOUBLE)"), ("classified_rows", nb(f"recon_label IN ({KNOWN})"))]


def _rates() -> list[tuple[str, str, str]]:
    """Each rate as numerator and denominator over result."""
    n = lambda where: f"count(*) FILTER ({where})"
    s_if = lambda c, where: f"CAST(coalesce(sum({c}) FILTER ({where}), 0) AS DOUBLE)"
    reconcilable, kept = f"recon_label IN ({METRICS}, 'LEDGER_ONLY')", f"recon_label IN ({METRICS}) AND {KAS}"
    return [
        ("coverage_inv", n("m"), n("m OR recon_label = 'INV_MISSING'")), ("coverage_led", n("m"), n(reconcilable)),
        ("recovery_late", n("recon_label = 'LEDGER_LATE'"), n("recon_label IN ('LEDGER_LATE', 'LEDGER_ONLY')")), ("recovery_all", n(f"recon_label IN ({METRICS})"), n(reconcilable)),
        ("shortfall", f"({s_if('inv_reserve', kept)} - {s_if('led_reserve', kept)})", s_if("inv_reserve", kept)),
        ("conformity", n(f"m AND {KAS}"), n(f"(m OR recon_label = 'INV_MISSING') AND {KAS}")),
        ("metrics_gap_pct", f"({s_if('inv_reserve', U)} - {s_if('led_reserve', U)})", s_if("inv_reserve", U)),
    ]


KPI = f"{RESULT}\n" + " UNION ALL ".join([f"SELECT '{n}' AS metric, {r(e)} AS value FROM result" for n, e in _figures()] + [f"SELECT '{n}' AS metric, {pct(a, b, 1, '0.0')} AS value FROM result" for n, a, b in _rates()])
KPI_HEADER = f"""{RESULT} SELECT strftime(max(inv_inventory_date) FILTER (recon_label <> 'LEDGER_LATE'), '%d/%m/%Y') AS inventory_date,
  count(*) = count(*) FILTER (recon_label IN ({KNOWN})) AS coherent, coalesce(string_agg(DISTINCT recon_label, ',' ORDER BY recon_label) FILTER (recon_label NOT IN ({KNOWN})), '') AS unknown_labels FROM result"""
RESIDUAL = "recon_label = CASE WHEN action = 'DELETE' THEN 'INV_DELETE' ELSE 'INV_MISSING' END"
KPI_BY_ACTION = f"""{RESULT}, a AS (
  SELECT action, count(*) AS nb, {n_if('m')} AS nb_matched, {n_if('m AND inv0 <> 0')} AS nb_nonzero, {total_if('inv_reserve', 'm')} AS inv_reserve, {total_if('led_reserve', 'm')} AS led_reserve
  FROM result WHERE action IS NOT NULL AND (m OR {RESIDUAL}) GROUP BY action),
b AS (SELECT *, CASE WHEN action = 'DELETE' THEN nb - nb_matched ELSE nb_matched END AS nb_conform, nb_matched - nb_nonzero AS nb_zero FROM a)
SELECT *, {r('inv_reserve - led_reserve')} AS gap, action <> 'DELETE' AS relevant, {pct('nb_conform', 'nb', 1, '0.0')} AS pct_conform, {pct('nb_nonzero', 'nb_matched', 1, '0.0')} AS pct_nonzero,
  {pct('nb_zero', 'nb_matched', 1, '0.0')} AS pct_zero, {pct('inv_reserve - led_reserve', 'inv_reserve', 1, '0.0')} AS shortfall_rate FROM b"""

GLOBAL = f"""{RESULT}, a AS (
  SELECT action, count(*) AS nb_total, {n_if('m')} AS nb_matched, {n_if('m AND inv0 <> 0')} AS nb_nonzero, {total_if('inv_reserve', 'm')} AS inv_reserve, {total_if('led_reserve', 'm')} AS led_reserve
  FROM result WHERE action IS NOT NULL AND (m OR recon_label IN ('INV_MISSING', 'INV_DELETE')) GROUP BY action),
b AS (SELECT *, CAST(list_position({ACTIONS}, action) AS INT) AS rank, nb_total - nb_matched AS nb_orphan, nb_matched - nb_nonzero AS nb_zero, {r('inv_reserve - led_reserve')} AS gap FROM a),
c AS (SELECT *, CASE WHEN action = 'DELETE' THEN nb_orphan ELSE nb_matched END AS nb_conform FROM b)
SELECT *, {pct('nb_conform', 'nb_total')} AS pct_conform, CASE WHEN action <> 'DELETE' THEN {pct('inv_reserve - led_reserve', 'inv_reserve')} END AS shortfall_rate FROM c"""

WHO = "inv_person_id, inv_birth_date, inv_event_date, inv_coverage"
FANOUT_SUMMARY = f"""{RESULT}
SELECT count(*) AS matched_rows, count(DISTINCT row({WHO})) AS matched_identities, count(*) - count(DISTINCT row({WHO})) AS overcount,
  (SELECT count(*) FROM inventory) AS input_rows, (SELECT count(DISTINCT row(person_id, birth_date, event_date, coverage)) FROM inventory) AS input_identities
FROM result WHERE m"""

AUDIT = "CASE WHEN m = (action <> 'DELETE') THEN 'CONFORM' ELSE 'NON_CONFORM' END"


def _conservation(mode: str) -> str:
    one = lambda side, table, col: f"SELECT '{side}' AS side, '{mode}' AS consume, count(*) AS rows_in, {n_if(f'id IN (SELECT {col} FROM labels WHERE {col} IS NOT NULL)')} AS rows_labelled FROM {table}"
    return f"{cascade(mode)} SELECT *, rows_in - rows_labelled AS rows_consumed FROM ({one('ledger', 'ledger', 'led_id')} UNION ALL {one('inventory', 'inventory', 'inv_id')})"


def step(label: str) -> str:
    n = [s[0] for s in STEPS].index(label) + 1
    return f"{cascade(steps=n)} SELECT led_id, inv_id FROM pairs{n}"


RAW = f"({base(fixtures.RAW_LEDGER)})"
LATEST = "row_number() OVER (PARTITION BY n_rpp, exercice_de_survenance, nom_prenom, date_de_naissance_de_l_assure, date_de_l_arret_de_travail, terme_de_garantie ORDER BY tech_day DESC, led_id) = 1"
PARSED_RESERVE, PARSED_EVENT = "CASE WHEN id % 50 = 2 THEN NULL ELSE reserve END", "CASE WHEN id % 50 = 1 THEN NULL ELSE event_date END"

FANOUT = f"""{RESULT} SELECT {WHO}, count(*) AS nb_ledger, {d('max(inv_reserve)')} AS inv_reserve, array_to_string(list_sort(list(DISTINCT recon_label)), ',') AS steps, min(inv_full_name) AS full_name
  FROM result WHERE m GROUP BY {WHO} HAVING count(*) > 1"""
CLEAN_LEDGER = f"""WITH l AS (SELECT led_id, n_rpp AS person_id, nom_prenom AS full_name, date_de_naissance_de_l_assure AS birth_date, CASE WHEN led_id % 50 <> 1 THEN date_de_l_arret_de_travail END AS event_date,
    CAST(terme_de_garantie AS INT) AS coverage, {d('CASE WHEN led_id % 50 <> 2 THEN pm_au_31_12 END')} AS reserve FROM {RAW} x WHERE vision = '2023' AND starts_with(clause, 'CPB_')
    QUALIFY row_number() OVER (PARTITION BY n_rpp, exercice_de_survenance, nom_prenom, date_de_naissance_de_l_assure, CASE WHEN led_id % 50 <> 1 THEN date_de_l_arret_de_travail END, terme_de_garantie ORDER BY tech_day DESC, led_id) = 1)
  SELECT *, person_id || strftime(birth_date, '%Y%m%d') || coalesce(strftime(event_date, '%Y%m%d'), '') || CAST(coverage AS VARCHAR) || {FULL} AS key_strict,
    person_id || strftime(birth_date, '%Y%m%d') || CAST(coverage AS VARCHAR) || {CUT} AS key_no_date_trunc FROM l"""

ORACLES = {
    "load_filter_ledger": f"SELECT led_id, clause, n_rpp, {d('pm_au_31_12')} AS reserve FROM {RAW} x WHERE vision = '2023' AND clause IN ('CPB_1000', 'CPB_1002')",
    "load_inventory_csv": f"WITH {SOURCES} SELECT id AS inv_id, person_id, full_name, birth_date, {PARSED_EVENT} AS event_date, coverage, {d(PARSED_RESERVE)} AS reserve, {ACTION} AS action FROM inventory WHERE status = 'OUI'",
    "rename_prefix": f"SELECT led_id, n_rpp AS led_person_id, nom_prenom AS led_full_name, terme_de_garantie AS led_coverage FROM {RAW} x",
    "keep_latest": f"SELECT led_id, {d('pm_au_31_12')} AS reserve, tech_day FROM {RAW} x WHERE vision = '2023' QUALIFY {LATEST}",
    "parse_amounts_dates": f"WITH {SOURCES} SELECT id AS inv_id, {d(PARSED_RESERVE)} AS reserve, {PARSED_EVENT} AS event_date FROM inventory",
    "parse_rejects": f"WITH {SOURCES} SELECT {n_if('id % 50 = 2')} AS reserve, {n_if('id % 50 = 1')} AS event_date FROM inventory",
    "normalize_names": f"WITH {SOURCES} SELECT id, {FULL} AS full_name, {CUT} AS cut_name FROM ledger",
    "matching_keys": f"WITH {SOURCES} SELECT id, {', '.join(KEYS)} FROM ledger",
    "classify_instruction": f"WITH {SOURCES} SELECT instruction, action, count(*) AS nb FROM inventory GROUP BY ALL",
    "bin_reserve": f"WITH {SOURCES}, b AS (SELECT reserve, {both_bins('reserve')} FROM inventory) SELECT bin, bin_rank, count(*) AS nb, {d('sum(reserve)')} AS reserve FROM b GROUP BY ALL",
    "step_exact": step("MATCH_EXACT"), "step_window": step("MATCH_WINDOW"), "step_truncated": step("MATCH_TRUNC"), "step_truncated_window": step("MATCH_TRUNC_WINDOW"),
    "step_transition": step("MATCH_TRANSITION"), "step_relapse": step("MATCH_RELAPSE"), "step_relapse_truncated": step("MATCH_RELAPSE_TRUNC"),
    "waterfall_labels_row": f"{cascade('row')} SELECT recon_label, count(*) AS nb FROM labels GROUP BY ALL",
    "waterfall_labels_key": f"{cascade('key')} SELECT recon_label, count(*) AS nb FROM labels GROUP BY ALL",
    "waterfall_pairs": f"{cascade()} SELECT * FROM labels",
    "conservation_audit": f"SELECT * FROM ({_conservation('row')}) UNION ALL SELECT * FROM ({_conservation('key')})",
    "late_recovery": f"{RESULT} SELECT led_id, inv_id, first_label AS recon_label, first_source AS late_source, {d('inv_reserve')} AS inv_reserve FROM wide WHERE first_label IN ('LEDGER_ONLY', 'LEDGER_LATE')",
    "flag_late_obs": f"{RESULT} SELECT recon_label, late_source, count(*) AS nb FROM result GROUP BY ALL",
    "orphan_tags": f"{RESULT} SELECT led_id, orphan_tag FROM result WHERE orphan_tag IS NOT NULL",
    "orphan_tag_distribution": f"{RESULT} SELECT orphan_tag, count(*) AS nb, {d('sum(led_reserve)')} AS reserve FROM result WHERE recon_label = 'LEDGER_ONLY' GROUP BY ALL",
    "audit_summary": f"""{RESULT}, a AS (SELECT clause, type, inv_status, action, {AUDIT} AS audit, count(*) AS nb, {d('sum(inv_reserve)')} AS inv_reserve FROM result WHERE action IS NOT NULL GROUP BY ALL)
      SELECT *, {share('nb', 'clause', 'type', 'inv_status', 'action')} AS pct_nb, {share('inv_reserve', 'clause', 'type', 'inv_status', 'action')} AS pct_reserve FROM a""",
    "instruction_ratios": f"""{RESULT}, a AS (SELECT clause, type, action, recon_label, count(*) AS nb, {d('sum(inv_reserve)')} AS inv_reserve FROM result WHERE action <> 'DELETE' GROUP BY ALL)
      SELECT *, {share('nb', 'clause', 'type')} AS ratio_nb, {share('inv_reserve', 'clause', 'type')} AS ratio_reserve FROM a""",
    "instruction_reserve": f"""{RESULT}, a AS (SELECT action, category0 AS category, {both_bins('inv0')}, {SUMS0}, {d('sum(inv0 - led0)')} AS gap FROM result WHERE {U} AND {KAS} GROUP BY ALL)
      SELECT *, {pct('gap', 'inv_reserve')} AS shortfall_rate, {share('nb', 'action')} AS pct_nb FROM a""",
    "instruction_global": GLOBAL,
    "delete_not_followed": f"{RESULT}, a AS (SELECT {both_bins('inv_reserve')}, {SUMS} FROM result WHERE m AND action = 'DELETE' GROUP BY ALL) SELECT *, {share('nb')} AS pct_nb FROM a",
    "shortfall_by_clause": f"""{RESULT}, a AS (SELECT clause, type, action, {_shortfall('inv_reserve', 'led_reserve', 'category')} FROM result WHERE m AND {KAS} GROUP BY ALL)
      SELECT *, {pct('gap', 'inv_reserve')} AS shortfall_rate, {share('nb', 'clause', 'type')} AS weight_nb, {share('inv_reserve', 'clause', 'type')} AS weight_reserve,
        {pct('nb_under', 'nb')} AS pct_under, {pct('nb_over', 'nb')} AS pct_over, {pct('nb_conform', 'nb')} AS pct_conform FROM a""",
    "shortfall_by_action": f"""{RESULT}, a AS (SELECT action, {_shortfall('inv0', 'led0', 'category0')} FROM result WHERE {U} AND {KAS} GROUP BY ALL)
      SELECT * EXCLUDE (gap_abs, gap_under, gap_over), {pct('gap', 'inv_reserve')} AS shortfall_rate FROM a""",
    "provision_by_clause": f"""{RESULT}, a AS (SELECT clause, type, action, category, {SUMS}, {d('sum(abs(inv_reserve - led_reserve))')} AS gap_abs FROM result WHERE m AND {KAS} GROUP BY ALL)
      SELECT *, {share('nb', 'clause', 'type', 'action')} AS pct_nb FROM a""",
    "gap_bins": f"""{RESULT}, g AS (SELECT *, abs(inv_reserve - led_reserve) AS x FROM result WHERE m AND {KAS} AND category <> 'CONFORM'),
      a AS (SELECT clause, type, action, category, {both_bins('x', GAP_BINS)}, {SUMS}, {d('sum(x)')} AS gap_total, {mean('x')} AS gap_mean, {d('max(x)')} AS gap_max FROM g GROUP BY ALL)
      SELECT *, {share('nb', 'clause', 'type', 'action', 'category')} AS pct_nb, {share('gap_total', 'clause', 'type', 'action', 'category')} AS pct_gap FROM a""",
    "provision_study": f"""{RESULT}, g AS (SELECT *, abs(inv0 - led0) AS x FROM result WHERE {U} AND (action IS NULL OR action <> 'DELETE')),
      a AS (SELECT category0 AS category, {SUMS0}, {d('sum(inv0 - led0)')} AS gap, {d('sum(x)')} AS gap_abs, {mean('x')} AS gap_mean, {d('max(x)')} AS gap_max FROM g GROUP BY ALL)
      SELECT *, {share('nb', places=1)} AS pct_nb, {share('inv_reserve', places=1)} AS pct_reserve, {pct('gap', 'inv_reserve')} AS shortfall_rate FROM a""",
    "ledger_only_by_month": _by_month("led_event_date", "led_reserve", "", "recon_label = 'LEDGER_ONLY'"),
    "inv_missing_by_month": _by_month("inv_event_date", "inv_reserve", "inv_status, action,", "recon_label = 'INV_MISSING' AND action <> 'DELETE'"),
    "ledger_only_breakdown": _breakdown("LEDGER_ONLY", True),
    "late_obs_breakdown": _breakdown("LEDGER_LATE_OBS", False),
    "fanout_detail": FANOUT, "fanout_top": f"{FANOUT} ORDER BY nb_ledger DESC, inv_reserve DESC NULLS LAST, {WHO} LIMIT 30",
    "audit_detail": f"{RESULT} SELECT led_id, inv_id, clause, type, action, recon_label, {AUDIT} AS audit FROM result WHERE action IS NOT NULL",
    "load_prefix_ledger": f"SELECT clause, vision, count(*) AS nb FROM {RAW} x WHERE vision = '2023' AND (starts_with(clause, 'CPB_1000') OR starts_with(clause, 'CPB_1002')) GROUP BY ALL",
    "load_inventory_clauses": f"WITH {SOURCES} SELECT clause AS n_clause_ratta1, status AS Statut_INV, count(*) AS nb FROM inventory WHERE status = 'NON' AND clause IN ('1000', '1001') GROUP BY ALL",
    "perimeter_counts": f"""WITH {SOURCES} SELECT count(*) AS rows_in, {n_if("status = 'OUI'")} AS kept_statut_inv, {n_if("status = 'OUI' AND type = 'PB'")} AS kept_type_clause,
      {n_if("status = 'OUI' AND type = 'PB' AND clause = '1002'")} AS kept_n_clause_ratta1 FROM inventory""",
    "clean_ledger": CLEAN_LEDGER,
    "waterfall_nearest": f"{cascade(pick='nearest')} SELECT * FROM labels", "waterfall_one_to_one": f"{cascade(one_to_one=True)} SELECT * FROM labels", "waterfall_no_transition": f"{cascade(leave_out='MATCH_TRANSITION')} SELECT * FROM labels",
    "late_recovery_days": f"""{cascade()}, {LATE_ROW} SELECT s.led_id, n.id AS inv_id, CASE WHEN n.id IS NULL THEN 'LEDGER_ONLY' ELSE 'LEDGER_LATE' END AS recon_label, CASE WHEN n.id IS NOT NULL THEN 'N1' END AS late_source
      FROM labels s JOIN ledger l ON s.led_id = l.id LEFT JOIN late_reps n ON l.key_no_date = n.key_no_date AND abs(date_diff('day', l.event_date, n.event_date)) <= 30 WHERE s.recon_label = 'LEDGER_ONLY'""",
    "late_recovery_list": f"""{cascade()}, lists AS (
      SELECT 1 AS place, id, key_no_date, event_date + 100 AS event_date, reserve FROM later WHERE id % 2 = 0 UNION ALL
      SELECT 2, id, key_no_date, event_date - 20, NULL FROM later WHERE id % 3 = 0 UNION ALL SELECT 3, id, key_no_date, event_date, reserve FROM later),
    reps AS (SELECT * FROM lists QUALIFY row_number() OVER (PARTITION BY place, key_no_date ORDER BY event_date, id) = 1),
    hits AS (SELECT l.id AS led_id, n.* FROM ledger l JOIN reps n ON l.key_no_date = n.key_no_date AND abs(date_diff('day', l.event_date, n.event_date)) <= 60 QUALIFY row_number() OVER (PARTITION BY l.id ORDER BY place) = 1)
    SELECT s.led_id, n.id AS inv_id, CASE WHEN n.id IS NULL THEN 'LEDGER_ONLY' ELSE 'LEDGER_LATE' END AS recon_label, 'N' || n.place AS late_source, CAST(n.event_date AS DATE) AS inv_event_date, {d('n.reserve')} AS inv_reserve
    FROM labels s LEFT JOIN hits n ON s.led_id = n.led_id WHERE s.recon_label = 'LEDGER_ONLY'""",
    "inventory_date": f"{RESULT} SELECT strftime(max(inv_inventory_date) FILTER (recon_label <> 'LEDGER_LATE'), '%d/%m/%Y') AS inventory_date FROM result", "kpi_header": KPI_HEADER,
    "catalog_tables": f"{RESULT}, c AS (SELECT recon_label, late_source, count(*) AS nb FROM result GROUP BY ALL) SELECT c.*, run_id, 'other' AS unknown FROM c CROSS JOIN (VALUES ('current'), ('run1'), ('run2')) v(run_id)",
    "fanout_summary": FANOUT_SUMMARY,
    "kpi_summary": KPI,
    "kpi_by_action": KPI_BY_ACTION,
    "label_coherence": f"{RESULT} SELECT count(*) AS total_rows, {n_if(f'recon_label IN ({KNOWN})')} AS classified_rows FROM result",
}


ORDER = "ORDER BY nb_ledger DESC, inv_reserve DESC NULLS LAST, inv_person_id, inv_birth_date, inv_event_date, inv_coverage"
ORACLES |= {
    "fanout_first": f"{FANOUT} {ORDER} LIMIT 3",
    "fanout_sketch": f"{RESULT} SELECT count(DISTINCT row({WHO})) AS exact, true AS merged_is_whole, true AS is_near FROM result WHERE m",
    "catalog_evolution": f"""WITH {SOURCES}, c AS (SELECT clause, count(*) AS nb, {d('sum(reserve)')} AS reserve FROM inventory GROUP BY ALL)
      SELECT clause, nb, NULL::DOUBLE AS reserve FROM c UNION ALL SELECT * FROM c UNION ALL SELECT clause, NULL, NULL FROM c""",
    "export_tables": f"SELECT 'C1' AS client, 'ALL' AS scope, g.*, 'instruction_global_1000,late_obs_breakdown_1000' AS tables, 'client,scope' AS first_columns FROM ({GLOBAL}) g",
    "inventory_quarantine": f"""WITH {SOURCES}, f AS (
        SELECT CASE id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS folder, *, CASE id % 3 WHEN 0 THEN false WHEN 1 THEN id % 40 = 7 ELSE true END AS broken FROM inventory WHERE id % 3 < 2 OR id % 300 = 2)
      SELECT folder, count(*) AS rows_read, {n_if('broken')} AS rows_broken, CAST(sum(person_id::BIGINT) FILTER (NOT broken) AS BIGINT) AS persons, min(full_name) FILTER (NOT broken) AS first_name,
        CASE WHEN folder <> 'c' THEN {n_if("NOT broken AND folder = 'a'")} END AS statuses FROM f GROUP BY folder""",
}


def _sizes(of: str, *keys: str) -> str:
    count = "nb_total" if of == "instruction_global" else "nb"
    return f"SELECT {''.join(f'{k}, ' for k in keys)}count(*) AS rows, CAST(sum({count}) AS BIGINT) AS nb FROM ({ORACLES[of]}) t"


BY_CLAUSE = ["audit_summary", "instruction_ratios", "shortfall_by_clause", "provision_by_clause", "gap_bins", "ledger_only_by_month", "inv_missing_by_month"]
COLLECTED = ["instruction_global", "shortfall_by_action", "instruction_reserve", "delete_not_followed", "provision_study", "ledger_only_breakdown", "late_obs_breakdown"]
ORACLES["full_analysis"] = " UNION ALL ".join(_sizes(name, f"'{name}' AS \"table\"") for name in BY_CLAUSE)
ORACLES["export_roundtrip"] = (
    "SELECT * FROM (" + " UNION ALL ".join(_sizes(name, f"'{name}' AS \"table\"") for name in COLLECTED) + ") CROSS JOIN (SELECT unnest(['csv', 'parquet']) AS format, 'written' AS status, '' AS detail) f"
)
