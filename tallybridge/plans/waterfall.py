"""The cascade of key joins, strict to loose, on one partitioning.

All keys begin with person and birth date, so both sides are dealt once by these two, as slim rows (side, id, names, day,
coverage). A step is then a pair of windows over its key: what it takes from the other side of the key, and who leaves. Windows
over more columns keep the partitioning, so seven steps need no further exchange, and nothing is written between
them. The rows are counted before they are dealt, into as many parts as TASK_ROWS asks for, and read for that from files of as
many rows (the shuffle sorts what a task reads): a task's memory does not grow with the input. Wide rows are joined back once, at the end.

* pick="first": the key's first open inventory row stands for it, before the condition.
* pick="nearest": the last open inventory row up to a ledger row's day and the first one from there on are carried along
  the key's rows in order of days; no pair is formed but the nearest.
* one_to_one: an assignment. For exact keys the k-th open rows of both sides are a pair; otherwise rows that are
  nearest to each other pair up, round after round, until no open row has a fitting open partner. Ties go to smaller ids.

A person and birth date with more than HOT rows (dummy persons), told by a sketch while the slim rows are written, is not left
to one task: with pick="first" its steps are joins with one representative a key (a map-side combined minimum, whose
probe side adaptive execution splits); in the other modes each step deals it anew by its whole key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config
from ..config import Recon
from ..functions import text
from ..operators import columns, matching
from .cut import cut, file_rows

KEYS = list(columns.KEYS)
LEDGER, INVENTORY = 0, 1
#: Labels of rows that are accounted for by another row: an inventory row of a pair, and rows that a key took along.
USED, CONSUMED = "USED", "CONSUMED"
#: Rows of a person and birth date that one task should have at most, and counters of the sketch that finds more.
HOT, COUNTERS = 1 << 20, 4096
#: Slim rows that a task of the windows has, about. A row takes 3 to 9 KB there, as each window of a stage sorts and holds its rows.
TASK_ROWS = 1 << 16


@dataclass
class Cascade:
    """pairs (led_id, inv_id, label), and the slim rows that are left on either side; counts: (side, rows in, rows with a label)."""

    pairs: DataFrame
    ledger_only: DataFrame
    inv_missing: DataFrame
    inv_delete: DataFrame
    counts: list[tuple[str, int, int]] = field(default_factory=list)

    def audit(self) -> DataFrame:
        """For each side: rows in, rows with a label, rows consumed without one; observed while rows were written."""
        rows = [(side, n, labelled, n - labelled) for side, n, labelled in self.counts]
        return self.pairs.sparkSession.createDataFrame(rows, "side string, rows_in long, rows_labelled long, rows_consumed long")


def steps(cfg: Recon) -> list[tuple[str | None, str, matching.Rule | None]]:
    """(label, key, condition); None in the place of a label splits off deletes."""
    window, relapse = matching.within_window(cfg.window_days), matching.relapse(cfg.relapse_days)
    out = [
        ("MATCH_EXACT", "key_strict", None),
        ("MATCH_WINDOW", "key_no_date", window),
        ("MATCH_TRUNC", "key_strict_trunc", None),
        ("MATCH_TRUNC_WINDOW", "key_no_date_trunc", window),
        (None, "", None),
    ]
    if cfg.transition_offset is not None:
        out.append(("MATCH_TRANSITION", "key_no_coverage", matching.transition(cfg.transition_offset, cfg.transition_signed)))
    return out + [("MATCH_RELAPSE", "key_no_date", relapse), ("MATCH_RELAPSE_TRUNC", "key_no_date_trunc", relapse)]


def key_parts(key: str) -> list[str]:
    event, coverage, cut_name = columns.KEYS[key]
    return ["person", "birth", "cut_name" if cut_name else "full_name", *(["day"] if event else []), *(["coverage"] if coverage else [])]


def slim(df: DataFrame, side: int, cfg: Recon) -> DataFrame:
    p = "inv_" if side else "led_"
    name, delete = F.col(f"{p}full_name"), F.coalesce(text.action(F.col("inv_instruction")) == "DELETE", F.lit(False)) if side else F.lit(False)
    return df.select(
        F.lit(side).alias("side"), F.col(f"{p}id").cast("long").alias("id"), F.col(f"{p}person_id").cast("string").alias("person"), F.col(f"{p}birth_date").alias("birth"), text.full_name(name).alias("full_name"),
        text.truncated_name(name, cfg.truncate).alias("cut_name"), F.datediff(f"{p}event_date", F.lit("1970-01-01").cast("date")).alias("day"), F.col(f"{p}coverage").try_cast("int").alias("coverage"), delete.alias("is_delete"),
    )


def _open(side: int | None = None) -> Column:
    return F.col("label").isNull() & (F.lit(True) if side is None else F.col("side") == side)


def nearest(key: str, rule: matching.Rule | None, side: int) -> Column:
    """For open rows of a side the id of the nearest open row of the other side of the key that fulfils the rule; the smaller id of equally near ones."""
    there, base, number = _open(1 - side), W.partitionBy(*key_parts(key)), F.col("id")
    if rule is None:
        return F.min(F.when(there, number)).over(base)
    if rule.offset is not None:
        apart = [rule.offset * (1 if side else -1)] if rule.signed else sorted({rule.offset, -rule.offset})
        known = there & F.col("coverage").isNotNull()
        found = [F.min(F.when(known, number)).over(base.orderBy("coverage").rangeBetween(x, x)) for x in apart]
        return F.when(F.col("coverage").isNotNull(), F.least(*found) if len(found) > 1 else found[0])
    known, last = there & F.col("day").isNotNull(), -1 if rule.strict else 0
    known = known & F.col("coverage").isNotNull() if rule.strict else known
    before = F.max(F.when(known, F.struct("day", (-number).alias("id")))).over(base.orderBy("day").rangeBetween(W.unboundedPreceding, last))
    after = F.min(F.when(known, F.struct("day", "id"))).over(base.orderBy(-F.col("day")).rangeBetween(W.unboundedPreceding, last))
    best = F.least(F.when(before.isNotNull(), F.struct((F.col("day") - before["day"]).alias("days"), (-before["id"]).alias("id"))), F.when(after.isNotNull(), F.struct((after["day"] - F.col("day")).alias("days"), after["id"].alias("id"))))
    return F.when(best["days"] <= rule.days, best["id"])


def _first(df: DataFrame, key: str, rule: matching.Rule | None) -> DataFrame:
    """hit: the key's representative, where the condition holds; used: an inventory row is the one that a ledger row took."""
    over = W.partitionBy(*key_parts(key))
    order = F.struct(F.col("day").isNull().alias("unknown"), "day", "id", "coverage")
    df = df.withColumn("rep", F.min(F.when(_open(INVENTORY), order)).over(over))
    date = lambda c: F.date_add(F.lit("1970-01-01").cast("date"), c)
    held = df.withColumns({"event_date": date(F.col("day")), "inv_event_date": date(F.col("rep.day")), "inv_coverage": F.col("rep.coverage")}) if rule else df
    held = held.withColumn("hit", F.when(_open(LEDGER) & (rule() if rule else F.lit(True)), F.col("rep.id")))
    return held.withColumn("used", (F.col("id") == F.col("rep.id")) & F.bool_or(F.col("hit").isNotNull()).over(over)).drop("rep", "event_date", "inv_event_date", "inv_coverage")


def _nearest(df: DataFrame, key: str, rule: matching.Rule | None) -> DataFrame:
    df = df.withColumn("hit", F.when(_open(LEDGER), nearest(key, rule, LEDGER)))
    target = F.when(F.col("side") == INVENTORY, F.col("id")).otherwise(F.col("hit"))
    df = df.withColumn("target", target)
    return df.withColumn("used", F.bool_or(F.col("hit").isNotNull()).over(W.partitionBy("person", "birth", "target"))).drop("target")


def _by_rank(df: DataFrame, key: str) -> DataFrame:
    parts = key_parts(key)
    df = df.withColumn("is_open", _open()).withColumn("place", F.row_number().over(W.partitionBy(*parts, "is_open", "side").orderBy("id")))
    over = W.partitionBy(*parts, "is_open", "place")
    df = df.withColumns({"met": F.max(F.when(_open(INVENTORY), F.col("id"))).over(over), "asked": F.bool_or(_open(LEDGER)).over(over)})
    return df.withColumns({"hit": F.when(_open(LEDGER), F.col("met")), "used": F.col("asked")}).drop("is_open", "place", "met", "asked")


def _mutual(df: DataFrame, key: str, rule: matching.Rule) -> DataFrame:
    """One round: rows that are each other's nearest."""
    df = df.withColumn("best", F.when(_open(LEDGER), nearest(key, rule, LEDGER)).when(_open(INVENTORY), nearest(key, rule, INVENTORY)))
    ledger = F.col("side") == LEDGER
    df = df.withColumns({"l": F.when(F.col("best").isNotNull(), F.when(ledger, F.col("id")).otherwise(F.col("best"))), "i": F.when(F.col("best").isNotNull(), F.when(ledger, F.col("best")).otherwise(F.col("id")))})
    both = F.col("best").isNotNull() & (F.count("best").over(W.partitionBy("person", "birth", "l", "i")) == 2)
    return df.withColumn("both", both).withColumns({"hit": F.when(F.col("both") & ledger, F.col("best")), "used": F.col("both")}).drop("best", "l", "i", "both")


def _settled(df: DataFrame, label: str) -> DataFrame:
    """Labels the rows that a step took; hit and used go."""
    now = F.when(F.col("hit").isNotNull(), F.lit(label)).when(_open(INVENTORY) & F.coalesce("used", F.lit(False)), F.lit(USED))
    return df.withColumns({"label": F.coalesce("label", now), "partner": F.coalesce("partner", "hit")}).drop("hit", "used")


def _keys_consumed(df: DataFrame, label: str, key: str) -> DataFrame:
    """consume="key": open rows of a key that a step has matched leave, too."""
    taken = F.bool_or(F.coalesce(F.col("label") == label, F.lit(False))).over(W.partitionBy(*key_parts(key)))
    return df.withColumn("taken", taken).withColumn("label", F.when(_open() & F.col("taken"), F.lit(CONSUMED)).otherwise(F.col("label"))).drop("taken")


def by_windows(df: DataFrame, cfg: Recon, last: str | None, parts: int) -> DataFrame:
    """Slim rows with label and partner after all steps; df is dealt by person and birth date, anew into so many parts after a round of one_to_one."""
    for label, key, rule in steps(cfg):
        if label is None:
            df = df.withColumn("label", F.when(_open(INVENTORY) & F.col("is_delete"), F.lit(config.INV_DELETE)).otherwise(F.col("label")))
            continue
        if cfg.one_to_one and rule is not None:
            found = 1
            while found:
                seen = Observation()
                df = _mutual(df, key, rule).observe(seen, F.count("hit").alias("found"))
                df = cut(_settled(df, label), label).repartition(parts, "person", "birth")
                found = seen.get["found"]
        else:
            df = _settled(_by_rank(df, key) if cfg.one_to_one else _nearest(df, key, rule) if cfg.pick == "nearest" else _first(df, key, rule), label)
        df = _keys_consumed(df, label, key) if cfg.consume == "key" else df
        if label == last:
            break
    return df


def by_joins(df: DataFrame, cfg: Recon, last: str | None) -> DataFrame:
    """The same for persons with very many rows: each step joins the ledger's rest with one representative a key."""
    for key in KEYS:
        df = df.withColumn(key, F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in key_parts(key)]))
    df = df.withColumn("event_date", F.date_add(F.lit("1970-01-01").cast("date"), F.col("day")))
    led, inv = (df.filter(F.col("side") == side).drop("label", "partner") for side in (LEDGER, INVENTORY))
    inv, done = cut(inv, "inventory"), []
    for label, key, rule in steps(cfg):
        if label is None:
            done.append(inv.filter("is_delete").withColumns({"label": F.lit(config.INV_DELETE), "partner": F.lit(None).cast("long")}))
            inv = inv.filter("NOT is_delete")
            continue
        step = cut(matching.matched(led, inv, key, rule), label)
        pairs = step.filter("inv_id IS NOT NULL").withColumns({"label": F.lit(label), "partner": F.col("inv_id")})
        done += [pairs, inv.join(pairs.select(F.col("inv_id").alias("id")).distinct(), "id", "left_semi").withColumns({"label": F.lit(USED), "partner": F.lit(None).cast("long")})]
        led, inv = matching.remaining(step, inv, key, cfg.consume)
        inv = cut(inv, "inventory")
        if label == last:
            break
    done += [x.withColumns({"label": F.lit(None).cast("string"), "partner": F.lit(None).cast("long")}) for x in (led, inv)]
    out = None
    for part in done:
        part = part.select("side", "id", "person", "birth", "full_name", "cut_name", "day", "coverage", "is_delete", "label", "partner")
        out = part if out is None else out.unionByName(part)
    return out


def hot_persons(found: list) -> list[str]:
    """Of a sketch's (person, estimate) pairs those with more than HOT rows."""
    return [x["item"] for x in found or [] if x["count"] > HOT]


def dealt(rows: DataFrame, hot: list[str], cfg: Recon, last: str | None, n: int) -> Iterator[DataFrame]:
    """The n rows after the steps, in parts: those with a whole key by persons that are hot or not, and those that no key can match."""
    own = F.concat_ws("|", "person", F.col("birth").cast("string"))
    whole = F.col("person").isNotNull() & F.col("birth").isNotNull() & F.col("full_name").isNotNull()
    rows, parts = rows.withColumns({"label": F.lit(None).cast("string"), "partner": F.lit(None).cast("long")}), max(-(-n // TASK_ROWS), 1)
    yield by_windows(rows.filter(whole & ~own.isin(hot) if hot else whole).repartition(parts, "person", "birth"), cfg, last, parts)
    if hot:
        some = rows.filter(whole & own.isin(hot))
        yield by_joins(some, cfg, last) if cfg.pick == "first" and not cfg.one_to_one else by_windows(some, cfg, last, parts)
    deletes = F.when(F.lit(last not in [s[0] for s in steps(cfg)[:4]]) & F.col("is_delete"), F.lit(config.INV_DELETE))
    yield rows.filter(~whole).withColumn("label", deletes)


def cascade(ledger: DataFrame, inventory: DataFrame, cfg: Recon = Recon(), last: str | None = None) -> Cascade:
    """Runs the steps (up to the label ``last``) over cleaned sources with led_id and inv_id."""
    rows, seen, after = slim(ledger, LEDGER, cfg).unionByName(slim(inventory, INVENTORY, cfg)), Observation(), Observation()
    person = F.concat_ws("|", "person", F.col("birth").cast("string"))
    sketch = F.call_function("approx_top_k", person, F.lit(COUNTERS // 8), F.lit(COUNTERS))
    sides = {"ledger": F.col("side") == LEDGER, "inventory": F.col("side") == INVENTORY}
    with file_rows(ledger.sparkSession, TASK_ROWS):
        rows = cut(rows.observe(seen, sketch.alias("persons"), *[F.count_if(of).alias(name) for name, of in sides.items()]), "slim-rows")
    out = None
    for part in dealt(rows, hot_persons(seen.get["persons"]), cfg, last, sum(seen.get[name] for name in sides)):
        out = part if out is None else out.unionByName(part)
    labelled = F.coalesce(F.col("label") != CONSUMED, F.lit(True))
    out = cut(out.observe(after, *[F.count_if(of & labelled).alias(name) for name, of in sides.items()]), "cascade")
    pairs = out.filter("partner IS NOT NULL").select(F.col("id").alias("led_id"), F.col("partner").alias("inv_id"), F.col("label").alias("recon_label"))
    counts = [(name, seen.get[name], after.get[name]) for name in sides]
    return Cascade(pairs, out.filter(_open(LEDGER)), out.filter(_open(INVENTORY)), out.filter(F.col("label") == config.INV_DELETE), counts)


def labels(run: Cascade) -> DataFrame:
    """(led_id, inv_id, recon_label) of every row that the cascade accounts for."""
    none = F.lit(None).cast("long")
    return (
        run.pairs.unionByName(run.inv_delete.select(none.alias("led_id"), F.col("id").alias("inv_id"), F.lit(config.INV_DELETE).alias("recon_label")))
        .unionByName(run.ledger_only.select(F.col("id").alias("led_id"), none.alias("inv_id"), F.lit(config.LEDGER_ONLY).alias("recon_label")))
        .unionByName(run.inv_missing.select(none.alias("led_id"), F.col("id").alias("inv_id"), F.lit(config.INV_MISSING).alias("recon_label")))
    )


def reconcile(ledger: DataFrame, inventory: DataFrame, cfg: Recon = Recon()) -> DataFrame:
    """The wide result: led_* and inv_* columns, keys (the ledger's, else the inventory's) and recon_label.

    Pairs, ledger rows alone and inventory rows alone are joined with their sources apart: no key is null.
    """
    run = cascade(ledger, inventory, cfg)
    alone = run.inv_missing.select(F.col("id").alias("inv_id"), F.lit(config.INV_MISSING).alias("recon_label")).unionByName(run.inv_delete.select(F.col("id").alias("inv_id"), F.lit(config.INV_DELETE).alias("recon_label")))
    pairs = run.pairs.join(ledger, "led_id").join(inventory.drop(*KEYS), "inv_id")
    only = ledger.join(run.ledger_only.select(F.col("id").alias("led_id")), "led_id", "left_semi").withColumn("recon_label", F.lit(config.LEDGER_ONLY))
    return pairs.unionByName(only, allowMissingColumns=True).unionByName(inventory.join(alone, "inv_id"), allowMissingColumns=True)


def consumed(ledger: DataFrame, inventory: DataFrame, labelled: DataFrame) -> DataFrame:
    """(side, id) of input rows that carry no label: none with consume="row", the rows a key took along with consume="key"."""
    led = ledger.select(F.lit("ledger").alias("side"), F.col("led_id").alias("id")).join(labelled.select(F.col("led_id").alias("id")).filter("id IS NOT NULL"), "id", "left_anti")
    inv = inventory.select(F.lit("inventory").alias("side"), F.col("inv_id").alias("id")).join(labelled.select(F.col("inv_id").alias("id")).filter("id IS NOT NULL").distinct(), "id", "left_anti")
    return led.select("side", "id").unionByName(inv.select("side", "id"))


def audit(ledger: DataFrame, inventory: DataFrame, labelled: DataFrame) -> DataFrame:
    """For each side: rows in, rows with a label, rows consumed without one."""
    lost = consumed(ledger, inventory, labelled).groupBy("side").agg(F.count("*").alias("rows_consumed"))
    sizes = ledger.agg(F.lit("ledger").alias("side"), F.count("*").alias("rows_in")).unionByName(inventory.agg(F.lit("inventory").alias("side"), F.count("*").alias("rows_in")))
    out = sizes.join(lost, "side", "left").withColumn("rows_consumed", F.coalesce("rows_consumed", F.lit(0)))
    return out.select("side", "rows_in", (F.col("rows_in") - F.col("rows_consumed")).alias("rows_labelled"), "rows_consumed")
