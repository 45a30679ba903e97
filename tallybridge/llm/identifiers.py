"""Personal data by bootstrapped contextual extraction, in built-in functions only.

Seeds are entities that tell themselves: e-mail addresses, IP addresses, card numbers, phone numbers, and secrets that
look random (16 or more letters and digits that change between the two three times or more). Each seed induces lexical patterns:

* left: the word before it and what stands between the two, without opening quotes and signs (``token = ``, ``password=``, ``tel: ``),
* affix: the first four characters and the length of a word of 12 or more letters and digits (``AKIA:20``).

Candidates are words with a digit, words of 16 or more letters and digits, and whatever follows ``=`` or ``:``. Candidates,
seeds and their patterns form a graph of values and patterns, with counts, that is scored in rounds:

* a pattern is trusted if SUPPORT or more different known values fill it, known fillers are a share of at least KNOWN of
  those that look like identifiers, and of known and plain fillers (words without a digit) TRUST are known. Fillers
  of a left pattern are counted over the whole corpus, so a common word is not trusted for the seeds that follow it;
* a value is accepted if its places in trusted left patterns and its affix make it likely enough (noisy or): then it
  is known wherever it stands, and its patterns count it from the next round on. Rounds end when nothing new is found.

The kind of a value is the kind that its best pattern has most of. Places of known values are spans beside the base ones.

Positions come from what lies between matches, summed up by a window per row of the table, so a text with very many
matches costs no more than its length. Patterns of regular expressions are possessive or anchored at a word's
start: one pass over a text, without recursion. The text is read twice: for matches, and for the fillers of left patterns.

Cases: a null text is empty and has no spans. Repeated rows are rows of their own. Base spans are as the query's contract has
them, each kind by itself; candidates that overlap one are left out. A left pattern has at most 40 characters; what
directly follows a match of its kind without a word between has none. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone", "secret")
SECRET, CANDIDATE = 4, 5
SUPPORT, KNOWN, TRUST, ACCEPT, ROUNDS = 5, 0.25, 0.8, 0.4, 6

WORD = r"A-Za-z0-9_\x{80}-\x{10FFFF}"
#: Left patterns that are broadcast to count what follows them.
FEW_PATTERNS = 100_000
#: Characters that a left pattern is looked for in, and that it has at most.
NEAR, LEFT = 64, 40
LOCAL = "A-Za-z0-9._%+-"
BASE = (
    rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
CANDIDATES = (
    r"(?:(?<=[=:]\x20?[\"']?)[A-Za-z0-9][^\s\"'<>,;]{2,}[A-Za-z0-9]"
    rf"|(?<![{WORD}-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{{6,}}+(?![{WORD}])"
    rf"|(?<![{WORD}-])[A-Za-z0-9]{{16,}}+(?![{WORD}]))"
)
LOOKS_RANDOM = r"^(?=[A-Za-z0-9]{16,}+$)[0-9]*+(?:[A-Za-z]++[0-9]++){3}"
#: Texts without any of these have no match.
ANY = r"[0-9@=:]|[A-Za-z0-9]{16}"


def good(kind: Column, value: Column) -> Column:
    """Whether a match of a base kind is one."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    small = value.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    card = F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    return F.when(kind == 0, True).when(kind == 1, small).when(kind == 2, card).when(kind == 3, F.length(digits).between(9, 15)).otherwise(False)


def spaced(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"\s+", " ")


def left_pattern(before: Column, value: Column) -> Column:
    """The word before a value and what stands between them; empty if there is none."""
    near = spaced(F.concat(F.right(before, F.lit(NEAR)), F.regexp_extract(value, rf"^[^{WORD}]*+", 0)))
    return shortened(F.regexp_extract(near, rf"[{WORD}]++[^{WORD}]++$", 0))


def shortened(unit: Column) -> Column:
    """A word and what follows it, without brackets, quotes and signs that open a value."""
    return F.right(F.rtrim(unit, F.lit("+([<\"'")), F.lit(LEFT))


def matches(docs: DataFrame) -> DataFrame:
    """(row, doc_id, hits): every match of every kind and the candidates, in the order of the text; gap: characters since the match before."""
    text = F.coalesce("text", F.lit(""))
    some = F.when(text.rlike(ANY), text).otherwise(F.lit(""))
    df = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", some.alias("text"))
    df = df.withColumns({f"{c}{kind}": x for kind, p in enumerate((*BASE, *[None] * (CANDIDATE - len(BASE)), CANDIDATES)) if p for c, x in (("f", F.regexp_extract_all("text", F.lit(p), F.lit(0))), ("p", F.split("text", p, -1)))})

    def hits(kind: int) -> Column:
        found, pieces = f"f{kind}", f"p{kind}"
        both = F.arrays_zip(F.col(found), F.slice(pieces, F.lit(1), F.size(found)).alias(pieces))
        return F.transform(both, lambda x, k: F.struct(F.lit(kind).alias("kind"), k.alias("pos"), F.length(x[pieces]).alias("gap"), F.length(x[found]).alias("len"), x[found].alias("value"), left_pattern(x[pieces], x[found]).alias("left")))

    return df.select("row", "doc_id", F.concat(*[hits(k) for k in (*range(len(BASE)), CANDIDATE)]).alias("hits"))


def places(rows: DataFrame) -> DataFrame:
    """(row, kind, start, end, value, left) of base spans and of candidates beside them; kind CANDIDATE: not known yet."""
    hit = rows.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    upto = W.partitionBy("row", "kind").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    hit = hit.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(upto)).withColumn("start", F.col("end") - F.col("len"))
    hit = hit.filter((F.col("kind") == CANDIDATE) | good(F.col("kind"), F.col("value")))
    base = F.col("kind") < CANDIDATE
    before = W.partitionBy("row").orderBy("start", "kind").rowsBetween(W.unboundedPreceding, -1)
    after = W.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(W.unboundedPreceding, -1)  # read backwards: one pass
    hit = hit.withColumns({"last_end": F.max(F.when(base, F.col("end"))).over(before), "next_start": F.min(F.when(base, F.col("start"))).over(after)})
    clear = (F.coalesce("last_end", F.lit(0)) <= F.col("start")) & (F.coalesce("next_start", F.col("end")) >= F.col("end"))
    return hit.filter(base | clear).select("row", "kind", "start", "end", "value", "left")


def fillers(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, total): how often each of the left patterns stands in the corpus, whatever follows.

    Up to FEW_PATTERNS are broadcast (some 50 bytes each) and other words leave before they are counted; beyond that all are
    counted in their tasks first, and the counts are joined.
    """
    units = F.regexp_extract_all(spaced(F.col("text")), F.lit(rf"[{WORD}]++[^{WORD}]++"), F.lit(0))
    stands = docs.select(F.explode(units).alias("unit")).select(shortened(F.col("unit")).alias("pattern"))
    if patterns.count() <= FEW_PATTERNS:
        return stands.join(F.broadcast(patterns), "pattern", "left_semi").groupBy("pattern").agg(F.count("*").alias("total"))
    return stands.groupBy("pattern").agg(F.count("*").alias("total")).join(patterns, "pattern", "left_semi")


def edges(found: DataFrame) -> DataFrame:
    """(value, pattern, is_left, looks, n): the graph of values and patterns; looks: like an identifier."""
    value = F.col("value")
    affix = F.when(value.rlike("^[A-Za-z0-9]{12,}$"), F.concat(F.left(value, F.lit(4)), F.lit(":"), F.length(value).cast("string")))
    both = F.array(F.struct(F.col("left").alias("pattern"), F.lit(True).alias("is_left")), F.struct(affix.alias("pattern"), F.lit(False).alias("is_left")))
    rows = found.select("value", F.explode(both).alias("of")).select("value", "of.*").filter("pattern IS NOT NULL")
    return rows.groupBy("value", "pattern", "is_left", value.rlike("[0-9@]").alias("looks")).agg(F.count("*").alias("n"))


def trusted(graph: DataFrame, totals: DataFrame, known: DataFrame) -> DataFrame:
    """(pattern, is_left, kind, score) of the patterns that known values (value, kind) make trustworthy."""
    marked = graph.filter("pattern <> ''").join(known, "value", "left")
    by_kind = marked.groupBy("pattern", "is_left", "kind").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("looks"), F.col("n")).otherwise(0)).alias("looks"), F.count("*").alias("values"))
    best = F.max(F.when(F.col("kind").isNotNull(), F.struct("n", (-F.col("kind")).alias("kind"))))
    seen = by_kind.groupBy("pattern", "is_left").agg(
        F.sum(F.when(F.col("kind").isNotNull(), F.col("n"))).alias("known"), F.sum(F.when(F.col("kind").isNotNull(), F.col("values"))).alias("values"), F.sum("looks").alias("looks"), F.sum("n").alias("there"), (-best["kind"]).alias("kind")
    ).filter(F.col("values") >= SUPPORT)
    seen = seen.join(totals.withColumn("is_left", F.lit(True)), ["pattern", "is_left"], "left")
    plain = F.greatest(F.when(F.col("is_left"), F.coalesce("total", "there")).otherwise(F.col("there")) - F.greatest("looks", "known"), F.lit(0))
    score = F.col("known") / (F.col("known") + plain)
    return seen.withColumn("score", score).filter((F.col("score") >= TRUST) & (F.col("known") >= KNOWN * F.col("looks"))).select("pattern", "is_left", "kind", "score")


def accepted(graph: DataFrame, patterns: DataFrame) -> DataFrame:
    """(value, kind) of the values that trusted patterns make likely."""
    met = graph.join(patterns, ["pattern", "is_left"], "left")
    left = F.sum(F.when(F.col("is_left"), F.col("n") * F.coalesce("score", F.lit(0.0)))) / F.sum(F.when(F.col("is_left"), F.col("n")))
    affix = F.coalesce(F.max(F.when(~F.col("is_left"), F.col("score"))), F.lit(0.0))
    best = F.max(F.when(F.col("score").isNotNull(), F.struct("score", (-F.col("kind")).alias("kind"))))
    out = met.groupBy("value").agg((1 - (1 - left) * (1 - affix)).alias("likely"), (-best["kind"]).alias("kind"))
    return out.filter(F.col("likely") >= ACCEPT).select("value", "kind")


def bootstrapped(docs: DataFrame, found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(value, kind) of all known values: seeds, and what rounds of patterns find from them."""
    graph = common.written(edges(found), "value-patterns")
    frequent = graph.filter("is_left AND pattern <> ''").groupBy("pattern").agg(F.count("*").alias("values")).filter(F.col("values") >= SUPPORT)  # others are never trusted
    totals = common.written(fillers(docs, common.written(frequent.select("pattern"), "frequent-patterns")), "fillers")
    seed = F.when(F.col("kind") < CANDIDATE, F.col("kind")).when(F.col("value").rlike(LOOKS_RANDOM), F.lit(SECRET))
    seeds = common.written(found.withColumn("kind", seed).filter("kind IS NOT NULL").groupBy("value").agg(F.min("kind").alias("kind")), "seeds")
    known = seeds
    for _ in range(rounds):
        new = accepted(graph, trusted(graph, totals, known)).join(known, "value", "left_anti")
        new = common.written(new, "new-values")
        if new.isEmpty():
            break
        known = known.unionByName(new)
    return known


def spans(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, spans) of every row of docs; spans: structs (start, kind, end, value, base), by start and kind. kind: a place in KINDS."""
    rows = common.written(matches(docs), "matches")
    found = common.written(places(rows), "places")
    known = bootstrapped(docs, found, rounds)
    own = found.filter(F.col("kind") < CANDIDATE).withColumn("base", F.lit(True))
    more = found.filter(F.col("kind") == CANDIDATE).drop("kind").join(known, "value").withColumn("base", F.lit(False))
    each = own.unionByName(more.select(*own.columns)).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "value", "base"))).alias("spans"))
    none = each.schema["spans"].dataType.simpleString()
    with_hits = rows.filter("size(hits) > 0").select("row", "doc_id").join(each, "row", "left").select("doc_id", F.coalesce("spans", F.array().cast(none)).alias("spans"))
    return with_hits.unionByName(rows.filter("size(hits) = 0").select("doc_id", F.array().cast(none).alias("spans")))


def listed(of: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(of, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op12_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{KINDS[k]}") for k in range(len(BASE))]
    return spans(common.documents(spark, sf_dir)).select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
