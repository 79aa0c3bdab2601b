"""Interaction of corpus filters: what each removes in every order of application.

Each document gets one bit per filter it fails.  The filters on the text alone are
SQL expressions (here over ``text``, null as empty, and ``words``, its distinct and
whole word counts).  The filter on copies is an existential self-join: a
document fails when some document of a smaller doc_id has the same text, found by a
left-semi join on the hash of the text, the text itself and the smaller doc_id.

Only texts whose hash occurs more than once enter the join.  Its right side is
one row per such text, the least doc_id (partial aggregation; any smaller doc_id
implies that one), so a group of copies that holds a third of all rows has one
partner, not a square of them.  Hashes of more than ``HOT_SHARE`` of the rows are
dealt over salts on the left and repeated for each salt on the right; there are at
most 1 / HOT_SHARE of them, so their list is broadcast.

The marked ids are united with the ids that fail another filter, and the bits of each
id are combined.  What follows works on the counts of bit combinations: for
each part and each filter f with each set P of filters before it (80 states for five
filters) the documents removed, kept and redundant; every one of the 120 orders
is a path through these states, and a filter's Shapley sum weighs its states with
the number of orders that pass through them.

Defined results: null text is empty; null parts are ``''``; a null doc_id is never a
copy and makes none; rows that repeat a doc_id are counted each, and are not copies of
each other unless a smaller doc_id has the text; a doc_id labelled more than once
counts with its largest label; an empty table has no parts and no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dssforge.llm.store import Scratch, small

#: White space between words: blank and the ASCII controls 9 to 13.
_WHITE = " \t\n\x0b\x0c\r"
#: Conditions under which a text fails, by filter; the copies' filter is ``COPIES``.
FILTERS = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_capitals > 3 * n_chars",
    "D": "marked",
}
COPIES = "E"
#: Share of the rows from which on a text's hash is salted.
HOT_SHARE = 1 / 1000


def figures(text: Column) -> dict[str, Column]:
    """What the filters look at: n_words, n_distinct, n_capitals, n_chars and marked (one of # $ % & * |)."""
    words = F.array_remove(F.split(F.translate(text, _WHITE, " " * len(_WHITE)), " "), "")
    return {
        "words": words,
        "n_chars": F.length(text),
        "n_capitals": F.regexp_count(text, F.lit("[A-Z]")),
        "marked": text.rlike("[#$%&*|]"),
    }


def copies(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of ``docs`` (doc_id, hash, text, ..) whose text some smaller doc_id has, without the text."""
    shared = docs.groupBy(F.col("hash").alias("of")).agg(F.count("*").alias("copies")).where("copies > 1")
    shared = scratch.keep(shared, "shared")
    total = docs.count()
    hot = shared.where(F.col("copies") > total * HOT_SHARE).select(F.col("of").alias("hot"), F.ceil(F.col("copies") / (total * HOT_SHARE)).cast("int").alias("salts"))
    repeated = docs.join(small(shared.select("of")), F.col("hash") == F.col("of"), "left_semi")
    repeated = repeated.join(F.broadcast(hot), F.col("hash") == F.col("hot"), "left").withColumn("salts", F.coalesce("salts", F.lit(1))).drop("hot")
    least = repeated.groupBy(F.col("hash").alias("h"), F.col("text").alias("t")).agg(F.min("doc_id").alias("least"), F.max("salts").alias("n_salts"))
    least = least.select("h", "t", "least", F.explode(F.sequence(F.lit(0), F.col("n_salts") - 1)).alias("s"))
    left = repeated.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("salts")).cast("int"))
    same = (F.col("hash") == F.col("h")) & (F.col("salt") == F.col("s")) & (F.col("text") == F.col("t")) & (F.col("least") < F.col("doc_id"))
    return left.join(least, same, "left_semi").drop("text", "salts", "salt")


def combinations(docs: DataFrame, labels: DataFrame, filters: dict[str, str] | None = None, copies_name: str = COPIES, part: str = "lang") -> DataFrame:
    """(part, bits, n, good, toxic): documents by the set of filters they fail, bit i for the i-th filter in order of name."""
    scratch = Scratch(docs.sparkSession)
    filters = FILTERS if filters is None else filters
    names = sorted([*filters, copies_name])
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    seen = rows.withColumns(figures(F.col("text"))).withColumns({"n_words": F.size("words"), "n_distinct": F.size(F.array_distinct("words"))})
    bits = sum((F.when(F.expr(fails), F.lit(1 << names.index(name))).otherwise(F.lit(0)) for name, fails in sorted(filters.items())), F.lit(0))
    failed = seen.select("doc_id", "hash", "part", bits.alias("bits"), F.lit(1).cast("long").alias("n"))
    marked = copies(rows, scratch).select("doc_id", "hash", "part", F.lit(1 << names.index(copies_name)).alias("bits"), F.lit(0).cast("long").alias("n"))
    # Rows that repeat a doc_id with one text fail alike, so they are combined as one id.
    per_id = failed.unionByName(marked).groupBy("doc_id", "hash", "part").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    told = per_id.join(known, F.col("doc_id") == F.col("id"), "left")
    label = {name: F.sum(F.when(F.col(column) == 1, F.col("n")).otherwise(0)).alias(name) for name, column in (("good", "quality"), ("bad", "toxic"))}
    found = told.groupBy("part", "bits").agg(F.sum("n").alias("n"), label["good"], label["bad"])
    return scratch.keep(found.withColumnRenamed("bad", "toxic"), "combinations")


def orders(found: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order of the filters and step of the combinations ``found`` (see ``query`` for the columns)."""
    k = len(names)
    states = [(f, p) for f in range(k) for p in range(1 << k) if not p >> f & 1]
    spark = found.sparkSession
    state = F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.lit(p).alias("p")) for f, p in states))).alias("state")
    rows = found.select("*", state).select("*", "state.f", "state.p")
    fails = F.shiftright("bits", 0).bitwiseAND(F.call_function("shiftleft", F.lit(1), F.col("f"))) != 0
    gone = F.col("bits").bitwiseAND(F.col("p")) != 0
    count = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0)).cast("long")
    per_state = rows.groupBy("part", "f", "p").agg(
        count(~fails & ~gone).alias("kept"), count(fails & ~gone).alias("removed"), count(fails & gone).alias("redundant"),
        count(F.col("bits") == F.call_function("shiftleft", F.lit(1), F.col("f"))).alias("unique_fails"),
        count(fails & ~gone, "good").alias("good_lost"), count(fails & ~gone, "toxic").alias("toxic_lost"))
    weight = sum((F.when(F.bit_count("p") == before, F.lit(factorial(before) * factorial(k - 1 - before))).otherwise(F.lit(0)) for before in range(k)), F.lit(0))
    shapley = per_state.groupBy(F.col("part").alias("sp"), F.col("f").alias("sf")).agg(F.sum(F.col("removed") * weight).cast("long").alias("shapley"))
    path = []
    for order in permutations(range(k)):
        before = 0
        for step, f in enumerate(order, 1):
            path.append(("".join(names[x] for x in order), step, f, before))
            before |= 1 << f
    paths = spark.createDataFrame(path, "filter_order string, step int, of int, before int")
    out = per_state.join(F.broadcast(paths), (F.col("f") == F.col("of")) & (F.col("p") == F.col("before")))
    out = out.join(shapley, (F.col("part") == F.col("sp")) & (F.col("f") == F.col("sf")))
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, str] | None = None, copies_name: str = COPIES, part: str = "lang") -> DataFrame:
    """Counts at each step of each order of ``filters`` (name: condition of failure) and the copies' filter, per part.

    Names are single letters; a step's filter is that letter of filter_order.
    """
    filters = FILTERS if filters is None else filters
    return orders(combinations(docs, labels, filters, copies_name, part), sorted([*filters, copies_name]))


def query(spark, sf_dir: str) -> DataFrame:
    """``op12_filter_audit``: kept, removed, redundant, unique and lost documents at each step of all 120 orders, per language."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return audit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic"))


ORACLE = r"""
WITH doc AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), figures AS (
  SELECT doc_id, part, text, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+') AS words,
         length(text) AS n_chars, length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals FROM doc
), firsts AS (SELECT text AS t, min(doc_id) AS least FROM doc GROUP BY text
), known AS (SELECT doc_id AS id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
), fails AS MATERIALIZED (
  SELECT part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b, 100 * n_capitals > 3 * n_chars AS c,
         regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > least, FALSE) AS e, coalesce(quality = 1, FALSE) AS good, coalesce(toxic = 1, FALSE) AS toxic
  FROM figures LEFT JOIN firsts ON t = text LEFT JOIN known ON id = doc_id
), cells AS MATERIALIZED (
  SELECT part, {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM fails GROUP BY ALL
), failed AS MATERIALIZED (
  SELECT part, n, good, toxic,
         (CASE WHEN f.A THEN 'A' ELSE '' END) || (CASE WHEN f.B THEN 'B' ELSE '' END) || (CASE WHEN f.C THEN 'C' ELSE '' END)
         || (CASE WHEN f.D THEN 'D' ELSE '' END) || (CASE WHEN f.E THEN 'E' ELSE '' END) AS letters FROM cells
), letter(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), perms AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x
), steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before FROM perms, range(1, 6) t(step)
), counted AS MATERIALIZED (
  SELECT part, filter_order, step, x,
         coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND failing), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND failing), 0) AS redundant, coalesce(sum(n) FILTER (letters = x), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND failing), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND failing), 0) AS toxic_lost
  FROM (SELECT *, contains(letters, x) AS failing, translate(letters, before, '') <> letters AS gone FROM failed, steps) GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM counted
"""
