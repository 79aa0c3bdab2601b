"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic).  The cells' token weights
are raked: scaled in turn to meet each margin's target shares, until all three
hold.  A document's probability is its cell's raked weight per token, scaled so
that the expected tokens are ``fraction`` of all (at most 1), and a document is
kept when a hash of its doc_id, read as a number in [0, 1), lies below it.

The fit is bounded: no cell's weight counts for more than its tokens can give,
and what a full cell cannot take goes to the others of its margins.  A value
whose target is more than all its tokens is kept whole, and the rest of its margin is
shared out in proportion to the other targets, so ``fraction`` holds (without the
bound, ``bounded=False``, probabilities are cut at 1 and the excess is lost).

Only DataFrame functions are used.  Documents are read once into cell sums
(partial aggregation; a hot source is one row per task) and once to be sampled;
every step of the fit works on the cell table, whose rows are distinct (source,
language, topic) triples.

The targets are each value's token share to the power ``TEMPER``, normalised, so
rare sources, languages and topics gain weight; other targets can be given as
a table (margin, value, share).

Defined results: null source, language or topic is the value ``''``; null or
blank text has 0 tokens, and cells without tokens keep probability 1; rows are
sampled one by one, those that repeat a doc_id alike; a null doc_id hashes as
the text ``''``; an empty table stays empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dssforge.llm.store import Scratch, small

TEMPER, FRACTION, ROUNDS = 0.5, 0.5, 12
#: Steps of the fit between two written tables.
STEPS_PER_TABLE = 9
#: Most cells that are raked in one task; beyond it every step is distributed.
ONE_TASK_CELLS = 100_000
MARGINS = ("source", "lang", "topic")
#: Whole tokens below which a text is a note, and from which it is long.
SHORT, LONG = 100, 1000


def tokens(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def topic(text: Column, n_tokens: Column) -> Column:
    """A text's kind, for tables without a topic column: tables, shouting, notes, long texts, prose."""
    cells = F.length(text) - F.length(F.replace(text, F.lit(" | "), F.lit("  ")))
    shouts = F.length(text) - F.length(F.replace(text, F.lit("!!"), F.lit("!")))
    return (
        F.when(4 * cells >= n_tokens, "table").when(4 * shouts >= n_tokens, "shout")
        .when(n_tokens < SHORT, "note").when(n_tokens >= LONG, "long").otherwise("prose")
    )


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) from the md5 of the doc_id as text (52 bits)."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(2**52))


def cells_of(docs: DataFrame) -> DataFrame:
    """(source, lang, topic, n) of documents with columns source, lang, topic and n_tokens: their sums."""
    return docs.groupBy(*MARGINS).agg(F.sum("n_tokens").cast("double").alias("n"))


def tempered_targets(cells: DataFrame, temper: float = TEMPER) -> DataFrame:
    """(margin, value, share): token shares to the power ``temper``, normalised within each margin."""
    sums = [cells.groupBy(F.col(m).alias("value")).agg(F.sum("n").alias("n")).where("n > 0").select(F.lit(m).alias("margin"), "value", F.pow("n", F.lit(temper)).alias("w")) for m in MARGINS]
    shares = reduce(DataFrame.unionByName, sums)
    totals = shares.groupBy(F.col("margin").alias("of")).agg(F.sum("w").alias("total"))
    return shares.join(F.broadcast(totals), F.col("margin") == F.col("of")).select("margin", "value", (F.col("w") / F.col("total")).alias("share"))


def attainable(cells: DataFrame, targets: DataFrame, scratch: Scratch, fraction: float = FRACTION) -> DataFrame:
    """``targets`` scaled and filled up so that no share is more than all its value's tokens are of the sample.

    Within a margin the shares are least(most, scale * share), summing to 1 (or to
    what the values with targets hold, if some margin's hold less than the sample).  The scale
    is found by Newton steps, each one aggregation; only the scales reach the driver.
    """
    total = cells.agg(F.sum("n")).first()[0] or 1.0
    sums = [cells.groupBy(F.lit(m).alias("margin"), F.col(m).alias("value")).agg(F.sum("n").alias("n")).where("n > 0") for m in MARGINS]
    most = reduce(DataFrame.unionByName, sums).withColumn("most", F.col("n") / F.lit(total * fraction))
    goals = scratch.keep(targets.join(most, ["margin", "value"]).where("share > 0").select("margin", "value", "share", "most"), "goals")
    reach = min([1.0, *(r["most"] for r in goals.groupBy("margin").agg(F.sum("most").alias("most")).collect())])
    scale = dict.fromkeys(MARGINS, 0.0)
    while True:
        by = reduce(lambda out, m: out.when(F.col("margin") == m, F.lit(scale[m])), MARGINS, F.when(F.lit(False), F.lit(0.0)))
        share = F.col("share") * by
        full = share >= F.col("most")
        rows = goals.groupBy("margin").agg(F.sum(F.when(full, F.col("most")).otherwise(0.0)).alias("held"), F.sum(F.when(full, 0.0).otherwise(F.col("share"))).alias("free")).collect()
        now = scale | {r["margin"]: (reach - r["held"]) / r["free"] for r in rows if r["free"] > 0}
        if all(now[m] <= scale[m] * (1 + 1e-12) for m in MARGINS):
            return goals.select("margin", "value", F.least("most", share).alias("share"))
        scale = {m: max(now[m], scale[m]) for m in MARGINS}


def rake(cells: DataFrame, targets: DataFrame, scratch: Scratch, rounds: int = ROUNDS, fraction: float | None = None) -> DataFrame:
    """``cells`` (source, lang, topic, n) with ``w``, fitted to ``targets``; w starts as the cell's share of all n.

    Each step multiplies w by target / current sum of one margin.  A value
    without a target gets none of the weight; a target without cells is left
    out.  With a ``fraction`` no cell's w counts for more than ``most``, its tokens' share
    of the sample: a step solves the sum of least(w, most) for its target, by one
    Newton step on the full and the free cells.  Up to ``ONE_TASK_CELLS`` counted cells the steps are windows in one task,
    written every ``STEPS_PER_TABLE`` steps; more cells are summed by partial
    aggregation, joined and written at every step.
    """
    now = cells.where("n > 0").withColumn("w", F.col("n") / cells.agg(F.sum("n").alias("total")).scalar())
    for m in MARGINS:
        goals = targets.where(F.col("margin") == m).select(F.col("value").alias("of"), F.col("share").alias(f"goal_{m}"))
        now = now.join(goals, F.col(m) == F.col("of"), "left").drop("of").fillna(0.0, [f"goal_{m}"])
    total = cells.agg(F.sum("n").alias("total")).scalar()
    now = now.withColumn("most", F.lit(float("inf")) if fraction is None else F.col("n") / (total * fraction))
    now = scratch.keep(now.coalesce(1) if cells.count() <= ONE_TASK_CELLS else now, "raked-0")
    one_task = now.count() <= ONE_TASK_CELLS
    steps = rounds * len(MARGINS)
    full = F.col("w") >= F.col("most")
    parts = {"sum": F.sum(F.least("w", "most"))}
    if fraction is not None:
        parts |= {"held": F.sum(F.when(full, F.col("most")).otherwise(0.0)), "free": F.sum(F.when(full, 0.0).otherwise(F.col("w")))}
    for step in range(steps):
        m = MARGINS[step % len(MARGINS)]
        goal = F.col(f"goal_{m}")
        fitted = F.when(F.col("sum") > 0, F.col("w") * goal / F.col("sum")).otherwise(F.lit(0.0))
        if fraction is not None:
            more = F.when(F.col("free") > 0, F.col("w") * (goal - F.col("held")) / F.col("free")).otherwise(F.col("w"))
            fitted = F.when(goal > F.col("sum"), more).otherwise(fitted)
        if one_task:
            now = (now.coalesce(1) if step % STEPS_PER_TABLE == 0 else now).withColumns({k: v.over(Window.partitionBy(m)) for k, v in parts.items()})
        else:
            sums = now.groupBy(F.col(m).alias("of")).agg(*(v.alias(k) for k, v in parts.items()))
            now = now.join(sums, F.col(m) == F.col("of")).drop("of")
        now = now.withColumn("w", fitted).drop(*parts)
        if not one_task or (step + 1) % STEPS_PER_TABLE == 0 or step + 1 == steps:
            now = scratch.keep(now, f"raked-{step + 1}")
    return now.withColumn("w", F.least("w", "most")).drop("most")


def probabilities(raked: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """(source, lang, topic, p): raked weight per token times ``fraction`` of all tokens, 1 at most."""
    total = raked.agg(F.sum("n").alias("total")).scalar()
    return raked.select(*MARGINS, F.least(F.lit(1.0), F.col("w") / F.col("n") * total * fraction).alias("p"))


def mix(docs: DataFrame, targets: DataFrame | None = None, fraction: float = FRACTION, temper: float = TEMPER, rounds: int = ROUNDS, topic_column: str | None = None, bounded: bool = True) -> DataFrame:
    """``docs`` with mix_tokens, mix_topic, mix_p and mix_kept appended; such columns are replaced."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.drop("mix_tokens", "mix_topic", "mix_p", "mix_kept")
    # Columns go by their place meanwhile, so that any names of theirs are kept apart from those made here.
    names, at = docs.columns, {name: f"c{i}" for i, name in enumerate(docs.columns)}
    told = docs.toDF(*at.values())
    words, said = F.col(at["text"]).cast("string"), F.coalesce(F.col(at["text"]).cast("string"), F.lit(""))
    told = told.withColumn("mix_tokens", tokens(words))
    kind = F.coalesce(F.col(at[topic_column]).cast("string"), F.lit("")) if topic_column else topic(said, F.col("mix_tokens"))
    told = told.withColumns({"mix_topic": kind, "mix_source": F.coalesce(F.col(at["source"]).cast("string"), F.lit("")), "mix_lang": F.coalesce(F.col(at["lang"]).cast("string"), F.lit(""))})
    keyed = told.select(F.col("mix_source").alias("source"), F.col("mix_lang").alias("lang"), F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("n_tokens"))
    cells = scratch.keep(cells_of(keyed), "cells")
    targets = scratch.keep(tempered_targets(cells, temper), "targets") if targets is None else targets
    raked = rake(cells, attainable(cells, targets, scratch, fraction), scratch, rounds, fraction) if bounded else rake(cells, targets, scratch, rounds)
    p = scratch.keep(probabilities(raked, fraction).toDF("p_source", "p_lang", "p_topic", "mix_p"), "p")
    same = (F.col("mix_source") == F.col("p_source")) & (F.col("mix_lang") == F.col("p_lang")) & (F.col("mix_topic") == F.col("p_topic"))
    out = told.join(small(p, 200_000), same, "left").withColumn("mix_p", F.coalesce("mix_p", F.lit(1.0)))
    kept = uniform(F.col(at["doc_id"])) < F.col("mix_p")
    return out.select(*at.values(), "mix_tokens", "mix_topic", "mix_p", kept.alias("mix_kept")).toDF(*names, "mix_tokens", "mix_topic", "mix_p", "mix_kept")


def query(spark, sf_dir: str) -> DataFrame:
    """``op5_mix_sources``: cell, probability and decision for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    return mix(docs).select(
        "doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("n_tokens"),
        F.round("mix_p", 6).alias("p"), F.col("mix_kept").alias("kept"))


def _oracle() -> str:
    steps = []
    for k in range(ROUNDS * len(MARGINS)):
        m = MARGINS[k % len(MARGINS)]
        steps.append(f"""r{k + 1} AS MATERIALIZED (
  SELECT source, lang, topic, n, most, CASE
      WHEN goal > total THEN CASE WHEN free > 0 THEN w * (goal - held) / free ELSE w END
      WHEN total > 0 THEN w * goal / total ELSE 0 END AS w
  FROM (SELECT r.*, coalesce(t.share, 0) AS goal, sum(least(w, most)) OVER v AS total,
               sum(CASE WHEN w >= most THEN most ELSE 0 END) OVER v AS held, sum(CASE WHEN w >= most THEN 0 ELSE w END) OVER v AS free
        FROM r{k} r LEFT JOIN attained t ON t.margin = '{m}' AND t.value = r.{m} WINDOW v AS (PARTITION BY r.{m})) x)""")
    most = " UNION ALL ".join(f"SELECT '{m}' AS margin, {m} AS value, sum(n) / (any_value(all_n) * {FRACTION}) AS most FROM cells, whole GROUP BY {m} HAVING sum(n) > 0" for m in MARGINS)
    shares = " UNION ALL ".join(f"SELECT '{m}' AS margin, {m} AS value, pow(sum(n), {TEMPER}) AS w FROM cells GROUP BY {m} HAVING sum(n) > 0" for m in MARGINS)
    return rf"""
WITH told AS (
  SELECT doc_id, source, lang, coalesce(source, '') AS s, coalesce(lang, '') AS l, coalesce(text, '') AS text,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS BIGINT) AS n_tokens
  FROM documents
), doc AS MATERIALIZED (
  SELECT doc_id, source, lang, s, l, n_tokens,
         CASE WHEN 4 * (length(text) - length(replace(text, ' | ', '  '))) >= n_tokens THEN 'table'
              WHEN 4 * (length(text) - length(replace(text, '!!', '!'))) >= n_tokens THEN 'shout'
              WHEN n_tokens < {SHORT} THEN 'note' WHEN n_tokens >= {LONG} THEN 'long' ELSE 'prose' END AS topic
  FROM told
), cells AS MATERIALIZED (SELECT s AS source, l AS lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS n FROM doc GROUP BY ALL
), shares AS ({shares}
), whole AS (SELECT coalesce(nullif(sum(n), 0), 1.0) AS all_n FROM cells
), targets AS MATERIALIZED (SELECT margin, value, w / sum(w) OVER (PARTITION BY margin) AS share FROM shares
), goals AS MATERIALIZED (SELECT margin, value, share, most FROM targets JOIN ({most}) USING (margin, value) WHERE share > 0
), reach AS (SELECT least(1.0, min(total)) AS reach FROM (SELECT sum(most) AS total FROM goals GROUP BY margin)
), filled AS (
  SELECT *, coalesce(sum(most) OVER (PARTITION BY margin ORDER BY most / share, value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(share) OVER (PARTITION BY margin ORDER BY most / share, value ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM goals
), scales AS (SELECT margin, max((reach - held) / open) AS scale FROM filled, reach WHERE (reach - held) / open <= most / share GROUP BY margin
), attained AS MATERIALIZED (SELECT margin, value, least(most, share * coalesce(scale, 'infinity')) AS share FROM goals LEFT JOIN scales USING (margin)
), r0 AS MATERIALIZED (SELECT source, lang, topic, n, n / sum(n) OVER () AS w, n / (all_n * {FRACTION}) AS most FROM cells, whole WHERE n > 0
), {", ".join(steps)}
, p AS (SELECT source, lang, topic, least(1.0, least(w, most) / n * sum(n) OVER () * {FRACTION}) AS p FROM r{ROUNDS * len(MARGINS)})
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(coalesce(p.p, 1.0), 6) AS p,
       CAST(('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) / 4503599627370496.0 < coalesce(p.p, 1.0) AS kept
FROM doc d LEFT JOIN p ON d.s = p.source AND d.l = p.lang AND d.topic = p.topic
"""


ORACLE = _oracle()
