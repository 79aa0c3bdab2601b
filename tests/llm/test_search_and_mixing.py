"""Exact search, mixing, chat formatting."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dssforge.llm import chat, mixing, topk
from dssforge.llm.store import Scratch

from .helpers import no_docs, odd_docs

VECTORS = "vec_id long, embedding array<float>, extra int"


def brute_top(rows, is_query, k):
    good = [(i, v, n) for n, (i, v) in enumerate(rows) if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [math.floor(1024 * x) for x in v], n) for i, v, n in good]
    out = []
    for i, q, n in ints:
        if is_query(i):
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j, m) for j, v, m in ints if m != n)[:k]
            out += [(i, rank, j, -s) for rank, (s, j, _) in enumerate(scored, 1)]
    return sorted(out)


def searched(spark, rows, k=3):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 5 == 0, k).collect())


@pytest.mark.parametrize("blocks", [(7, 3), (1000, 1000)])
def test_search_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "CANDIDATES", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    rng = random.Random(8)
    grid = [-0.5, 0.25, 0.125, 0.0, 1.0]
    rows = [(i, [rng.choice(grid) for _ in range(20)]) for i in range(60)]
    rows += [(61, None), (62, [None] * 20), (65, [float("nan")] * 20), (70, [float("inf")] * 20), (None, [1.0] * 20)]
    rows += [(5, rows[3][1]), (5, rows[3][1]), (80, rows[10][1])]
    assert searched(spark, rows) == brute_top(rows, lambda i: i % 5 == 0, 3)


def test_search_across_blocks_with_ragged_vectors_ties_and_hot_copies(spark, monkeypatch):
    """Blocks bounded by components, a vector that a third of the rows share, empty blocks, batches that cut a block."""
    monkeypatch.setattr(topk, "CELLS", 240)
    monkeypatch.setattr(topk, "QUERIES", 11)
    rng = random.Random(12)
    hot = [rng.uniform(-1, 1) for _ in range(24)]
    rows = [(i, hot if i % 3 == 0 else [rng.uniform(-1, 1) for _ in range(rng.choice([24, 24, 24, 3, 0]))]) for i in range(160)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
        assert searched(spark, rows, 4) == brute_top(rows, lambda i: i % 5 == 0, 4)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_a_floor_and_the_bounds_drop_only_what_cannot_be_among_the_best():
    rng = np.random.default_rng(3)
    vectors = rng.integers(-1024, 1024, (500, 40)).astype(float)
    query, ids = rng.integers(-1024, 1024, 40).astype(float), np.arange(500)
    block, scores = topk.Vertical(vectors), vectors @ query
    order = np.lexsort((ids, -scores))
    for floor, kept in ((-np.inf, 10), (scores[order[4]], 5), (scores[order[0]] + 1, 0)):
        at, score = topk.best(query, -1, block, ids, ids, 10, floor)
        assert at.tolist() == order[:kept].tolist() and score.tolist() == scores[order[:kept]].tolist()


def test_search_of_wide_values_and_few_rows(spark):
    rows = [(0, [3e4, -2e6]), (1, [1e6, 1e6]), (2, [-5e5, 7.0])]
    assert searched(spark, rows) == brute_top(rows, lambda i: i % 5 == 0, 3)
    assert searched(spark, [(0, [1.0])]) == [] and searched(spark, []) == []


def test_raking_meets_all_targets(spark, monkeypatch):
    rng = random.Random(9)
    cells = [(s, a, t, float(rng.randint(1, 500))) for s, a, t in itertools.product("abc", "xy", "pqr")]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, n double")
    shares = {"source": {"a": 0.2, "b": 0.3, "c": 0.5}, "lang": {"x": 0.6, "y": 0.4}, "topic": {"p": 0.1, "q": 0.7, "r": 0.2}}
    targets = spark.createDataFrame([(m, v, s) for m, d in shares.items() for v, s in d.items()], "margin string, value string, share double")
    results = []
    for most in (100_000, 0):  # in one task, and distributed
        monkeypatch.setattr(mixing, "ONE_TASK_CELLS", most)
        rows = mixing.rake(df, targets, Scratch(spark), 12 if most else 3).collect()
        results.append({(r.source, r.lang, r.topic): r.w for r in rows})
    for m, d in shares.items():
        for v, s in d.items():
            got = sum(w for k, w in results[0].items() if k[mixing.MARGINS.index(m)] == v)
            assert abs(got - s) < 1e-6
    monkeypatch.setattr(mixing, "ONE_TASK_CELLS", 100_000)
    three = {(r.source, r.lang, r.topic): r.w for r in mixing.rake(df, targets, Scratch(spark), 3).collect()}
    assert all(abs(three[k] - results[1][k]) < 1e-12 for k in three)


def expected_shares(rows, column):
    total = sum(r.mix_tokens * r.mix_p for r in rows)
    return {v: sum(r.mix_tokens * r.mix_p for r in rows if r[column] == v) / total for v in {r[column] for r in rows}}, total / sum(r.mix_tokens for r in rows)


@pytest.mark.parametrize("most", [100_000, 0])
def test_skewed_cells_meet_targets_and_fraction_under_the_bound(spark, monkeypatch, most):
    monkeypatch.setattr(mixing, "ONE_TASK_CELLS", most)
    # Raked without a bound, the cells (b, x, q) and (c, y, q) get probabilities well over 1.
    sizes = {("a", "x", "p"): 400, ("a", "x", "q"): 90, ("a", "y", "p"): 80, ("a", "y", "q"): 80, ("b", "x", "p"): 60, ("b", "x", "q"): 5, ("b", "y", "p"): 50, ("b", "y", "q"): 70, ("c", "x", "p"): 60, ("c", "x", "q"): 40, ("c", "y", "p"): 60, ("c", "y", "q"): 5}
    docs = spark.createDataFrame([(i, "w " * 10, *k) for i, k in enumerate(k for k, n in sizes.items() for _ in range(n))], "doc_id long, text string, source string, lang string, kind string")
    shares = {"source": {"a": 0.5, "b": 0.28, "c": 0.22}, "lang": {"x": 0.55, "y": 0.45}, "kind": {"p": 0.45, "q": 0.55}}
    targets = spark.createDataFrame([("topic" if m == "kind" else m, v, s) for m, d in shares.items() for v, s in d.items()], "margin string, value string, share double")
    rows = mixing.mix(docs, targets, topic_column="kind").collect()
    assert max(r.mix_p for r in mixing.mix(docs, targets, topic_column="kind", bounded=False).collect()) == 1.0
    for m, d in shares.items():
        got, fraction = expected_shares(rows, m)
        assert abs(fraction - 0.5) < 2e-3 and all(abs(got[v] - s) < 2e-3 for v, s in d.items()), (m, got, fraction)


def test_a_target_beyond_its_tokens_is_kept_whole_and_the_rest_shared_out(spark):
    sizes = {("a", "p"): 500, ("b", "p"): 300, ("a", "q"): 30, ("b", "r"): 170}
    docs = spark.createDataFrame([(i, "w " * 10, s, "en", t) for i, (s, t) in enumerate(k for k, n in sizes.items() for _ in range(n))], "doc_id long, text string, source string, lang string, kind string")
    goal = {"p": 0.6, "q": 0.2, "r": 0.2}  # of 1000 documents 500 go; all 30 of q are 0.06 of them
    targets = spark.createDataFrame([*(("topic", v, s) for v, s in goal.items()), ("source", "a", 0.5), ("source", "b", 0.5), ("lang", "en", 1.0)], "margin string, value string, share double")
    rows = mixing.mix(docs, targets, topic_column="kind").collect()
    assert {round(r.mix_p, 9) for r in rows if r.kind == "q"} == {1.0}
    got, fraction = expected_shares(rows, "kind")
    assert abs(fraction - 0.5) < 1e-3
    assert all(abs(got[v] - s) < 1e-3 for v, s in {"q": 0.06, "p": 0.94 * 0.75, "r": 0.94 * 0.25}.items())
    assert abs(expected_shares(rows, "source")[0]["a"] - 0.5) < 1e-3


def test_sample_follows_the_probabilities(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "repeat('w ', 150) AS text", "concat('s', id % 3 % 2) AS source", "'en' AS lang", "'t' AS kind")
    rows = mixing.mix(docs, topic_column="kind").groupBy("source", "mix_p").agg(F.avg(F.col("mix_kept").cast("int")).alias("kept")).collect()
    assert len(rows) == 2 and all(abs(r.kept - r.mix_p) < 0.05 for r in rows)
    kept_tokens = mixing.mix(docs, topic_column="kind").where("mix_kept").count() / 6000
    assert abs(kept_tokens - mixing.FRACTION) < 0.05


def test_mixing_of_odd_rows(spark):
    docs = odd_docs(spark).withColumn("mix_p", F.lit("old")).withColumn("goal_source", F.lit(1))
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count() and {r.mix_tokens for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert all(r.mix_p == 1.0 and r.mix_kept for r in rows if r.mix_tokens == 0 and r.source != "zz" and r.doc_id == 1)
    assert len({r.mix_kept for r in rows if r.doc_id == 5}) == 1
    assert mixing.mix(no_docs(spark)).collect() == []


TURNS = "conv_id long, turn long, role string, text string, seq int"


def formatted(spark, rows):
    turns = spark.createDataFrame([(*r, 0) for r in rows], TURNS)
    return Scratch(spark).keep(chat.format_segments(turns), "segments")


def test_control_strings_come_back(spark):
    rng = random.Random(11)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "[SYS]", "[ROLE ", "[/ROLE]", "\\", "\\l", "\\e", "\\b", "<", "[", "]", "/s>", "a", "\n", "é", " "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(300)]
    segments = formatted(spark, [(i, 0, "user", t) for i, t in enumerate(texts)]).where("part = 1")
    rows = {r.conv_id: r.text for r in segments.collect()}
    assert [chat.unescape(rows[i]) for i in range(len(texts))] == texts
    import re
    assert not any(re.search(chat.DEFAULT.controls, t) for t in rows.values())


def test_machine_accepts_only_the_order_of_the_template(spark):
    orders = ["ua", "sua", "uaua", "a", "u", "us", "ssua", "uau", "uua", "uaa", "aua", "sa", "uasua"]
    roles = {"u": "user", "a": "assistant", "s": "system"}
    rows = [(n, t, roles[r], "x") for n, o in enumerate(orders) for t, r in enumerate(o)]
    got = {r.conv_id: r.valid for r in chat.read_back(formatted(spark, rows)).collect()}
    assert [orders[n] for n in sorted(got) if got[n]] == ["ua", "sua", "uaua"]


def test_chat_of_odd_rows(spark):
    import hashlib
    rows = [(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 2, "to]ol", "z" * 50_000),
            (None, 0, "assistant", "n1"), (None, 1, "assistant", "n2"), (2, 0, "assistant", "")]
    got = {r.conv_id: r for r in chat.read_back(formatted(spark, rows)).collect()}
    turns = [("", ""), ("user", "a"), ("user", "a"), ("user", "b"), ("to]ol", "z" * 50_000)]
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert (got[1].n_turns, got[1].loss_chars, got[None].n_turns, got[None].loss_chars, got[2].loss_chars) == (5, 0, 2, 4, 0)
    assert got[None].loss_sha256 == hashlib.sha256(b"n1n2").hexdigest()
    assert chat.read_back(formatted(spark, [])).collect() == []
