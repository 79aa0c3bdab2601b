"""Toxicity field and quality model: brute force, held-out accuracy, odd rows."""

import itertools

import numpy as np
import pyarrow as pa
import pytest

from dssforge.llm import bytetext as B
from dssforge.llm import quality, toxicity
from dssforge.llm.store import Scratch
from dssforge.llm.training import Sample, held_out, labelled_sample

from .helpers import no_docs, odd_docs

SF = "/root/testdata/sf0.01"


def test_messages_give_the_marginals_of_all_taggings():
    rng = np.random.default_rng(1)
    chain = np.array([0, 4, 5, 10])
    e, t, start = rng.normal(size=10), rng.normal(size=(2, 2)), 0.3
    a, b = toxicity.messages(e, chain, t, start)
    got = toxicity.sigmoid(a + b)
    for lo, hi in zip(chain[:-1], chain[1:]):
        total, toxic = 0.0, np.zeros(hi - lo)
        for tags in itertools.product((0, 1), repeat=hi - lo):
            score = start * tags[0] + sum(e[lo + i] * y for i, y in enumerate(tags)) + sum(t[x, y] for x, y in zip(tags, tags[1:]))
            total += np.exp(score)
            toxic += np.exp(score) * np.array(tags)
        assert np.allclose(got[lo:hi], toxic / total)


def test_field_learns_words_and_marks_their_place(spark):
    bad, good = "you are a vermlike person\nsecond line here", "you are a kind person\nsecond line there"
    texts = [f"{w} {bad}" for w in map(str, range(60))] + [f"{w} {good}" for w in map(str, range(60))]
    y = [1] * 60 + [0] * 60
    # Each line is different, as copies of a line count once.
    texts = [t.replace("person", f"person{i}") for i, t in enumerate(texts)]
    scratch = Scratch(spark)
    rows = scratch.keep(spark.createDataFrame(list(zip(y, texts)), "y int, text string").repartition(5), "rows")
    model = toxicity.fit(Sample(rows, {0: 1.0, 1: 1.0}, 0.5), scratch)
    column = pa.array(["é so vermlike indeed", "so kind indeed", ""])
    (_, _, data, at), = B.slices(column)
    c = toxicity.chains(data, at)
    p = model.marginals(c)
    scores = model.scores(toxicity.document_figures(p, c.text))
    spans = toxicity._spans_of(c, p, data, at)
    assert scores[0] > 0.7 > max(scores[1:]) and [(s["start"], s["end"]) for s in spans[0]] == [(5, 13)] and spans[1:] == [[], []]


@pytest.mark.parametrize("module,label,floor", [(toxicity, "toxic", 0.95), (quality, "quality", 0.97)])
def test_held_out_accuracy(spark, module, label, floor):
    rows = module.query(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    known = rows[rows.held_out].merge(labels, on="doc_id")
    assert len(rows) == 1000 and rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.7)).all()
    assert (known.predicted == known[label]).mean() >= floor


@pytest.mark.parametrize("module,column", [(toxicity, "toxicity"), (quality, "quality_score")])
def test_odd_rows_and_one_sided_labels(spark, module, column):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(5, 1, 1), (7, 0, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    model = module.learn(docs, labels)
    rows = module.score(docs.withColumn(column, docs.doc_id), model).collect()
    assert len(rows) == docs.count() and all(0 <= r[column] <= 1 for r in rows)
    assert len({r[column] for r in rows if r.doc_id in (1, 2)}) == 1
    assert module.score(no_docs(spark), model).collect() == []
    for value in (0, 1):
        one = spark.createDataFrame([(d, value, value) for d in range(1, 10)], "doc_id long, quality int, toxic int")
        assert {round(r[column]) for r in module.score(docs, module.learn(docs, one)).collect()} == {value}
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert len(module.score(docs, module.learn(docs, none)).collect()) == docs.count()


def test_additive_model_learns_a_pair_of_figures():
    rng = np.random.default_rng(3)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000], np.ones(3000))
    assert (0, 1) in model.pairs and ((model.scores(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.95


def test_field_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(6)
    chain, seat = np.array([0, 3, 4, 8]), rng.integers(0, 5, (8, 2)).astype(np.int32)
    target, weight = rng.integers(0, 2, 8).astype(float), rng.random(8) + 0.5
    for lo, hi in zip(chain[:-1], chain[1:]):
        weight[lo:hi] = weight[lo]  # one weight a line
    kinds = seat.shape[1]

    def loss(x):
        w, start, bias, t = x[:5], x[5], x[6], x[7:].reshape(2, 2)
        e, total = w[seat].sum(axis=1) + bias, 0.0
        for lo, hi in zip(chain[:-1], chain[1:]):
            def score(tags):
                return start * tags[0] + sum(e[lo + i] * y for i, y in enumerate(tags)) + sum(t[a, b] for a, b in zip(tags, tags[1:]))
            every = [score(tags) for tags in itertools.product((0, 1), repeat=hi - lo)]
            total += weight[lo] * (np.logaddexp.reduce(every) - score([int(v) for v in target[lo:hi]]))
        return total

    x = rng.normal(size=11) * 0.3
    got = toxicity.field_gradient(x, seat, target, weight, chain, 5)
    near = [(loss(x + d) - loss(x - d)) / 2e-6 for d in np.eye(11) * 1e-6]
    assert kinds == 2 and np.allclose(got, near, atol=1e-4)


def test_marked_features_equal_a_plain_count(spark):
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(300):
        picked = list(rng.choice(words, 6)) + [f"own{i}"]
        toxic = "w3" in picked
        rows.append((int(toxic or rng.random() < 0.02), " ".join(picked)))
    scratch = Scratch(spark)
    lines = scratch.keep(spark.createDataFrame(rows, "y int, text string").mapInArrow(toxicity._lines, "name long, y int, n int, features binary"), "lines")
    strong = {(r.kind, r.feature) for r in toxicity.strong_features(lines, 300, sum(y for y, _ in rows), scratch).collect()}
    (_, _, data, at), = B.slices(pa.array([f"{w}" for w in words]))
    names = B.signed(toxicity.chains(data, at).features[:, 0].copy()).tolist()
    n, bad_lines = len(rows), sum(y for y, _ in rows)
    want = set()
    distinct = len({w for _, t in rows for w in t.split()})
    for w in words:
        df, bad = sum(w in t.split() for _, t in rows), sum(y for y, t in rows if w in t.split())
        share, base = bad / df, bad_lines / n
        g = 2 * ((bad * np.log(share / base) if bad else 0) + ((df - bad) * np.log((1 - share) / (1 - base)) if df > bad else 0))
        if g > 2 * np.log(distinct + 1) + 2 and (bad + 0.5) / (bad_lines + 1) / ((df - bad + 0.5) / (n - bad_lines + 1)) > 4:
            want.add((0, names[words.index(w)]))
    assert {k for k in strong if k[0] == 0} == want and len(want) >= 1


def test_sample_is_bounded_and_takes_whole_texts(spark):
    docs = spark.createDataFrame([(i, "x" * (100_000 if i == 2 else 5)) for i in range(300)] + [(1, "a"), (2, None)], "doc_id long, text string")
    docs = docs.withColumnsRenamed({}).selectExpr("doc_id", "text", "1 AS id", "2 AS y")
    labels = spark.createDataFrame([(i, i % 3 % 2) for i in range(400)] + [(2, 1), (7, None), (None, 1)], "doc_id long, q int")
    sample = labelled_sample(docs, labels, "q", 3, 1, Scratch(spark), per_class=20)
    rows = sample.rows.collect()
    assert sorted(r.y for r in rows) == [0] * 20 + [1] * 20
    known = labels.where("q is not null and doc_id is not null").where(~held_out(labels.doc_id, 3, 1)).groupBy("doc_id").agg({"q": "max"}).collect()
    share = sum(r[1] for r in known) / len(known)
    assert abs(sample.share - share) < 1e-12 and abs(sample.weights[1] / sample.weights[0] - share / (1 - share)) < 1e-9
    everything = labelled_sample(docs, labels, "q", 3, 1, Scratch(spark))
    texts = [r.text for r in everything.rows.collect()]
    assert ("x" * 100_000 in texts) == (2 in {r.doc_id for r in known}) and len(texts) == len([r for r in known if r.doc_id < 300])


def test_scores_keep_columns_of_any_name(spark):
    docs = odd_docs(spark).withColumnsRenamed({"lang": "a`b", "source": "id", "n_chars": "y"})
    labels = spark.createDataFrame([(5, 1, 1), (7, 0, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")
    for module in (toxicity, quality):
        found = module.score(docs, module.learn(docs, labels))
        assert found.columns[:5] == docs.columns and found.count() == docs.count()
