"""Near-duplicates, decontamination and the pipeline against brute force."""

import random

import pytest

from dssforge.llm import buckets, decontam, minhash
from dssforge.llm.components import components
from dssforge.llm.store import Scratch

from .helpers import no_docs, odd_docs


def shingles(text, width=2):
    words = [w.lower() for w in (text or "").replace("\n", " ").split(" ") if w.strip()]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def groups(docs, width=2, percent=80):
    own = {d: d for d, _ in docs}

    def find(i):
        while own[i] != i:
            i = own[i]
        return i

    sets = [(d, shingles(t, width)) for d, t in docs]
    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(d), find(e)
                own[max(x, y)] = min(x, y)
    return {d: find(d) for d in own}


def varied(seed, bases, copies, change):
    rng = random.Random(seed)
    out = []
    for _ in range(bases):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(30, 90))]
        for _ in range(rng.randint(1, copies)):
            out.append(" ".join(f"w{rng.randrange(3000)}" if rng.random() < rng.choice(change) else w for w in words))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("width", [2, 5])
def test_groups_equal_brute_force(spark, width):
    docs = varied(1, 60, 6, (0, 0.01, 0.03, 0.06))
    got = {r.doc_id: (r.component_id, r.kept, r.n_shingles) for r in
           minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width).collect()}
    want = groups(docs, width)
    assert got == {d: (want[d], want[d] == d, len(shingles(t, width))) for d, t in docs}


@pytest.mark.parametrize("turns,share", [(4, 0.05), (4, 0.0), (0, 1.0)])
def test_one_large_group_keeps_every_link(spark, monkeypatch, turns, share):
    monkeypatch.setattr(buckets, "ANCHOR_TURNS", turns)
    monkeypatch.setattr(buckets, "WORTH_A_TURN", share)
    docs = varied(2, 1, 1, (0,))
    rng = random.Random(3)
    base = docs[0][1].split(" ") * 2
    docs = [(i, " ".join(f"w{rng.randrange(3000)}" if rng.random() < rng.choice((0, 0.02, 0.05, 0.08)) else w for w in base)) for i in range(160)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == groups(docs)


def test_last_turn_in_small_blocks_with_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(buckets, "ANCHOR_TURNS", 0)
    monkeypatch.setattr(minhash, "OUTSIDE_BLOCK", 4)
    monkeypatch.setattr(minhash, "INSIDE_BLOCK", 6)
    rng = random.Random(17)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    docs = [(i, " ".join(f"w{rng.randrange(3000)}" if rng.random() < rng.choice((0.02, 0.05, 0.08)) else w for w in base)) for i in range(60)]
    docs += [(5, docs[5][1]), (5, docs[40][1]), (12, "some words that no other document has at all"), (70, None), (None, docs[3][1])]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got.pop(None) is None
    texts = [(d, t) for d, t in docs if d is not None]
    classes = groups([(n, t) for n, (_, t) in enumerate(texts)])  # of texts; a doc_id joins the classes of all its texts
    own = {d: d for d, _ in texts}
    for _ in own:
        least = {}
        for n, (d, _) in enumerate(texts):
            least[classes[n]] = min(least.get(classes[n], d), own[d])
        for n, (d, _) in enumerate(texts):
            own[d] = min(own[d], least[classes[n]])
    assert got == own


def test_sketches_estimate_the_similarity(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    rows = []
    for shared in (400, 640, 760, 800):
        common = rng.integers(0, 2**63, shared, dtype=np.uint64)
        a, b = (np.concatenate([common, rng.integers(0, 2**63, 800 - shared, dtype=np.uint64)]) for _ in range(2))
        x, y = (minhash.odd_sketch(minhash.signature(np.unique(s))).tolist() for s in (a, b))
        rows.append((shared / (1600 - shared), x, y))
    df = spark.createDataFrame(rows, "j double, x array<long>, y array<long>")
    for r in df.select("j", minhash.estimate(df.x, df.y).alias("e")).collect():
        assert abs(r.j - r.e) < minhash.MARGIN


def test_near_duplicates_of_odd_rows(spark):
    rows = minhash.near_duplicates(odd_docs(spark)).collect()
    got = {(r.doc_id, r.component_id, r.kept) for r in rows}
    assert len(rows) == 10 and {(5, 5, True), (6, 5, False), (1, 1, True), (2, 2, True), (3, 3, True), (None, None, True)} <= got
    assert minhash.near_duplicates(no_docs(spark)).collect() == []
    twice = [(7, "a b c d e f g h"), (7, "p q r s t u v w"), (8, "p q r s t u v w"), (3, "a b c d e f g h")]
    rows = minhash.near_duplicates(spark.createDataFrame(twice, "doc_id long, text string")).collect()
    assert {r.component_id for r in rows} == {3} and sum(r.kept for r in rows) == 1


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (200, 201)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark), "t", len(edges)).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    large = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark), "t", 10**9).collect()}
    assert large == got


BENCH = [(1, "One two three four five six seven eight nine ten eleven"), (2, "Short item!"), (2, "second text of Item two"), (3, None), (4, " .. "), (None, "no id here")]
DOCS = [
    (1, "zero ONE, two-three four five six seven eight nine ten eleven twelve"), (2, "a short item? yes. short  ITEM"),
    (3, "one two three four five six seven eight nine"), (4, None), (5, ""), (6, "é second text of item two é"), (6, "short item"),
]


def brute_hits(text, n=10):
    import re
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = re.findall(pattern, (text or "").lower())
    hit, items = set(), set()
    for item, body in BENCH:
        own = re.findall(pattern, (body or "").lower())
        if item is None or not own:
            continue
        size = min(n, len(own))
        for k in range(len(own) - size + 1):
            for p in range(len(words) - size + 1):
                if words[p : p + size] == own[k : k + size]:
                    hit |= set(range(p, p + size))
                    items.add(item)
    return len(words), len(hit), sorted(items)


def test_hits_equal_brute_force_and_large_benchmarks_agree(spark):
    docs, bench = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(BENCH, "item_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in decontam.scan(docs, bench).collect())
    assert got == sorted((d, *brute_hits(t)) for d, t in DOCS)
    single = docs.where("doc_id < 6")
    large = sorted((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in decontam.scan_large(single, bench).collect())
    assert large == [g for g in got if g[0] < 6]
    with pytest.raises(ValueError):
        decontam.scan(docs, bench, max_windows=1)


def test_spans_or_documents_go(spark):
    docs, bench = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(BENCH, "item_id long, text string")
    assert sorted(r.doc_id for r in decontam.decontaminate(docs, bench).collect()) == [3, 4, 5]
    cut = sorted(((r.doc_id, r.text) for r in decontam.decontaminate(docs, bench, "spans").collect()), key=str)
    assert cut == [(1, "zero  twelve"), (2, "a ? yes. "), (3, DOCS[2][1]), (4, None), (5, ""), (6, ""), (6, "é  é")]


def test_decontamination_of_odd_rows(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    docs = odd_docs(spark)
    docs = docs.withColumn("n_hit", docs.doc_id)
    rows = decontam.scan(odd_docs(spark), bench).collect()
    assert sorted(r.doc_id for r in rows if r.n_hit) == [5, 5, 6] and len(rows) == 10
    assert decontam.decontaminate(docs, bench).columns == [c for c in docs.columns]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.scan(no_docs(spark), bench).collect() == [] and not any(r.n_hit for r in decontam.scan(odd_docs(spark), none).collect())


def test_any_number_of_windows_gives_the_same_hits(spark):
    docs, bench = spark.createDataFrame([*DOCS, (None, "Short item"), (None, "nothing")], "doc_id long, text string"), spark.createDataFrame(BENCH, "item_id long, text string")
    want = sorted([*((d, *brute_hits(t)) for d, t in DOCS), (None, 2, 2, [2]), (None, 1, 0, [])], key=str)
    rows = [decontam.hits(docs, bench, max_windows=most).collect() for most in (0, 1000)]
    for got in rows:
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got), key=str) == want
    assert sorted(map(str, rows[0])) == sorted(map(str, rows[1]))
    assert sorted((r.doc_id for r in decontam.decontaminate(docs, bench, max_windows=0).collect()), key=str) == [3, 4, 5, None]
    cut = [sorted(map(str, decontam.decontaminate(docs, bench, "spans", max_windows=most).collect())) for most in (0, 1000)]
    assert cut[0] == cut[1]
    assert decontam.hits(no_docs(spark), bench, max_windows=0).collect() == []


def test_query_and_pipeline_take_a_benchmark_beyond_the_bound(spark, monkeypatch):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    results = []
    for most in (decontam.MAX_WINDOWS, 0):
        monkeypatch.setattr(decontam, "MAX_WINDOWS", most)
        results.append([sorted(map(str, df.collect())) for df in (decontam.query(spark, sf), corpus_pipeline.drop_contaminated(spark, docs, sf))])
    assert results[0] == results[1] and any("contaminated=True" in r for r in results[0][0])
