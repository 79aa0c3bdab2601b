"""Line dedup against brute force on edited lines."""

import random

from pyspark.sql import functions as F

from dssforge.llm.line_dedup import duplicate_lines, histogram, may_be_near, within_edits

from dssforge.llm.store import Scratch

from .helpers import no_docs, odd_docs


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def edited(rng, line, edits):
    line = list(line)
    for _ in range(edits):
        at, kind = rng.randrange(len(line)), rng.randrange(3)
        if kind == 0:
            del line[at]
        elif kind == 1:
            line.insert(at, rng.choice("abé"))
        else:
            line[at] = rng.choice("abé")
    return "".join(line)


def some_lines(seed, n, edits=(0, 1, 1, 2, 2, 3, 5)):
    rng = random.Random(seed)
    bases = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(30, 50))).strip().ljust(30, "x") for _ in range(n // 8)]
    return [edited(rng, rng.choice(bases), rng.choice(edits)) for _ in range(n)]


def expected_classes(lines, edits=2, min_chars=30):
    own = list(range(len(lines)))

    def find(i):
        while own[i] != i:
            i = own[i]
        return i

    for i, a in enumerate(lines):
        for j in range(i):
            b = lines[j]
            near = min(len(a), len(b)) >= min_chars and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits
            if a == b or near:
                x, y = find(i), find(j)
                own[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(lines))]


def test_banded_recurrence_equals_the_distance(spark):
    rng = random.Random(3)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(9, 20)))
        pairs.append((a, edited(rng, a, rng.randint(0, 5)) or "x" * 9))
    pairs = [p for p in pairs if len(p[1]) > 3]
    for edits in (1, 2, 3):
        df = spark.createDataFrame(pairs, "a string, b string")
        got = [r.ok for r in df.select(within_edits(df.a, df.b, edits).alias("ok")).collect()]
        assert got == [distance(a, b) <= edits for a, b in pairs]


def test_classes_equal_brute_force(spark):
    lines = some_lines(1, 240)
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id: (r.class_doc_id, r.kept) for r in duplicate_lines(docs).collect()}
    classes = expected_classes(lines)
    assert got == {i: (c, c == i) for i, c in enumerate(classes)}


def test_one_dense_group_is_resolved(spark, monkeypatch):
    from dssforge.llm import buckets
    monkeypatch.setattr(buckets, "WORTH_A_TURN", 0.0)
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(45)).ljust(45, "x").replace(" ", "_")
    lines = [edited(rng, base, rng.randint(0, 4)) for _ in range(150)]
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    got = [r.class_doc_id for r in duplicate_lines(docs).orderBy("doc_id").collect()]
    assert got == expected_classes(lines)


def test_odd_rows(spark):
    rows = duplicate_lines(odd_docs(spark)).collect()
    assert {r.doc_id for r in rows} == {None, 4, 5, 6, 7, 9}
    same = {(r.doc_id, r.class_doc_id, r.kept) for r in rows if r.doc_id in (5, 6)}
    assert same == {(5, 5, True), (6, 5, False)} and len(rows) == 7
    assert duplicate_lines(no_docs(spark)).collect() == []
    clash = spark.createDataFrame([(1, "x\n\nx\ny", 7, 8)], "doc_id long, text string, h long, key long")
    assert [(r.line_no, r.class_line_no, r.kept) for r in duplicate_lines(clash).orderBy("line_no").collect()] == [(0, 0, True), (2, 0, False), (3, 3, True)]


def test_histograms_never_rule_out_a_near_pair(spark):
    rng = random.Random(12)
    pairs = [(a, edited(rng, a, k), k) for k in (0, 1, 2) for a in some_lines(20 + k, 120, (0,))] + [("e" * 300, "e" * 302, 2)]
    scratch = Scratch(spark)
    df = scratch.keep(spark.createDataFrame(pairs, "a string, b string, k int").select(histogram(F.col("a")).alias("x"), histogram(F.col("b")).alias("y")), "near")
    assert df.where(~may_be_near(2)(F.col("x"), F.col("y"))).isEmpty()
    far = spark.createDataFrame([("the same words here", "the same mountain here")], "a string, b string")
    far = scratch.keep(far.select(histogram(F.col("a")).alias("x"), histogram(F.col("b")).alias("y")), "far")
    assert far.where(may_be_near(2)(F.col("x"), F.col("y"))).isEmpty()


def test_lines_of_one_segment_make_no_pairs(spark, monkeypatch):
    """Lines that share a long beginning and are no near copies: their pairs are ruled out where they meet."""
    from dssforge.llm import line_dedup
    rng = random.Random(14)
    lines = ["one beginning that all of these many lines share, then " + "".join(rng.choice("abcdefghiklmnoprstu ") for _ in range(24)) for _ in range(190)]
    listed = []
    plain = line_dedup._Links.__call__
    monkeypatch.setattr(line_dedup._Links, "__call__", lambda self, pairs, rows: (listed.append(rows), plain(self, pairs, rows))[1])
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    got = [r.class_doc_id for r in duplicate_lines(docs).orderBy("doc_id").collect()]
    assert got == expected_classes(lines) and sum(listed) < len(lines) * (len(lines) - 1) / 20


def test_classes_of_many_lines(spark, monkeypatch):
    from dssforge.llm import line_dedup
    monkeypatch.setattr(line_dedup, "HOT_SHARE", 0.05)
    lines = some_lines(9, 80) + ["short"] * 30 + ["another short"]
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    got = [r.class_doc_id for r in duplicate_lines(docs).orderBy("doc_id").collect()]
    assert got == expected_classes(lines)
