"""Filter audit: odd rows and planted copies against a document-by-document version."""

import re
from collections import Counter
from itertools import permutations

import pytest

from dssforge.llm import audit

from .helpers import no_docs, odd_docs

LABELS = "doc_id long, quality int, toxic int"


def plain(docs, labels):
    rows = [(r.doc_id, r.lang or "", r.text or "") for r in docs.collect()]
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in labels.collect() if r.toxic == 1 and r.doc_id is not None}

    def fails(doc, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        return {x for x, yes in {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": doc is not None and any(d is not None and d < doc and t == text for d, _, t in rows)}.items() if yes}

    failed = [(doc, part, fails(doc, text)) for doc, part, text in rows]
    out, shapley = [], Counter()
    for part in {p for _, p, _ in failed}:
        own = [(d, f) for d, p, f in failed if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                removed, kept = [r for r in left if x in r[1]], [r for r in left if x not in r[1]]
                shapley[part, x] += len(removed)
                out.append((part, "".join(order), step, len(kept), len(removed), sum(x in f for _, f in own) - len(removed), sum(f == {x} for _, f in own),
                            sum(d in good for d, _ in removed), sum(d in toxic for d, _ in removed)))
                left = kept
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def labels_of(spark):
    return spark.createDataFrame([(5, 1, 0), (6, 0, 1), (6, 1, None), (None, 1, 1), (7, 1, 1), (99, 1, 1)], LABELS)


@pytest.mark.parametrize("hot", [1 / 1000, 10.0, 0.01])
def test_copies_and_odd_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(audit, "HOT_SHARE", hot)
    texts = ["same text | again", "same text | again ", "A B C", None, "word " * 300, " ".join(f"w{i}" for i in range(400))]
    planted = spark.createDataFrame([(100 + i, texts[i % 6] if i % 3 else texts[0], "en" if i % 2 else "de", "x", 1) for i in range(90)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = odd_docs(spark).unionByName(planted).repartition(4)
    assert sorted(map(tuple, audit.audit(docs, labels_of(spark)).collect())) == plain(docs, labels_of(spark))


def test_empty_and_clashing_names(spark):
    assert audit.audit(no_docs(spark), labels_of(spark)).collect() == []
    docs = odd_docs(spark).withColumnRenamed("source", "hash").withColumnRenamed("n_chars", "words")
    assert sorted(map(tuple, audit.audit(docs, labels_of(spark)).collect())) == plain(odd_docs(spark), labels_of(spark))


def test_other_filters_and_parts(spark):
    docs = odd_docs(spark)
    found = audit.audit(docs, labels_of(spark), {"S": "n_words < 5"}, copies_name="X", part="source")
    rows = {(r.part, r.filter_order, r.step): (r.kept, r.removed) for r in found.collect()}
    assert rows["c", "SX", 1] == (2, 0) and rows["c", "SX", 2] == (1, 1) and len(rows) == 5 * 4
