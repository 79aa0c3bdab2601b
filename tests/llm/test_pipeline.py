"""The pipeline's stages, each against a plain version on its own input."""

import hashlib
import re

from pyspark.sql import functions as F

import corpus_pipeline
from dssforge.llm import mixing, toxicity
from dssforge.llm.store import Scratch

from .helpers import no_docs, odd_docs
from .test_documents import groups

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs, scratch, frames = spark.read.parquet(f"{SF}/documents.parquet"), Scratch(spark), {}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_output"]
    frames["input"] = docs
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = frames[name] = scratch.keep(stage(spark, docs, SF), name)
        if name != "token_output":
            assert docs.columns == before.columns
    ids = {name: sorted(r.doc_id for r in df.select("doc_id").collect()) for name, df in frames.items()}

    model = toxicity.learn(frames["input"], spark.read.parquet(f"{SF}/labels.parquet"))
    clean = [r.doc_id for r in toxicity.score(frames["input"], model).collect() if r.toxicity < 0.7]
    assert ids["toxicity"] == sorted(clean)

    texts = [(r.doc_id, r.text) for r in frames["toxicity"].collect()]
    want = groups(texts, width=5)
    assert ids["near_dedup"] == sorted(d for d in want if want[d] == d)

    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = re.findall(pattern, (r.text or "").lower())
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}

    def leaked(text):
        w = re.findall(pattern, (text or "").lower())
        return any(tuple(w[p : p + n]) in windows for n in sizes for p in range(len(w) - n + 1))

    assert ids["decontamination"] == sorted(r.doc_id for r in frames["near_dedup"].collect() if not leaked(r.text))
    kept = mixing.mix(frames["decontamination"]).where("mix_kept")
    assert ids["mixing"] == sorted(r.doc_id for r in kept.collect()) and 0 < len(ids["mixing"]) < len(ids["decontamination"])
    assert ids["token_output"] == ids["mixing"]
    assert [tuple(r) for r in corpus_pipeline.run(spark, SF).orderBy("start").collect()] == [tuple(r) for r in frames["token_output"].orderBy("start").collect()]


def test_stages_take_odd_and_empty_tables(spark):
    for docs in (odd_docs(spark), no_docs(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = Scratch(spark).keep(stage(spark, docs, SF), "stage")
        docs.collect()


def test_stages_keep_columns_of_any_name(spark):
    names = ["id", "y", "gone", "p_source", "mix_p", "n_hit", "toxicity", "kept", "a`b", "node", "hash"]
    docs = odd_docs(spark).select("*", *(F.lit(i).alias(name) for i, name in enumerate(names)))
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = Scratch(spark).keep(stage(spark, docs, SF), "stage")
        if name != "token_output":
            assert docs.columns == columns and {r[-len(names):] for r in map(tuple, docs.collect())} <= {tuple(range(len(names)))}
    assert docs.count() > 0


def test_mixing_stage_meets_its_targets(spark):
    """The stage's own input, raked and sampled once more in plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = {r.doc_id: r for r in mixing.mix(docs).collect()}
    cells = {}
    for r in mixed.values():
        cells.setdefault((r.source or "", r.lang or "", r.mix_topic), []).append(r.mix_tokens)
    n = {c: float(sum(t)) for c, t in cells.items() if sum(t)}
    total = sum(n.values())
    most = {c: x / (total * mixing.FRACTION) for c, x in n.items()}
    goals = []
    for m in range(3):
        sums, full = {}, {}
        for c, x in n.items():
            sums[c[m]] = sums.get(c[m], 0.0) + x
            full[c[m]] = full.get(c[m], 0.0) + most[c]
        tempered = {v: x**mixing.TEMPER for v, x in sums.items()}
        share = {v: x / sum(tempered.values()) for v, x in tempered.items()}
        low, high = 0.0, 1e6
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(full[v], mid * s) for v, s in share.items()) < 1 else (low, mid)
        goals.append({v: min(full[v], high * s) for v, s in share.items()})
    w = {c: x / total for c, x in n.items()}
    for step in range(3 * mixing.ROUNDS):
        m, now = step % 3, dict(w)
        for v, goal in goals[m].items():
            own = [c for c in n if c[m] == v]
            got = sum(min(w[c], most[c]) for c in own)
            held, free = sum(most[c] for c in own if w[c] >= most[c]), sum(w[c] for c in own if w[c] < most[c])
            for c in own:
                now[c] = w[c] * ((goal - held) / free if free > 0 else 1.0) if goal > got else w[c] * goal / got
        w = now
    for r in mixed.values():
        c = (r.source or "", r.lang or "", r.mix_topic)
        want = min(1.0, min(w[c], most[c]) / n[c] * total * mixing.FRACTION) if c in n else 1.0
        assert abs(r.mix_p - want) < 1e-6
        drawn = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:13], 16) / 2**52
        assert r.mix_kept == (drawn < r.mix_p)
