"""Toxic spans by a linear-chain conditional random field, and document scores.

A line is a chain of words with two tags, clean and toxic.  A word's features
are the word, its first 3, 4, 5, 6 and 8 bytes and its last 3, hashed into one weight
table; transitions and starts have weights of their own.  The labels mark
documents only, so words are labelled first: a word of a toxic document is a
toxic token when one of its features sits in lines of toxic documents far more
often than in other lines (a likelihood-ratio test over all features seen; each
distinct line counts once, so copied documents mark nothing); every other word,
and every word of a clean document, is a clean token.  The field is then fitted
to these tokens.

With two tags, forward and backward messages are one log-odds each, computed
for all lines of a slice together, position by position.  The marginals give
the offending spans (``SPAN_AT``), and a document's score is a logistic
function of its expected number of toxic words, the highest marginal (as
log-odds) and the share of toxic words.

Fitting uses a bounded sample (``training.SAMPLE_PER_CLASS`` documents per class, whole
texts).  Lines are hashed, made distinct and tested in Spark; the driver gets the feature
hashes of at most ``MAX_TOKENS`` words, those of lines with marked words first, and three figures
per sampled document.  Scoring reads whole texts.

Defined results: null, empty or wordless text has no spans and the score of a
text without toxic words; each row is scored on its own; with labels of one
class only, every score is that class's share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dssforge.llm import bytetext as B
from dssforge.llm.store import Scratch, mapped, tidy
from dssforge.llm.training import Sample, labelled_sample, logistic, sigmoid

PARTS, HELD_OUT_PART, THRESHOLD = 3, 1, 0.7
SPAN_AT = 0.5
TABLE = 1 << 18
MAX_TOKENS, LONGEST_CHAIN = 400_000, 256
_PREFIXES, _SUFFIX = (3, 4, 5, 6, 8), 3


@dataclass
class Chains:
    """Words of some texts: hashed features, and where lines and texts begin."""

    features: np.ndarray  # words x kinds, hashes
    chain: np.ndarray  # index of the first word of each line, and the number of words
    text: np.ndarray  # index of the first word of each text, and the number of words
    starts: np.ndarray
    ends: np.ndarray


def chains(data: np.ndarray, at: np.ndarray) -> Chains:
    starts, ends, first = B.spans(data, at, B.WORD)
    features = np.empty((len(starts), len(_PREFIXES) + 2), dtype=np.uint64)
    features[:, 0] = B.span_hashes(data, starts, ends)
    for n, k in enumerate(_PREFIXES, 1):
        features[:, n] = B.mix(B.span_hashes(data, starts, np.minimum(starts + k, ends)) + np.uint64(k))
    features[:, -1] = B.mix(B.span_hashes(data, np.maximum(ends - _SUFFIX, starts), ends) + np.uint64(99))
    breaks = np.zeros(len(starts), dtype=bool)
    if len(starts):
        lines = np.cumsum(data == 10)[starts]
        breaks[0], breaks[1:] = True, lines[1:] != lines[:-1]
        breaks[first[:-1][first[:-1] < len(starts)]] = True
    return Chains(features, np.append(np.flatnonzero(breaks), len(starts)), first, starts, ends)


def _order(chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the chains, longest first, and how many reach each position."""
    lengths = np.diff(chain)
    order = np.argsort(-lengths, kind="stable")
    reach = len(lengths) - np.cumsum(np.bincount(lengths))[:-1] if len(lengths) else np.zeros(0, int)
    return chain[:-1][order], reach


def messages(e: np.ndarray, chain: np.ndarray, t: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """Forward (with the word's own score) and backward log-odds of the toxic tag for each word.

    ``e``: score of each word; ``t``: 2 x 2 transition scores; ``start``: score
    of a chain that starts with the toxic tag.
    """
    a, b = np.zeros(len(e)), np.zeros(len(e))
    begin, reach = _order(chain)
    for k, n in enumerate(reach):
        now = begin[:n] + k
        if k == 0:
            a[now] = e[now] + start
        else:
            before = a[now - 1]
            a[now] = e[now] + np.logaddexp(t[0, 1], before + t[1, 1]) - np.logaddexp(t[0, 0], before + t[1, 0])
    for k in range(len(reach) - 2, -1, -1):
        now = begin[: reach[k + 1]] + k
        after = e[now + 1] + b[now + 1]
        b[now] = np.logaddexp(t[1, 0], after + t[1, 1]) - np.logaddexp(t[0, 0], after + t[0, 1])
    return a, b


@dataclass
class Model:
    weights: np.ndarray  # TABLE
    transitions: np.ndarray  # 2 x 2
    start: float
    bias: float
    document: np.ndarray  # logistic weights of the document's figures, the intercept last

    def emissions(self, features: np.ndarray) -> np.ndarray:
        e = np.full(len(features), self.bias)
        for k in range(features.shape[1]):
            e += self.weights[(features[:, k] & np.uint64(TABLE - 1)).astype(np.int64)]
        return e

    def marginals(self, c: Chains) -> np.ndarray:
        a, b = messages(self.emissions(c.features), c.chain, self.transitions, self.start)
        return sigmoid(a + b)

    def scores(self, figures: np.ndarray) -> np.ndarray:
        return sigmoid(figures @ self.document[:-1] + self.document[-1])


def document_figures(p: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Per text: log of 1 + the expected number of toxic words, log-odds of the highest marginal, root of the toxic share."""
    n = np.diff(text)
    sums = np.concatenate([[0.0], np.cumsum(p)])
    expected = sums[text[1:]] - sums[text[:-1]]
    top = np.full(len(n), 1e-3)
    has = np.flatnonzero(n)
    if len(has):
        top[has] = np.clip(np.maximum.reduceat(p, text[:-1][has]), 1e-3, 1 - 1e-3)
    return np.column_stack([np.log1p(expected), np.log(top / (1 - top)), np.sqrt(expected / np.maximum(n, 1))])


def line_names(c: Chains) -> np.ndarray:
    """A 64-bit name of each line's words."""
    seat = np.arange(len(c.starts)) - np.repeat(c.chain[:-1], np.diff(c.chain))
    return np.add.reduceat(B.mix(c.features[:, 0] + B.mix(seat.astype(np.uint64))), c.chain[:-1]) if len(c.starts) else np.zeros(0, np.uint64)


def constant(share: float) -> Model:
    """The model of labels of one class only."""
    return Model(np.zeros(TABLE), np.zeros((2, 2)), 0.0, -10.0, np.array([0.0, 0.0, 0.0, 40.0 if share == 1 else -40.0]))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, y, n, features) of every line of rows (y, text); a word has a 64-bit hash for each kind of feature."""
    for batch in batches:
        for lo, hi, data, at in B.slices(batch.column(1)):
            c = chains(data, at)
            text = np.searchsorted(c.text, c.chain[:-1], side="right") - 1
            y, width = batch.column(0).slice(lo, hi - lo), c.features.shape[1] * 8
            raw = pa.py_buffer(np.ascontiguousarray(c.features))
            kept = pa.Array.from_buffers(pa.large_binary(), len(text), [None, pa.py_buffer((c.chain * width).astype(np.int64)), raw])
            cols = [pa.array(B.signed(line_names(c))), y.take(pa.array(text)), pa.array(np.diff(c.chain).astype(np.int32)), kept]
            yield pa.record_batch(cols, ["name", "y", "n", "features"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, feature, df, bad) of the distinct lines of a batch (y, features): in how many a feature is, and in how many toxic ones.

    A feature counts once a line; endings are too common to mark a word.
    """
    for batch in batches:
        ys, tables = batch.column(0).to_numpy(zero_copy_only=False), [_table_of(raw) for raw in batch.column(1)]
        for k in range(len(_PREFIXES) + 1):
            found = [np.unique(t[:, k]) for t in tables]
            sizes = [len(f) for f in found]
            names, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_inverse=True)
            bad = np.bincount(at, weights=np.repeat(ys, sizes), minlength=len(names)).astype(np.int64)
            df = np.bincount(at, minlength=len(names)).astype(np.int64)
            yield pa.record_batch([pa.array(np.full(len(names), k, np.int32)), pa.array(B.signed(names)), pa.array(df), pa.array(bad)], ["kind", "feature", "df", "bad"])


def _table_of(raw) -> np.ndarray:
    """Features of a line's words, words x kinds."""
    return np.frombuffer(raw.as_buffer(), np.uint64).reshape(-1, len(_PREFIXES) + 2)


def strong_features(lines: DataFrame, size: int, toxic: int, scratch: Scratch) -> DataFrame:
    """(kind, feature) of features that mark toxic lines, by a likelihood-ratio test over the ``size`` distinct lines (see the module)."""
    counts = lines.select("y", "features").mapInArrow(tidy(_counts), "kind int, feature long, df long, bad long")
    seen = scratch.keep(counts.groupBy("kind", "feature").agg(F.sum("df").alias("df"), F.sum("bad").alias("bad")), "seen")
    names = {r["kind"]: r["count"] for r in seen.groupBy("kind").count().collect()}  # one row per kind of feature
    base, bad, df = toxic / size, F.col("bad"), F.col("df")

    def part(count, share, of: float):
        return F.when(count > 0, count * F.log(share / of)).otherwise(0.0)

    g = 2 * (part(bad, bad / df, base) + part(df - bad, (df - bad) / df, 1 - base))
    odds = (bad + 0.5) / (toxic + 1) / ((df - bad + 0.5) / (size - toxic + 1))
    enough = reduce(lambda out, k: out.when(F.col("kind") == k, F.lit(2 * float(np.log(names[k] + 1)) + 2)), names, F.when(F.lit(False), F.lit(0.0)))
    return seen.where((g > enough) & (odds > 4)).select("kind", "feature")


def _marked(strong: list[np.ndarray]):
    """Tasks that add to rows (name, y, n, features) which words have a strong feature (a byte each), and whether any has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for raw in batch.column(3):
                table = B.signed(np.ascontiguousarray(_table_of(raw)))
                found = np.zeros(len(table), dtype=bool)
                for k, names in enumerate(strong):
                    if len(names):
                        at = np.minimum(np.searchsorted(names, table[:, k]), len(names) - 1)
                        found |= names[at] == table[:, k]
                marks.append(found.astype(np.uint8).tobytes())
            yield pa.record_batch([*batch.columns, pa.array(marks, pa.binary()), pa.array([b"\1" in m for m in marks])], [*batch.schema.names, "marks", "marked"])

    return run


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows that are not held out."""
    scratch = Scratch(docs.sparkSession)
    sample = labelled_sample(docs, labels, "toxic", PARTS, HELD_OUT_PART, scratch)
    if not 0 < sample.share < 1:
        return constant(sample.share)
    return fit(sample, scratch)


def fit(sample: Sample, scratch: Scratch, steps: int = 60) -> Model:
    """Fit the field to token labels, then the document score to the documents' labels."""
    spark = scratch.spark
    lines = sample.rows.mapInArrow(tidy(_lines), "name long, y int, n int, features binary")
    # Copies of a line count once, as a toxic line only where all of them are in toxic documents.
    lines = scratch.keep(lines.groupBy("name").agg(F.min("y").alias("y"), F.min("n").alias("n"), F.min("features").alias("features")), "lines")
    size = lines.agg(F.count("*").alias("lines"), F.coalesce(F.sum("y"), F.lit(0)).alias("toxic")).first()
    model = Model(np.zeros(TABLE), np.zeros((2, 2)), 0.0, -10.0, np.zeros(4))
    if 0 < size["toxic"] < size["lines"]:
        # The features that mark toxic lines: a small part of those of the sampled documents.
        names = strong_features(lines, size["lines"], size["toxic"], scratch).toPandas()
        strong = [np.sort(names["feature"][names["kind"] == k].to_numpy(np.int64)) for k in range(len(_PREFIXES) + 1)]
        told = scratch.keep(lines.mapInArrow(tidy(_marked(strong)), "name long, y int, n int, features binary, marks binary, marked boolean"), "marked")
        # Lines with such words first, toxic or clean, then others in the order of a hash.
        order = told.select("name", "n", "marked").orderBy(F.col("marked").desc(), F.xxhash64("name"), "name").limit(MAX_TOKENS).select("name", "n").toPandas()
        picked = order["name"][order["n"].cumsum() <= MAX_TOKENS]
        picks = F.broadcast(spark.createDataFrame(picked.to_frame("pick"), "pick long"))
        rows = told.join(picks, F.col("name") == F.col("pick"), "left_semi").orderBy("name").select("y", "features", "marks").toArrow()
        kinds = len(_PREFIXES) + 2
        table = [_table_of(raw) for chunk in rows["features"].chunks for raw in chunk]
        n = np.array([len(t) for t in table], np.int64)
        table = np.concatenate(table) if len(table) else np.zeros((0, kinds), np.uint64)
        toxic = np.repeat(np.array(rows["y"].to_pylist(), np.int64), n) if len(n) else np.zeros(0, np.int64)
        suspect = np.frombuffer(b"".join(rows["marks"].to_pylist()), np.uint8) > 0
        cut = np.concatenate([[0], np.cumsum(np.concatenate([_pieces(x) for x in n]))]) if len(n) else np.zeros(1, int)
        seat = (table & np.uint64(TABLE - 1)).astype(np.int32)
        weight = np.where(toxic > 0, sample.weights[1], sample.weights[0])
        model = _fit_field(seat, (suspect & (toxic > 0)).astype(np.float64), weight, cut, model, steps)
    figures = sample.rows.mapInArrow(tidy(_document_figures(model)), "y int, f0 double, f1 double, f2 double").toPandas()
    y = figures["y"].to_numpy(np.float64)
    model.document = logistic(figures[["f0", "f1", "f2"]].to_numpy(), y, np.where(y > 0, sample.weights[1], sample.weights[0]))
    return model


def _document_figures(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in B.slices(batch.column(1)):
                c = chains(data, at)
                found = document_figures(model.marginals(c), c.text)
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), *(pa.array(found[:, k]) for k in range(3))], ["y", "f0", "f1", "f2"])

    return run


def _pieces(n: int) -> np.ndarray:
    """Lengths of the chains that a training line of ``n`` words is cut into."""
    return np.diff(np.append(np.arange(0, n, LONGEST_CHAIN), n))


def field_gradient(x: np.ndarray, seat: np.ndarray, target: np.ndarray, weight: np.ndarray, chain: np.ndarray, table: int = TABLE) -> np.ndarray:
    """Gradient of the weighted negative log-likelihood of the tags by x: word weights, start, bias, transitions."""
    inner = np.ones(len(seat), dtype=bool)
    inner[chain[:-1]] = False
    now = np.flatnonzero(inner)
    y = target.astype(np.int8)
    seen = np.bincount(y[now - 1] * 2 + y[now], weights=weight[now], minlength=4)
    w, start, bias, t = x[:table], x[table], x[table + 1], x[table + 2 :].reshape(2, 2)
    e = np.full(len(seat), bias)
    for k in range(seat.shape[1]):
        e += w[seat[:, k]]
    a, b = messages(e, chain, t, start)
    gradient = np.zeros_like(x)
    gap = weight * (sigmoid(a + b) - target)
    for k in range(seat.shape[1]):
        gradient[:table] += np.bincount(seat[:, k], weights=gap, minlength=table)
    gradient[table] = gap[chain[:-1]].sum()
    gradient[table + 1] = gap.sum()
    before, after = a[now - 1], e[now] + b[now]
    joint = np.stack([t[0, 0] + 0 * before, t[0, 1] + after, t[1, 0] + before, t[1, 1] + before + after])
    joint = np.exp(joint - joint.max(axis=0)) if len(now) else joint
    gradient[table + 2 :] = (joint / joint.sum(axis=0)) @ weight[now] - seen
    return gradient


def _fit_field(seat: np.ndarray, target: np.ndarray, weight: np.ndarray, chain: np.ndarray, model: Model, steps: int) -> Model:
    """Maximum likelihood, words weighted as their texts, with a small ridge, by adaptive gradient steps."""
    # Word weights, start, bias and transitions in one vector; start and bias have no ridge.
    x, squares = np.zeros(TABLE + 6), np.full(TABLE + 6, 1e-8)
    x[TABLE + 1] = -3.0
    ridge = np.full(TABLE + 6, 0.3)
    ridge[TABLE : TABLE + 2] = 0.0
    for _ in range(steps):
        gradient = field_gradient(x, seat, target, weight, chain) + ridge * x
        squares += gradient * gradient
        x -= 0.5 * gradient / np.sqrt(squares)
    model.weights, model.start, model.bias, model.transitions = x[:TABLE].copy(), float(x[TABLE]), float(x[TABLE + 1]), x[TABLE + 2 :].reshape(2, 2).copy()
    return model


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])


def _spans_of(c: Chains, p: np.ndarray, data: np.ndarray, at: np.ndarray) -> list[list[dict]]:
    """Per text the runs of neighbouring toxic words of a line, in characters."""
    out: list[list[dict]] = [[] for _ in range(len(at) - 1)]
    toxic = np.flatnonzero(p >= SPAN_AT)
    if not len(toxic):
        return out
    characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    line = np.searchsorted(c.chain, toxic, side="right")
    new = np.flatnonzero(np.concatenate([[True], (np.diff(toxic) > 1) | (np.diff(line) > 0)]))
    for lo, hi in zip(new, [*new[1:], len(toxic)]):
        first, last = toxic[lo], toxic[hi - 1]
        text = int(np.searchsorted(c.text, first, side="right")) - 1
        base = characters[at[text]]
        out[text].append({"start": int(characters[c.starts[first]] - base), "end": int(characters[c.ends[last]] - base), "probability": float(p[toxic[lo:hi]].max())})
    return out


def _score(shared, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for lo, hi, data, at in B.slices(batch.column(text_at)):
                c = chains(data, at)
                p = model.marginals(c)
                score = model.scores(document_figures(p, c.text))
                rows = batch.slice(lo, hi - lo)
                cols = [pa.array(score), pa.array(_spans_of(c, p, data, at), pa.list_(_SPAN))]
                yield pa.record_batch([*rows.columns, *cols], [*rows.schema.names, "toxicity", "toxic_spans"])

    return run


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with toxicity (0 to 1) and toxic_spans (character offsets) appended; such columns are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("toxicity", "toxic_spans")
    return mapped(docs, _score(shared, docs.columns.index(text)), "toxicity double, toxic_spans array<struct<start:long,end:long,probability:double>>")


def query(spark, sf_dir: str) -> DataFrame:
    """``op6_toxicity``: score of every document, with its toxic spans."""
    from dssforge.llm.training import held_out

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = score(docs, model)
    return found.select(
        "doc_id", held_out(F.col("doc_id"), PARTS, HELD_OUT_PART).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"), "toxic_spans",
    )
