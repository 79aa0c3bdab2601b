"""Quality score by a generalised additive model with pairwise interactions.

A text becomes ``FEATURES`` figures (shares of character kinds, repetition of
words, word pairs and lines, lengths).  Each figure is cut into quantile bins, and
the model is one lookup table per figure plus one per chosen pair of figures::

    log-odds = base + sum table_f[bin_f] + sum table_fg[coarse bin_f, coarse bin_g]

The tables are learned by boosting in cycles: in turn for each figure, a shallow
tree over its bins (two cuts) is fitted to the current gradient and added, at a
small rate, to its table.  Then the pairs whose best quadrant cut still gains most
are boosted the same way.  Scoring is bin lookup and addition on whole columns.

Fitting uses a bounded sample (``training.SAMPLE_PER_CLASS`` documents per class, whole texts,
whose figures are computed in Spark); scoring reads whole texts.

Defined results: null, empty or blank text has zeros for figures and is scored
like any other; each row is scored on its own; with labels of one class only,
every score is that class's share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dssforge.llm import bytetext as B
from dssforge.llm.store import Scratch, mapped
from dssforge.llm.training import held_out, labelled_sample, sigmoid

PARTS, HELD_OUT_PART, THRESHOLD = 4, 2, 0.7
BINS, COARSE, PAIRS = 32, 8, 6
CYCLES, PAIR_CYCLES, RATE, RIDGE = 120, 60, 0.15, 2.0

FEATURES = (
    "log_words", "word_bytes", "upper", "digits", "bars", "shouts", "stops", "commas", "other_marks", "breaks", "beyond_ascii",
    "distinct_words", "equal_neighbours", "distinct_pairs", "distinct_lines", "log_longest_word", "log_words_a_line", "top_word",
)


def _kinds() -> np.ndarray:
    """Kind of each byte: 1 upper, 2 lower, 3 digit, 4 bar, 5 shout, 6 stop, 7 comma, 8 other mark, 9 line break, 10 beyond ASCII."""
    kind = np.zeros(256, np.uint8)
    kind[0x21:0x7F] = 8
    kind[0x41:0x5B], kind[0x61:0x7B], kind[0x30:0x3A] = 1, 2, 3
    kind[ord("|")], kind[ord("!")], kind[ord(".")], kind[ord(",")], kind[10] = 4, 5, 6, 7, 9
    kind[0x80:0xC0] = 0  # continuation bytes
    kind[0xC0:] = 10
    return kind


_KIND, _N_KINDS = _kinds(), 11


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner the number of distinct values and the count of the most frequent one."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (o[1:] != o[:-1])])) if len(v) else np.zeros(0, int)
    runs = np.diff(np.append(new, len(v)))
    top = np.zeros(n)
    np.maximum.at(top, o[new], runs)
    return np.bincount(o[new], minlength=n), top


def figures(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of figures for each text of a slice."""
    n = len(at) - 1
    text_of = np.repeat(np.arange(n), np.diff(at))
    count = np.bincount(text_of * _N_KINDS + _KIND[data], minlength=n * _N_KINDS).reshape(n, _N_KINDS).astype(np.float64)
    starts, ends, first = B.spans(data, at)
    words = np.diff(first).astype(np.float64)
    owner = np.repeat(np.arange(n), np.diff(first))
    h = B.span_hashes(data, starts, ends)
    distinct, top = _distinct(h, owner, n)
    inner = owner[1:] == owner[:-1]
    equal = np.bincount(owner[1:][inner & (h[1:] == h[:-1])], minlength=n)
    pairs = B.mix(h[:-1] + B.mix(h[1:]))[inner]
    distinct_pairs, _ = _distinct(pairs, owner[1:][inner], n)
    # A line is told by its words.
    line = np.cumsum(data == 10)[starts] if len(starts) else np.zeros(0, int)
    new = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | ~inner])) if len(starts) else np.zeros(0, int)
    seat = np.arange(len(starts)) - np.repeat(new, np.diff(np.append(new, len(starts))))
    names = np.add.reduceat(B.mix(h + B.mix(seat.astype(np.uint64))), new) if len(new) else np.zeros(0, np.uint64)
    lines = np.bincount(owner[new], minlength=n)
    distinct_lines, _ = _distinct(names, owner[new], n)
    longest = np.zeros(n)
    np.maximum.at(longest, owner, ends - starts)
    w, letters = np.maximum(words, 1), np.maximum(count[:, 1] + count[:, 2], 1)
    size = np.bincount(owner, weights=ends - starts, minlength=n)
    two = np.maximum(words - 1, 1)
    return np.column_stack([
        np.log1p(words), size / w, count[:, 1] / letters, count[:, 3] / w, count[:, 4] / w, count[:, 5] / w, count[:, 6] / w, count[:, 7] / w,
        count[:, 8] / w, count[:, 9] / w, count[:, 10] / np.maximum(size, 1), distinct / w, equal / two, distinct_pairs / two,
        distinct_lines / np.maximum(lines, 1), np.log1p(longest), np.log1p(words / np.maximum(lines, 1)), top / w,
    ])


@dataclass
class Model:
    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            z += table[np.searchsorted(cuts, x[:, f], side="right")]
        for (f, g), table in zip(self.pairs, self.pair_tables):
            z += table[np.searchsorted(self.coarse[f], x[:, f], side="right"), np.searchsorted(self.coarse[g], x[:, g], side="right")]
        return sigmoid(z)


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf value of each bin for the best two cuts, the second inside the better half."""
    out = np.zeros(len(g))
    parts = [(0, len(g))]
    for _ in range(2):
        best = (1e-9, None, 0)
        for lo, hi in parts:
            if hi - lo < 2:
                continue
            gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            gain = _gain(gl, hl) + _gain(g[lo:hi].sum() - gl, h[lo:hi].sum() - hl) - _gain(g[lo:hi].sum(), h[lo:hi].sum())
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), (lo, hi), lo + k + 1)
        if best[1] is None:
            break
        lo, hi = best[1]
        parts.remove(best[1])
        parts += [(lo, best[2]), (best[2], hi)]
    for lo, hi in parts:
        out[lo:hi] = -g[lo:hi].sum() / (h[lo:hi].sum() + RIDGE)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best cut of a grid into four quadrants."""
    cg, ch = np.cumsum(np.cumsum(g, 0), 1), np.cumsum(np.cumsum(h, 0), 1)
    a, b = cg[:-1, :-1], ch[:-1, :-1]
    parts = [(a, b), (cg[:-1, -1:] - a, ch[:-1, -1:] - b), (cg[-1:, :-1] - a, ch[-1:, :-1] - b),
             (cg[-1, -1] - cg[:-1, -1:] - cg[-1:, :-1] + a, ch[-1, -1] - ch[:-1, -1:] - ch[-1:, :-1] + b)]
    if not a.size:
        return 0.0, np.zeros_like(g)
    gain = sum(_gain(x, y) for x, y in parts)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    values = [-x[i, j] / (y[i, j] + RIDGE) for x, y in parts]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = values
    return float(gain[i, j] - _gain(cg[-1, -1], ch[-1, -1])), out


def fit(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> Model:
    """Tables by cyclic boosting of the logistic loss."""
    share = float(np.average(y, weights=weights)) if len(y) else 0.0
    if not 0 < share < 1:
        return Model(40.0 if share == 1 else -40.0)
    model = Model(float(np.log(share / (1 - share))))
    model.cuts, model.coarse = [_edges(c, BINS) for c in x.T], [_edges(c, COARSE) for c in x.T]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.cuts)]
    z = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = sigmoid(z)
        return weights * (p - y), weights * np.maximum(p * (1 - p), 1e-6)

    for _ in range(CYCLES):
        for f, b in enumerate(bins):
            g, h = slopes()
            size = len(model.tables[f])
            step = RATE * _tree(np.bincount(b, g, size), np.bincount(b, h, size))
            model.tables[f] += step
            z += step[b]
    grid = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.coarse)]
    shape = [len(c) + 1 for c in model.coarse]

    def cells(f: int, k: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(grid[f] * shape[k] + grid[k], v, shape[f] * shape[k]).reshape(shape[f], shape[k])

    g, h = slopes()
    gains = sorted(((_quadrants(cells(f, k, g), cells(f, k, h))[0], f, k) for f, k in combinations(range(len(bins)), 2)), reverse=True)
    model.pairs = [(f, k) for _, f, k in gains[:PAIRS]]
    model.pair_tables = [np.zeros((shape[f], shape[k])) for f, k in model.pairs]
    for _ in range(PAIR_CYCLES):
        for table, (f, k) in zip(model.pair_tables, model.pairs):
            g, h = slopes()
            step = RATE * _quadrants(cells(f, k, g), cells(f, k, h))[1]
            table += step
            z += step[grid[f], grid[k]]
    return model


def _sample_figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, at in B.slices(batch.column(1)):
            x = figures(data, at)
            yield pa.record_batch([batch.column(0).slice(lo, hi - lo), *(pa.array(c) for c in x.T)], ["y", *FEATURES])


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows that are not held out."""
    sample = labelled_sample(docs, labels, "quality", PARTS, HELD_OUT_PART, Scratch(docs.sparkSession))
    if not 0 < sample.share < 1:
        return Model(40.0 if sample.share == 1 else -40.0)
    rows = sample.rows.mapInArrow(_sample_figures, "y int, " + ", ".join(f"{name} double" for name in FEATURES)).toPandas()
    y = rows["y"].to_numpy(np.float64)
    return fit(rows[list(FEATURES)].to_numpy(), y, np.where(y > 0, sample.weights[1], sample.weights[0]))


def _score(shared, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for lo, hi, data, at in B.slices(batch.column(text_at)):
                rows = batch.slice(lo, hi - lo)
                yield pa.record_batch([*rows.columns, pa.array(model.scores(figures(data, at)))], [*rows.schema.names, "quality_score"])

    return run


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with quality_score (0 to 1) appended; such a column is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("quality_score")
    return mapped(docs, _score(shared, docs.columns.index(text)), "quality_score double")


def query(spark, sf_dir: str) -> DataFrame:
    """``op8_quality``: score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), PARTS, HELD_OUT_PART).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))
