"""A bounded, balanced sample of labelled documents, and logistic regression on it."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dssforge.llm.store import Scratch

#: Labelled documents per class that a classifier is fitted on; their texts are taken whole.
SAMPLE_PER_CLASS = 2000


def held_out(doc_id, parts: int, part: int):
    """Whether crc32 of the doc_id as text leaves ``part`` when divided by ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts == part


@dataclass
class Sample:
    """Written rows (y, text), and the weight of a row of each class (they restore the classes' shares, mean 1)."""

    rows: DataFrame
    weights: dict[int, float]
    share: float  # of class 1 among all labelled rows; 0 without any


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int, scratch: Scratch, per_class: int = SAMPLE_PER_CLASS) -> Sample:
    """At most ``per_class`` documents of each class, none of them held out.

    Documents are taken in the order of a hash of their doc_id, so the sample does
    not depend on the layout of the tables.  Null labels and null texts take no part; a
    doc_id labelled more than once counts with its largest label, one with several
    texts with the least of them.  Texts stay in Spark; the driver sees at most ``4 * per_class`` ids.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).alias("y"))
    known = known.where(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id"), parts, part))
    known = known.groupBy("id").agg(F.max("y").cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    order = F.xxhash64("id", F.lit(17))
    # Twice the rows, since a label may have no text here.
    chosen = [known.where(F.col("y") == y).orderBy(order, "id").limit(2 * per_class) for y in (0, 1)]
    texts = docs.select(F.col("doc_id").alias("of"), F.col("text").cast("string").alias("text")).where("text is not null")
    met = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), F.col("of") == F.col("id"))
    found = scratch.keep(met.groupBy("id", "y").agg(F.min("text").alias("text")), "labelled")
    names = found.select("id", "y", order.alias("h")).toPandas().sort_values(["y", "h", "id"])
    names = names.groupby("y").head(per_class)
    sizes = names["y"].value_counts().to_dict()
    picked = docs.sparkSession.createDataFrame([(x,) for x in names["id"].tolist()], f"pick {found.schema['id'].dataType.simpleString()}")
    rows = found.join(F.broadcast(picked), F.col("id") == F.col("pick"), "left_semi").select("y", "text")
    total = sum(counts.get(y, 0) for y in sizes)
    weights = {int(y): counts[y] / n * (sum(sizes.values()) / total) for y, n in sizes.items()}
    return Sample(scratch.keep(rows, "sample"), weights, counts.get(1, 0) / total if total and 1 in sizes else 0.0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, l2: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression, the intercept last (Newton steps)."""
    x = np.column_stack([x, np.ones(len(x))])
    b = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ b)
        gradient = x.T @ (weights * (p - y)) + ridge * b
        hessian = (x * (weights * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        b -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
    return b
