"""Exact top-k by inner product: columnar branch and bound.

Vectors are quantised to integers, floor(1024 * x).  A block of candidates is
laid out vertically (one row per dimension) with, per block of dimensions, the
length of what remains of each vector.  For a query the partial products are
accumulated one block of dimensions after another; by Cauchy-Schwarz the rest of a
score is within the product of the remaining lengths, so a candidate whose
upper bound falls below the k-th best lower bound is out, and the survivors are
compacted before the next block.  After the last block the scores are exact.

Queries are a stated set.  Candidates are dealt to blocks of bounded size (at most
``CANDIDATES`` rows and ``CELLS`` components).  A first block is searched for all queries; the
k-th best score that it gives a query is the floor from which every other block starts,
so those blocks drop most candidates early and return few rows.  Every candidate is moved once;
the queries, the small side, are copied to the blocks and stream through them behind
the block's candidates, so a task holds one block whatever the number of queries.

Defined results: vectors that are null or hold a null or non-finite component
take no part; shorter vectors count as padded with zeros; a row never meets
itself, but rows that repeat a vec_id are rows like any other; ties go to the
smaller vec_id; an empty table gives no rows.  Scores past a long's range are
given as the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dssforge.llm.store import Scratch

SCALE, TOP, EVERY = 1024, 10, 100
#: Most rows and components of a block of candidates, and queries that share a copy of the first block.
CANDIDATES, CELLS, QUERIES = 65_536, 1 << 22, 16_384
#: Rows of a block below which no more blocks are made for the sake of parallel tasks.
LEAST = 1_024
DIMENSIONS = 16
_EXACT = float(2**53)


class Vertical:
    """Candidates by dimension, with the remaining length of each before every block of dimensions."""

    def __init__(self, vectors: np.ndarray):
        self.columns = np.ascontiguousarray(vectors.T)
        self.blocks = [slice(k, k + DIMENSIONS) for k in range(0, len(self.columns), DIMENSIONS)]
        self.largest = np.abs(self.columns).max()

    @cached_property
    def rest(self) -> np.ndarray:
        return remaining(self.columns, self.blocks)


def remaining(columns: np.ndarray, blocks: list[slice]) -> np.ndarray:
    """Length of the dimensions from each block on; a last row of zeros."""
    squares = [np.square(columns[b]).sum(axis=0) for b in blocks] + [np.zeros(columns.shape[1])]
    return np.sqrt(np.cumsum(np.array(squares)[::-1], axis=0)[::-1])


def best(query: np.ndarray, own: int, block: Vertical, rows: np.ndarray, ids: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions and exact scores of the k best candidates from ``floor`` on, the row ``own`` left out; ties to the smaller id."""
    alive = np.flatnonzero(rows != own)
    score = np.zeros(len(alive))
    rest = remaining(query[:, None], block.blocks)[:, 0]
    for n, dims in enumerate(block.blocks):
        if len(alive) == block.columns.shape[1]:
            score += query[dims] @ block.columns[dims]
        else:
            score += query[dims] @ block.columns[dims][:, alive]
        slack = rest[n + 1] * block.rest[n + 1][alive] * (1 + 1e-9) + 0.5
        least = floor
        if len(alive) > k:
            least = max(floor, np.partition(score - slack, len(alive) - k)[len(alive) - k])
        stay = score + slack >= least
        if not stay.all():
            alive, score = alive[stay], score[stay]
    order = np.lexsort((rows[alive], ids[alive], -score))[:k]
    return alive[order], score[order]


_OUT = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Quantised vectors, padded with zeros."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.diff(lists.offsets.to_numpy())
    flat = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(lengths), int(lengths.max(initial=1))))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _wide(q: np.ndarray, x: np.ndarray, own: int, rows: np.ndarray, ids: np.ndarray, k: int):
    """The same for components too large for exact doubles, in Python integers."""
    a = [int(v) for v in q]
    scored = sorted((-sum(p * int(v) for p, v in zip(a, x[i])), int(ids[i]), int(rows[i]), i) for i in range(len(x)) if rows[i] != own)[:k]
    top = 2**63 - 1
    return [s[3] for s in scored], [max(-top - 1, min(top, -s[0])) for s in scored]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Consecutive rows of one block that are all candidates or all queries."""
    for batch in batches:
        if batch.num_rows:
            block, asks = batch["block"].to_numpy(), batch["asks"].to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((np.diff(block) != 0) | (asks[1:] != asks[:-1])) + 1
            for a, b in pairwise([0, *turns.tolist(), batch.num_rows]):
                yield int(block[a]), bool(asks[a]), batch.slice(a, b - a)


def _answers(block: Vertical, rows: np.ndarray, ids: np.ndarray, queries: pa.RecordBatch, k: int) -> pa.RecordBatch:
    """The best candidates of a block for each query."""
    q = _matrix(queries["vector"])[:, : len(block.columns)]
    q = np.pad(q, ((0, 0), (0, len(block.columns) - q.shape[1])))
    exact = block.largest * np.abs(q).max() * len(block.columns) < _EXACT
    floors = queries["floor"].to_numpy(zero_copy_only=False).astype(np.float64)
    out = []
    for vector, row, vec_id, floor in zip(q, queries["row"].to_pylist(), queries["vec_id"].to_pylist(), np.where(np.isnan(floors), -np.inf, floors)):
        at, score = best(vector, row, block, rows, ids, k, floor) if exact else _wide(vector, block.columns.T, row, rows, ids, k)
        out += [(row, vec_id, int(rows[i]), int(ids[i]), int(s)) for i, s in zip(at, score)]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(_OUT), _OUT.types)], schema=_OUT)


def _search(k: int):
    """Task over rows in the order of (block, asks): the candidates of a block, then its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, block = None, [], None
        for number, asks, part in _stretches(batches):
            if not asks:
                if number != at:
                    at, held, block = number, [], None
                held.append(part)
            elif number == at:
                if block is None:
                    table = pa.Table.from_batches(held)
                    block, rows, ids, held = Vertical(_matrix(table["vector"])), table["row"].to_numpy(), table["vec_id"].to_numpy(), []
                yield _answers(block, rows, ids, part, k)

    return run


def _meet(candidates: DataFrame, queries: DataFrame, blocks: int, k: int) -> DataFrame:
    """The best candidates of each block for the queries sent to it; both sides carry ``block``."""
    both = candidates.withColumns({"asks": F.lit(False), "floor": F.lit(None).cast("long")}).unionByName(queries.withColumn("asks", F.lit(True)))
    laid = both.repartition(blocks, "block").sortWithinPartitions("block", "asks")
    return laid.mapInArrow(_search(k), "query_row long, query_id long, row long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query, k: int = TOP, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for each row where ``is_query`` holds.

    ``is_query`` is a condition on the column ``vec_id``; null vec_ids take no part.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    part = F.col(vector)
    whole = part.isNotNull() & F.forall(part, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), part.alias("vector")).where(F.coalesce(whole, F.lit(False)))
    rows = scratch.keep(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("asked"), F.max(F.size("vector")).alias("longest")).first()
    most = max(1, min(CANDIDATES, CELLS // max(1, sizes.longest or 1)))
    blocks = max(-(-sizes.n // most), min(spark.sparkContext.defaultParallelism, -(-sizes.n // LEAST)), 1)
    shares = -(-sizes.asked // QUERIES) or 1

    def dealt(column: str, parts: int) -> F.Column:
        return F.pmod(F.xxhash64(column), F.lit(parts)).cast("long")

    def copied(first: int, last: int) -> F.Column:
        return F.explode(F.sequence(F.lit(first), F.lit(last)).cast("array<bigint>"))

    candidates = rows.withColumn("block", dealt("row", blocks))
    queries = rows.where(is_query)
    sample = candidates.where("block = 0").withColumn("block", copied(0, shares - 1))
    first = scratch.keep(_meet(sample, queries.withColumns({"floor": F.lit(None).cast("long"), "block": dealt("row", shares)}), shares, k), "first")
    found = first
    if blocks > 1:
        floors = first.groupBy(F.col("query_row").alias("row")).agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("floor"))
        asked = queries.join(floors, "row", "left").withColumn("block", copied(1, blocks - 1))
        found = first.unionByName(_meet(candidates.where("block > 0"), asked, blocks - 1, k))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """``op4_exact_topk``: the 10 best rows for every vec_id divisible by 100."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % EVERY == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
