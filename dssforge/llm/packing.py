"""Packing documents into training sequences of several lengths.

Documents are cut into whole long windows first; what remains of each (shorter
than a long window) is routed to the tier of the smallest context size that
holds it.  Tiers are packed from the longest to the shortest: a window opens with
the longest remainder of its tier, its gap takes the longest remainders of
shorter tiers that fit, and a gap that none fits is closed exactly by cutting the
shortest remainder that is longer; the rest of that goes back to its tier.  No
more windows open than the remaining tokens can fill, so every window of every
tier is full, but for one last sequence of fewer tokens than the shortest tier,
which is padded to the longest.

A remainder's length decides all, and there are only ``tiers[0] - 1`` lengths.
So the packing is planned on their histogram: a step places or cuts a *range* of
equally long remainders at once, and the plan (some thousand ranges, whatever
the number of documents) says for the k-th remainder of a length where its pieces go.
k is a running number over all documents: counted inside each task while
encoding, plus the counts of the tasks before it.  So nothing is sorted,
no task holds a tier, and a length that a third of the documents have costs no more.

Step groups take sequences in turn: tiers follow each other in the numbering, so
sequence s in group s modulo the number of groups gives every group the same number
of windows of each tier, to one.

Encoded documents are written once (2 bytes an id) in the shared folder, so the
ranks, the plan and the placing all read the same rows.

Defined results: null or empty text is the end id alone; each row is packed on its
own, so repeated and null doc_ids keep all their rows; an empty table has no pieces.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dssforge.llm import chunks as C
from dssforge.llm.store import Scratch, few, fewer_tasks

TOKENIZER, END_ID = "byte_bpe_50k.json", 0
#: Context sizes, longest first, and the tokens of a training step.
TIERS, STEP_TOKENS = (1024, 512, 256, 128), 1 << 16


# --- the plan, on the histogram of lengths ----------------------------------


@dataclass
class Stock:
    """Remainders by length: ranges of equally long ones, each (length of the whole, first number, how many, start in it)."""

    ranges: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=lambda: defaultdict(list))
    tokens: int = 0

    def put(self, length: int, whole: int, first: int, n: int, start: int) -> None:
        if length and n:
            self.ranges[length].append((whole, first, n, start))
            self.tokens += length * n

    def take(self, length: int, most: int) -> tuple[int, int, int, int]:
        """A range of at most ``most`` remainders of a length."""
        whole, first, n, start = self.ranges[length].pop()
        if n > most:
            self.ranges[length].append((whole, first + most, n - most, start))
            n = most
        if not self.ranges[length]:
            del self.ranges[length]
        self.tokens -= length * n
        return whole, first, n, start


@dataclass
class Plan:
    """Pieces of ranges of remainders, and where the sequences of each tier begin.

    A piece (whole, first, n, start, length, sequence, offset) says: the remainders
    ``first`` to ``first + n`` of length ``whole`` put their ``length`` tokens from ``start`` on
    into the sequences ``sequence`` to ``sequence + n``, at ``offset``.
    """

    pieces: list[tuple[int, int, int, int, int, int, int]]
    tiers: list[tuple[int, int]]  # (first sequence, its context size)
    sequences: int


def plan(histogram: dict[int, int], tiers: tuple[int, ...] = TIERS) -> Plan:
    """Sequences for ``histogram`` (length: how many remainders), lengths under ``tiers[0]``."""
    stock = Stock()
    for length, n in histogram.items():
        stock.put(length, length, 0, n, 0)
    out = Plan([], [], 0)
    for tier in tiers:
        out.tiers.append((out.sequences, tier))
        last = tier == tiers[-1]
        while stock.tokens >= tier:
            longest = max(stock.ranges)
            if longest <= tier // 2 and not last:
                break
            opened = min(longest, tier)
            whole, first, n, start = stock.take(longest, stock.tokens // tier)
            stock.put(longest - opened, whole, first, n, start + opened)
            _fill(stock, out, tier, n, [(whole, first, start, opened, 0)], opened)
    if stock.tokens:
        out.tiers.append((out.sequences, tiers[0]))
        pieces, used = [], 0
        for length in sorted(stock.ranges, reverse=True):
            for whole, first, n, start in stock.ranges[length]:
                # Fewer tokens than the shortest tier remain, so these are few.
                for k in range(n):
                    pieces.append((whole, first + k, 1, start, length, out.sequences, used))
                    used += length
        out.pieces += pieces
        out.sequences += 1
    return out


def _fill(stock: Stock, out: Plan, tier: int, n: int, pieces: list[tuple[int, int, int, int, int]], used: int) -> None:
    """Fill ``n`` alike windows, which hold ``pieces`` (whole, first, start, length, offset) and ``used`` tokens."""
    open_windows = [(n, pieces, used)]
    while open_windows:
        n, pieces, used = open_windows.pop()
        gap = tier - used
        if not gap:
            out.pieces += [(whole, first, n, start, length, out.sequences, offset) for whole, first, start, length, offset in pieces]
            out.sequences += n
            continue
        fits = max((x for x in stock.ranges if x <= gap), default=None)
        length = fits or min(stock.ranges)
        whole, first, m, start = stock.take(length, n)
        piece = min(length, gap)
        stock.put(length - piece, whole, first, m, start + piece)
        if m < n:
            open_windows.append((n - m, [(w, f + m, s, x, o) for w, f, s, x, o in pieces], used))
        open_windows.append((m, [*pieces, (whole, first, start, piece, used)], used + piece))


@dataclass
class Lookup:
    """Pieces by remainder: ``codes`` are (length, first number) of intervals, whose pieces are ``rows[begins[i]:begins[i+1]]``."""

    codes: np.ndarray
    begins: np.ndarray
    rows: np.ndarray  # start, length, first sequence less first number, offset
    tiers: np.ndarray
    sizes: np.ndarray


_BITS = 44


def lookup(found: Plan) -> Lookup:
    """The plan cut into intervals of remainders that share all their pieces."""
    by_whole = defaultdict(list)
    for piece in found.pieces:
        by_whole[piece[0]].append(piece)
    codes, begins, rows = [], [0], []
    for whole in sorted(by_whole):
        starting, ending = defaultdict(list), defaultdict(list)
        for piece in by_whole[whole]:
            starting[piece[1]].append(piece)
            ending[piece[1] + piece[2]].append(piece)
        now: dict[int, tuple] = {}
        for k in sorted({*starting, *ending}):
            for piece in ending[k]:
                if now.get(piece[3]) is piece:
                    del now[piece[3]]
            for piece in starting[k]:
                now[piece[3]] = piece
            if now:
                codes.append(whole << _BITS | k)
                rows += [(s, length, sequence - first, offset) for _, first, _, s, length, sequence, offset in (now[s] for s in sorted(now))]
                begins.append(len(rows))
    tiers = np.array(found.tiers, np.int64).reshape(-1, 2)
    return Lookup(np.array(codes, np.int64), np.array(begins, np.int64), np.array(rows, np.int64).reshape(-1, 4), tiers[:, 0], tiers[:, 1])


# --- encoding and placing ---------------------------------------------------


@lru_cache(1)
def _encoder(path: str) -> C.ByteLevel:
    """One encoder for each worker process, so later tasks find its words."""
    return C.ByteLevel(path)


def _encode(path: str, end_id: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(path), TaskContext.get().partitionId()
        seen, windows = np.zeros(window, np.int64), 0
        for batch in batches:
            for lo, hi, data, at in C.text_slices(batch.column(1)):
                ids, begins = encoder.texts(data, at, end_id)
                n = np.diff(begins)
                full, rest = n // window, n % window
                # Number of each remainder among those of its length, in this task.
                order = np.argsort(rest, kind="stable")
                alike = rest[order]
                k = np.empty(len(rest), np.int64)
                k[order] = np.arange(len(rest)) - np.searchsorted(alike, alike)
                k += seen[rest]
                seen += np.bincount(rest, minlength=window)
                before = windows + np.cumsum(full) - full
                windows += int(full.sum())
                cols = [pa.array(np.full(hi - lo, part, np.int32)), batch.column(0).slice(lo, hi - lo), pa.array(n), pa.array(rest.astype(np.int32)),
                        pa.array(k), pa.array(before), C.binary_rows(ids, begins)]
                yield pa.record_batch(cols, ["part", "doc_id", "n_tokens", "rest", "k", "windows", "ids"])

    return run


_PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context long, step_group long"


def _place(shared, window: int, full_windows: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Lookup = shared.value
        for batch in batches:
            doc_at, start, length, sequence, offset, crc, total = [], [], [], [], [], [], []
            rest, k, first = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3, 4))
            for i, raw in enumerate(batch.column(5)):
                ids = np.frombuffer(raw.as_buffer(), "<u2").astype("<u4")
                full = len(ids) // window
                places = [(s * window, window, int(first[i]) + s, 0) for s in range(full)]
                if rest[i]:
                    at = int(np.searchsorted(table.codes, int(rest[i]) << _BITS | int(k[i]), side="right")) - 1
                    for s, n, base, o in table.rows[table.begins[at] : table.begins[at + 1]].tolist():
                        places.append((full * window + s, n, full_windows + base + int(k[i]), o))
                for s, n, q, o in places:
                    doc_at.append(i)
                    start.append(s)
                    length.append(n)
                    sequence.append(q)
                    offset.append(o)
                    crc.append(zlib.crc32(ids[s : s + n]))
                total += [len(ids)] * len(places)
            sequence = np.array(sequence, np.int64)
            tier = np.searchsorted(table.tiers + full_windows, sequence, side="right") - 1
            context = np.where(tier < 0, window, table.sizes[np.maximum(tier, 0)] if len(table.sizes) else window)
            cols = [batch.column(0).take(pa.array(doc_at, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total, sequence, offset, context, sequence % groups))]
            yield pa.record_batch(cols, ["doc_id", *(f.split()[0] for f in _PIECES.split(", "))])

    return run


def pack(docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID, step_tokens: int = STEP_TOKENS,
         text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context, step_group) of every piece.

    ``context`` is the sequence's context size: what it is padded to (all but one
    sequence hold as many tokens).  ``tiers`` are powers of two, longest first.
    """
    if list(tiers) != sorted(set(tiers), reverse=True) or any(t & (t - 1) for t in tiers):
        raise ValueError("tiers are powers of two, longest first")
    scratch, window = Scratch(docs.sparkSession), tiers[0]
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    encoded = rows.mapInArrow(_encode(tokenizer, end_id, window), f"part int, doc_id {kind}, n_tokens long, rest int, k long, windows long, ids binary")
    encoded = scratch.keep(encoded, "encoded")

    # Counts of each task, then what stands before it: at most one row per task and length.
    counts = encoded.groupBy(F.col("part").alias("of"), F.col("rest").alias("len")).agg(
        F.count("*").alias("n"), F.sum(F.floor(F.col("n_tokens") / window)).alias("full"))
    counts = scratch.keep(counts, "counts")
    n_counts = counts.count()
    before = Window.partitionBy("len").orderBy("of")
    ranks = counts.select("of", "len", (F.sum("n").over(before) - F.col("n")).alias("k_before"))
    parts = counts.groupBy(F.col("of").alias("task")).agg(F.sum("full").alias("full"))
    parts = parts.select("task", (F.sum("full").over(Window.orderBy("task")) - F.col("full")).alias("w_before"))
    histogram = {r["len"]: r["n"] for r in counts.where("len > 0").groupBy("len").agg(F.sum("n").alias("n")).collect()}
    full_windows = counts.agg(F.coalesce(F.sum("full"), F.lit(0))).first()[0]

    found = plan(histogram, tiers)
    shared = docs.sparkSession.sparkContext.broadcast(lookup(found))
    tokens = full_windows * window + sum(n * k for n, k in histogram.items())
    groups = max(1, -(-tokens // step_tokens))
    placed = encoded.join(few(fewer_tasks(ranks, n_counts), n_counts), (F.col("part") == F.col("of")) & (F.col("rest") == F.col("len")))
    placed = placed.join(few(parts, n_counts), F.col("part") == F.col("task"))
    placed = placed.select("doc_id", "n_tokens", "rest", (F.col("k") + F.col("k_before")).alias("k"), (F.col("windows") + F.col("w_before")).alias("first"), "ids")
    return placed.mapInArrow(_place(shared, window, full_windows, groups), f"doc_id {kind}, {_PIECES}")


def query(spark, sf_dir: str) -> DataFrame:
    """``op11_packing``: every piece of every document, its sequence and its place there."""
    from dssforge.llm.token_store import tokenizer_path

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path(TOKENIZER))
