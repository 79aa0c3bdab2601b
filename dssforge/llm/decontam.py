"""Benchmark decontamination by a broadcast hash set of test n-grams.

Both sides are lower-cased (A-Z) and cut into words; a window is ``n``
consecutive words of a benchmark item, and an item of fewer words is one
window.  The windows' hashes are broadcast; each document's word windows are
scanned against them, every hit is verified on its words, and the words inside
a verified window are marked.  Contaminated spans or whole documents can then
be removed, without moving a document between tasks.

The broadcast is used while the benchmark's counted windows stay within
``max_windows``.  Beyond that a bitmap of bounded size (``MOST_BITS``) is sent
instead, and the windows it lets through are verified by a join on their words;
``hits`` chooses, and the result is the same.

Defined results: null or empty text has no words, hence no hits; an item with
a null id or without words has no windows; rows that repeat an item_id add
their windows to that item; repeated documents are answered row by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dssforge.llm import bytetext as B
from dssforge.llm.store import Scratch, mapped, quoted

WINDOW = 10
MAX_WINDOWS = 200_000
#: Bits of a bitmap over window hashes; that of a large benchmark grows with its windows, up to MOST_BITS.
FILTER_BITS, MOST_BITS, BITS_PER_WINDOW = 1 << 24, 1 << 27, 16

_WINDOWS = "item_id long, size int, hash long, words binary"


def _windows(n: int):
    """Tasks that list the windows of benchmark rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, data, at in B.slices(batch.column(1)):
                starts, ends, first = B.spans(data, at, B.WORD)
                hashes = B.span_hashes(data, starts, ends)
                low = B.LOWER[data].tobytes()
                out = []
                for i in range(lo, hi):
                    a, b = first[i - lo], first[i - lo + 1]
                    if ids[i] is None or a == b:
                        continue
                    size = min(n, int(b - a))
                    words = [low[s:e] for s, e in zip(starts[a:b], ends[a:b])]
                    rolled = B.signed(rolling(hashes[a:b], size))
                    out += [(ids[i], size, int(h), b" ".join(words[k : k + size])) for k, h in enumerate(rolled)]
                if out:
                    cols = list(zip(*out))
                    types = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], ["item_id", "size", "hash", "words"])

    return run


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive word hashes."""
    n = len(hashes) - size + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(size):
        out = out * np.uint64(0x100000001B3) + hashes[k : k + n] if n > 0 else out
    return B.mix(out + np.uint64(size))


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(item_id, size, hash, words) of every window of ``benchmark`` (item_id, text)."""
    return benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(_windows(n), _WINDOWS).distinct()


class _Filter:
    """A bitmap over window hashes, per window size; ``keys`` holds what a hit is verified against."""

    def __init__(self, sizes, bits: np.ndarray, keys: dict[bytes, list[int]] | None):
        self.sizes, self.bits, self.keys = tuple(sizes), bits, keys

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(len(self.bits) * 8 - 1)
        return np.flatnonzero(self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1)


def _bitmap(hashes: np.ndarray, bits: int) -> np.ndarray:
    flags = np.zeros(bits, dtype=np.uint8)
    flags[hashes.view(np.uint64) & np.uint64(bits - 1)] = 1
    return np.packbits(flags, bitorder="little")


def _slice_hits(data, at, look: _Filter):
    """Per text of a slice: number of words and its candidate windows as (size, first word, words); words only there."""
    starts, ends, first = B.spans(data, at, B.WORD)
    hashes = B.span_hashes(data, starts, ends)
    found: dict[int, list[tuple[int, int]]] = {}
    for size in look.sizes:
        rolled = rolling(hashes, size)
        for p in look.candidates(rolled):
            text = int(np.searchsorted(first, p, side="right")) - 1
            if p + size <= first[text + 1]:
                found.setdefault(text, []).append((size, int(p)))
    low = B.LOWER[data].tobytes() if found else b""

    def words(p: int, size: int) -> bytes:
        return b" ".join(low[starts[k] : ends[k]] for k in range(p, p + size))

    return starts, ends, first, found, words


def _covered(marks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of (first word, end word) ranges, as ranges that neither touch nor overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(marks):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan_exact(shared, text_at: int, extra: pa.Schema):
    """Tasks that append (n_words, n_hit, item_ids, spans) to their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = shared.value
        for batch in batches:
            for lo, hi, data, at in B.slices(batch.column(text_at)):
                starts, ends, first, found, words = _slice_hits(data, at, look)
                n_hit, items, spans = np.zeros(hi - lo, np.int64), [[] for _ in range(hi - lo)], [[] for _ in range(hi - lo)]
                for text, candidates in found.items():
                    marks, ids = [], set()
                    for size, p in candidates:
                        owners = look.keys.get(words(p, size))
                        if owners:
                            marks.append((p, p + size))
                            ids.update(owners)
                    covered = _covered(marks)
                    n_hit[text] = sum(b - a for a, b in covered)
                    items[text] = sorted(ids)
                    spans[text] = [{"start": int(starts[a] - at[text]), "end": int(ends[b - 1] - at[text])} for a, b in covered]
                cols = [pa.array(np.diff(first), pa.int64()), pa.array(n_hit), pa.array(items, extra.field(2).type), pa.array(spans, extra.field(3).type)]
                rows = batch.slice(lo, hi - lo)
                yield pa.record_batch([*rows.columns, *cols], [*rows.schema.names, *extra.names])

    return run


def _scan_candidates(shared, text_at: int, extra: pa.Schema):
    """Tasks that append (n_words, candidates) to their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = shared.value
        for batch in batches:
            for lo, hi, data, at in B.slices(batch.column(text_at)):
                starts, ends, first, found, words = _slice_hits(data, at, look)
                out = [[] for _ in range(hi - lo)]
                for t, candidates in found.items():
                    out[t] = [
                        {"words": words(p, size), "first": int(p - first[t]), "size": size, "start": int(starts[p] - at[t]), "end": int(ends[p + size - 1] - at[t])}
                        for size, p in candidates
                    ]
                cols = [pa.array(np.diff(first), pa.int64()), pa.array(out, extra.field(1).type)]
                rows = batch.slice(lo, hi - lo)
                yield pa.record_batch([*rows.columns, *cols], [*rows.schema.names, *extra.names])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, n_hit, item_ids, spans) of rows (row, marks, item_ids)."""
    for batch in batches:
        n_hit, spans = [], []
        for marks in batch.column(1).to_pylist():
            covered = _covered([(m["first"], m["first"] + m["size"]) for m in marks])
            start, end = {m["first"]: m["start"] for m in marks}, {m["first"] + m["size"]: m["end"] for m in marks}
            n_hit.append(sum(b - a for a, b in covered))
            spans.append([{"start": start[a], "end": end[b]} for a, b in covered])
        yield pa.record_batch([batch.column(0), pa.array(n_hit, pa.int64()), batch.column(2), pa.array(spans, _FOUND_ARROW.field(3).type)], ["row", *_FOUND_ARROW.names[1:]])


_FOUND = "n_words long, n_hit long, item_ids array<long>, spans array<struct<start:long,end:long>>"
_FOUND_ARROW = pa.schema([("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.int64())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

_TOLD = "n_words long, candidates array<struct<words:binary,first:long,size:long,start:long,end:long>>"
_TOLD_ARROW = pa.schema([("n_words", pa.int64()), ("candidates", pa.list_(pa.struct([("words", pa.binary()), *((k, pa.int64()) for k in ("first", "size", "start", "end"))])))])


def hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, text: str = "text", max_windows: int | None = None) -> DataFrame:
    """``docs`` with n_words, n_hit, item_ids and spans (byte offsets of hit ranges) appended, for a benchmark of any size.

    Columns of ``docs`` that already have such a name are replaced.  The
    benchmark's windows are counted; up to ``max_windows`` (``MAX_WINDOWS``) they are broadcast.
    """
    most = MAX_WINDOWS if max_windows is None else max_windows
    windows = Scratch(docs.sparkSession).keep(benchmark_windows(benchmark, n), "windows")
    count = windows.count()
    return _by_broadcast(docs, windows.collect(), text) if count <= most else _by_join(docs, windows, count, text)


def scan(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, text: str = "text", max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``hits`` by the broadcast alone: a benchmark of more than ``max_windows`` windows is refused."""
    rows = benchmark_windows(benchmark, n).limit(max_windows + 1).collect()
    if len(rows) > max_windows:
        raise ValueError(f"the benchmark has more than {max_windows} windows; use hits")
    return _by_broadcast(docs, rows, text)


def scan_large(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, text: str = "text") -> DataFrame:
    """``hits`` by the join alone."""
    windows = Scratch(docs.sparkSession).keep(benchmark_windows(benchmark, n), "windows")
    return _by_join(docs, windows, windows.count(), text)


def _by_broadcast(docs: DataFrame, rows: list, text: str) -> DataFrame:
    keys: dict[bytes, list[int]] = {}
    for r in rows:
        keys.setdefault(bytes(r["words"]), []).append(r["item_id"])
    look = _Filter(sorted({r["size"] for r in rows}), _bitmap(np.array([r["hash"] for r in rows], dtype=np.int64), FILTER_BITS), keys)
    shared = docs.sparkSession.sparkContext.broadcast(look)
    docs = docs.drop(*_FOUND_ARROW.names)
    return mapped(docs, _scan_exact(shared, docs.columns.index(text), _FOUND_ARROW), _FOUND)


def _by_join(docs: DataFrame, windows: DataFrame, count: int, text: str) -> DataFrame:
    """Windows that pass the bitmap meet the benchmark in a join on their words.

    The documents are written once with a row number, their number of words and
    their candidates; what a row hits is joined back on that number, so
    repeated and null ids stay apart.
    """
    size = min(MOST_BITS, max(FILTER_BITS, 1 << (BITS_PER_WINDOW * count - 1).bit_length()))
    parts = windows.select(F.col("hash").bitwiseAND(size - 1).alias("bit"))
    # At most MOST_BITS / 64 rows, however many windows there are.
    packed = parts.groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    bits = np.zeros(size // 64, dtype=np.int64)
    for r in packed.toLocalIterator():
        bits[r["word"]] = r["bits"]
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most n values
    shared = docs.sparkSession.sparkContext.broadcast(_Filter(sizes, bits.view(np.uint8), None))

    docs = docs.drop(*_FOUND_ARROW.names)
    names = docs.columns
    told = mapped(docs, _scan_candidates(shared, names.index(text), _TOLD_ARROW), _TOLD)
    told = told.toDF(*(f"d{k}" for k in range(len(names))), *_TOLD_ARROW.names).withColumn("row", F.monotonically_increasing_id())
    told = Scratch(docs.sparkSession).keep(told, "told")
    owners = windows.groupBy("words").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    # Windows of one passage mostly have the same items, which count once in a set of lists.
    met = told.select("row", F.inline("candidates")).join(owners, "words").groupBy("row").agg(
        F.collect_list(F.struct("first", "size", "start", "end")).alias("marks"), F.collect_set("items").alias("lists"))
    met = met.select("row", "marks", F.array_sort(F.array_distinct(F.flatten("lists"))).alias("item_ids"))
    found = met.mapInArrow(_merge, "row long, " + _FOUND.partition(", ")[2])
    out = told.drop("candidates").join(found.withColumnRenamed("row", "at"), F.col("row") == F.col("at"), "left")
    none = {name: F.coalesce(name, F.lit(0) if name == "n_hit" else F.array().cast(found.schema[name].dataType)) for name in _FOUND_ARROW.names[1:]}
    return out.select(*(F.col(f"d{k}").alias(name) for k, name in enumerate(names)), "n_words", *(c.alias(name) for name, c in none.items()))


def _cut(text_at: int, spans_at: int):
    """Tasks that remove the byte ranges in ``spans`` from the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for i, ranges in enumerate(batch.column(spans_at).to_pylist()):
                if ranges:
                    raw, out, last = texts[i].encode(), [], 0
                    for r in ranges:
                        out.append(raw[last : r["start"]])
                        last = r["end"]
                    texts[i] = b"".join([*out, raw[last:]]).decode()
            yield batch.set_column(text_at, batch.schema.field(text_at), pa.array(texts, batch.schema.field(text_at).type))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", n: int = WINDOW, text: str = "text", max_windows: int | None = None) -> DataFrame:
    """``docs`` without contaminated documents, or with the hit spans cut out (``remove="spans"``).

    Returns the columns of ``docs``.  A cut joins what stood before and after
    the span as they are; a document whose every word is hit stays with what
    lies between its words.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(remove)
    found = hits(docs, benchmark, n, text, max_windows)
    if remove == "documents":
        return found.where("n_hit = 0").select(*map(quoted, docs.columns))
    return mapped(found, _cut(found.columns.index(text), found.columns.index("spans")), "").select(*map(quoted, docs.columns))


def query(spark, sf_dir: str) -> DataFrame:
    """``op9_decontaminate``: hits of every document against the whole benchmark."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text")
    ids = F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH bench AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         array_to_string(list_slice(w, p, p + least(10, len(w)) - 1), ' ') AS words
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS p FROM bench WHERE len(w) > 0)
), doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), sizes AS (SELECT DISTINCT size FROM win
), cand AS (
  SELECT doc_id, size, p, array_to_string(list_slice(w, p, p + size - 1), ' ') AS words
  FROM (SELECT doc_id, size, w, unnest(generate_series(1, len(w) - size + 1)) AS p FROM doc, sizes WHERE len(w) >= size)
), hit AS (
  SELECT c.doc_id, c.size, c.p, v.item_id FROM cand c JOIN win v ON c.words = v.words AND c.size = v.size
), cover AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(p, p + size - 1)) AS q FROM (SELECT DISTINCT doc_id, size, p FROM hit)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN cover c USING (doc_id) LEFT JOIN items i USING (doc_id)
"""
