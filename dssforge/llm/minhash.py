"""Near-duplicate groups by MinHash bands, verified with odd sketches and full sets.

Each text becomes the set of its ``width``-word shingles (A-Z lower-cased,
words cut at ASCII white space).  Texts with the same set are one node from
then on, so exact copies never meet in pairs.  ``BANDED / ROWS`` band keys of
MinHash samples propose pairs, and ``SAMPLES`` of them make an odd sketch: every
sample flips one bit of a small bitmap, so the XOR of two bitmaps counts
differing samples, and its population count estimates the similarity.  A pair is
dropped only where that estimate is ``MARGIN`` below the threshold; what remains is
confirmed on the two full sets.

Pairs inside a band bucket are not listed (``buckets.connect``), and no link is
lost, whatever the size of a group; a pair that shares no band (fewer than 1 in
10 million at the threshold) is the only miss.

Defined results: null, empty or blank text has an empty set and is linked with
nothing; a text of fewer words than ``width`` is one shingle; rows that repeat
a doc_id are one document and share a component; a null doc_id is linked with
nothing, has a null component and is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dssforge.llm import bytetext as B
from dssforge.llm.buckets import connect, ends
from dssforge.llm.store import Scratch, few, fewer_tasks, small, tidy

WIDTH, PERCENT = 2, 80
#: MinHash samples: all of them go into the sketch, the first ``BANDED`` into bands of ``ROWS``.
SAMPLES, BANDED, ROWS = 512, 128, 4
SKETCH_BITS = 1024
#: How far below the threshold an estimate must be for a pair to be dropped unconfirmed: six standard deviations.
MARGIN = 0.14

#: Most members of a block, about, where whole families are compared.
OUTSIDE_BLOCK, INSIDE_BLOCK = 128, 512

_RNG = np.random.Generator(np.random.PCG64(7))
_FACTORS = (_RNG.integers(0, 2**63, SAMPLES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_OFFSETS = _RNG.integers(0, 2**63, SAMPLES, dtype=np.uint64)
_SEATS = B.mix(np.arange(1, SAMPLES + 1, dtype=np.uint64))


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a slice."""
    starts, ends, first = B.spans(data, at)
    words = B.span_hashes(data, starts, ends)
    n = len(words) - width + 1
    rolled = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(width if n > 0 else 0):
        rolled = B.mix(rolled * np.uint64(0x9E3779B1) + words[k : k + n])
    out = []
    for i in range(len(at) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        else:  # the whole sequence as one, told apart from shingles of full width by its length
            whole = np.zeros(min(b - a, 1), dtype=np.uint64)
            for k in range(a, b):
                whole = B.mix(whole * np.uint64(0x9E3779B1) + words[k])
            out.append(B.mix(whole + np.uint64(b - a)) if b > a else whole)
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash samples of one nonempty set."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(shingles), 1024):
        np.minimum(least, (shingles[None, k : k + 1024] * _FACTORS[:, None] + _OFFSETS[:, None]).min(axis=1), out=least)
    return least


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples, as longs."""
    seats = B.mix(samples ^ _SEATS) % np.uint64(SKETCH_BITS)
    parity = (np.bincount(seats.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").view(np.int64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDED // ROWS, dtype=np.uint64)
    for row in samples[:BANDED].reshape(-1, ROWS).T:
        keys = B.mix(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return B.signed(keys)


def digest(shingles: np.ndarray) -> list[int]:
    """128 bits that stand for a set, as two longs."""
    sums = np.add.reduce(B.mix(shingles)), np.add.reduce(B.mix(shingles * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)))
    return [int(B.signed(x.reshape(1))[0]) for x in sums]


_SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch array<long>"


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in B.slices(batch.column(1)):
                sets = shingle_sets(data, at, width)
                rows = []
                for s in sets:
                    if len(s):
                        samples = signature(s)
                        rows.append((len(s), *digest(s), band_keys(samples), odd_sketch(samples)))
                    else:
                        rows.append((0, 0, 0, None, None))
                cols = list(zip(*rows))
                longs = pa.list_(pa.int64())
                yield pa.record_batch(
                    [batch.column(0).slice(lo, hi - lo), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], longs), pa.array(cols[4], longs)],
                    ["doc_id", "n_shingles", "d1", "d2", "bands", "sketch"],
                )

    return run


def estimate(a, b):
    """Similarity estimated from two odd sketches: 1 + n / 4k * ln(1 - 2 z / n) for z differing bits of n, k samples."""
    z = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    part = F.greatest(1 - 2 * z / F.lit(float(SKETCH_BITS)), F.lit(1e-9))
    return 1 + F.lit(SKETCH_BITS / (4.0 * SAMPLES)) * F.log(part)


def may_link(a, b, percent: int):
    """Whether two sketches leave a similarity of ``percent`` possible."""
    return estimate(a, b) >= percent / 100 - MARGIN


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar."""
    if not len(x) or not len(y) or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _confirm(width: int, percent: int):
    """Tasks that keep the pairs with similar full sets (of any texts, where a doc_id has several)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for c in (2, 3):
                lists, sets = batch.column(c), []
                for _, _, data, at in B.slices(lists.flatten()):
                    sets += shingle_sets(data, at, width)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in lists.to_pylist()])])
                sides.append([sets[a:b] for a, b in zip(ends[:-1], ends[1:])])
            similar = [any(linked(x, y, percent) for x in xs for y in ys) for xs, ys in zip(*sides)]
            yield batch.filter(pa.array(similar, pa.bool_())).select([0, 1])

    return run


def _paired(pairs: DataFrame, rows: int, table: DataFrame, column: str) -> DataFrame:
    """(a, b, a_side, b_side): ``column`` of ``table`` (doc_id, column) for both ends of each pair, as lists.

    The table is met once, by both ends together, and then regrouped by pair;
    a node that is in many pairs is never one key.
    """
    met = table.join(few(ends(pairs), 2 * rows), F.col("doc_id") == F.col("id"))
    sides = [F.collect_set(F.when(F.col("side") == k, F.col(column))).alias(name) for k, name in enumerate(("a_side", "b_side"))]
    return met.groupBy("a", "b").agg(*sides)


class _Links:
    """Confirms candidate pairs of nodes on their texts."""

    def __init__(self, scratch: Scratch, docs: DataFrame, nodes: DataFrame, width: int, percent: int):
        self.scratch, self.docs, self.nodes = scratch, docs, nodes
        self.width, self.percent, self.rounds = width, percent, 0

    def __call__(self, pairs: DataFrame, rows: int) -> DataFrame:
        self.rounds += 1
        both = _paired(pairs, rows, self.nodes.select("doc_id", "sketch"), "sketch")
        near = both.where(may_link(F.col("a_side")[0], F.col("b_side")[0], self.percent)).select("a", "b")
        near = self.scratch.keep(fewer_tasks(near, rows), f"near-{self.rounds}")
        texts = _paired(near, near.count(), self.docs, "text")
        links = texts.select("a", "b", "a_side", "b_side").mapInArrow(tidy(_confirm(self.width, self.percent)), "a long, b long")
        links = self.scratch.keep(links, f"links-{self.rounds}")
        self.scratch.drop(f"near-{self.rounds}")
        return links

    def in_families(self, outside: DataFrame, inside: DataFrame) -> DataFrame:
        """The links between ``outside`` and ``inside`` (family, id) of the same family, written.

        The texts of the families are made shingle sets once.  Both sides of a
        family are cut into blocks of bounded size, and a task compares the
        members of two blocks that share a band: odd sketches rule out, sets
        confirm, and only links become rows.
        """
        sizes = inside.groupBy("family").agg(F.count("*").alias("m")).join(
            outside.groupBy(F.col("family").alias("f")).agg(F.count("*").alias("o")), F.col("family") == F.col("f"))
        sizes = sizes.select(F.col("family").alias("f"), F.ceil(F.col("o") / OUTSIDE_BLOCK).alias("o"), F.ceil(F.col("m") / INSIDE_BLOCK).alias("m"))
        sizes = self.scratch.keep(sizes, "sizes")
        n_families, n_inside = sizes.count(), inside.count()
        ids = fewer_tasks(inside.select("id").distinct(), n_inside)
        texts = self.docs.where("text is not null").join(few(ids, n_inside), F.col("doc_id") == F.col("id"), "left_semi")
        sets = texts.distinct().mapInArrow(tidy(_sets(self.width)), "of long, s1 long, s2 long, shingles array<long>")
        known = self.nodes.select("doc_id", "d1", "d2", "bands", "sketch")
        sets = sets.join(known, (F.col("of") == F.col("doc_id")) & (F.col("s1") == F.col("d1")) & (F.col("s2") == F.col("d2")))
        sets = self.scratch.keep(sets.select("of", "bands", "sketch", "shingles"), "family-sets")

        def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
            """Rows with their block and sets, once for each block of the other side."""
            placed = rows.join(few(sizes, n_families), F.col("family") == F.col("f"))
            placed = placed.withColumn(f"{own}_block", F.pmod(F.xxhash64("id"), F.col(own)))
            placed = placed.withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
            own_sets = sets.select(*(F.col(c).alias(f"own_{c}") for c in sets.columns))  # columns of its own for each side
            placed = placed.join(own_sets, F.col("id") == F.col("own_of"))
            return placed.select("family", "o_block", "m_block", F.col("id").alias("id"), *(F.col(f"own_{c}").alias(c) for c in ("bands", "sketch", "shingles")))

        keys = ["family", "o_block", "m_block"]
        found = dealt(outside, "o", "m").groupBy(*keys).cogroup(dealt(inside, "m", "o").groupBy(*keys)).applyInArrow(
            _compare(self.percent), "a long, b long")
        return self.scratch.keep(found, "family-links")


def _sets(width: int):
    """Tasks that turn (id, text) into (id, digest, shingles), texts without words left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in B.slices(batch.column(1)):
                sets = shingle_sets(data, at, width)
                rows = [(i, *digest(s), B.signed(s)) for i, s in zip(batch.column(0).slice(lo, hi - lo).to_pylist(), sets) if len(s)]
                cols = list(zip(*rows)) or [()] * 4
                yield pa.record_batch([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.list_(pa.int64()))], ["of", "s1", "s2", "shingles"])

    return run


def _compare(percent: int):
    """Tasks that list the links between two blocks of (.., id, bands, sketch, shingles) among members that share a band."""

    def matrix(column: pa.ChunkedArray) -> np.ndarray:
        return np.concatenate([c.flatten().to_numpy() for c in column.chunks]).view(np.uint64).reshape(len(column), -1)

    def members(table: pa.Table):
        sets: list[np.ndarray] = []
        for c in table["shingles"].chunks:
            if len(c):
                sets += np.split(c.flatten().to_numpy().view(np.uint64), np.cumsum(c.value_lengths().to_numpy())[:-1])
        return table["id"].to_numpy(), matrix(table["bands"]), matrix(table["sketch"]), sets

    def run(outside: pa.Table, inside: pa.Table) -> pa.Table:
        pairs: set[tuple[int, int]] = set()
        if outside.num_rows and inside.num_rows:
            ids, bands, sketches, sets = members(outside)
            for id_, own_bands, sketch, s in zip(*members(inside)):
                met = np.flatnonzero((bands == own_bands).any(axis=1) & (ids != id_))
                differing = np.bitwise_count(sketches[met] ^ sketch).sum(axis=1, dtype=np.int64)
                about = 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(np.maximum(1 - 2 * differing / SKETCH_BITS, 1e-9))
                for k in met[about >= percent / 100 - MARGIN]:
                    if linked(sets[k], s, percent):
                        pairs.add((max(int(ids[k]), int(id_)), min(int(ids[k]), int(id_))))
        a, b = zip(*sorted(pairs)) if pairs else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    Documents are linked where 100 * intersection >= ``percent`` * union of
    their shingle sets; component_id is the smallest doc_id reachable.
    """
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = scratch.keep(docs.mapInArrow(tidy(_sign(width)), _SIGNED), "signed")
    has = signed.where("n_shingles > 0 and doc_id is not null")

    # One node for each distinct set, named by its smallest doc_id.
    first = scratch.keep(has.groupBy("d1", "d2").agg(F.min("doc_id").alias("node")), "first")
    owned = signed.select("doc_id", "n_shingles", *(F.when(F.col("n_shingles") > 0, F.col(d)).alias(d) for d in ("d1", "d2")))
    owned = scratch.keep(owned.join(first, ["d1", "d2"], "left").select("doc_id", "n_shingles", "node"), "owned")
    nodes = has.join(first.withColumnRenamed("node", "doc_id"), ["d1", "d2", "doc_id"], "left_semi")
    nodes = scratch.keep(nodes.select("doc_id", "d1", "d2", "bands", "sketch").dropDuplicates(["doc_id", "d1", "d2"]), "nodes")
    # Rows that repeat a doc_id with other texts are one document: its nodes are linked.
    versions = owned.where("doc_id is not null").groupBy("doc_id").agg(F.collect_set("node").alias("n")).where("size(n) > 1")
    edges = scratch.keep(versions.select(F.explode("n").alias("a"), F.array_min("n").alias("b")).where("a <> b"), "edges")

    bands = nodes.select("doc_id", F.explode("bands").alias("band"))
    full = bands.groupBy("band").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub < last")
    full = scratch.keep(full.select(F.col("band").alias("key")), "full")
    members = bands.join(small(full), F.col("band") == F.col("key")).select("key", F.col("doc_id").alias("id"), F.lit(True).alias("anchor"))
    members = scratch.keep(members, "members")

    links = _Links(scratch, docs, nodes, width, percent)
    names, n_nodes = connect(members, members.count(), links, scratch, edges, edges.count(), links.in_families)
    out = owned.join(few(names.toDF("n", "component"), n_nodes), F.col("node") == F.col("n"), "left")
    component = F.coalesce("component", "node", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"), kept.alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    """``op7_minhash_dedup``: groups of near-duplicates over all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) AS s FROM doc WHERE len(w) >= 2
    UNION ALL SELECT doc_id, w[1] FROM doc WHERE len(w) = 1)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)
), both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.seen = e.a
), comp AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM doc d LEFT JOIN n USING (doc_id) JOIN comp c ON c.node = d.doc_id
"""
