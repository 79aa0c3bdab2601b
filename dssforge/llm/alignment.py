"""Cross-tokenizer alignment: which tokens of two tokenizers make up the same bytes.

Text (with a blank before it) is encoded by a byte-level BPE (A) and a
piece BPE with byte fallback (B).  Both give a list of byte ends; where an A end and a
B end agree, a group closes.  ``align`` walks the two end lists by diagonal runs: as long
as the tokens correspond one to one, the lists agree at a fixed shift of their
indexes, so blocks of doubling size are compared at the current shift and
jumped whole; at the first difference the side that is behind advances until the
ends meet again (an irregular group), and the shift is updated.

Neither tokenizer joins a token across a blank that follows a character that is
no white space, so texts fall into chunks there (``chunks``), and every place
between two chunks closes a group.  The new chunks of a slice are laid end to
end and aligned in one walk; a task keeps the groups of recent chunks, so
each is walked once.

The last A and the last B token of a group end together and are its link.  A
link's count is how many links of the whole corpus have its (A id, B id); it is
found by one aggregation over the links, which are kept as one 31-bit number each in a
written table, and joined back by that number (broadcast up to
``store.BROADCAST_IDS`` counted pairs, else a shuffle whose hot pairs adaptive
execution splits).

Defined results: a text that is null or empty, or whose tokens' bytes differ from
the blank and the text (the blank's own symbol U+2581 is such a character), has
no tokens, no groups, zeros and the digest ``''``; each row is aligned on its own, so
repeated and null doc_ids keep their rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dssforge.llm import bytetext as T
from dssforge.llm import chunks as C
from dssforge.llm.memo import Memo
from dssforge.llm.store import Scratch, small

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Distinct chunks whose groups a task keeps in each of two generations, and bytes of text that are aligned together.
CACHED, SLICE = 150_000, 1 << 21
#: Ids of B are below 2 ** B_BITS, ids of A below 2 ** (31 - B_BITS).
B_BITS = 15
_BLANK = T.byte_class([0x20])
#: Ends compared one by one before blocks are.
_FIRST_PROBE = 4


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index after the last A token and after the last B token of each group; both lists must close together."""
    if not len(ends_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(ends_b) or ends_a[-1] != ends_b[-1]:
        raise ValueError("the token lists cover different bytes")
    a, b = ends_a.tolist(), ends_b.tolist()
    na, nb, i, j = len(a), len(b), 0, 0
    runs_a, lengths, shifts = [], [], []  # a group after each of ``length`` tokens of A from ``run``, at a shift
    while i < na:
        begin, stop = i, min(i + _FIRST_PROBE, na, nb - j + i)
        while i < stop and a[i] == b[j]:
            i += 1
            j += 1
        if i == begin + _FIRST_PROBE:
            block = 2 * _FIRST_PROBE
            while (n := min(block, na - i, nb - j)) > 0:
                same = ends_a[i : i + n] == ends_b[j : j + n]
                run = n if same.all() else int(same.argmin())
                i += run
                j += run
                if run < n:
                    break
                block *= 2
        if i > begin:
            runs_a.append(begin)
            lengths.append(i - begin)
            shifts.append(j - i)
        if i == na:
            break
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        runs_a.append(i)
        lengths.append(1)
        i += 1
        j += 1
        shifts.append(j - i)
    lengths = np.array(lengths, np.int64)
    first = np.cumsum(lengths) - lengths
    closed_a = np.repeat(np.array(runs_a, np.int64) - first, lengths) + np.arange(int(lengths.sum())) + 1
    return closed_a, closed_a + np.repeat(np.array(shifts, np.int64), lengths)


def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in one array, with each token's start and length."""
    lengths = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


def _same_bytes(table: tuple, ids: np.ndarray, n: np.ndarray, want: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each chunk (``n`` of the ids, bytes of ``want`` up to ``ends``) whether its ids' bytes are its own."""
    flat, starts, lengths = table
    size = lengths[ids]
    after = np.cumsum(size)
    got_ends = np.concatenate([[0], after])[np.cumsum(n)]
    begins = np.concatenate([[0], ends[:-1]])
    same = np.diff(got_ends, prepend=0) == ends - begins
    if not same.all():  # a chunk of another length shifts those behind it, so each is looked at alone
        whole, got = want.tobytes(), flat[np.repeat(starts[ids] - (after - size), size) + np.arange(int(size.sum()))].tobytes()
        got_begins = np.concatenate([[0], got_ends[:-1]])
        return np.array([whole[a:b] == got[c:d] for a, b, c, d in zip(begins, ends, got_begins, got_ends)])
    got = flat[np.repeat(starts[ids] - (after - size), size) + np.arange(int(size.sum()))]
    return np.logical_and.reduceat(got == want, begins)


class Aligner:
    """Groups of chunks; a chunk begins with a blank."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = C.ByteLevel(path_a, plain_specials=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        if self.b.get_piece_size() > 1 << B_BITS or self.a.library.get_vocab_size() > 1 << (31 - B_BITS):
            raise ValueError("ids do not fit a link's number")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        mark = "▁"
        if any(mark in p.lstrip(mark) for p in pieces):
            raise ValueError("pieces join across blanks")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(mark, " ").encode() for i, p in enumerate(pieces)]
        self.a_table, self.b_table = _table(self.a.token_bytes), _table(self.b_bytes)
        self.b_lengths = np.array([len(p) for p in self.b_bytes], np.int64)
        self.names_a, self.names_b = ([str(i) for i in range(len(t))] for t in (self.a.token_bytes, self.b_bytes))
        self.known = Memo(CACHED)

    def _b_ids(self, chunks: list[bytes]) -> list[list[int]]:
        """B adds the chunk's first blank itself; a chunk of that blank alone is its piece."""
        found = self.b.encode([c[1:].decode() for c in chunks], num_threads=1)
        blank = [self.b.piece_to_id("▁")]
        return [ids if len(c) > 1 else blank for c, ids in zip(chunks, found)]

    def fresh(self, chunks: list[bytes]) -> list[tuple[bytes, bytes, int, int] | None]:
        """(groups as text, links as 32-bit numbers, A tokens, B tokens) of each chunk, None where a tokenizer changes its bytes."""
        raw_a = self.a.fresh(chunks)
        flat_a, ends_a = C.gather(raw_a, np.arange(len(chunks)), np.uint16)
        flat_a, ids_b = flat_a.astype(np.int64), self._b_ids(chunks)
        n_b = np.fromiter(map(len, ids_b), np.int64, len(chunks))
        flat_b = np.fromiter(chain.from_iterable(ids_b), np.int64, int(n_b.sum()))
        n_a, ends = np.diff(ends_a), np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        want = np.frombuffer(b"".join(chunks), np.uint8)
        good = _same_bytes(self.a_table, flat_a, n_a, want, ends) & _same_bytes(self.b_table, flat_b, n_b, want, ends)
        out: list[tuple | None] = [None] * len(chunks)
        if not good.any():
            return out
        flat_a, flat_b = flat_a[np.repeat(good, n_a)], flat_b[np.repeat(good, n_b)]
        closed_a, closed_b = align(np.cumsum(self.a.lengths[flat_a]), np.cumsum(self.b_lengths[flat_b]))
        links = (flat_a[closed_a - 1] << B_BITS | flat_b[closed_b - 1]).astype(np.int32).tobytes()
        # A chunk's groups are those up to its last token.
        stops = np.searchsorted(closed_a, np.cumsum(n_a[good])) + 1
        names_a, names_b = self.names_a, self.names_b
        a, b = flat_a.tolist(), flat_b.tolist()
        groups, p, r = [], 0, 0
        for q, s in zip(closed_a.tolist(), closed_b.tolist()):
            if q - p == 1 and s - r == 1:
                groups.append(f"{names_a[a[p]]}|{names_b[b[r]]}")
            else:
                groups.append(f"{','.join([names_a[t] for t in a[p:q]])}|{','.join([names_b[t] for t in b[r:s]])}")
            p, r = q, s
        lo = 0
        for i, hi, x, y in zip(np.flatnonzero(good).tolist(), stops.tolist(), n_a[good].tolist(), n_b[good].tolist()):
            out[i] = (";".join(groups[lo:hi]).encode(), links[4 * lo : 4 * hi], x, y)
            lo = hi
        return out

    def texts(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Per text A tokens, B tokens and the digest of its groups, then all links and where each text's begin (and the end).

        Every text begins with the added blank; a text of that blank alone has no tokens.
        """
        d = C.distinct(data, at, _BLANK)
        # None is a value here, so the memo holds tuples of one.
        parts = [p[0] for p in C.remembered(self.known, d.values, lambda new: [(p,) for p in self.fresh(new)])]
        n = len(at) - 1
        bad = np.array([p is None for p in parts], np.int64)
        faults = np.concatenate([[0], np.cumsum(bad[d.index])])
        none = (faults[d.first[1:]] > faults[d.first[:-1]]) | (np.diff(at) <= 1)
        kept = np.repeat(~none, np.diff(d.first))
        index, first = d.index[kept], np.concatenate([[0], np.cumsum(np.where(none, 0, np.diff(d.first)))])
        whole = [p or (b"", b"", 0, 0) for p in parts]
        links, ends = C.gather([p[1] for p in whole], index, np.int32)
        sums = []
        for k in (2, 3):
            per = np.array([p[k] for p in whole], np.int64)
            total = np.concatenate([[0], np.cumsum(per[index])])
            sums.append(total[first[1:]] - total[first[:-1]])
        strings, where = [p[0] for p in whole], index.tolist()
        digests = [hashlib.sha256(b";".join([strings[x] for x in where[first[i] : first[i + 1]]])).hexdigest() if first[i + 1] > first[i] else "" for i in range(n)]
        return sums[0], sums[1], digests, links, ends[first]


@lru_cache(1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner for each worker process, so later tasks find its chunks."""
    return Aligner(path_a, path_b)


def _aligned(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, row = _aligner(path_a, path_b), TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, data, at in C.text_slices(batch.column(1), SLICE):
                n_a, n_b, digests, links, begins = aligner.texts(data, at)
                rows = pa.array(np.arange(row, row + hi - lo))
                row += hi - lo
                lists = pa.LargeListArray.from_arrays(pa.array(begins.astype(np.int64)), pa.array(links))
                cols = [rows, batch.column(0).slice(lo, hi - lo), pa.array(n_a), pa.array(n_b), pa.array(np.diff(begins)), pa.array(digests, pa.string()), lists.cast(pa.list_(pa.int32()))]
                yield pa.record_batch(cols, ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    return run


def aligned(docs: DataFrame, path_a: str, path_b: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, groups_sha256, links) of each row; a link is A id * 2 ** B_BITS + B id."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.concat(F.lit(" "), F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text"))
    return rows.mapInArrow(_aligned(path_a, path_b), f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, links array<int>")


def pair_counts(found: DataFrame) -> DataFrame:
    """(a, b, n, best) of each linked id pair of written rows: its links, and whether none of its B id has more."""
    pairs = found.select(F.explode("links").alias("link")).groupBy("link").agg(F.count("*").alias("n"))
    split = pairs.select(F.shiftright("link", B_BITS).alias("a"), F.col("link").bitwiseAND(F.lit((1 << B_BITS) - 1)).alias("b"), "n")
    most = split.groupBy(F.col("b").alias("of")).agg(F.max("n").alias("most"))
    return split.join(most, F.col("b") == F.col("of")).select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, path_a: str, path_b: str, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Digest of every row, (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), and the table of linked id pairs."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.keep(aligned(docs, path_a, path_b, text, doc_id), "aligned")
    pairs = scratch.keep(pair_counts(found), "pairs")
    counted = pairs.select((F.shiftleft("a", B_BITS) + F.col("b")).alias("of"), F.col("n").alias("n"), F.col("best").cast("int").alias("best"))
    links = found.select("row", F.explode("links").alias("link"))
    sums = links.join(small(counted), F.col("link") == F.col("of")).groupBy(F.col("row").alias("r")).agg(F.sum("n").alias("count_sum"), F.sum("best").alias("n_best"))
    out = found.drop("links").join(sums, F.col("row") == F.col("r"), "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.coalesce("n_best", zero).alias("n_best"),
                      F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"), pairs


def query(spark, sf_dir: str) -> DataFrame:
    """``op13_token_alignment``: groups and links of every document, with the corpus-wide counts of its links."""
    from dssforge.llm.token_store import tokenizer_path

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align_documents(docs, tokenizer_path(TOKENIZER_A), tokenizer_path(TOKENIZER_B))[0]
