"""Token ids of a corpus in binary blocks with Elias-Fano document boundaries.

Documents are encoded where they are read and written once as ids, which are then
ordered by doc_id over range partitions and packed into blocks of about
``BLOCK_TOKENS`` ids, so no text is ever shuffled.  A block is one self-contained record::

    magic "EFTS" | id bytes (1) | 3 spare | n_docs u32 | n_null u32 | n_tokens u64 | first doc_id i64
    two Elias-Fano lists: document starts (n_docs + 1 values), doc_id minus first doc_id
    the ids, little-endian, 2 bytes each where the vocabulary fits, else 4

An Elias-Fano list of n values up to U holds floor(log2(U / n)) low bits of each
value packed, and the rest as gaps in unary; every ``SAMPLE``-th one bit's
position is kept (32 bits), so ``select`` finds a value from one sample and a
few words, at about 2 + log2(U / n) bits a value instead of 64.

Blocks are the rows of a Parquet table in the shared folder (any store that
Spark writes to), with their range partition and number, so a document's global
start is a running sum over partitions, then over a partition's blocks.

Reading goes through the lists in fixed memory: ``select`` for one document,
``EliasFano.runs`` for all in order, so no 64-bit table of a block is made.

Defined results: null text is empty and encodes as the end id alone; rows that
repeat a doc_id (they may fill many partitions) follow each other ordered by a hash
of their ids; null doc_ids come first.
"""

from __future__ import annotations

import struct
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dssforge.llm import bytetext as T
from dssforge.llm import chunks as C
from dssforge.llm.memo import Memo
from dssforge.llm.store import Scratch, tidy

TOKENIZER, END_ID = "word_bpe_49k.json", 1
BLOCK_TOKENS = 1 << 20
SAMPLE = 64
#: Words whose ids a task keeps in each of two generations, and bytes of text that are encoded together.
CACHED_WORDS, SLICE = 200_000, 1 << 21
#: Documents that are read at once, and words that go to the library as one string.
READ_ROWS, JOINED_WORDS = 4096, 2000

_HEAD = struct.Struct("<4sB3xIIQq")
_LIST = struct.Struct("<IBxxxII")


# --- Elias-Fano -------------------------------------------------------------


def ef_encode(values: np.ndarray) -> bytes:
    """Nondecreasing values from 0, as bytes."""
    n = len(values)
    top = int(values[-1]) if n else 0
    low_bits = max(0, int(top // n).bit_length() - 1) if n else 0
    values = values.astype(np.uint64)
    shifts = np.arange(low_bits, dtype=np.uint64)
    low = np.packbits((values[:, None] >> shifts & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little") if low_bits else np.zeros(0, np.uint8)
    ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    flags = np.zeros(-(-(int(ones[-1]) + 1 if n else 0) // 64) * 64, dtype=np.uint8)
    flags[ones] = 1
    high = np.packbits(flags, bitorder="little")
    samples = ones[::SAMPLE].astype("<u4")
    return _LIST.pack(n, low_bits, len(low), len(high)) + low.tobytes() + high.tobytes() + samples.tobytes()


class EliasFano:
    """Reads values of an encoded list in place."""

    def __init__(self, raw: memoryview, at: int = 0):
        self.n, self.low_bits, n_low, n_high = _LIST.unpack_from(raw, at)
        at += _LIST.size
        self.low = np.frombuffer(raw, np.uint8, n_low, at)
        self.high = np.frombuffer(raw, np.uint8, n_high, at + n_low)
        n_samples = -(-self.n // SAMPLE)
        self.samples = np.frombuffer(raw, "<u4", n_samples, at + n_low + n_high)
        self.end = at + n_low + n_high + 4 * n_samples

    def _low(self, i: int) -> int:
        bit = i * self.low_bits
        last = (bit + self.low_bits + 7) >> 3
        return (int.from_bytes(self.low[bit >> 3 : last].tobytes(), "little") >> (bit & 7)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Value ``i``, found from the sample before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        word, skip = at >> 3, at & 7
        byte = int(self.high[word]) >> skip << skip
        while (ones := byte.bit_count()) <= left:
            left -= ones
            word += 1
            byte = int(self.high[word])
        for _ in range(left):
            byte &= byte - 1
        one = 8 * word + (byte & -byte).bit_length() - 1
        return ((one - i) << self.low_bits) | self._low(i)

    def runs(self, rows: int = READ_ROWS) -> Iterator[np.ndarray]:
        """All values in order, at most ``rows`` at a time; memory follows ``rows``, not the list."""
        done, byte = 0, 0
        left = np.zeros(0, np.int64)  # positions of one bits read and not yet returned
        while done < self.n:
            while len(left) < rows and byte < len(self.high):
                ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + rows], bitorder="little")) + 8 * byte
                left, byte = np.concatenate([left, ones]), byte + rows
            n = min(rows, self.n - done, len(left))
            out = (left[:n] - np.arange(done, done + n)) << self.low_bits
            if self.low_bits:
                first = done * self.low_bits
                stop = (done + n) * self.low_bits
                bits = np.unpackbits(self.low[first >> 3 : (stop + 7) >> 3], bitorder="little")[first & 7 :][: stop - first]
                out = out | (bits.reshape(n, self.low_bits).astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
            yield out.astype(np.int64)
            left, done = left[n:], done + n

    def values(self) -> np.ndarray:
        """All values."""
        return np.concatenate([np.zeros(0, np.int64), *self.runs()])


# --- blocks -----------------------------------------------------------------


def write_block(doc_ids: list[int | None], lengths: list[int], ids: bytes, id_bytes: int) -> bytes:
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    n_null = sum(d is None for d in doc_ids)
    known = doc_ids[n_null:]
    base = known[0] if known else 0
    offsets = np.array([d - base for d in known], dtype=np.uint64)
    head = _HEAD.pack(b"EFTS", id_bytes, len(doc_ids), n_null, int(starts[-1]), base)
    return head + ef_encode(starts) + ef_encode(offsets) + ids


class Block:
    """A block read in place: document ``i`` is ``doc_ids()[i]`` with ids ``ids(i)``."""

    def __init__(self, raw):
        self.raw = memoryview(raw)
        magic, self.id_bytes, self.n_docs, self.n_null, self.n_tokens, self.base = _HEAD.unpack_from(self.raw, 0)
        if magic != b"EFTS":
            raise ValueError("not a token block")
        self.starts = EliasFano(self.raw, _HEAD.size)
        self._ids = EliasFano(self.raw, self.starts.end)
        self.tokens = np.frombuffer(self.raw, f"<u{self.id_bytes}", self.n_tokens, self._ids.end)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + [self.base + int(x) for x in self._ids.values()]

    def documents(self, rows: int = READ_ROWS) -> Iterator[tuple[pa.Array, np.ndarray]]:
        """(doc_ids, bounds of their ids) of all documents in order, ``rows`` at a time."""
        names = self._doc_ids(rows)
        last = np.zeros(0, np.int64)
        for starts in self.starts.runs(rows):
            starts, last = np.concatenate([last, starts]), starts[-1:]
            if len(starts) > 1:
                n, parts = len(starts) - 1, []
                while n > sum(map(len, parts)):
                    parts.append(next(names))
                both = pa.concat_arrays(parts)
                if len(both) > n:
                    names = _again(both.slice(n), names)
                yield both.slice(0, n), starts

    def _doc_ids(self, rows: int) -> Iterator[pa.Array]:
        for lo in range(0, self.n_null, rows):
            yield pa.nulls(min(rows, self.n_null - lo), pa.int64())
        for values in self._ids.runs(rows):
            yield pa.array(values + self.base)

    def ids(self, i: int) -> np.ndarray:
        return self.tokens[self.starts.select(i) : self.starts.select(i + 1)]


def _again(first: pa.Array, rest: Iterator[pa.Array]) -> Iterator[pa.Array]:
    yield first
    yield from rest


# --- encoding ---------------------------------------------------------------


class WordEncoder:
    """Ids of whole texts, word by word, equal to the library's on the whole text.

    The tokenizer drops white space and never joins across it, nor across the place
    where a mark follows a letter, so a text is the sequence of such words; each
    distinct word of a slice is looked up once, and each new one is encoded by the
    library and kept.  A-Z become a-z before that, as the tokenizer's normalizer does
    (not in slices with combining marks, which compose with some letters of one case only, nor
    in slices that hold a special token's string in any case).  Texts with a
    special token's string go to the library whole.
    """

    def __init__(self, path: str, end_id: int | None, words_apart: bool = True):
        C.quiet_library()
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.id_bytes = 2 if self.library.get_vocab_size() <= 1 << 16 and (end_id or 0) < 1 << 16 else 4
        self.kind = "H" if self.id_bytes == 2 else "I"
        self.end_id, self.end = end_id, b"" if end_id is None else self._bytes([end_id])
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.words_apart = words_apart
        self.ending_token = np.zeros(self.library.get_vocab_size(), dtype=bool)
        self.ending_token[[i for t, i in self.library.get_vocab().items() if t.endswith("</w>")]] = True
        self.known = Memo(CACHED_WORDS)

    def _bytes(self, ids: list[int]) -> bytes:
        packed = array(self.kind, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _library(self, texts: list[bytes]) -> list[bytes]:
        found = self.library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [self._bytes(e.ids) for e in found]

    def fresh(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each chunk.  Words of letters alone go as joined strings, since each is one run that ends in one ending token."""
        if not self.words_apart:
            return self._library(chunks)
        texts = [c.decode() for c in chunks]
        plain = [i for i, t in enumerate(texts) if t.isalpha() and (t.isascii() or max(t) < "\u0100")]
        out: list[bytes] = [b""] * len(chunks)
        groups = [plain[k : k + JOINED_WORDS] for k in range(0, len(plain), JOINED_WORDS)]
        others = sorted(set(range(len(chunks))) - set(plain))
        found = self.library.encode_batch_fast([" ".join([texts[i] for i in g]) for g in groups] + [texts[i] for i in others], add_special_tokens=False)
        for g, e in zip(groups, found):
            ids = np.array(e.ids, np.int64)
            ends = np.flatnonzero(self.ending_token[ids]) + 1
            if len(ends) != len(g):
                raise ValueError("a word of letters is more than one run")
            raw, lo = ids.astype(f"<u{self.id_bytes}").tobytes(), 0
            for i, hi in zip(g, (ends * self.id_bytes).tolist()):
                out[i] = raw[lo:hi]
                lo = hi
        for i, e in zip(others, found[len(groups) :]):
            out[i] = self._bytes(e.ids)
        return out

    def __call__(self, raw: bytes) -> bytes:
        return self.fresh([raw])[0] + self.end

    def texts(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice (each with the end id) and where each text's begin (and the end)."""
        if not self.words_apart:
            d = C.distinct(data, at, C.NOWHERE)
        else:
            low = T.LOWER[data]
            raw = low.tobytes()
            if b"\xcc" not in raw and b"\xcd" not in raw and not any(s.lower() in raw for s in self.special):
                data = low
            d = C.distinct(data, at, whole=self.special, marks=True, apart=True)
        return C.ids_of_texts(self.known, self.fresh, d, self.end_id, np.dtype(f"<u{self.id_bytes}"))


_BLOCKS = "part int, block int, n_docs int, n_tokens long, payload binary"


@lru_cache(1)
def _encoder(path: str, end_id: int | None, words_apart: bool) -> WordEncoder:
    """One encoder for each worker process, so later tasks find its words."""
    return WordEncoder(path, end_id, words_apart)


def _encode(path: str, end_id: int | None, words_apart: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = _encoder(path, end_id, words_apart), TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, data, at in C.text_slices(batch.column(1), SLICE):
                ids, begins = encoder.texts(data, at)
                cols = [batch.column(0).slice(lo, hi - lo), pa.array(np.arange(row, row + hi - lo)), C.binary_rows(ids, begins)]
                row += hi - lo
                yield pa.record_batch(cols, ["doc_id", "row", "ids"])

    return run


def _pack(id_bytes: int, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        docs, lengths, parts, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            payload = write_block(docs, lengths, b"".join(parts), id_bytes)
            cols = [[part], [block], [len(docs)], [size], [payload]]
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], ["part", "block", "n_docs", "n_tokens", "payload"])

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids.as_py()
                n = len(ids) // id_bytes
                # A block holds doc_ids whose distance fits; a document is never split.
                if docs and (size + n > block_tokens or docs[-1] is None and doc is not None):
                    yield flush()
                    block += 1
                    docs, lengths, parts, size = [], [], [], 0
                docs.append(doc)
                lengths.append(n)
                parts.append(ids)
                size += n
        if docs:
            yield flush()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = END_ID, words_apart: bool = True,
                 block_tokens: int = BLOCK_TOKENS, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode ``docs`` in ascending doc_id order into a table of blocks at ``path``.

    ``tokenizer`` is a tokenizers file that every executor can read;
    ``words_apart`` says that it drops white space and never joins across it.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    encoded = rows.mapInArrow(tidy(_encode(tokenizer, end_id, words_apart)), "doc_id long, row long, ids binary")
    scratch = Scratch(docs.sparkSession)
    # Written, so that the ranges are drawn and the rows moved without encoding again; row keeps a repeated doc_id apart.
    encoded = scratch.keep(encoded, "encoded").withColumn("h", F.xxhash64("ids"))
    order = ["doc_id", "h", "row"]
    ordered = encoded.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    id_bytes = WordEncoder(tokenizer, end_id, words_apart).id_bytes
    ordered.mapInArrow(tidy(_pack(id_bytes, block_tokens)), _BLOCKS).write.option("compression", "zstd").parquet(path)
    scratch.drop("encoded")


_READ = "part int, block int, doc_id long, local long, n_tokens long, ids_crc32 long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            b = Block(batch.column(2)[i].as_buffer())
            part, block = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            for doc_ids, starts in b.documents():
                wide, base, n = b.tokens[starts[0] : starts[-1]].astype("<u4"), int(starts[0]), len(doc_ids)
                crc = [zlib.crc32(wide[s:e]) for s, e in zip((starts[:-1] - base).tolist(), (starts[1:] - base).tolist())]
                cols = [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, block, np.int32)), doc_ids, pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(crc, pa.int64())]
                yield pa.record_batch(cols, ["part", "block", "doc_id", "local", "n_tokens", "ids_crc32"])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for raw in batch.column(0):
            b = Block(raw.as_buffer())
            for doc_ids, starts in b.documents():
                ids = pa.array(b.tokens[starts[0] : starts[-1]].astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array((starts - starts[0]).astype(np.int32)), ids)
                yield pa.record_batch([doc_ids, lists], ["doc_id", "ids"])


def read_ids(spark, path: str) -> DataFrame:
    """(doc_id, ids) of every document stored at ``path``."""
    return spark.read.parquet(path).select("payload").mapInArrow(_documents, "doc_id long, ids array<int>")


def read_index(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the stored blocks.

    start is the number of ids before the document in the whole table.
    """
    blocks = spark.read.parquet(path)
    # Running sums in two levels: over partitions, then inside each.
    per_part = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("part").orderBy("block")
    offsets = blocks.select("part", "block", (F.sum("n_tokens").over(inside) - F.col("n_tokens")).alias("inside"))
    offsets = offsets.join(before, "part").select("part", "block", (F.col("before") + F.col("inside")).alias("offset"))
    rows = blocks.select("part", "block", "payload").mapInArrow(tidy(_read), _READ)
    return rows.join(offsets, ["part", "block"]).select("doc_id", (F.col("offset") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(spark, sf_dir: str) -> DataFrame:
    """``op2_token_store``: every document's place, length and checksum, read back from the written blocks."""
    path = Scratch(spark).path("tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, tokenizer_path())
    return read_index(spark, path)
