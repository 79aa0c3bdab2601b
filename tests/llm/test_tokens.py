"""Token blocks, prefix counts: round trips and the tokenizers library itself."""

import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from dssforge.llm import chunks, token_counts, token_store
from dssforge.llm.store import Scratch
from dssforge.llm.token_store import Block, EliasFano, WordEncoder, ef_encode, tokenizer_path, write_block

from .helpers import no_docs, odd_docs

TEXTS = [
    "", "  ", "A̱ H̱x <|endoftext|> b", "İ ΑΣ Σ x y\x1cz\x85q <|ENDOFTEXT|>", "don't we'LL 123 4.5 ！？ 中文字 \U0001f600",
    "Ḧ Ḣ. é. É, ×. ÷, ñ!? x,y z.. a' b'. c's, — “d”. e…, f.—", "H̱. a,̱ b.", "end. ", "x" * 300, "a\n\n\nb  c \n",
]


def test_elias_fano_round_trip():
    rng = np.random.default_rng(1)
    for n, top in [(0, 1), (1, 1), (5, 1), (300, 4), (300, 10**6), (65, 2**40), (64, 2**33)]:
        values = np.sort(rng.integers(0, top, n))
        read = EliasFano(memoryview(ef_encode(values)))
        assert (read.values() == values).all() and [read.select(i) for i in range(n)] == list(values)
        with pytest.raises(IndexError):
            read.select(n)


def test_boundaries_take_little_space():
    starts = np.cumsum(np.random.default_rng(2).integers(1, 1000, 100_000))
    assert len(ef_encode(starts)) < 0.25 * 8 * len(starts)


def test_block_round_trip():
    ids = [[1, 2, 3], [], [40000] * 5, [7]]
    raw = write_block([None, -5, -5, 9], [len(x) for x in ids], np.concatenate([np.array(x, "<u2") for x in ids]).tobytes(), 2)
    block = Block(raw)
    assert block.doc_ids() == [None, -5, -5, 9] and [block.ids(i).tolist() for i in range(4)] == ids
    with pytest.raises(ValueError):
        Block(b"x" * 64)


def test_words_encode_as_whole_texts():
    encode = WordEncoder(tokenizer_path(), None)
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice(["Aé", "́", "H", ".", ",", " ", "the", "İ", "'s", "3", "\n", "ß"]) for _ in range(12)) for _ in range(600)]
    got = [np.frombuffer(encode(t.encode()), "<u2").tolist() for t in texts]
    assert got == [e.ids for e in encode.library.encode_batch(texts, add_special_tokens=False)]


def test_memo_keeps_recent_keys(monkeypatch):
    monkeypatch.setattr(token_store, "CACHED_WORDS", 3)
    encode = WordEncoder(tokenizer_path(), 1)
    text = " ".join(f"w{i % 7}" for i in range(40))
    assert encode(text.encode()) == encode(text.encode())
    for lo in range(0, 60, 2):
        chunks.remembered(encode.known, [f"w{lo}".encode(), f"w{lo + 1}".encode()], encode.fresh)
        assert len(encode.known.new) + len(encode.known.old) <= 2 * 3 + 2 * 2


def test_slices_encode_as_whole_texts():
    encode, whole = WordEncoder(tokenizer_path(), 1), WordEncoder(tokenizer_path(), 1, words_apart=False)
    rng = random.Random(8)
    bits = ["Aé", "́", "H", ".", ",", " ", "the", " Word", "İ", "'s", "3", "\n", "ß", "<|endoftext|>", " <|EndOfText|>x", "ª", "²", "ﬁ", "ǆ", "…", "\xa0"]
    texts = TEXTS + [None] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    want = [e.ids + [1] for e in encode.library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for e in (encode, whole):
        for size in (1 << 20, 300):
            got = []
            for _, _, data, at in chunks.text_slices(pa.array(texts), size):
                ids, begins = e.texts(data, at)
                got += [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])]
            assert got == want


def test_runs_read_in_fixed_memory():
    rng = np.random.default_rng(5)
    for n, top in [(0, 1), (1, 9), (1000, 3), (5000, 10**9), (777, 2**40)]:
        values = np.sort(rng.integers(0, top, n))
        read = EliasFano(memoryview(ef_encode(values)))
        for rows in (1, 7, 64, 4096):
            runs = list(read.runs(rows))
            assert all(len(r) <= rows for r in runs) and [int(x) for r in runs for x in r] == values.tolist()


def test_documents_of_a_block_in_steps():
    lengths = [3, 0, 5, 1, 2, 4]
    raw = write_block([None, None, None, 4, 4, 9], lengths, np.arange(15, dtype="<u2").tobytes(), 2)
    for rows in (1, 2, 4, 100):
        docs, bounds = [], []
        for names, starts in Block(raw).documents(rows):
            docs += names.to_pylist()
            bounds += list(zip(starts[:-1].tolist(), starts[1:].tolist()))
        ends = np.cumsum(lengths).tolist()
        assert docs == [None, None, None, 4, 4, 9] and bounds == list(zip([0, *ends], ends))


def stored(spark, docs, **options):
    path = Scratch(spark).path("tokens")
    token_store.write_tokens(docs, path, tokenizer_path(), **options)
    index = [tuple(r) for r in token_store.read_index(spark, path).orderBy("start").collect()]
    return index, {r.doc_id: r.ids for r in token_store.read_ids(spark, path).collect()}


def test_store_reads_back_every_document(spark):
    docs = spark.createDataFrame([(900 - i, t) for i, t in enumerate(TEXTS * 9)], "doc_id long, text string")
    index, ids = stored(spark, docs, block_tokens=200)
    library = Tokenizer.from_file(tokenizer_path())
    start = 0
    for doc_id, text in sorted((900 - i, t) for i, t in enumerate(TEXTS * 9)):
        want = library.encode(text, add_special_tokens=False).ids + [1]
        assert index.pop(0) == (doc_id, start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        assert ids[doc_id] == want
        start += len(want)


def test_store_of_odd_rows(spark):
    index, _ = stored(spark, odd_docs(spark))
    assert [r[0] for r in index] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 9] and [r[2] for r in index[1:4]] == [1, 1, 1]
    assert [r[1] for r in index] == list(np.cumsum([0] + [r[2] for r in index[:-1]]))
    assert stored(spark, no_docs(spark)) == ([], {})


def test_every_prefix_counts_as_the_library():
    path = tokenizer_path(token_counts.TOKENIZER)
    library, count = Tokenizer.from_file(path), token_counts.PrefixCounts(path)
    rng = random.Random(6)
    bits = ["a", "th", "the", " ", "  ", "\n", "\n\n", "'", "'re", "'ll", "re", "ing", " the", "é", "中文", "!", "\x85", "　", "\x1c",
            "<|endoftext|>", "<|", "9", "123", "…", "İ", "\r\n", "\t", "    ", "don't"]
    for _ in range(250):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        counts, at = token_counts.prefix_counts(count(text)), 0
        assert len(counts) == len(text.encode())
        for i, char in enumerate(text, 1):
            at += len(char.encode())
            assert counts[at - 1] == len(library.encode(text[:i], add_special_tokens=False).ids), repr(text[:i])


def test_budget_is_the_longest_prefix():
    path = tokenizer_path(token_counts.TOKENIZER)
    library, count = Tokenizer.from_file(path), token_counts.PrefixCounts(path)
    text = "Stores stored in the store's tall storage, é中文 restored."
    for budget in range(0, 12):
        fits = token_counts.longest_within(count(text), text.encode(), budget)
        want = max(i for i in range(len(text) + 1) if len(library.encode(text[:i], add_special_tokens=False).ids) <= budget)
        assert fits == len(text[:want].encode())


def test_counts_of_odd_rows(spark):
    path = tokenizer_path(token_counts.TOKENIZER)
    library = Tokenizer.from_file(path)
    docs = odd_docs(spark)
    got = [(r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, path, keep_changes=True).collect()]
    want = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "").ids)) for r in docs.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(no_docs(spark), path).collect() == []


def test_slices_count_as_whole_texts():
    path = tokenizer_path(token_counts.TOKENIZER)
    library = Tokenizer.from_file(path)
    rng = random.Random(11)
    bits = ["a", "th", "the", " ", "  ", "\n", "'", "'re", "re", " the", "é", "É.", "中文", "!", "\x85", "\u3000", "\x1c", "<|endoftext|>", "9", "…", "\t", "don't", "x,y", "\xa0", "aaaa", "----"]
    texts = [None, ""] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(2500)]
    want = [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for budget in (3, 9):
        batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
        got = pa.Table.from_batches(token_counts._count(path, budget, True)(iter([batch]))).to_pylist()
        assert [r["n_tokens"] for r in got] == want
        for r, t in zip(got[:600], texts):
            raw = (t or "").encode()
            assert len(r["changes"]) == len(raw) == r["n_bytes"] and r["fits_bytes"] == token_counts.longest_within(r["changes"], raw, budget)


def test_long_runs_are_quick():
    count = token_counts.PrefixCounts(tokenizer_path(token_counts.TOKENIZER))
    library = Tokenizer.from_file(tokenizer_path(token_counts.TOKENIZER))
    for text in (" " * 10**6, "a" * 10**6, "word " * 200_000, "\n" * 10**6 + "x"):
        begun = time.process_time()
        total = int(token_counts.prefix_counts(count(text))[-1])
        assert time.process_time() - begun < 10 and total == len(library.encode(text, add_special_tokens=False).ids)
