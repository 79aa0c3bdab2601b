"""Alignment of two tokenizers against a token-by-token version on the libraries themselves."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from dssforge.llm import alignment
from dssforge.llm.chunks import byte_of_letter
from dssforge.llm.token_store import tokenizer_path

from .helpers import no_docs, odd_docs

PATHS = tokenizer_path(alignment.TOKENIZER_A), tokenizer_path(alignment.TOKENIZER_B)


def plain_align(a, b):
    seat = {y: j for j, y in enumerate(b)}
    return [(i + 1, seat[x] + 1) for i, x in enumerate(a) if x in seat]


@pytest.mark.parametrize("seed", range(30))
def test_align_equals_a_plain_walk(seed):
    rng = random.Random(seed)
    n = rng.choice([0, 1, 5, 40, 700])
    p, q = rng.choice([(0.9, 0.9), (0.5, 0.9), (0.999, 0.999), (0.1, 0.3)])
    a = [x for x in range(1, n) if rng.random() < p] + [n] * (n > 0)
    b = [x for x in range(1, n) if rng.random() < q] + [n] * (n > 0)
    got = alignment.align(np.array(a, np.int64), np.array(b, np.int64))
    assert list(zip(*(x.tolist() for x in got))) == plain_align(a, b)


def test_lists_over_different_bytes_are_refused():
    for b in ([], [4]):
        with pytest.raises(ValueError):
            alignment.align(np.array([1, 3]), np.array(b, np.int64))


def plain(rows):
    """Expected digests of (doc_id, text) rows, straight from the libraries on whole texts."""
    library, pieces = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    library.encode_special_tokens = True
    code, words = byte_of_letter(), {i: t for t, i in library.get_vocab().items()}
    found, counts = [], Counter()
    for doc, text in rows:
        ids_a, ids_b, groups, links = [], [], [], []
        if text:
            want = (" " + text).encode()
            ids_a, ids_b = library.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
            bytes_a = [bytes(code[c] for c in words[i]) for i in ids_a]
            bytes_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
                ids_a, ids_b = [], []
            else:
                closed = plain_align(np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist())
                p = q = 0
                for x, y in closed:
                    groups.append(",".join(map(str, ids_a[p:x])) + "|" + ",".join(map(str, ids_b[q:y])))
                    links.append((ids_a[x - 1], ids_b[y - 1]))
                    p, q = x, y
        counts.update(links)
        found.append((doc, len(ids_a), len(ids_b), groups, links))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(doc, a, b, len(g), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for doc, a, b, g, links in found]


BITS = ["a", "th", "the", " ", "  ", "\n", "\n\n", "'", "'re", " the", "é", "中文", "!", "\x85", "　", "\x1c", "<|endoftext|>", "<s>", "9", "123", "…",
        "▁", "\r\n", "\t", "    ", "don't", "\x00", "\U0001f600", "ü", "\xa0", "Storage", " überall"]


def test_digests_equal_the_libraries(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(BITS) for _ in range(rng.randint(0, 14)))) for i in range(1500)]
    rows += [(9000, " "), (9001, "  "), (9002, "x "), (9003, " x"), (9004, "word" * 5000), (9005, " " * 4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got, pairs = alignment.align_documents(docs, *PATHS)
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows))
    assert pairs.groupBy("a", "b").count().where("count > 1").isEmpty()


def test_query_on_a_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, alignment.query(spark, "/root/testdata/sf0.001").collect())) == sorted(want)


def test_pairs_beyond_the_broadcast_bound(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted(map(tuple, alignment.query(spark, "/root/testdata/sf0.001").collect()))
    monkeypatch.setattr(alignment, "small", lambda df: df)
    assert sorted(map(tuple, alignment.align_documents(docs, *PATHS)[0].collect())) == want


def test_odd_rows(spark):
    docs = odd_docs(spark)
    want = sorted(plain([(r.doc_id, r.text) for r in docs.collect()]), key=str)
    clash = docs.withColumnRenamed("lang", "links").withColumnRenamed("source", "row")
    for d in (docs, clash):
        assert sorted(map(tuple, alignment.align_documents(d, *PATHS)[0].collect()), key=str) == want
    assert alignment.align_documents(no_docs(spark), *PATHS)[0].collect() == []
