"""Packing: plans on random histograms, and pieces that make up every document."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from dssforge.llm import packing
from dssforge.llm.token_store import tokenizer_path

from .helpers import no_docs, odd_docs


@pytest.mark.parametrize("seed", range(40))
def test_plan_places_every_token_once(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randint(1, 1023), rng.randint(1, 40), 600]) for _ in range(rng.choice([1, 3, 50, 3000]))]
    histogram = defaultdict(int)
    for n in lengths:
        histogram[n] += 1
    found = packing.plan(histogram)
    covered, sequences = defaultdict(list), defaultdict(list)
    for whole, first, n, start, length, sequence, offset in found.pieces:
        for i in range(n):
            covered[whole, first + i].append((start, length))
            sequences[sequence + i].append((offset, length))
    assert set(covered) == {(n, k) for n, count in histogram.items() for k in range(count)}
    for (whole, _), pieces in covered.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at and length > 0
            at += length
        assert at == whole
    assert sorted(sequences) == list(range(found.sequences))
    filled = []
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        filled.append(at)
    assert sum(x not in packing.TIERS for x in filled) <= 1 and all(x <= packing.TIERS[0] for x in filled)
    table = packing.lookup(found)
    for (whole, k), pieces in covered.items():
        at = int(np.searchsorted(table.codes, whole << 44 | k, side="right")) - 1
        assert [tuple(r[:2]) for r in table.rows[table.begins[at] : table.begins[at + 1]].tolist()] == sorted(pieces)


def test_plan_size_does_not_follow_the_documents():
    rng = random.Random(1)
    histogram = {n: rng.randint(1, 50) for n in range(1, 1024)}
    small = len(packing.plan(histogram).pieces)
    assert small < 100_000 and len(packing.plan({n: c * 10**9 for n, c in histogram.items()}).pieces) < 2 * small


def checked(spark, docs, **options):
    """Pieces of every row against the library, by sequence; returns tokens of each sequence."""
    rows = packing.pack(docs, tokenizer_path(packing.TOKENIZER), **options).collect()
    library = Tokenizer.from_file(tokenizer_path(packing.TOKENIZER))
    want = defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append(library.encode(r.text or "", add_special_tokens=False).ids + [0])
    got, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length, r.context, r.step_group))
    assert set(got) == set(want)
    for doc, texts in want.items():
        if len(texts) > 1:
            assert sum(p[1] for p in got[doc]) == sum(map(len, texts))
            continue
        at = 0
        for start, length, crc, total in sorted(got[doc]):
            piece = texts[0][start : start + length]
            assert (start, total, crc) == (at, len(texts[0]), zlib.crc32(np.array(piece, "<u4").tobytes())) and length
            at += length
        assert at == len(texts[0])
    tokens = {}
    for q, pieces in sequences.items():
        at = 0
        for offset, length, *_ in sorted(pieces):
            assert offset == at
            at += length
        assert len({p[2:] for p in pieces}) == 1 and at <= pieces[0][2]
        tokens[q] = (at, *pieces[0][2:])
    assert sorted(tokens) == list(range(len(tokens)))
    return tokens


def test_documents_are_packed_whole(spark):
    tokens = checked(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(7), step_tokens=1 << 14)
    assert sum(n != context for n, context, _ in tokens.values()) <= 1
    per_group = defaultdict(lambda: defaultdict(int))
    for n, context, group in tokens.values():
        per_group[group][context] += 1
    for tier in packing.TIERS:
        counts = [g[tier] for g in per_group.values()]
        assert max(counts) - min(counts) <= 2


def test_odd_rows(spark):
    checked(spark, odd_docs(spark))
    checked(spark, odd_docs(spark).withColumnRenamed("lang", "ids").withColumnRenamed("source", "k"), tiers=(64, 16))
    assert packing.pack(no_docs(spark), tokenizer_path(packing.TOKENIZER)).collect() == []
    with pytest.raises(ValueError):
        packing.pack(no_docs(spark), tokenizer_path(packing.TOKENIZER), tiers=(128, 1024))
