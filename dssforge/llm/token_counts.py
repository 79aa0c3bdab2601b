"""Token counts at every prefix of a text, by dynamic programming over its bytes.

For a byte-level BPE each prefix of a piece has one last token: the longest
vocabulary entry that ends there and may follow the last token of what stands
before it.  An automaton over the vocabulary names the entries that end at a byte,
longest first.  Two tokens may stand side by side when no merge joins the end of the
first to the beginning of the second while both are still being built, which the
merge table tells.  So one pass gives the token count of *every* prefix.
Pieces follow each other independently, hence a text's counts are its pieces'
counts added up.  They are kept as one signed byte per byte of text: the change
of the count from one prefix to the next (its running sum at byte i is the
exact number of tokens of the first i bytes).  Truncation and budget questions
are then answered by a running sum, with no further encoding.

Texts are cut into chunks at white space (``chunks``); each distinct chunk of a
slice is looked up once, a task keeps the changes of recent ones, and a text's
table is those byte strings joined.

Defined results: null or empty text has 0 bytes and 0 tokens; every input row
gets one row.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dssforge.llm import chunks as C
from dssforge.llm.memo import Memo

TOKENIZER, LIMIT = "byte_bpe_50k.json", 512
#: Chunks and token pairs that a task keeps in each of two generations.
CACHED, CACHED_PAIRS = 300_000, 400_000

# White space as the tokenizer's own pattern has it.
_WS = "\t-\r \x85\xa0  -     　"
#: A word with the blank before it; a run of white space but for its last character, if a word follows; white space.
_CHUNK = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]")
_RUN = re.compile(f"(?<![{_WS}])[{_WS}]{{2,}}+(?=[^{_WS}])")
#: Pieces whose first two characters are two pieces when they stand alone.
_SPLIT_CONTRACTIONS = {"'re", "'ve", "'ll"}
#: The first letter that is not looked at without the tokenizer's own pattern.
_BEYOND = "\u0250"


class Merges:
    """Which tokens may stand side by side, from the merge table of a byte-level BPE."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        self.joins: dict[int, dict[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (x, y) in enumerate(merges):
            left, right = vocabulary[x], vocabulary[y]
            self.joins.setdefault(left, {})[right] = rank
            self.parts.setdefault(vocabulary[x + y], (left, right, rank))
        self.edges: tuple[dict, dict] = ({}, {})

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at one side of a token while it is built, each with the rank of the merge that takes it up, the whole first."""
        found = self.edges[side].get(token)
        if found is None:
            found, now, taken = [], token, 1 << 60
            while True:
                found.append((now, taken))
                if now not in self.parts:
                    break
                taken, now = self.parts[now][2], self.parts[now][side]
            self.edges[side][token] = found
        return found

    def apart(self, first: int, second: int) -> bool:
        """Whether merging the joined bytes leaves these two tokens.

        A merge crosses the border when its left token is still there (its rank is below that of the merge
        which takes the left token up) and its right token too (the same rank is enough: of equal merges the
        leftmost goes first, and that is the crossing one).
        """
        starts = self.edge(second, 0)
        for x, x_taken in self.edge(first, 1):
            joins = self.joins.get(x)
            if joins:
                for y, y_taken in starts:
                    rank = joins.get(y)
                    if rank is not None and rank < x_taken and rank <= y_taken:
                        return False
        return True


class PrefixCounts:
    """Count changes for whole texts with one byte-level BPE tokenizer of the two-step kind (pattern, then merges)."""

    def __init__(self, path: str):
        C.quiet_library()
        import ahocorasick
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.pieces_of, self.merge = library.pre_tokenizer.pre_tokenize_str, library.model.tokenize
        added = library.get_added_tokens_decoder()
        self.specials = [t.content.encode() for t in added.values() if t.content]
        self.special = re.compile("|".join(re.escape(t.content) for t in added.values() if t.content) or r"(?!)")
        vocabulary = library.get_vocab(with_added_tokens=False)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in json.loads(library.to_str())["model"]["merges"]]
        self.merges = Merges(vocabulary, merges)
        self.automaton = ahocorasick.Automaton()
        letters = C.byte_of_letter()
        for token, i in vocabulary.items():
            # A token that its own merges do not give stands nowhere.
            if all(c in letters for c in token) and len(self.merge(token)) == 1:
                self.automaton.add_word(token, (i, len(token)))
        self.automaton.make_automaton()
        self.letter = {b: c for c, b in letters.items()}
        self.pairs, self.known = Memo(CACHED_PAIRS), Memo(CACHED)

    def _apart(self, first: int, second: int) -> bool:
        key = first << 32 | second
        found = self.pairs.new.get(key)
        if found is None:
            found = self.pairs.old.get(key)
            if found is None:
                found = self.merges.apart(first, second)
            self.pairs.put(key, found)
        return found

    def piece(self, piece: str) -> list[int]:
        """Token count of each nonempty prefix of a piece (one character per byte)."""
        n, apart = len(piece), self._apart
        counts, last = [0] * (n + 1), [0] * (n + 1)
        for end, (token, length) in self.automaton.iter(piece):
            end += 1
            if not counts[end]:
                start = end - length
                if not start or apart(last[start], token):
                    counts[end] = counts[start] + 1
                    last[end] = token
        if piece in _SPLIT_CONTRACTIONS:
            counts[2] = 2
        return counts[1:]

    def _pieces(self, chunk: str) -> list[str]:
        body = chunk[1:] if chunk[:1] == " " else chunk
        if body.isalpha() and max(body) < _BEYOND:  # a word of letters is one piece
            return [chunk.encode().decode("latin-1").translate(self.letter)]
        return [piece for piece, _ in self.pieces_of(chunk)]

    def _word(self, chunk: str) -> bytes:
        changes: list[int] = []
        for piece in self._pieces(chunk):
            before = 0
            for count in self.piece(piece):
                changes.append(count - before & 0xFF)
                before = count
        return bytes(changes)

    def _plain(self, text: str) -> bytes:
        """Changes of a text without special tokens."""
        joined = b"".join([self._word(chunk) for chunk in _CHUNK.findall(text)])
        return self._runs(text, joined) if _RUN.search(text) else joined

    def _runs(self, text: str, joined: bytes) -> bytes:
        """A prefix that ends with a run of white space has the run as one piece; the next byte takes back the difference."""
        changes, at, last = np.frombuffer(joined, np.int8).copy(), 0, 0
        for run in _RUN.finditer(text):
            at += len(text[last : run.end() - 1].encode())
            last = run.end() - 1
            whole = self._word(run.group())
            width = len(text[last].encode())
            own = np.frombuffer(whole, np.int8)[-width:]
            difference = int(own.sum()) - int(changes[at : at + width].sum())
            changes[at : at + width] = own
            changes[at + width] -= difference
        return changes.tobytes()

    def __call__(self, text: str) -> bytes:
        """One signed byte per byte of ``text``: how its prefixes' token counts change."""
        out, last = [], 0
        for found in self.special.finditer(text):
            if found.end() == found.start():
                continue
            start = found.start()
            partly = np.frombuffer(self._plain(text[last : found.end() - 1]), np.int8)
            before = int(np.frombuffer(self._plain(text[last:start]), np.int8).sum(dtype=np.int64))
            final = before + 1 - int(partly.sum(dtype=np.int64))
            out += [partly.tobytes(), np.array([final], np.int8).tobytes()]
            last = found.end()
        out.append(self._plain(text[last:]))
        return b"".join(out)


def prefix_counts(changes: bytes) -> np.ndarray:
    """Token count of each nonempty prefix, by bytes."""
    return np.cumsum(np.frombuffer(changes, np.int8), dtype=np.int64)


def longest_within(changes: bytes, raw: bytes, budget: int) -> int:
    """Bytes of the longest prefix of whole characters with at most ``budget`` tokens."""
    counts = prefix_counts(changes)
    data = np.frombuffer(raw, np.uint8)
    whole = np.append((data[1:] & 0xC0) != 0x80, True) if len(data) else np.zeros(0, bool)
    fits = np.flatnonzero(whole & (counts <= budget))
    return int(fits[-1]) + 1 if len(fits) else 0


_COUNTED = "n_bytes long, n_tokens long, fits_bytes long"


@lru_cache(1)
def _counter(path: str) -> PrefixCounts:
    """One counter for each worker process, so later tasks find its words."""
    return PrefixCounts(path)


def _count(path: str, budget: int, keep_changes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in batches:
            for lo, hi, data, at in C.text_slices(batch.column(1)):
                d = C.distinct(data, at, whole=count.specials, marks=True)
                parts = C.remembered(count.known, d.values, lambda new: [count(c.decode()) for c in new])
                sums = np.add.reduceat(np.frombuffer(b"".join(parts) or b"\0", np.int8), np.cumsum([0, *map(len, parts[:-1])]), dtype=np.int64) if parts else np.zeros(0, np.int64)
                total = np.concatenate([[0], np.cumsum(sums[d.index])])
                n_tokens, fits = total[d.first[1:]] - total[d.first[:-1]], np.diff(at)
                for i in np.flatnonzero(n_tokens > budget).tolist():
                    # The last chunk that begins within the budget: its beginning fits, and perhaps some of it.
                    first, stop = d.first[i], d.first[i + 1]
                    k = first + int(np.searchsorted(total[first:stop] - total[first], budget, side="right")) - 1
                    begin, part = int(d.offsets[k]), parts[d.index[k]]
                    left = budget - int(total[k] - total[first])
                    fits[i] = begin - at[i] + longest_within(part, data[begin : begin + len(part)].tobytes(), left)
                cols = [batch.column(0).slice(lo, hi - lo), *(pa.array(x, pa.int64()) for x in (np.diff(at), n_tokens, fits))]
                names = ["doc_id", "n_bytes", "n_tokens", "fits_bytes"]
                if keep_changes:
                    where = d.index.tolist()
                    kept = [b"".join([parts[x] for x in where[a:b]]) for a, b in zip(d.first[:-1], d.first[1:])]
                    cols, names = [*cols, pa.array(kept, pa.binary())], [*names, "changes"]
                yield pa.record_batch(cols, names)

    return run


def count_tokens(docs: DataFrame, tokenizer: str, budget: int = LIMIT, keep_changes: bool = False, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, fits_bytes[, changes]) of each row of ``docs``.

    ``changes`` is the prefix table (see ``prefix_counts``, ``longest_within``);
    fits_bytes is the longest prefix of whole characters within ``budget`` tokens.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, {_COUNTED}" + (", changes binary" if keep_changes else "")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_count(tokenizer, budget, keep_changes), schema)


def query(spark, sf_dir: str) -> DataFrame:
    """``op3_token_counts``: exact token counts of every document and its prefix within 512 tokens."""
    from dssforge.llm.token_store import tokenizer_path

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = count_tokens(docs, tokenizer_path(TOKENIZER), LIMIT)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fits_bytes")
