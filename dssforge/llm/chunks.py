"""Texts cut into chunks that a tokenizer encodes one by one, each distinct chunk once.

A chunk is white space with the run of other characters after it.  Byte-level
and word-piece tokenizers never join a token across the place where white space
begins after a character that is none, so a text's ids are its chunks' ids one
after the other.  Cuts are made before ASCII white space only, and only
where the character before it is surely no white space of any script; elsewhere
a chunk is just longer.

``Encoder`` finds the distinct chunks of a slice of texts (Arrow's dictionary
encoding of the bytes in place), asks the library for those not met before, and
gathers all ids by index.  A task keeps recent chunks in a bounded memo, so its memory
follows the slice.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from dssforge.llm import bytetext as B
from dssforge.llm.memo import Memo

#: Bytes of text that are encoded together, chunks kept in each of two generations, and the longest of these.
SLICE, CACHED, LONGEST_CACHED = 1 << 22, 300_000, 64
#: Bytes of new chunks that go to the library as one string.
JOINED = 1 << 15

_SPACE = B.byte_class([0x20, *range(0x09, 0x0E)])
#: No cut inside a text.
NOWHERE = B.byte_class([])
#: ASCII characters that no pattern takes for white space.
_SURE = ~B.byte_class([0x20, *range(0x09, 0x0E), *range(0x1C, 0x20), *range(0x80, 0x100)])
_LETTER = B.byte_class([*range(0x41, 0x5B), *range(0x61, 0x7B)])
#: Second bytes of the letters from U+00C0 to U+00FF, whose first byte is C3.
_LATIN = B.byte_class([b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)])
_MARK = B.byte_class([b for b in range(0x21, 0x7F) if not (0x30 <= b < 0x3A or 0x41 <= b < 0x5B or 0x61 <= b < 0x7B)])


def bounds(data: np.ndarray, at: np.ndarray, cut_before: np.ndarray = _SPACE, whole: Sequence[bytes] = (), marks: bool = False, apart: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the chunks of texts ``data[at[i]:at[i+1]]`` (and the end), and each text's first chunk (and the end).

    ``marks``: also cut between a letter (ASCII or Latin-1) and an ASCII mark after it, where the pattern of a
    byte-level tokenizer always cuts.  ``apart``: white space is a chunk of its own (for tokenizers that drop it).  Texts that hold one of the strings ``whole`` are one chunk.
    """
    cut = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 1:
        space = cut_before[data[1:]]
        cut[1:-1] = space & _SURE[data[:-1]]
        unsure = np.flatnonzero(space & (data[:-1] >= 0x80)) + 1
        if len(unsure):
            one, two, three = data[unsure - 1], data[np.maximum(unsure - 2, 0)], data[np.maximum(unsure - 3, 0)]
            blank = ((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | ((three == 0xE1) & ((two == 0x9A) | (two == 0xA0)))
            blank |= ((three == 0xE2) & ((two == 0x80) | (two == 0x81))) | ((three == 0xE3) & (two == 0x80))
            cut[unsure[~blank]] = True
        if apart:
            cut[1:-1] |= cut_before[data[:-1]] & ~space
        if marks:
            after = np.flatnonzero(_MARK[data[1:]]) + 1
            one, two = data[after - 1], data[np.maximum(after - 2, 0)]
            cut[after[_LETTER[one] | ((two == 0xC3) & _LATIN[one])]] = True
    if whole:
        raw = data.tobytes()
        for string in whole:
            found = raw.find(string)
            while found >= 0:
                text = int(np.searchsorted(at, found, side="right")) - 1
                cut[at[text] : at[text + 1]] = False
                found = raw.find(string, max(int(at[text + 1]), found + 1))
    cut[at] = True
    offsets = np.flatnonzero(cut)
    return offsets, np.searchsorted(offsets, at)


@dataclass
class Distinct:
    """Chunks of a slice: the distinct ones, each chunk's index among them, and each text's first chunk (and the end)."""

    values: list[bytes]
    index: np.ndarray
    first: np.ndarray
    offsets: np.ndarray


def distinct(data: np.ndarray, at: np.ndarray, cut_before: np.ndarray = _SPACE, whole: Sequence[bytes] = (), marks: bool = False, apart: bool = False) -> Distinct:
    offsets, first = bounds(data, at, cut_before, whole, marks, apart)
    n = len(offsets) - 1
    if n <= 0:
        return Distinct([], np.zeros(0, np.int64), np.zeros(len(at), np.int64), np.zeros(1, np.int64))
    wide = int(offsets[-1]) >= 1 << 31
    chunks = pa.Array.from_buffers(pa.large_binary() if wide else pa.binary(), n, [None, pa.py_buffer(offsets.astype(np.int64 if wide else np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = chunks.dictionary_encode()
    return Distinct(coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), first, offsets)


def remembered(memo: Memo, values: list[bytes], fresh: Callable[[list[bytes]], list]) -> list:
    """A value for each chunk: from the memo, or from ``fresh``, which gets the chunks not met before."""
    parts = memo.all(values)
    missing = [i for i, part in enumerate(parts) if part is None]
    if missing:
        new = [values[i] for i in missing]
        found = fresh(new)
        for i, part in zip(missing, found):
            parts[i] = part
        memo.put_all({chunk: part for chunk, part in zip(new, found) if len(chunk) <= LONGEST_CACHED})
    return parts


def gather(parts: list[bytes], index: np.ndarray, kind) -> tuple[np.ndarray, np.ndarray]:
    """Items of the parts ``index`` one after the other, and where each begins (and the end)."""
    size = np.dtype(kind).itemsize
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // size
    starts = np.cumsum(lengths) - lengths
    n = lengths[index]
    ends = np.concatenate([[0], np.cumsum(n)])
    flat = np.frombuffer(b"".join(parts), kind)
    return flat[np.repeat(starts[index] - ends[:-1], n) + np.arange(ends[-1])], ends


def quiet_library() -> None:
    """A task has one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


class ByteLevel:
    """Ids of chunks by a byte-level BPE of the tokenizers library (no normaliser, so a token's bytes are the text's).

    ``plain_specials``: strings of special tokens are ordinary text.  Otherwise
    texts that hold one are encoded whole (``special`` lists them).
    """

    def __init__(self, path: str, plain_specials: bool = False):
        quiet_library()
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain_specials
        added = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.special = [] if plain_specials else [s.encode() for s in added]
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        code = byte_of_letter()
        self.token_bytes = [b""] * self.library.get_vocab_size()
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            # An added token may stand in the vocabulary under its own text.
            self.token_bytes[i] = bytes(code[c] for c in token) if token not in added and all(c in code for c in token) else token.encode()
        self.lengths = np.array([len(t) for t in self.token_bytes], np.int64)
        self.known = Memo(CACHED)

    def fresh(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each chunk, 2 bytes each.  Chunks that begin with white space and surely end without go as joined strings."""
        out: list[bytes] = [b""] * len(chunks)
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        blob = b"".join(chunks)
        data, ends = np.frombuffer(blob, np.uint8), np.cumsum(lengths)
        last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
        joins = _SPACE[data[ends - lengths]] & (_SURE[last] | ((before == 0xC3) & _LATIN[last]))
        if any(s in blob for s in self.special):
            joins &= ~np.array([any(s in c for s in self.special) for c in chunks])
        joined = np.flatnonzero(joins)
        size = np.cumsum(lengths[joined])
        groups = np.split(joined, np.flatnonzero(np.diff(size // JOINED)) + 1) if len(joined) else []
        groups += [np.array([i]) for i in np.flatnonzero(~joins)]
        texts = [b"".join([chunks[i] for i in g.tolist()]).decode() for g in groups]
        for g, found in zip(groups, self.library.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, np.uint16)
            if len(g) == 1:
                out[g[0]] = ids.tobytes()
                continue
            cuts = 2 * (np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(lengths[g])) + 1)
            raw, lo = ids.tobytes(), 0
            for i, hi in zip(g.tolist(), cuts.tolist()):
                out[i] = raw[lo:hi]
                lo = hi
        return out

    def texts(self, data: np.ndarray, at: np.ndarray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice (each with ``end_id``) and where each text's begin (and the end)."""
        return ids_of_texts(self.known, self.fresh, distinct(data, at, whole=self.special, marks=True), end_id)


def ids_of_texts(memo: Memo, fresh: Callable, d: Distinct, end_id: int | None, kind=np.uint16) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a slice, each followed by ``end_id``, and where each text's begin (and the end)."""
    parts, index, first = remembered(memo, d.values, fresh), d.index, d.first
    if end_id is not None:
        index = np.insert(index.astype(np.int64), first[1:], len(parts))
        first = first + np.arange(len(first))
        parts = [*parts, np.array([end_id], kind).tobytes()]
    ids, ends = gather(parts, index, kind)
    return ids, ends[first]


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: itself where printable, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + n): b for n, b in enumerate(others)}


def binary_rows(ids: np.ndarray, begins: np.ndarray) -> pa.Array:
    """Each text's ids as one binary value."""
    raw = np.ascontiguousarray(ids)
    return pa.Array.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer((begins * ids.itemsize).astype(np.int64)), pa.py_buffer(raw)])


def text_slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    return B.slices(column, size)
