"""Words and shingles of whole Arrow text batches as numpy arrays, with no Python loop over words.

Texts are handled as UTF-8 bytes. Every non-ASCII byte belongs to a word, so the byte classes below are exactly
the code point classes ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` (lower-cased words) and ``[^\\x20\\x09-\\x0D]``
(blank-separated tokens). Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
WORD = np.zeros(256, bool)
WORD[ord("0"):ord("9") + 1] = WORD[ord("a"):ord("z") + 1] = WORD[128:] = True
TOKEN = np.ones(256, bool)
TOKEN[[0x20, *range(0x09, 0x0E)]] = False

_powers: dict[int, np.ndarray] = {}


def _power_table(base: np.uint64, size: int) -> np.ndarray:
    """base ** 0, 1, 2, ... modulo 2 ** 64."""
    table = _powers.get(int(base))
    if table is None or len(table) < size:
        table = np.full(max(size, SLICE_BYTES + 1), base, np.uint64)
        table[0] = 1
        table = _powers[int(base)] = np.multiply.accumulate(table)
    return table


def mix(value: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


@dataclass
class Words:
    """Words of consecutive documents: document number, byte span in the slice, hash."""
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    prefix: dict[int, np.ndarray]


@dataclass
class Slice:
    """Rows ``first`` to ``last`` of a batch: their bytes and the offset of each document in them."""
    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n_docs(self) -> int:
        return self.last - self.first

    def text(self, doc: int) -> bytes:
        return self.data[self.offsets[doc]:self.offsets[doc + 1]].tobytes()


def slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cuts a column of texts between documents into slices of some ``max_bytes``; null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1)
        yield Slice(first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def _pieces(inside: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts bytes between words, so that one very long document is not hashed in one go."""
    begin, size = 0, len(inside)
    while begin < size:
        end = min(size, begin + SLICE_BYTES)
        if end < size and inside[end - 1]:
            gaps = np.flatnonzero(~inside[begin:end])
            if len(gaps):
                end = begin + int(gaps[-1]) + 1
            else:
                after = np.flatnonzero(~inside[end:])
                end = end + int(after[0]) if len(after) else size
        yield begin, end
        begin = end


def words(part: Slice, member: np.ndarray = WORD, lower: bool = True, prefixes: tuple[int, ...] = ()) -> Words:
    """All words of a slice. ``prefixes`` also hashes the first bytes of longer words, 0 for shorter ones."""
    data = LOWER[part.data] if lower else part.data
    inside = member[data]
    size = len(data)
    before, after = np.zeros(size, bool), np.zeros(size, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = part.offsets[(part.offsets > 0) & (part.offsets < size)]
    before[cuts], after[cuts - 1] = False, False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    hashed = np.empty(len(start), np.uint64)
    heads = {length: np.zeros(len(start), np.uint64) for length in prefixes}
    for begin, stop in _pieces(inside):
        one, two = np.searchsorted(start, (begin, stop))
        if one == two:
            continue
        powers, inverse = _power_table(BASE, stop - begin + 1), _power_table(BASE_INVERSE, stop - begin + 1)
        total = np.zeros(stop - begin + 1, np.uint64)
        np.cumsum((data[begin:stop].astype(np.uint64) + np.uint64(1)) * powers[:stop - begin], out=total[1:])
        s, e = start[one:two] - begin, end[one:two] - begin
        hashed[one:two] = mix((total[e] - total[s]) * inverse[s])
        for length, head in heads.items():
            longer = e - s > length
            at = s[longer]
            head[one:two][longer] = mix((total[at + length] - total[at]) * inverse[at] + np.uint64(length))
    doc = np.searchsorted(part.offsets, start, "right") - 1
    return Words(doc, start, end, hashed, heads)


def shingles(found: Words, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` words in a row and where each document's begin; a shorter document is one shingle."""
    count = np.bincount(found.doc, minlength=n_docs)
    begins = np.concatenate([[0], np.cumsum(count)])
    runs = np.maximum(count - size + 1, np.minimum(count, 1))
    out_begins = np.concatenate([[0], np.cumsum(runs)])
    doc = np.repeat(np.arange(n_docs), runs)
    first = begins[doc] + np.arange(out_begins[-1]) - out_begins[doc]
    padded = np.concatenate([found.hash, np.zeros(size, np.uint64)])
    left = begins[doc + 1] - first
    total = np.zeros(len(first), np.uint64)
    for step in range(size):
        total = total * BASE + np.where(step < left, padded[first + step], np.uint64(0))
    return mix(total + np.minimum(left, size).astype(np.uint64)), out_begins
