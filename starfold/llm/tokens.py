"""Whole texts to word and shingle hashes, a batch of texts at a time.

Words are the maximal runs without the ASCII blanks space, tab, line feed,
vertical tab, form feed and carriage return. Hashes are computed for all
words of a batch together: with ``T`` a fixed random number for each byte and
``B`` odd, ``sum(T[b_i] * B**i)`` over a word, divided by ``B**start``, does
not depend on where the word stands, and prefix sums give it for every word
at once. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled in slices of about this many bytes (a longer text is a slice of its own).
SLICE_BYTES = 1 << 21
#: Spans are hashed in parts of the buffer of about this many bytes or code points.
HASH_PART = 1 << 18

_BASE = 0x9E3779B97F4A7C15  # odd
_BASE_INV = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)
_STEP = np.random.default_rng(20240301).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        out = np.full(max(n, HASH_PART + 4096), base, dtype=np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        if n > 4 * HASH_PART:  # a very long word: do not keep its table
            return out
        have = _powers[name] = out
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: list[bytes], size_limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``size_limit`` bytes."""
    yield from _ranges([len(t) for t in texts], size_limit)


def _ranges(sizes: list[int], size_limit: int) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > size_limit:
            yield begin, i
            begin, size = i, 0
        size += n + 1
    if begin < len(sizes):
        yield begin, len(sizes)


def parts(column: pa.Array, size_limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """The ranges of :func:`slices` of an Arrow column of texts, each with its texts as :func:`utf8` gives them.

    Only one range's texts are held beside the column.
    """
    for a, b in _ranges(pc.fill_null(pc.binary_length(column), 0).to_pylist(), size_limit):
        yield a, b, utf8(column.slice(a, b - a))


class Words:
    """The words of a list of UTF-8 texts.

    ``buf`` holds the texts, each followed by a line feed; ``start`` and
    ``end`` are the byte offsets of each word, ``first`` the number of the
    first word of each text (one more entry than texts). ``blank`` says for
    each byte whether it separates words.
    """

    def __init__(self, texts: list[bytes], lower: bool = True, blank: np.ndarray = BLANK):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        self.buf = LOWER[raw] if lower else raw
        size = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        edge = np.flatnonzero(np.diff(blank[raw], prepend=True, append=True))
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, np.concatenate([[0], np.cumsum(size)]))
        self._hashes: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash for each word."""
        if self._hashes is None:
            self._hashes = span_hashes(self.buf, self.start, self.end)
        return self._hashes


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray = _TABLE) -> np.ndarray:
    """A 64-bit hash of each span of ``buf`` (ascending, not overlapping); equal spans get equal hashes.

    ``buf`` holds bytes, or code points as larger numbers.
    """
    out = np.empty(len(start), dtype=np.uint64)
    step = min(HASH_PART, SLICE_BYTES)
    cuts = np.unique(np.searchsorted(start, np.arange(0, len(buf) + step, step))).tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # spans in order, a part of the buffer at a time
        low, high = int(start[a]), int(end[a:b].max())
        part = buf[low:high]
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        symbol = table[part] if part.dtype == np.uint8 else mix(part.astype(np.uint64) + np.uint64(1))
        np.cumsum(symbol * _power("up", _BASE, len(part))[: len(part)], out=total[1:])
        s = start[a:b] - low
        out[a:b] = mix((total[end[a:b] - low] - total[s]) * _power("down", _BASE_INV, len(part))[s])
    return out


def shingles(word_hashes: np.ndarray, first: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each text, the sorted distinct hashes of its runs of ``k`` words.

    A text of fewer words has its whole sequence as one shingle; a text
    without words has none.
    """
    n = len(word_hashes)
    if n >= k:
        full = np.zeros(n - k + 1, dtype=np.uint64)
        for j in range(k):
            full += word_hashes[j : n - k + 1 + j] * _STEP[j]
        full = mix(full)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(full[a : b - k + 1])
        elif b > a:
            one = np.uint64(b - a)
            yield mix(np.array([(word_hashes[a:b] * _STEP[: b - a]).sum(dtype=np.uint64) ^ one], dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)


def utf8(column) -> list[bytes]:
    """An Arrow or pandas column of texts as UTF-8; null is empty."""
    values = column.to_pylist() if hasattr(column, "to_pylist") else column.tolist()
    return [v.encode("utf-8", "surrogatepass") if isinstance(v, str) else b"" for v in values]
