"""Hashed words and word shingles of Arrow text columns, in numpy.

A batch's UTF-8 bytes are hashed without making Python strings: words are runs of word
bytes, a word's hash is a polynomial in its bytes (from prefix sums modulo 2**64, then
mixed), a shingle's hash a mixed sum of its words' hashes. Memory is bounded by
``slices`` and ``CHUNK``, also for very long texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes hashed at a time, and bytes of text in a slice of a batch.
CHUNK = 1 << 19
SLICE = 1 << 22


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def mix1(x: np.ndarray, factor: np.uint64, offset: np.uint64) -> np.ndarray:
    """A hash function of already mixed values, chosen by ``factor`` (odd) and ``offset``."""
    y = x * factor + offset
    return (y ^ (y >> U(29))) * factor


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U) + U(seed * 1_000_003)) * U(0x9E3779B97F4A7C15))


_ODD = U(0x5851F42D4C957F2D)
_FACTORS = stream(77, 64) | U(1)


class Alphabet:
    """Which bytes belong to words, and what each counts for."""

    def __init__(self, word: np.ndarray):
        self.word = word
        values = stream(5, 256)
        values[65:91] = values[97:123]  # A-Z count as a-z
        self.values = values


def _whitespace() -> Alphabet:
    word = np.ones(256, bool)
    word[[0x20, *range(0x09, 0x0E)]] = False
    return Alphabet(word)


def _alphanumeric() -> Alphabet:
    word = np.zeros(256, bool)
    word[48:58] = word[65:91] = word[97:123] = word[128:] = True
    return Alphabet(word)


#: Words between ASCII white space; and runs of ASCII letters, digits and all non-ASCII characters.
WHITESPACE, ALPHANUMERIC = _whitespace(), _alphanumeric()


class _Powers:
    def __init__(self):
        self.up = self.down = np.ones(1, U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK + 1)
            up, down = np.full(size, _ODD, U), np.full(size, U(pow(int(_ODD), -1, 1 << 64)), U)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up, self.down


_powers = _Powers()


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have at most ``most`` bytes (or one row)."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)).astype(np.int64)
    ends, start, held = len(sizes), 0, 0
    for i in range(ends):
        if held and held + sizes[i] > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(sizes[i])
    if start < ends:
        yield batch.slice(start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each row's offsets into them; null is empty."""
    column = pa.compute.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _cut(raw: np.ndarray, word: np.ndarray, at: int) -> int:
    """Where to end a chunk that begins at ``at``: after a byte that is in no word."""
    end = min(at + CHUNK, len(raw))
    if end == len(raw):
        return end
    back = np.flatnonzero(~word[raw[at:end]])
    if len(back):
        return at + int(back[-1]) + 1
    while end < len(raw):  # one word longer than a chunk
        ahead = np.flatnonzero(~word[raw[end : end + CHUNK]])
        if len(ahead):
            return end + int(ahead[0])
        end = min(end + CHUNK, len(raw))
    return end


def words(raw: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and each row's offsets into them."""
    hashes, starts_at = [], []
    inner = offsets[1:-1]
    at = 0
    with np.errstate(over="ignore"):
        while at < len(raw):
            end = _cut(raw, alphabet.word, at)
            part = raw[at:end]
            is_word = alphabet.word[part]
            first = is_word.copy()
            first[1:] &= ~is_word[:-1]
            last = is_word.copy()
            last[:-1] &= ~is_word[1:]
            breaks = inner[(inner > at) & (inner < end)] - at
            first[breaks] = is_word[breaks]
            last[breaks - 1] = is_word[breaks - 1]
            starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
            up, down = _powers.get(len(part) + 1)
            sums = np.zeros(len(part) + 1, U)
            np.cumsum(alphabet.values[part] * up[: len(part)], out=sums[1:])
            hashes.append(mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(U)))
            starts_at.append(starts + at)
            at = end
    found = np.concatenate(hashes) if hashes else np.zeros(0, U)
    places = np.concatenate(starts_at) if starts_at else np.zeros(0, np.int64)
    return found, np.searchsorted(places, offsets, "left")


def sequence_hash(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    with np.errstate(over="ignore"):
        total = np.full(n, U(k))
        for j in range(k):
            total += hashes[j : j + n] * _FACTORS[j]
        return mix(total)


def shingles(hashes: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles of each row, in order, and offsets into them.

    A row with fewer words has its whole sequence as one shingle; one without, none.
    """
    counts = np.diff(offsets)
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    out_at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = np.zeros(int(out_at[-1]), U)
    runs = sequence_hash(hashes, k)
    long = counts >= k
    if long.any():
        at = np.repeat(offsets[:-1][long] - out_at[:-1][long], sizes[long])
        to = np.flatnonzero(np.repeat(long, sizes))
        out[to] = runs[to + at]
    for m in range(1, k):
        rows = np.flatnonzero(counts == m)
        if len(rows):
            out[out_at[rows]] = sequence_hash(hashes, m)[offsets[rows]]
    return out, out_at


def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's values sorted and without repeats, and offsets into them."""
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, rows))
    v, r = values[order], rows[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    counts = np.bincount(r[keep], minlength=len(offsets) - 1)
    return v[keep], np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
