"""Words of many texts at once as 64-bit hashes, by array operations on the UTF-8 bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
_PIECE = 1 << 20
#: Sums of letters times powers modulo 2^64 cancel out for some pairs of long words whatever the base; those are hashed by XXH3.
LONG_WORD = 64


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


_LETTER = mixed(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    found = np.zeros(256, bool)
    for low, high in ranges:
        found[low : high + 1] = True
    return found


#: Letters, digits and everything beyond ASCII; a UTF-8 text has the same words by bytes and by code points.
LETTERS = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Everything but white space.
VISIBLE = ~byte_set((0x20, 0x20), (0x09, 0x0D))


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64. One pair of tables is kept, as long as any that was asked for;
    one for more than KEPT numbers is made for the occasion."""

    KEPT = 4 * _PIECE

    def __init__(self, base: int):
        self.bases = U(base), U(pow(base, -1, 1 << 64))
        self.tables = (np.zeros(0, U),) * 2

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """At least the powers 0 to n - 1 of both."""
        if n <= len(self.tables[0]):
            return self.tables
        size = -(-n // (1 << 16)) << 16
        with np.errstate(over="ignore"):
            tables = tuple(np.concatenate([[U(1)], np.cumprod(np.full(size - 1, b, U))]) for b in self.bases)
        if n <= self.KEPT:
            self.tables = tables
        return tables


_POWERS = Powers(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """Words of consecutive texts: those of text i are first[i] to first[i + 1] - 1."""

    raw: np.ndarray  # the bytes of all texts, a line feed after each
    data: np.ndarray  # the same with A-Z lower-cased
    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    starts: np.ndarray  # where each text's bytes begin, and the length of all

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, each followed by a line feed, and where each begins (and the last ends)."""
    raw = [b"" if x is None else x for x in texts.cast(pa.binary()).to_pylist()]
    starts = np.concatenate([[0], np.cumsum(np.fromiter((len(x) + 1 for x in raw), np.int64, len(raw)))])
    return np.frombuffer(b"".join(x + b"\n" for x in raw), np.uint8), starts


def split(texts: pa.Array, inside: np.ndarray) -> Words:
    """Lower-case A-Z and take the runs of bytes that are `inside` (a line feed never is).

    inside: true for each byte of words, or numbers for several kinds of them; a run is of one kind.
    """
    raw, starts = joined(texts)
    data = _LOWER[raw]
    found = [_piece(data, a, b, inside) for a, b in _pieces(data, inside)]
    begin, end, hashes = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U))
    return Words(raw, data, begin, end, hashes, np.searchsorted(begin, starts), starts)


def _pieces(data: np.ndarray, inside: np.ndarray):
    """Ranges of about _PIECE bytes that end behind a byte outside words."""
    at, n = 0, len(data)
    while at < n:
        to = min(n, at + _PIECE)
        while to < n:
            gaps = np.flatnonzero(inside[data[to - 1 : to + _PIECE]] == 0)
            if len(gaps):
                to += int(gaps[0])
                break
            to = min(n, to + _PIECE)
        yield at, to
        at = to


def _piece(data: np.ndarray, a: int, b: int, inside: np.ndarray):
    part = data[a:b]
    kind = np.zeros(len(part) + 2, inside.dtype)
    kind[1:-1] = inside[part]
    edges = np.flatnonzero(kind[1:] != kind[:-1])
    full = np.flatnonzero(kind[edges + 1] != 0)
    begin, end = edges[full], edges[full + 1]
    up, down = _POWERS.upto(len(part))
    with np.errstate(over="ignore"):
        sums = np.concatenate([[U(0)], np.cumsum(_LETTER[part] * up[: len(part)])])
        hashes = mixed((sums[end] - sums[begin]) * down[begin])
    hash_long(hashes, part, begin, end)
    return begin + a, end + a, hashes


def hash_long(hashes: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 0) -> None:
    """Replace the hashes of words of more than LONG_WORD numbers of `data`."""
    for i in np.flatnonzero(end - begin > LONG_WORD).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(data[begin[i] : end[i]].tobytes(), seed)


_STEPS = mixed(np.arange(11, 11 + 64, dtype=U)) | U(1)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of `size` words (of the whole text if it has fewer, but some), and their bounds by text."""
    n, counts = len(words.hash), words.counts
    with np.errstate(over="ignore"):
        full = np.zeros(max(0, n - size + 1), U)
        for k in range(size):
            full += words.hash[k : k + len(full)] * _STEPS[k]
        have = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        first = np.concatenate([[0], np.cumsum(have)])
        out = np.zeros(first[-1], U)
        long = counts >= size
        at = np.repeat(words.first[:-1][long] - first[:-1][long], have[long]) + _ranges(first[:-1][long], have[long])
        out[_ranges(first[:-1][long], have[long])] = full[at]
        for i in np.flatnonzero((counts < size) & (counts > 0)):
            own = words.hash[words.first[i] : words.first[i + 1]]
            out[first[i]] = np.sum(own * _STEPS[: len(own)], dtype=U) + U(len(own)) * U(0xA0761D6478BD642F)
    return mixed(out), first


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count."""
    total = int(counts.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
