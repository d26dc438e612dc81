"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a batch are held as one ragged array of symbols. In each round every pre-token's lowest-rank
pair is found by a segmented minimum and all pre-tokens apply theirs at once; what is left at the end is counted. No
encoder of the library takes part: only its normaliser and splitter, for texts with rare scripts.
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .batches import lengths, with_columns
from .tokens import Cut, Encoder, Remembered, long_pieces, lowered

NONE = np.int64(1 << 40)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself where printable, else the next free one."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, free = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in letters:
            letters[b], free = chr(free), free + 1
    return [letters[b] for b in range(256)]


class Merges:
    """The merge table of a vocabulary whose pre-tokens end with a marked symbol."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + suffix] for c in letters], np.int64)
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        left, right, made = (np.array([vocab[x] for x in column], np.int64) for column in zip(*((a, b, a + b) for a, b in pairs)))
        key = left << 20 | right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order, made
        # A merge whose product also takes part in an earlier-ranked pair is applied to its leftmost place only, for that
        # pair comes first then.
        least = np.full(max(vocab.values()) + 1, NONE)
        for side in (left, right):
            np.minimum.at(least, side, np.arange(len(pairs)))
        self.single = least[made] < np.arange(len(pairs))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """How many symbols are left of each pre-token."""
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        symbols = self.inner[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), size)
        full = size > 0
        ends = (np.cumsum(size) - 1)[full]
        symbols[ends] = self.last[np.frombuffer(b"".join(t[-1:] for t in tokens), np.uint8)]
        left_over = np.zeros(len(tokens), np.int64)
        while len(symbols):
            rank = np.full(len(symbols), NONE)
            same = owner[1:] == owner[:-1]
            rank[:-1][same] = self.rank(symbols[:-1][same], symbols[1:][same])
            heads = np.flatnonzero(np.concatenate([[True], ~same]))
            lowest = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.append(heads, len(symbols))))
            done = lowest == NONE
            left_over += np.bincount(owner[done], minlength=len(tokens))
            take = (rank == lowest) & ~done
            # Of overlapping places (the same symbol repeated) every second one counts, from the left.
            first = take & ~np.concatenate([[False], take[:-1] & same])
            place = np.flatnonzero(take)
            if len(place):
                run = np.cumsum(first[place]) - 1
                begins = np.flatnonzero(first)
                take[place[(place - begins[run]) % 2 == 1]] = False
                place = np.flatnonzero(take)
                once = self.single[rank[place]]
                if once.any():
                    again = np.concatenate([[False], owner[place[1:]] == owner[place[:-1]]])
                    place = place[~(once & again)]
            symbols[place] = self.made[rank[place]]
            stay = ~done
            stay[place + 1] = False
            symbols, owner = symbols[stay], owner[stay]
        return left_over


class Counter:
    def __init__(self, path: str):
        self.parts = Encoder(path)
        merges = Merges(path)
        self.merges = merges
        self.remembered = Remembered(lambda x: (merges.count([s.encode("utf-8", "surrogatepass") for s in x]), np.ones(len(x), np.int64)), np.int64)
        self.special = regex.compile("|".join(map(regex.escape, self.parts.specials)))
        letters = {c: b for b, c in enumerate(byte_letters())}
        self.bytes_of = lambda s: bytes(letters[c] for c in s)

    def _odd(self, text: str) -> int:
        library, total = self.parts.library, len(self.special.findall(text))
        for between in self.special.split(text):
            tokens = [self.bytes_of(s) for s, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(between))]
            total += int(self.merges.count(tokens).sum())
        return total

    def count(self, texts: pa.Array) -> np.ndarray:
        texts = texts.to_pylist()
        odd = {i: self._odd(t) for i, t in enumerate(texts) if not self.parts.plain(t)}
        pieces = [[""] if i in odd else long_pieces(lowered(t)) for i, t in enumerate(texts)]
        cut = Cut([p for x in pieces for p in x], spaced=False)
        rows = self.remembered.rows(cut.hash, cut.string)
        sums = np.concatenate([[0], np.cumsum(self.remembered.flat[rows])])
        first = cut.first[np.concatenate([[0], np.cumsum([len(x) for x in pieces])])]
        out = np.diff(sums[first])
        for i, n in odd.items():
            out[i] = n
        return out


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = 2048, keep: list[str] | None = None) -> DataFrame:
    """The rows of `docs` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    path: a vocabulary file of the `tokenizers` library with lower-casing, word ends and white space dropped. Null and
    empty texts have no tokens; repeated rows are counted each; special strings inside a text are one token each. A
    column that has one of the new names is replaced.
    """

    def maker():
        count = counter(path).count

        def make(texts):
            n = count(texts)
            return [pa.array(lengths(texts)), pa.array(n), pa.array(n > limit)]

        return make

    return with_columns(docs, text, "n_bytes long, n_tokens long, over_limit boolean", maker, keep)
