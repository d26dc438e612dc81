"""Token ids of many texts at once for two public vocabularies of the `tokenizers` library.

Texts are cut into pre-tokens (the pieces inside which merges happen) by array operations on their code points, and
each distinct pre-token is encoded once per worker. Texts with special strings or with rare scripts, where Unicode
versions could disagree, are cut by the library itself.
"""

from __future__ import annotations

import os
import re
import unicodedata
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex

from .words import Powers, U, _ranges, hash_long, mixed

LETTER, NUMBER, SPACE, OTHER, END = 1, 2, 3, 0, 4
#: Distinct pre-tokens that a worker remembers before it forgets the rare ones: some 30 bytes each.
REMEMBERED = 400_000
#: A longer text is cut at blanks between two letters, where a pre-token always ends.
LONG = 1 << 20
#: Scripts whose letters are the same in all Unicode versions of the last years, and symbols.
_STEADY = regex.compile(r"[\x01-ͯͰ-׿ऀ-෿฀-࿿Ⴀ-ᇿḀ-⯿　-㄰㐀-龥가-힣\U0001F300-\U0001F64F]*")
_SPACED_WORD, _WORD = regex.compile(r" \p{L}+"), regex.compile(r"\p{L}+")
_CUT = re.compile(r"[a-z](?= [a-z])")


@cache
def _classes() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            a, b = ord(every[m.start()]), ord(every[m.end() - 1])
            out[a : b + 1] = kind
    out[0xD800:0xE000] = OTHER
    return out


#: Hashes of pre-tokens live in one worker, so each worker draws its own: nobody can write two that meet.
_SECRET = int.from_bytes(os.urandom(8), "little")


@cache
def _codes() -> np.ndarray:
    return mixed(np.arange(1, 0x110001, dtype=U) ^ U(_SECRET))


_POWERS = Powers(_SECRET | 1)


def steady(text: str) -> bool:
    return text.isascii() and "\0" not in text or _STEADY.fullmatch(text) is not None


def long_pieces(text: str) -> list[str]:
    if len(text) <= LONG:
        return [text]
    out, at = [], 0
    while len(text) - at > LONG and (m := _CUT.search(text, at + LONG)):
        out.append(text[at : m.end()])
        at = m.end()
    return [*out, text[at:]]


class Cut:
    """Pre-tokens of consecutive texts: their bounds in the joined text, a hash of each, and where each text's begin."""

    def __init__(self, texts: list[str], spaced: bool):
        """spaced: a blank belongs to the word behind it and white space counts; else white space is dropped."""
        self.joined = "\0".join(texts) + "\0"
        cp = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
        kind = _classes()[cp]
        kind[ends] = END
        start = np.empty(len(cp), bool)
        start[0] = True
        np.not_equal(kind[1:], kind[:-1], out=start[1:])
        if spaced:
            after = np.flatnonzero(start[1:] & (kind[:-1] == SPACE) & (kind[1:] != END)) + 1
            start[after - 1] = True
            start[after[cp[after - 1] == 0x20]] = False
        else:
            start |= kind == NUMBER
        self._contractions(cp, kind, start)
        start[ends] = True
        bounds = np.flatnonzero(start)
        real = kind[bounds] != END
        if not spaced:
            real &= kind[bounds] != SPACE
        real[-1] = False
        at = np.flatnonzero(real)
        self.begin, self.end = bounds[at], bounds[at + 1]
        with np.errstate(over="ignore"):
            up, down = _POWERS.upto(len(cp))
            sums = np.concatenate([[U(0)], np.cumsum(_codes()[cp] * up[: len(cp)])])
            self.hash = mixed((sums[self.end] - sums[self.begin]) * down[self.begin])
        hash_long(self.hash, cp, self.begin, self.end, _SECRET)
        self.first = np.concatenate([[0], np.searchsorted(self.begin, ends)])

    @staticmethod
    def _contractions(cp, kind, start):
        """'s 't 'm 'd 're 've 'll are pre-tokens of their own where a quote mark begins one."""
        quote = np.flatnonzero((cp[:-1] == 0x27) & start[:-1])
        if not len(quote):
            return
        one = cp[quote + 1]
        two = cp[np.minimum(quote + 2, len(cp) - 1)]
        is_ = lambda x, c: x == ord(c)
        size = np.where(is_(one, "s") | is_(one, "t") | is_(one, "m") | is_(one, "d"), 2, 0)
        size = np.where(((is_(one, "r") | is_(one, "v")) & is_(two, "e")) | (is_(one, "l") & is_(two, "l")), 3, size)
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        rest = quote + size
        start[rest[kind[rest] == LETTER]] = True

    def string(self, i: int) -> str:
        return self.joined[self.begin[i] : self.end[i]]


class Remembered:
    """Values (arrays of numbers) by the hash of a pre-token, each made once. Of more than REMEMBERED those stay that were
    asked for again since the last time, if they are at most half as many."""

    def __init__(self, make, dtype):
        self.make, self.dtype = make, dtype
        self.clear()

    def clear(self):
        self.keys, self.row, self.again = np.zeros(0, U), np.zeros(0, np.int32), np.zeros(0, bool)
        self.at, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, self.dtype)

    def forget(self):
        kept = np.flatnonzero(self.again)
        if 2 * len(kept) > REMEMBERED:
            return self.clear()
        place = np.full(len(self.again), -1, np.int32)
        place[kept] = np.arange(len(kept))
        row = place[self.row]
        self.keys, self.row, self.again = self.keys[row >= 0], row[row >= 0], np.zeros(len(kept), bool)
        size = self.size[kept]
        self.flat = self.flat[_ranges(self.at[kept], size)]
        self.at, self.size = np.cumsum(size, dtype=np.int64) - size, size

    def rows(self, hashes: np.ndarray, string) -> np.ndarray:
        back, unique = pd.factorize(hashes)
        index = np.empty(len(unique), np.int64)
        index[back[::-1]] = np.arange(len(hashes))[::-1]
        if len(self.keys) > REMEMBERED:
            self.forget()
        place = np.searchsorted(self.keys, unique)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == unique[known]
        rows = np.empty(len(unique), np.int64)
        rows[known] = self.row[place[known]]
        self.again[rows[known]] = True
        missing = np.flatnonzero(~known)
        if len(missing):
            flat, size = self.make([string(i) for i in index[missing]])
            rows[missing] = len(self.again) + np.arange(len(missing))
            new = missing[np.argsort(unique[missing])]
            self.keys = np.insert(self.keys, place[new], unique[new])
            self.row = np.insert(self.row, place[new], rows[new].astype(np.int32))
            self.again = np.concatenate([self.again, np.zeros(len(missing), bool)])
            self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(size, dtype=np.int64) - size])
            self.size = np.concatenate([self.size, size.astype(np.int32)])
            self.flat = np.concatenate([self.flat, flat.astype(self.dtype)])
        return rows[back]


def lowered(text: str) -> str:
    """NFC and lower case, letter by letter (a capital sigma has one small form wherever it stands)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Encoder:
    """Ids of whole texts as `Tokenizer.encode(text, add_special_tokens=False)` gives them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self.spaced = self.library.normalizer is None
        self.remembered = Remembered(self._encode, np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32)

    def _encode(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens. Words go to the library as one text with a divider between them that is no part of any:
        a line feed where a blank begins each word, else a digit, which is a pre-token of its own."""
        words = _SPACED_WORD if self.spaced else _WORD
        easy = np.fromiter((words.fullmatch(s) is not None for s in strings), bool, len(strings))
        if easy.sum() < 100:
            return self._one_by_one(strings)
        divider = "\n" if self.spaced else "0"
        (mark,) = self.library.encode(divider, add_special_tokens=False).ids
        text = divider.join(s for s, e in zip(strings, easy) if e) + divider
        ids = np.asarray(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        ends = np.flatnonzero(ids == mark)
        if len(ends) != easy.sum():
            return self._one_by_one(strings)
        hard, hard_size = self._one_by_one([s for s, e in zip(strings, easy) if not e])
        size = np.empty(len(strings), np.int64)
        size[easy], size[~easy] = np.diff(ends, prepend=-1) - 1, hard_size
        flat = np.empty(int(size.sum()), np.int64)
        at = np.cumsum(size) - size
        flat[_ranges(at[easy], size[easy])] = np.delete(ids, ends)
        flat[_ranges(at[~easy], size[~easy])] = hard
        return flat, size

    def _one_by_one(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.library.encode_batch_fast(strings, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for x in found for i in x), np.int64, int(size.sum())), size

    def plain(self, text: str) -> bool:
        return steady(text) and not ("<" in text and any(s in text for s in self.specials))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's begin (and the last end)."""
        texts = texts.to_pylist()
        odd = {i: np.asarray(self.library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts) if not self.plain(t)}
        pieces = [[""] if i in odd else long_pieces(t if self.spaced else lowered(t)) for i, t in enumerate(texts)]
        cut = Cut([p for x in pieces for p in x], self.spaced)
        rows = self.remembered.rows(cut.hash, cut.string)
        size = self.remembered.size[rows]
        flat = self.remembered.flat[_ranges(self.remembered.at[rows], size)]
        first = cut.first[np.concatenate([[0], np.cumsum([len(x) for x in pieces])])]
        first = np.concatenate([[0], np.cumsum(size)])[first]
        if odd:
            own = [odd.get(i, flat[first[i] : first[i + 1]]) for i in range(len(texts))]
            first = np.concatenate([[0], np.cumsum([len(x) for x in own])])
            flat = np.concatenate(own)
        return flat, first


@cache
def encoder(path: str) -> Encoder:
    """One for each worker process."""
    return Encoder(path)
