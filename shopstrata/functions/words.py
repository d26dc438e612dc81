"""Phrase to words."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word is a run of letters and digits; a Han character, written without spaces, is a word of its own.
WORD = r"\p{IsHan}|[\p{L}\p{N}&&[^\p{IsHan}]]+"
# Some 500,000 words.
LIST_BYTES = 64 << 20
RUN = r"\p{IsHan}+|[\p{L}\p{N}&&[^\p{IsHan}]]+"


def words(phrase: Column | str) -> Column:
    """The phrase's words in lower case, in order, as an array."""
    text = F.col(phrase) if isinstance(phrase, str) else phrase
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def explode_words(df: DataFrame, phrase: str, word: str = "keyword", split=words) -> DataFrame:
    """One row per word of `phrase`; the other columns repeat."""
    kept = [c for c in df.columns if c != phrase]
    return df.select(*kept, F.explode(split(F.col(phrase))).alias(word))


def trie_of(known: Iterable[str]) -> dict:
    """Nested dicts by character; the key '' marks the end of a word."""
    root: dict = {}
    for word in known:
        node = root
        for c in word:
            node = node.setdefault(c, {})
        if word:
            node[""] = True
    return root


def fewest_words(run: str, trie: dict) -> list[str]:
    """`run` cut into known words and single characters, as few as there can be; of equal numbers the longer first words."""
    n = len(run)
    count, size = [0] * (n + 1), [1] * n
    for i in reversed(range(n)):
        count[i] = 1 + count[i + 1]
        node = trie
        for j in range(i, n):
            node = node.get(run[j])
            if node is None:
                break
            if "" in node and 1 + count[j + 1] <= count[i]:
                count[i], size[i] = 1 + count[j + 1], j + 1 - i
    out, at = [], 0
    while at < n:
        out.append(run[at : at + size[at]])
        at += size[at]
    return out


def word_list_splitter(spark: SparkSession, known: Iterable[str], list_bytes: int = LIST_BYTES):
    """A `split` for `explode_words` that cuts runs of Han characters into known words, as `fewest_words` does.

    The list is a dictionary of the language, so its size does not grow with the data. It is sent to every executor; one of
    more than `list_bytes` is refused.
    """
    known = frozenset(known)
    if sum(map(sys.getsizeof, known)) > list_bytes:
        raise ValueError(f"a word list of more than {list_bytes} bytes is no dictionary to send to every executor")
    vocabulary = spark.sparkContext.broadcast(trie_of(known))

    @F.pandas_udf("array<string>")
    def cut_runs(phrases: pd.Series) -> pd.Series:
        trie = vocabulary.value

        def cut(run: str) -> list[str]:
            return fewest_words(run, trie) if unicodedata.name(run[0], "").startswith("CJK") else [run]

        return phrases.map(lambda runs: None if runs is None else [w for run in runs for w in cut(run)])

    return lambda phrase: cut_runs(F.regexp_extract_all(F.lower(phrase), F.lit(RUN), F.lit(0)))
