"""Quality classifier: hashed n-grams of words, logistic regression by follow-the-regularised-leader, sparse dot products.

A text's tokens are its words and its runs of punctuation. Features are the one- and two-grams of the lower-cased tokens
and the one- to three-grams of their shapes (lower case, capital, upper case, mixed, digits, the same as the token before;
punctuation stands for itself), each hashed into one of 2^18 weights. A feature's value is its share of the text's n-grams of that family, so a
text's length has no weight of its own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import with_columns
from .words import U, Words, byte_set, mixed, split

BITS = 18
SIZE = 1 << BITS
#: At most so many labelled ids are learnt from, those with the smallest hash.
SAMPLE = 8000
SHARDS, EPOCHS = 4, 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4

#: 1: letters and digits, 2: punctuation; blanks and control characters divide.
KINDS = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)).astype(np.uint8)
KINDS += 2 * byte_set((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)).astype(np.uint8)
_UPPER, _DIGIT = byte_set((0x41, 0x5A)), byte_set((0x30, 0x39))
_FAMILIES = ((False, 1), (False, 2), (True, 1), (True, 2), (True, 3))
_SHAPES = mixed(np.arange(1001, 1007, dtype=U))


def _shapes(words: Words) -> np.ndarray:
    """A number for each token: its shape, or the token itself if it is punctuation."""
    size = words.end - words.begin
    count = lambda table: np.diff(np.concatenate([[0], np.cumsum(table[words.raw])])[np.stack([words.begin, words.end])], axis=0)[0]
    if not len(size):
        return np.zeros(0, U)
    upper, digits = count(_UPPER), count(_DIGIT)
    first = _UPPER[words.raw[words.begin]]
    shape = np.select([digits * 2 > size, upper == 0, first & (upper == 1), upper * 2 >= size], [4, 0, 1, 2], 3)
    again = np.concatenate([[False], words.hash[1:] == words.hash[:-1]])
    again[words.first[:-1][words.counts > 0]] = False
    shape[again] = 5
    return np.where((KINDS[words.raw[words.begin]] == 2) & (shape != 5), words.hash, _SHAPES[shape])


def features(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each family the weights' numbers of all n-grams, text after text, and where each text's begin."""
    words = split(texts, KINDS)
    shapes, out = _shapes(words), []
    for k, (shaped, size) in enumerate(_FAMILIES):
        base = shapes if shaped else words.hash
        with np.errstate(over="ignore"):
            gram = np.full(max(0, len(base) - size + 1), U(k + 1) * U(0x9E3779B97F4A7C15))
            for i in range(size):
                gram = mixed(gram * U(3) + base[i : i + len(gram)])
        bucket = (gram >> U(64 - BITS)).astype(np.int64)
        have = np.maximum(words.counts - size + 1, 0)
        first = np.concatenate([[0], np.cumsum(have)])
        inside = np.arange(len(words.hash)) < np.repeat(words.first[1:] - size + 1, words.counts)
        out.append((bucket[inside[: len(bucket)]], first))
    return out


def dot(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Sparse dot products of the texts' features with the weights; the last weight is the bias."""
    total = np.full(len(texts), weights[-1])
    for bucket, first in features(texts):
        # Each text is summed by itself, so its score doesn't depend on its neighbours.
        have = np.diff(first)
        owner = np.repeat(np.arange(len(have)), have)
        total += np.bincount(owner, weights=weights[bucket], minlength=len(have)) / np.maximum(have, 1)
    return total


class Leader:
    """Follow-the-regularised-leader with a learning rate for each weight."""

    def __init__(self):
        self.z, self.n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label
        g = error * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _vectors(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    found = features(texts)
    out = []
    for i in range(len(texts)):
        at, x = [np.array([SIZE])], [np.ones(1)]
        for bucket, first in found:
            if n := first[i + 1] - first[i]:
                own, counts = np.unique(bucket[first[i] : first[i + 1]], return_counts=True)
                at.append(own), x.append(counts / n)
        at, back = np.unique(np.concatenate(at), return_inverse=True)
        out.append((at, np.bincount(back, weights=np.concatenate(x))))
    return out


def _train(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["rank", "label"], kind="stable")
    vectors = _vectors(pa.array(rows["text"], pa.string()))
    leader = Leader()
    for _ in range(EPOCHS):
        for (at, x), label in zip(vectors, rows["label"]):
            leader.learn(at, x, int(label))
    return pd.DataFrame({"shard": rows["shard"].iloc[:1].to_numpy(), "weights": [leader.weights().astype("<f8").tobytes()], "n": [len(rows)]})


def held_out(doc_id) -> F.Column:
    """True for the third of the ids whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_column: str = "doc_id", text: str = "text",
    sample: int = SAMPLE,
) -> np.ndarray:
    """Weights learnt from rows of `docs` whose id `labels` marks 0 or 1 and that are not held out.

    `sample` bounds the ids learnt from; they are the ones with the smallest hash, so the same at every run, with the
    classes' natural shares, so that a short text is good unless something speaks against it. An id that is marked both ways is not used. Each of SHARDS tasks follows its own leader and their weights are
    averaged. Without labels all weights are 0 and every score is 0.5.
    """
    marked = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & ~held_out(id_column))
        .groupBy(F.col(id_column).alias("doc_id"))
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other"))
        .where("label = other")
        .select("doc_id", "label", F.xxhash64("doc_id").alias("rank"))
    )
    # At most `sample` rows of three numbers: a proven bound for the broadcast.
    chosen = F.broadcast(marked.orderBy("rank", "doc_id").limit(sample))
    rows = (
        docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .join(chosen, "doc_id")
        .select(F.pmod("rank", F.lit(SHARDS)).alias("shard"), "rank", "label", "text")
    )
    found = rows.groupBy("shard").applyInPandas(_train, "shard long, weights binary, n long").collect()
    found.sort(key=lambda r: r["shard"])
    total = sum(r["n"] for r in found)
    return sum((np.frombuffer(r["weights"], "<f8") * (r["n"] / total) for r in found), np.zeros(SIZE + 1))


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 if score >= 0.5, else 0). Null and empty texts get the bias alone."""
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def maker():
        def make(texts):
            p = 1 / (1 + np.exp(-np.clip(dot(texts, model.value), -500, 500)))
            return [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

        return make

    return with_columns(docs, text, "score double, predicted int", maker, keep)
