"""The classifier against plain loops: n-grams counted one by one, and one leader followed weight by weight."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash

from shopstrata.llm import quality, words

MASK = (1 << 64) - 1
TOKEN = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+|[!-/:-@\[-`{-~]+")


def mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def token_hash(token):
    return int(words.split(pa.array([token]), quality.KINDS).hash[0])


def shape(token, before):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), token)
    if before is not None and low == re.sub("[A-Z]", lambda m: m[0].lower(), before):
        return mixed(1006)
    if not re.match(r"[0-9A-Za-z\u0080-\U0010ffff]", token):
        return token_hash(token)
    size, upper, digits = len(token.encode()), len(re.findall("[A-Z]", token)), len(re.findall("[0-9]", token))
    if digits * 2 > size:
        kind = 4
    elif not upper:
        kind = 0
    elif upper == 1 and "A" <= token[0] <= "Z":
        kind = 1
    else:
        kind = 2 if upper * 2 >= size else 3
    return mixed(1001 + kind)


def vector(text):
    """Weight number -> value."""
    tokens = TOKEN.findall(text or "")
    hashes = [token_hash(t) for t in tokens]
    shapes = [shape(t, tokens[i - 1] if i else None) for i, t in enumerate(tokens)]
    out = Counter({quality.SIZE: 1.0})
    for k, (base, size) in enumerate(((hashes, 1), (hashes, 2), (shapes, 1), (shapes, 2), (shapes, 3))):
        grams = [base[i : i + size] for i in range(len(base) - size + 1)]
        for gram in grams:
            h = (k + 1) * 0x9E3779B97F4A7C15 & MASK
            for x in gram:
                h = mixed((h * 3 + x) & MASK)
            out[h >> (64 - quality.BITS)] += 1 / len(grams)
    return out


def leader(rows):
    """Weights after following the leader over (text, label) in order."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return (math.copysign(quality.L1, z[i]) - z[i]) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    vectors = [(vector(t), y) for t, y in rows]
    for _ in range(quality.EPOCHS):
        for x, y in vectors:
            w = {i: weight(i) for i in x}
            error = 1 / (1 + math.exp(-sum(w[i] * x[i] for i in x))) - y
            for i in x:
                g = error * x[i]
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def made(rnd):
    pool = ["The", "river", "RUNS", "fAst", "2024", "x9y8", "été", "日本", "...", "!!", "river", "--", "a", "I'm", "\t", "\x7f", "B2B", "w" * 90]
    return " ".join(rnd.choice(pool) for _ in range(rnd.randrange(25)))


def rank(doc_id):
    h = xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), 42)
    return h - (1 << 64) if h >> 63 else h


def test_features_are_the_counted_n_grams():
    rnd = random.Random(2)
    texts = [made(rnd) for _ in range(60)] + ["", None, "one", "Same same SAME"]
    for text, (at, x) in zip(texts, quality._vectors(pa.array([t or "" for t in texts]))):
        want = vector(text)
        assert sorted(at.tolist()) == sorted(want)
        assert np.allclose(x, [want[i] for i in at.tolist()])


def test_weights_and_scores(spark):
    rnd = random.Random(9)
    rows = [(i, made(rnd), rnd.randrange(2)) for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    found = quality.fit(docs, labels)
    learnt = sorted((rank(i), y, t) for i, t, y in rows if zlib.crc32(str(i).encode()) % 3 != 1)
    want = np.zeros(quality.SIZE + 1)
    for shard in range(quality.SHARDS):
        own = [(t, y) for r, y, t in learnt if r % quality.SHARDS == shard]
        for i, w in leader(own).items():
            want[i] += w * len(own) / len(learnt)
    assert np.abs(found - want).max() < 1e-9 and np.abs(want).max() > 0
    for r in quality.score(docs, found).collect():
        dot = sum(found[i] * x for i, x in vector(r.text).items())
        assert abs(r.score - 1 / (1 + math.exp(-dot))) < 1e-9 and r.predicted == (r.score >= 0.5)
