"""Bottom-k sketches against an own computation of the hashes, and their estimates against the full sets."""

import hashlib
import random
import re

import pytest
import xxhash

from pyspark.sql import functions as F
from shopstrata.llm import fingerprints
from shopstrata.llm.queries import QUERIES


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chained(hashes):
    seed = 42
    for h in hashes:
        seed = xxhash.xxh64_intdigest(int.to_bytes(h & (2**64 - 1), 8, "little"), seed)
    return signed(seed)


def shingles(text, size=5):
    words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.findall(r"[^ \t\n\x0b\f\r]+", (text or "").lower())]
    return {chained(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def sketch(text, size):
    return sorted(shingles(text))[:size]


def resemblance(a, b, size):
    union = sorted({*a, *b})[:size]
    return sum(x in a and x in b for x in union) / len(union) if union else 1.0


def followed(rows):
    """Each (doc_id, text) with the text of the next one."""
    key = lambda r: hashlib.sha256(f"{'null' if r[0] is None else r[0]}:{r[1] or ''}".encode()).digest()
    once = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is None, -(r[0] or 0), key(r)))
    return {r: once[(i + 1) % len(once)][1] for i, r in enumerate(once)}


def edit(text, other):
    third = len(text) // 3
    return text[: len(text) - third] + other[:third]


def strange():
    rnd = random.Random(5)
    say = lambda n: " ".join(rnd.choice(["Alpha", "beta", "g\U0001f600", "d", "éé"]) + str(rnd.randrange(40)) for _ in range(n))
    rows = [(i, say(rnd.randrange(60))) for i in range(0, 200, 3)]
    rows += [(7, None), (8, ""), (10, " \n\t "), (11, "one two"), (11, "one  TWO"), (13, say(30_000)), (-5, "below"), (2**63 - 1, say(9))]
    return rows + [(14, "same words here as there now")] * 5 + [(None, "no id")] * 3 + [(None, say(20)), (-(2**63), None)]


def test_sketches_edits_and_order(spark):
    rows = strange()
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, key int, `__row` string, copies int")
    found = fingerprints.repeated(fingerprints.edited(df.repartition(7), 16)).collect()
    want = followed(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in found) == sorted((i is None, i or 0, t or "") for i, t in rows)
    for r in found:
        other = want[r.doc_id, r.text]
        assert r.edited == edit(r.text, other)
        assert (r.sketch, r.edited_sketch, r.next_sketch) == (sketch(r.text, 16), sketch(r.edited, 16), sketch(other, 16))
    assert fingerprints.edited(df.limit(0)).count() == 0


def test_one_document_follows_itself(spark):
    (row,) = fingerprints.edited(spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")).collect()
    assert (row.edited, row.copies) == ("abcdab", 1)


@pytest.mark.parametrize("shared", [0, 100, 400, 800, 1000])
def test_estimates(spark, shared):
    a, b = [f"a{i}" for i in range(1004)], [f"b{i}" for i in range(1004)]
    pair = (" ".join(a), " ".join(a[: shared + 4] + b[shared + 4 :]) if shared else " ".join(b))
    df = spark.createDataFrame([pair], "a string, b string")
    df = fingerprints.with_sketch(fingerprints.with_sketch(df, "a", "x"), "b", "y")
    got = df.select(
        fingerprints.resemblance(F.col("x"), F.col("y")).alias("r"), fingerprints.containment(F.col("x"), F.col("y")).alias("c"),
        fingerprints.distinct_shingles(F.col("x")).alias("n"), "x", "y",
    ).first()
    one, two = shingles(pair[0]), shingles(pair[1])
    assert got.r == pytest.approx(resemblance(got.x, got.y, fingerprints.SIZE))
    assert abs(got.r - len(one & two) / len(one | two)) < 0.15 and abs(got.c - len(one & two) / len(one)) < 0.2 and abs(got.n - 1000) < 300


def test_sketches_merge_and_are_written_and_read(spark):
    rnd = random.Random(3)
    parts = [(k, " ".join(str(rnd.randrange(10**6)) for _ in range(rnd.choice([3, 40])))) for k in [1] * 30 + [2] * 2] + [(3, ""), (None, "a b c d e f"), (None, None)]
    df = fingerprints.with_sketch(spark.createDataFrame(parts, "k int, text string"), "text", "s", 20)
    want = {k: sorted(set().union(*(shingles(t) for j, t in parts if j == k)))[:20] for k, _ in parts}
    assert {r.k: r.s for r in fingerprints.merged(df, ["k"], "s", 20).collect()} == want
    text = fingerprints.as_text(F.col("s"))
    read = df.select("s", fingerprints.from_text(text).alias("again"), text.alias("t")).collect()
    assert all(r.s == r.again and len(r.t) == 16 * len(r.s) for r in read)


def test_query_on_the_sample(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want, size = followed(rows), fingerprints.SIZE
    found = QUERIES["op11_fingerprints"](spark, folder).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        text = texts[r.doc_id] or ""
        other, after = edit(text, want[r.doc_id, text]), want[r.doc_id, text]
        own, new, after = (sketch(t, size) for t in (text, other, after))
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(other.encode()).hexdigest())
        assert r.fingerprint == "".join(f"{h & (2**64 - 1):016x}" for h in own) and r.edited_fingerprint == "".join(f"{h & (2**64 - 1):016x}" for h in new)
        assert r.near_edited == pytest.approx(resemblance(own, new, size)) and r.near_next == pytest.approx(resemblance(own, after, size))
