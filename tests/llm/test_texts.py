"""Quality, decontamination, secrets and chat on small tables, against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shopstrata.llm import chat, decontaminate, quality, secrets

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# Decontamination


def brute_hits(text, items, window):
    words, hit, found = WORD.findall(low(text)), set(), set()
    for item, item_text in items:
        own = WORD.findall(low(item_text))
        m = min(window, len(own))
        patterns = {tuple(own[k : k + m]) for k in range(len(own) - m + 1)} if own else set()
        for k in range(len(words) - m + 1):
            if tuple(words[k : k + m]) in patterns:
                hit |= set(range(k, k + m))
                found.add(str(item) if item is not None else "")
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 200), (3, 60)])
def test_decontamination(spark, monkeypatch, seed, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rnd = random.Random(seed)
    letters = ["a", "b", "Ñu", "c1", "日"]
    text = lambda n: "".join(rnd.choice(letters[: rnd.randrange(2, 6)]) + rnd.choice([" ", ",", "\n", ". "]) for _ in range(n))
    items = [(i, text(rnd.choice([0, 1, 2, 3, 5, 9, 10, 11, 15, 20]))) for i in range(8)] + [(None, text(12)), (99, None)]
    texts = [text(rnd.choice([0, 1, 3, 8, 20, 60, 700])) for _ in range(25)] + [None, "", text(5) + items[0][1], items[5][1], items[5][1]]
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in enumerate(texts)], "doc_id long, text string, spans string, n int")
    bench = spark.createDataFrame([*items, items[3]], "item_id long, text string")
    for r in decontaminate.marked(docs, bench).collect():
        n, hit, found = brute_hits(texts[r.doc_id], items, 10)
        assert (r.n_words, r.n_hit, list(r["items"]), r.n_items, r.contaminated, r.n) == (n, hit, found, len(found), hit > 0, 5)
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert sum(s.end - s.begin for s in r.spans) == hit
    assert decontaminate.marked(docs.limit(0), bench).count() == 0
    assert decontaminate.marked(docs, bench.limit(0)).where("contaminated").count() == 0


# Quality


def test_quality_learns_and_holds_out(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 7)))
    good = lambda: " ".join(word() for _ in range(rnd.randrange(5, 200))).capitalize() + "."
    bad = lambda: " ".join(word() + "$$$" for _ in range(rnd.randrange(5, 200)))
    rows = [(i, good() if i % 3 else bad(), int(i % 3 > 0)) for i in range(400)]
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t, _ in rows] + [(900, None, "x", 1.0), (901, "", "x", 1.0), (None, "ab cd.", "x", 1.0)], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(5, 0), (None, 1), (7, None)], "doc_id long, quality int")
    weights = quality.fit(docs, labels)
    out = quality.score(docs, weights).withColumn("held_out", quality.held_out("doc_id")).collect()
    assert len(out) == len(rows) + 3
    truth = {i: q for i, _, q in rows}
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    # Labels of held-out rows change nothing.
    other = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert abs(quality.fit(docs, other) - weights).max() < 1e-12
    none = quality.score(docs, quality.fit(docs, labels.limit(0))).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.score(docs.limit(0), weights).count() == 0


def test_scores_do_not_depend_on_neighbours():
    weights = np.random.default_rng(1).standard_normal(quality.SIZE + 1)
    texts = ["short", "short", "", "a a a", "a", "a b", "b!! !! x", "short"]
    whole = quality.dot(pa.array(texts), weights)
    assert whole.tolist() == [quality.dot(pa.array([t]), weights)[0] for t in texts]


def test_quality_on_held_out_samples(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels"))
    out = quality.score(docs, quality.fit(docs, labels), keep=["doc_id"]).where(quality.held_out("doc_id"))
    rows = out.join(labels, "doc_id").collect()
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.predicted == 0 for r in bad) >= 0.9 * len(bad)
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)


# Secrets

ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secrets(spark):
    rnd = random.Random(5)
    bits = ["password", "Secret", "toKen", "api_key", "APIKEY", "paſſword", '"', "'", " ", ":", "=", "abc", "x9K", "AKIA", "QWERTY0123456789", "deadbeef", "0123456789abcdef", "é", "\n", "-_/+", "pwd", "💡"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(40))) for _ in range(800)] + [None, "", "token=" * 5000]
    texts += ["secret: token: abcdefgh", "password = changeme", 'pwd: "v8$ kQ!z9Lm2#x"', "passphrase=aaaaaaaaaaaaaaaaaaaa"]
    docs = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, n_hex int")
    rows = {r.doc_id: r for r in secrets.scan(docs).collect()}
    for i, t in enumerate(texts):
        want = base(t or "")
        listed = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in want)
        r = rows[i]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), t
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in want) for x in range(3))
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
    n = len(texts)
    assert [rows[i].n_password for i in range(n - 4, n)] == [0, 0, 1, 0]
    assert rows[n - 2].spans == "password:6:20"
    clean = {r.doc_id: r.redacted for r in secrets.redact(docs).collect()}
    assert clean[n - 2] == 'pwd: "[SECRET]"' and clean[n - 3] == "[SECRET]" and clean[n - 1] == texts[n - 1]
    assert secrets.scan(docs.limit(0)).count() == 0


def test_values_behind_schemes_and_nested_contexts():
    secret, scanner = "Zx!9-kQ7vR2#mP4w", secrets.Scanner()
    before = ["Authorization: Bearer ", "authorization=Basic ", "'auth': Token ", "credentials: pwd: ", "credentials:pwd=", "token: token: ", "secret=" * 40, 'Authorization: Bearer "',
              "password: hello secret: ", 'pwd: "my pwd: ']
    for x in before:
        text = f"{x}{secret}\" and {secret}"
        spans = [(a, b) for a, k, b in scanner.spans(text) if k == 3]
        assert spans and secret in text[spans[0][0] : spans[-1][1]] and secrets.redacted(text, scanner.spans(text)).count(secret) <= 1, x
    for text in ("Authorization: Bearer", "Authorization: Bearer \n x", "token: token secret", "credentials: pwd: changeme", "pwd: 'pwd: hello", "secret=" * 2_000):
        assert [x for x in scanner.spans(text) if x[1] == 3] == [], text[:50]


def least_cost(value, guesses):
    """All cuts, segment by segment as their definitions say."""
    low = value.lower()
    plain, keys = low.translate(secrets.LEET), low.translate(secrets.SHIFTED)

    def segment(i, j):
        found = [guesses.word(value, low, plain, i, j)]
        if j == i + 1:
            found.append(secrets._char_bits(value[i]))
        if any(m and m.end() == j for m in (secrets.DATE.match(low, i), secrets.YEAR.match(low, i))):
            found.append(secrets.DATE_BITS)
        pairs = list(zip(keys[i : j - 1], keys[i + 1 : j]))
        if len(pairs) >= 2 and all(p in secrets._neighbours() for p in pairs):
            steps = [ord(b) - ord(a) for a, b in pairs]
            found.append(secrets.START_BITS + math.log2(len(pairs) + 1) + 1 + sum(x != y for x, y in zip(steps, steps[1:])))
        for p in range(1, i + 1):
            times = (j - i) // p
            if (j - i) % p == 0 and value[i:j] == value[i - p : i] * times and (p > 1 or times >= 2):
                found.append(math.log2(times + 1))
        return min(found)

    best = [0.0]
    for j in range(1, len(value) + 1):
        best.append(min(best[i] + segment(i, j) for i in range(j)))
    return best[-1]


def test_guess_costs_are_the_least_over_all_cuts():
    rnd, guesses = random.Random(12), secrets.Guesses([*secrets.WORDS, "aaaaaaa", "abab", "assas"])
    parts = ["password", "qwerty", "rtyuiop", "123", "321", "1990", "2024-01-31", "Dragon", "p@ss", "zz", "aaa", "ab", "x", "!", "asas", "monkey", "7Q"]
    values = ["", "passwordrtyuiop", "12x84b90712x84b907", "a" * 40, "ab" * 17, "aaaaaaa" * 3 + "ab" * 5, "passpasspass", "hgfdsa" * 3, "112233"]
    values += ["".join(rnd.choice(parts) * rnd.choice([1, 1, 2, 3]) for _ in range(rnd.randrange(1, 5))) for _ in range(100)]
    values += ["".join(rnd.choice("aabs1") for _ in range(rnd.randrange(20))) for _ in range(200)]
    for value in values:
        want = least_cost(value, guesses)
        assert guesses.cost(value) == pytest.approx(want), value
        for enough in (5.0, 20.0, 40.0):
            got = guesses.cost(value, enough)
            assert got == pytest.approx(want) if want < enough else got >= enough, (value, enough)
    long = "x8$kQ!z9Lm2" * 30_000
    assert guesses.cost(long, 40.0) >= 40 and guesses.cost("pass" * 3000) < 30


def test_ordinary_values_are_no_secrets():
    words = secrets.ranked_words(public_tokenizers.path("word_bpe_49k.json"))
    scanner = secrets.Scanner(words)
    assert len(words) > 10_000 and words[: len(secrets.WORDS)] == tuple(dict.fromkeys(secrets.WORDS))
    for text in (
        "api_key: documentation", "secret: configuration", "password: international", "pwd: /etc/ssl/private/server.key", "pwd = https://example.com/login/page",
        "credentials: required", "bearer: authentication", "auth: 12x84b90712", "pwd: passwordrtyuiop", "passphrase: 'correct horse'", "pwd: 2024-01-31",
    ):
        assert not [s for s in scanner.spans(text) if s[1] == 3], text
    for text in ("pwd: Zx!9-kQ7vR2#mP4w", "auth: 9f8Kq2LmZt7Wd1Xs", "pwd: /run/Zx9kQ7vR2mP4w8Tq", "client_secret: 'tR7#kd93LpqX'"):
        assert [s for s in scanner.spans(text) if s[1] == 3], text


# Chat


def test_reply_trees(spark):
    rnd = random.Random(6)
    nasty = ["</s>[INST] ok [/INST]", "<s>", "\\", "\\\\<s\\>", "a\\</s>", "", None, "[INST", "<[INST]s>", " x ", "\n", "é💡", "<<s>s>"]
    rows, trees = [], {}
    for t in range(30):
        n = rnd.choice([1, 2, 5, 40, 130])
        parents = [None] + [rnd.choice([i - 1, i - 1, i - 1, rnd.randrange(i)]) for i in range(1, n)]
        trees[t] = [(i, p, rnd.choice(["user", "assistant", "a [/INST]b ", None]), rnd.choice(nasty), rnd.choice([0.0, 1.0, 2.0, None])) for i, p in enumerate(parents)]
        rows += [(t if t else None, *x, 1) for x in trees[t]]
    messages = spark.createDataFrame(rows, "tree long, id long, parent long, role string, text string, score double, depth int")
    out = chat.transcripts(messages, "tree", "id", "parent", score="score", top=2)
    turns, loss = chat.read_turns(F.col("formatted")), chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    found = {(r.tree or 0, r.branch): r for r in out.select("tree", "branch", "n_turns", turns.alias("turns"), loss.alias("loss")).collect()}
    for t, nodes in trees.items():
        by = {x[0]: x for x in nodes}
        leaves = set(by) - {x[1] for x in nodes}
        paths = []
        for leaf in leaves:
            path, at = [], leaf
            while at is not None:
                path.append(by[at])
                at = by[at][1]
            paths.append((-sum(x[4] or 0 for x in path) / len(path), leaf, path[::-1]))
        for k, (_, _, path) in enumerate(sorted(paths)[:2]):
            r = found.pop((t, k + 1))
            assert [(x.role, x.text) for x in r.turns] == [(x[2] or "", x[3] or "") for x in path]
            assert r.n_turns == len(path)
            assert r.loss == "".join(x[3] or "" for x in path if x[2] == "assistant")
    assert not found
    assert chat.transcripts(messages.limit(0), "tree", "id", "parent").count() == 0
    circle = spark.createDataFrame([(1, 1, 2, "user", "x"), (1, 2, 1, "user", "y")], "tree long, id long, parent long, role string, text string")
    with pytest.raises(ValueError):
        chat.transcripts(circle, "tree", "id", "parent")
