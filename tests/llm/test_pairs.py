"""Near duplicates of texts and vectors, components and license scans, against brute force."""

import math
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest

from shopstrata.llm import embeddings, licenses, minhash
from shopstrata.llm.components import components
from shopstrata.llm.words import LETTERS, split


def classes(n, links):
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    return [top(x) for x in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd, n = random.Random(seed), 300
    links = [(i, i + 1) for i in range(100)] + [(rnd.randrange(100, n), rnd.randrange(100, n)) for _ in range(120)] + [(5, 5), (3, 4)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = classes(n, links)
    assert found == {i: c for i, c in enumerate(want) if i != c}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(sys.modules[components.__module__], "BROADCAST_IDS", 0)
    rnd, n = random.Random(3), 200
    links = [(i, i + 1) for i in range(60)] + [(rnd.randrange(60, n), rnd.randrange(60, n)) for _ in range(150)] + [(5, 5), (3, 4), (4, 3), (None, 7)]
    found = sorted(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = classes(n, [x for x in links if None not in x])
    assert found == [(i, c) for i, c in enumerate(want) if i != c]


def tasks_of(spark, work):
    """How many tasks `work` runs."""
    group = f"counted-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    return sum(x.numCompletedTasks for x in map(tracker.getStageInfo, stages) if x)


def test_stars_need_no_round(spark):
    stars = spark.createDataFrame([(i, i % 5) for i in range(50)], "a long, b long").coalesce(1)
    found = []
    n = tasks_of(spark, lambda: found.extend(components(stars).collect()))
    assert {tuple(r) for r in found} == {(i, i % 5) for i in range(5, 50)}
    assert n <= 10


# Texts


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def changed(rnd, text, n):
    words = text.split()
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"w{rnd.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("like", [minhash.Likeness(3, 85, 100), minhash.Likeness()])
def test_near_duplicates(spark, monkeypatch, like):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "BESIDE", 3)
    monkeypatch.setattr(minhash, "BROADCAST_IDS", 0 if like.size == 3 else 10**6)
    rnd = random.Random(7)
    text = lambda n: " ".join(f"v{rnd.randrange(400)}" for _ in range(n))
    texts = [None, "", " \n", "a", "A", "a b", "b a", "a b c", "x" * 5000, "é É"]
    for n in (40, 200, 1000):
        first = text(n)
        chain = first
        for k in range(14):
            texts += [changed(rnd, first, rnd.randrange(0, max(2, n // 40))), chain.upper()]
            chain = changed(rnd, chain, max(1, n // 120))
    texts += [text(100) for _ in range(30)] + [texts[12]] * 20
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    order = sorted(range(len(texts)), key=lambda i: ids[i])
    texts = [texts[i] for i in order]
    sets = [shingles(t, like.size) for t in texts]
    alike = lambda a, b: a and b and like.below * len(a & b) >= like.above * len(a | b)
    links = [(i, j) for i in range(len(texts)) for j in range(i) if alike(sets[i], sets[j])]
    want = classes(len(texts), links)
    assert 10 < len(set(want)) < len(texts) - 20
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[20], "y"), (None, None, "y")], "doc_id long, text string, band string").repartition(5)
    rows = minhash.near_duplicates(docs, like).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert minhash.near_duplicates(docs.limit(0), like).count() == 0


def test_near_duplicates_over_many_partitions(spark):
    """Of few documents most tasks are empty: each table and each exchange costs as many as there are partitions."""
    rnd = random.Random(4)
    texts = []
    for _ in range(12):
        texts.append(" ".join(f"v{rnd.randrange(300)}" for _ in range(120)))
        for _ in range(5):
            texts.append(changed(rnd, texts[-1], 2))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    like, held = minhash.Likeness(3, 85, 100), {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    found = []
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        n = tasks_of(spark, lambda: found.extend(minhash.near_duplicates(docs, like).collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sets = [shingles(t, 3) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(classes(len(texts), links)))
    assert n <= 60 * 20


def test_estimates_and_losses():
    rng = np.random.default_rng(8)
    for like in (minhash.Likeness(3, 85, 100), minhash.Likeness()):
        s = like.above / like.below
        assert (1 - s**like.rows) ** (minhash.HASHES // like.rows) <= minhash.MISSED
        worst = []
        for _ in range(60):
            shared = rng.integers(0, 1 << 63, 850, dtype=np.uint64)
            more = int(850 * (1 / s - 1) / 2)
            a, b = (np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, more, dtype=np.uint64)])) for _ in range(2))
            low = minhash.low_bits(minhash.minima([a, b]))
            equal = minhash.equal_bits(low[:1], low[1:])[0, 0]
            plain = sum((int(x) >> 4 * k & 15) == (int(y) >> 4 * k & 15) for x, y in zip(*low) for k in range(16))
            assert equal == plain
            worst.append((equal / minhash.HASHES - 1 / 16) / (15 / 16))
            assert equal >= like.matches()
            wide = minhash.low_bits(minhash.minima([a, b], minhash.WIDE))
            assert minhash.equal_bits(wide[:1], wide[1:])[0, 0] >= like.matches(minhash.WIDE)
        assert abs(np.mean(worst) - s) < 0.02


# Vectors


@pytest.mark.parametrize("small_blocks", [False, True])
def test_vectors(spark, monkeypatch, small_blocks):
    if small_blocks:
        monkeypatch.setattr(embeddings, "BLOCK", 7)
        monkeypatch.setattr(embeddings, "SMALL", 3)
    rng = np.random.default_rng(9)
    rows = []
    for label in (0, 1, None):
        for _ in range(12):
            centre = rng.standard_normal(16)
            for _ in range(rng.integers(1, 25)):
                rows.append((centre + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.25, 0.35]), label))
    rows += [(np.full(16, np.nan), 0), (np.zeros(16), 0), (np.full(16, np.inf), 1), (rows[0][0][:8], 0), (rows[0][0] * 3, 0)]
    rows = [([float(np.float32(x)) for x in v], label) for v, label in rows] + [(None, 0), ([], 0), ([1.0, None], 1)]
    n = len(rows)
    links = []
    for i, (v, a) in enumerate(rows):
        for j in range(i):
            w, b = rows[j]
            if a is None or a != b or not v or not w or len(v) != len(w) or None in v or None in w:
                continue
            if not all(map(math.isfinite, v + w)) or not any(v) or not any(w):
                continue
            if np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.93:
                links.append((i, j))
    want, degree = classes(n, links), np.bincount(np.array(links).ravel(), minlength=n)
    data = [(i, v, label, 1) for i, (v, label) in enumerate(rows)]
    table = spark.createDataFrame([*data, (None, rows[0][0], 0, 1)], "vec_id long, embedding array<float>, label int, n int").repartition(3)
    found = embeddings.near_duplicates(table).collect()
    assert len(found) == n + 1
    for r in found:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (degree[r.vec_id], want[r.vec_id], want[r.vec_id] == r.vec_id), rows[r.vec_id]
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


def test_tables_keep_the_loss_at_any_size():
    for largest in (1, 10**3, 10**6, 10**10):
        bits, tables = embeddings.plan(largest, 0.93)
        assert (1 - (1 - math.acos(0.93) / math.pi) ** bits) ** tables <= embeddings.MISSED


def test_low_bits_of_different_elements_agree_by_chance():
    one, other = (np.array([x], np.uint64) for x in (0x1230, 0x9871))
    for a, b in ((one, other), (one, one + np.uint64(16))):
        low = minhash.low_bits(minhash.minima([a, b], minhash.WIDE))
        assert abs(minhash.equal_bits(low[:1], low[1:])[0, 0] - minhash.WIDE / 16) < 60


# Licenses


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT"][2]
    texts = [
        None, "", "é. Licensed under CC BY-NC 4.0. é", "licensed under cc by nc sa 4.0", "Licensed under the Foo License.", "All rights reserved",
        f"Copyright X. {mit} And more.", mit.replace("any person", "each single person").replace("without restriction, ", ""), " ".join(mit.split()[:20]),
        "Released under the\n * MIT License.\n" * 50, "word " * 3000 + "This work is licensed under the GNU General Public License, version 3.",
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, matches string")
    rows = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert [list(rows[i].licenses) for i in range(len(texts))] == [[], [], ["CC-BY-NC-4.0"], [], [], ["Proprietary"], ["MIT"], ["MIT"], [], ["MIT"], ["GPL-3.0"]]
    for i, t in enumerate(texts):
        for m in rows[i].matches:
            assert t[m.begin : m.end].lower().startswith(("licensed", "all", "permission", "released", "this"))
    assert texts[2][rows[2].matches[0].begin : rows[2].matches[0].end] == "Licensed under CC BY-NC 4.0"
    assert rows[6].matches[0].coverage == 1 and 0.9 < rows[7].matches[0].coverage < 1 and len(rows[9].matches) == 50
    assert licenses.scan(docs.limit(0)).count() == 0


def test_each_template_is_found_inside_a_text():
    rnd = random.Random(11)
    few = {"One": ["Copyleft"], "Two": ["Public domain."], "Three": ["No rights reserved."]}
    for templates in (licenses.TEMPLATES, few):
        index = licenses.Index(templates)
        for name, notices in templates.items():
            for notice in notices:
                copies = 12 if len(notice) < 2000 else 1
                texts = [" ".join([*(f"w{rnd.randrange(10**9)}" for _ in range(9)), notice, *(f"w{rnd.randrange(10**9)}" for _ in range(9))]) for _ in range(copies)]
                found = index.matches(split(pa.array([notice, *texts]), LETTERS))
                assert [(i, m.license) for i, m in found] == [(i, name) for i in range(copies + 1)], notice[:200]
    twice = licenses.Index(few).matches(split(pa.array(["copyleft copyleft", "public domain public domain"]), LETTERS))
    assert [(i, m.begin, m.end) for i, m in twice] == [(0, 0, 1), (0, 1, 2), (1, 0, 2), (1, 2, 4)]
    # Words of one text and the next are no notice.
    assert licenses.Index(few).matches(split(pa.array(["public", "domain", "no rights", "reserved"]), LETTERS)) == []


GNU_HEADER = (
    "This {} is free software; you can redistribute it and/or\n * modify it under the terms of the {} as published by the Free Software Foundation; "
    "either\n * version {} of the License, or (at your option) any later version.\n"
)


def test_words_that_tell_licenses_apart():
    general, lesser, affero = (f"GNU {x}General Public License" for x in ("", "Lesser ", "Affero "))
    sentence = "x This work is licensed under the {}, version {}. y"
    cases = [
        (GNU_HEADER.format("program", general, "2"), ["GPL-2.0"]), (GNU_HEADER.format("program", general, "3"), ["GPL-3.0"]),
        (GNU_HEADER.format("library", lesser, "2.1"), ["LGPL-2.1"]), (GNU_HEADER.format("program", lesser, "3"), ["LGPL-3.0"]),
        (GNU_HEADER.format("library", "GNU Library General Public License", "2"), ["LGPL-2.0"]),
        (GNU_HEADER.format("program", affero, "3"), ["AGPL-3.0"]), (GNU_HEADER.format("program", general, "3.0"), ["GPL-3.0"]),
        (GNU_HEADER.format("program", general, "7"), []), (GNU_HEADER.format("program", "Foo Public License", "3"), []),
        (sentence.format(lesser, "2.1"), ["LGPL-2.1"]), (sentence.format(general, "2.1"), []), (sentence.format(general, "3.0"), ["GPL-3.0"]),
        (sentence.format(general, "2") + sentence.format(general, "3"), ["GPL-2.0", "GPL-3.0"]), (sentence.format(affero, "3"), ["AGPL-3.0"]),
        ("This Source Code Form is subject to the terms of the Foo Public License, v. 2.0.", []),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", []),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ["MPL-2.0"]),
    ]
    bsd2, bsd3 = licenses.TEMPLATES["BSD-2-Clause"][0], licenses.TEMPLATES["BSD-3-Clause"][0]
    cases += [(f"x {bsd2} y", ["BSD-2-Clause"]), (f"x {bsd3.replace('copyright holder', 'author')} y", ["BSD-3-Clause"])]
    bodies = {n: t[-1] for n, t in licenses.TEMPLATES.items() if len(t[-1]) > 5000}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"} == set(bodies)
    cases += [(f"z {bodies[name][:-1500]} z", [name]) for name in ("Apache-2.0", "GPL-2.0", "GPL-3.0")]
    cases += [(f"z {body} z", [name]) for name, body in bodies.items()]
    # A full Affero license differs in few words, which all tell.
    cases.append((bodies["GPL-3.0"].replace("GNU General", "GNU Affero General").replace("GNU GENERAL", "GNU AFFERO GENERAL"), []))
    found = licenses.Index(licenses.TEMPLATES).matches(split(pa.array([t for t, _ in cases]), LETTERS))
    for i, (text, want) in enumerate(cases):
        assert [m.license for j, m in found if j == i] == want, (text[:200], want)


def test_alignment_takes_the_shortest_part():
    notice = licenses.TEMPLATES["ISC"][0]
    found = licenses.Index(licenses.TEMPLATES).matches(split(pa.array([f"{notice} {notice}"]), LETTERS))
    assert [(m.begin, m.end) for _, m in found] == [(0, 34), (34, 68)]


def test_alignment_is_the_longest_common_sequence():
    rnd = random.Random(10)
    for _ in range(60):
        own = [f"t{rnd.randrange(9)}" for _ in range(rnd.randrange(12, 40))]
        text = [w for w in own if rnd.random() > 0.05]
        for _ in range(rnd.randrange(3)):
            text.insert(rnd.randrange(len(text) + 1), "new")
        whole = ["x"] * 5 + text + ["y"] * 5
        index = licenses.Index({"T": [" ".join(own)]}, 0.5)
        match = index._align(split(pa.array([" ".join(whole)]), LETTERS).hash, 0, 5, 5, 0, len(whole))
        best = [[0] * (len(whole) + 1) for _ in range(len(own) + 1)]
        for i, a in enumerate(own):
            for j, b in enumerate(whole):
                best[i + 1][j + 1] = best[i][j] + 1 if a == b else max(best[i][j + 1], best[i + 1][j])
        assert match is not None and match.words == best[-1][-1]


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_scan_finds_what_whole_alignments_find(spark):
    """Altered templates among other words: found where the most words in order, over the whole text, are four fifths."""
    rnd = random.Random(21)
    templates = {f"T{k}": [" ".join(f"t{k}w{rnd.randrange(60)}" for _ in range(rnd.choice([14, 30, 80])))] for k in range(6)}
    texts = []
    for _ in range(80):
        parts = []
        for name in rnd.sample(sorted(templates), rnd.randrange(3)):
            words = templates[name][0].split()
            for _ in range(rnd.randrange(len(words) // 4)):
                at = rnd.randrange(len(words))
                words[at : at + rnd.randrange(2)] = ["other"] * rnd.randrange(2)
            parts += [f"f{rnd.randrange(900)}" for _ in range(rnd.randrange(30))] + words
        texts.append(" ".join([*parts, "end"]))
    texts += [texts[0], "", None]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, matches string, n_licenses int")
    found = {r.doc_id: r.licenses for r in licenses.scan(docs, templates).collect()}
    wanted = 0
    for i, text in enumerate(texts):
        words = (text or "").split()
        share = {name: longest_common(t.split(), words) / len(t.split()) for name, (t,) in templates.items()}
        assert found[i] == sorted(n for n, s in share.items() if s >= licenses.COVERAGE - 1e-9), (i, share)
        wanted += len(found[i])
    assert wanted > 40 and found[0] == found[80]
