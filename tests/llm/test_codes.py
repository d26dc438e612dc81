"""Vector codes against a plain computation over all vectors."""

import hashlib
import math
import random

import numpy as np
import pytest

from shopstrata.llm import codes


def plain(rows, parts, entries, rounds):
    def fine(e):
        return e is not None and all(x is not None and math.isfinite(x) for x in e)

    kept = [(i, label, [math.floor(4096 * x) for x in e]) for i, e, label in rows if fine(e)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    length = next((len(v) for _, _, v in order if v and len(v) % parts == 0), None)
    if length is None:
        return None, []
    w = length // parts
    alike = [r for r in order if len(r[2]) == length]
    books = [[r[2][p * w : (p + 1) * w] for r in alike[:entries]] for p in range(parts)]

    def nearest(p, part):
        d = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            cut = [r[2][p * w : (p + 1) * w] for r in alike]
            near = [nearest(p, x)[0] for x in cut]
            for k in range(len(books[p])):
                if own := [x for x, n in zip(cut, near) if n == k]:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    out = []
    for i, label, v in kept:
        best = [nearest(p, v[p * w : (p + 1) * w]) for p in range(parts)] if len(v) == length else None
        out.append((i, label, "".join(f"{k:02x}" for k, _ in best) if best else None, sum(d for _, d in best) if best else None))
    sums = {label: sum(e for _, x, _, e in out if x == label and e is not None) if any(x == label and e is not None for _, x, _, e in out) else None for _, label, _, _ in out}
    return books, [(*r, sums[r[1]]) for r in out]


def vectors(n, dims, rnd, levels=None):
    value = (lambda: rnd.choice(levels)) if levels else (lambda: rnd.gauss(0, 0.2))
    return [(i, [np.float32(value()).item() for _ in range(dims)], rnd.choice([0, 1, None])) for i in range(n)]


def strange(rnd):
    rows = vectors(120, 16, rnd) + vectors(60, 16, rnd, [0.0, 0.25, -0.25, -0.0])
    rows += [(500, None, 1), (501, [0.1] * 15 + [None], 1), (502, [math.nan] * 16, 0), (503, [math.inf] + [0.0] * 15, 0), (504, [], 0)]
    rows += [(505, [0.5] * 8, 7), (506, [0.3] * 15, None), (None, [0.2] * 16, None), (7, [0.1] * 16, 0)] + [(8, [1e-5 * -1] * 16, 2)] * 3
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("leaves", [4096, 5])
@pytest.mark.parametrize("kind", ["strange", "few values", "fewer vectors than entries"])
def test_codes(spark, monkeypatch, kind, leaves):
    monkeypatch.setattr(codes, "LEAVES", leaves)
    rnd = random.Random(4)
    rows = {"strange": strange(rnd), "few values": vectors(200, 8, rnd, [0.0, 0.5, 1.0]), "fewer vectors than entries": vectors(5, 8, rnd)}[kind]
    df = spark.createDataFrame([(*r, "x", 1.5) for r in rows], "vec_id long, embedding array<float>, label int, code string, `values` double")
    parts = 4
    found = codes.compressed(df, parts, 16, 3).collect()
    books, want = plain(rows, parts, 16, 3)
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted(((r.vec_id, r.label, r.code, r.error, r.label_error) for r in found), key=key) == sorted(want, key=key)
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    assert {r.codebooks_sha256 for r in found} == {digest}


def test_empty_tables_and_nothing_to_cut(spark):
    fields = "vec_id long, embedding array<float>, label int"
    assert codes.compressed(spark.createDataFrame([], fields)).count() == 0
    (row,) = codes.compressed(spark.createDataFrame([(1, [0.5] * 7, 1)], fields)).collect()
    assert (row.vec_id, row.code, row.error, row.label_error) == (1, None, None, None)
    with pytest.raises(Exception, match="beyond"):
        codes.compressed(spark.createDataFrame([(1, [1e9] * 8, 1)], fields)).collect()


@pytest.mark.parametrize("leaves", [1, 3, 1000])
def test_a_walk_finds_the_nearest_entries(monkeypatch, leaves):
    monkeypatch.setattr(codes, "LEAVES", leaves)
    rnd = np.random.default_rng(2)
    rows, book = np.unique(rnd.integers(-4, 5, (300, 4)), axis=0), rnd.integers(-4, 5, (16, 4))
    near, far = codes._walk(rows, book)
    every = ((rows[:, None, :] - book[None]) ** 2).sum(2)
    assert (near == every.argmin(1)).all() and (far == every.min(1)).all()
