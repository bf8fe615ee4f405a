"""Ball k-means against plain k-means in Python's whole numbers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from siltbed.llm.vector_codes import nearest, part_bounds, vector_codes


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """(id, code, error, label_error, digest) of (id, vector, label) rows."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1])
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in kept if len(v) == size]
    bounds = part_bounds(size, parts)
    books = [[q[a:b] for _, q, _ in kept[:entries]] for a, b in bounds]

    def assign(q):
        best = []
        for (a, b), book in zip(bounds, books):
            best.append(min((sum((x - y) ** 2 for x, y in zip(q[a:b], e)), k) for k, e in enumerate(book)))
        return best

    for _ in range(rounds):
        chosen = [assign(q) for _, q, _ in kept]
        for p, (a, b) in enumerate(bounds):
            for k in range(len(books[p])):
                mine = [q[a:b] for (_, q, _), c in zip(kept, chosen) if c[p][1] == k]
                if mine:
                    books[p][k] = [sum(xs) // len(mine) for xs in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out = [(i, assign(q), label) for i, q, label in kept]
    total = {}
    for _, c, label in out:
        total[label] = total.get(label, 0) + sum(d for d, _ in c)
    return [(i, "".join(f"{k:02x}" for _, k in c), sum(d for d, _ in c), total[label], digest) for i, c, label in out]


SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(rng, n, size, steps=8):
    """Coarse components, so that equal distances are frequent."""
    return [(i, [rng.randrange(-steps, steps) / 32 for _ in range(size)], rng.choice([None, 0, 1])) for i in range(n)]


@pytest.mark.parametrize("n,size", [(300, 32), (500, 64), (40, 16), (90, 40)])
def test_equals_plain_k_means(spark, n, size):
    rows = vectors(random.Random(n), n, size)
    got = vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(map(tuple, got.collect())) == sorted(plain_codes(rows))


def test_awkward_rows(spark):
    rng = random.Random(3)
    rows = [(i * 5 % 97, v, label) for i, v, label in vectors(rng, 97, 16)]
    rows += [rows[3], rows[3], (4, rows[5][1], None), (None, rows[7][1], 2), (None, rows[8][1], 2)]
    rows += [(-9, None, 0), (-8, [], 0), (-7, [None] + [0.0] * 15, 0), (-6, [float("nan")] * 16, 0), (-5, [float("-inf")] * 16, 0)]
    rows += [(200, [0.5] * 7, 1)]
    wide = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", code string, q int")
    got = vector_codes(wide.repartition(4))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_codes(rows), key=repr)
    none = vector_codes(wide.where("vec_id < 0"))
    assert none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and none.count() == 0


def test_huge_components_do_not_overflow(spark):
    rows = [(i, [3e38 * (-1) ** i] * 16, 0) for i in range(4)]
    assert [r["error"] for r in vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()] == [0] * 4


def test_balls_save_distances_and_find_the_nearest():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (64, 4))
    centres[9] = centres[5]
    code = rng.integers(0, 64, 5000)
    x = centres[code] + rng.integers(-200, 200, (5000, 4))
    found, d, taken = nearest(x, centres, code)
    whole = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (found == whole.argmin(axis=1)).all() and (d == whole.min(axis=1)).all()
    assert taken < 3 * len(x)
    # From a wrong start the answer is the same.
    again, _, _ = nearest(x, centres, np.zeros(5000, np.int64))
    assert (again == found).all()
