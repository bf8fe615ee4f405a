"""Comparisons are given up early also when every query is among the values."""

from __future__ import annotations

import numpy as np

from siltbed.llm import simhash


def test_words_beyond_the_radius_are_abandoned(monkeypatch):
    left = []
    plain = simhash.open_words

    def counted(beyond):
        live = plain(beyond)
        left.append(len(live))
        return live

    monkeypatch.setattr(simhash, "open_words", counted)
    values = np.random.default_rng(7).integers(0, 1 << 63, 1000, dtype=np.uint64)
    values[900:] = values[:100] ^ np.uint64(5)
    a, b = simhash.within_radius(values, values, 3)
    want = {(i, j) for i, x in enumerate(values.tolist()) for j, y in enumerate(values.tolist()) if (x ^ y).bit_count() <= 3}
    assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want)
    # Of 16 words a query, its own stays, and that of its near copy for 200 of 1000.
    assert left[-1] <= 1200
