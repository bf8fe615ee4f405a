"""The near-duplicate stage decides by row, not by id."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from siltbed.llm import stages


@pytest.mark.parametrize("stage", [stages.keep_one_of_each_near_group, stages.keep_one_of_each_group])
def test_exactly_one_row_of_each_group_stays(spark, stage):
    rng = random.Random(4)
    a, b, c, d, e, f = (" ".join(f"w{rng.randrange(5000)}" for _ in range(300)) for _ in range(6))
    rows = [
        (0, a, "x"), (0, b, "x"), (0, c, "x"),  # one default id on unrelated texts
        (5, a + " end", "x"),  # near copy of a row of a repeated id
        (None, d, "x"), (None, d + " end", "x"), (None, d, "x"),  # a group without ids
        (None, e, "x"), (7, e + " end", "x"),  # a group with one id
        (9, f, "x"), (9, f, "x"), (9, f, "w"),  # whole copies
        (None, None, "x"), (None, "", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = Counter(map(tuple, stage(docs).collect()))
    assert got == Counter(
        [(0, a, "x"), (0, b, "x"), (0, c, "x"), (None, d, "x"), (7, e + " end", "x"), (9, f, "w"), (None, None, "x")]
    )
