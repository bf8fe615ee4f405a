"""Small document tables that hold the awkward cases."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int, size: int = 300) -> str:
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(5, 120)) for _ in range(40)]
    texts += [texts[0], texts[1], texts[1] + " tail", None, "", " ", "\n\n", "word", "a b", "x" * 3000]
    texts += [texts[2] + "\n" + texts[3], "same " * 400, texts[4][:200] + texts[5], prose(rng, 9000)]
    texts += ["  two  spaces \n and\ttabs\x0b\x85 here ", "ünï cödé 😀😀 größe " * 9, "A B C d", "a b c D"]
    texts += ["a <|endoftext|>b", "<|endoftext|>", " <|endoftext|>  x <|endoftext|", "w1 <|endoftext|> w2 w3"]
    rows = [(i * 7 % 101, t, "en", f"src{i % 3}" if i % 5 else None, 0) for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
