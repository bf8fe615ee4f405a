"""Toxicity scores: FTRL-proximal logistic regression over hashed words, n-grams and skip-grams.

Features are the distinct words, neighbouring pairs and pairs over one word, hashed to
2^20 places. Per-coordinate learning rates let rare features move while common ones settle,
and the L1 penalty keeps weights at zero until the evidence is enough, so the model is a
short list of weights that is sent to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.words import WordBatch, combine, mix, slices


@dataclass(frozen=True)
class Settings:
    """Training parameters. ``most_rows`` bounds the sample of labelled rows that is learned from."""

    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.1
    epochs: int = 5
    most_rows: int = 8000
    seed: int = 7


def features(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each text: all places, and where each text's begin.

    Words are compared in lower case and by their letters and digits alone.
    """
    words = WordBatch(texts)
    plain = pc.utf8_lower(pc.replace_substring_regex(words.distinct, "[^\\p{L}\\p{N}]+", ""))
    h = np.fromiter((xxhash.xxh64_intdigest(w) for w in plain.to_pylist()), dtype=np.uint64, count=len(plain))
    single = h[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    rows = np.repeat(np.arange(len(words.offsets) - 1), words.counts())
    found, owners = [mix(single)], [rows]
    for gap in (1, 2):
        same = rows[gap:] == rows[:-gap]
        found.append(combine(single[:-gap][same] + np.uint64(gap), single[gap:][same]))
        owners.append(rows[:-gap][same])
    places = (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)
    keys = np.unique((np.concatenate(owners) << bits) | places)
    return keys & ((1 << bits) - 1), np.searchsorted(keys, np.arange(len(words.offsets)) << bits)


class Ftrl:
    """FTRL-proximal with one state per coordinate; binary features."""

    def __init__(self, settings: Settings):
        self.s = settings
        self.z = np.zeros(1 << settings.bits)
        self.n = np.zeros(1 << settings.bits)
        self.bias_z = self.bias_n = 0.0

    def weights(self, at: np.ndarray) -> np.ndarray:
        s, z = self.s, self.z[at]
        step = (s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2
        return np.where(np.abs(z) > s.l1, -(z - np.sign(z) * s.l1) / step, 0.0)

    def bias(self) -> float:
        return -self.bias_z / ((self.s.beta + self.bias_n**0.5) / self.s.alpha)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        b = self.bias()
        g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - label
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.s.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g
        move = ((self.bias_n + g * g) ** 0.5 - self.bias_n**0.5) / self.s.alpha
        self.bias_z += g - move * b
        self.bias_n += g * g


def chosen_rows(docs: DataFrame, known: DataFrame, settings: Settings) -> DataFrame:
    """(order, text, label) of a bounded, seeded sample of the labelled rows.

    ``docs`` has (id, text), ``known`` (id, label). The sample is at most
    ``settings.most_rows`` labels, by a digest of the id, of ids that some document has; only
    then are texts fetched, the smallest where rows share an id, so no other text moves.
    """
    order = F.xxhash64("id", F.lit(settings.seed))
    there = known.where(F.col("label").isNotNull()).join(docs.select("id"), "id", "left_semi")
    keys = there.withColumn("order", order).orderBy("order", "id", "label").limit(settings.most_rows)
    # At most ``most_rows`` ids and labels, whatever the size of the tables.
    keys = F.broadcast(keys)
    texts = docs.join(keys.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    return texts.join(keys, "id").select("order", "text", "label")


def train(sample: DataFrame, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights and bias learned from the rows of ``chosen_rows``.

    They become features on the executors; one task learns from these. What returns is
    sparse and has at most 2^bits entries.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            places, bounds = features(pc.fill_null(part.column(1), ""), settings.bits)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(places, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), lists], names=["order", "label", "places"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (label, np.array(row.values, dtype=np.int32))
            for batch in batches
            for label, row in zip(batch.column(1).to_pylist(), batch.column(2))
        ]
        model = Ftrl(settings)
        rng = np.random.default_rng(settings.seed)
        for _ in range(settings.epochs):
            for i in rng.permutation(len(rows)):
                model.learn(rows[i][1], rows[i][0])
        weights = model.weights(np.arange(1 << settings.bits))
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(weights[at], model.bias()))], names=["place", "weight"]
        )

    learned = (
        sample.mapInArrow(extract, "order long, label int, places array<int>")
        .repartition(1)
        .sortWithinPartitions("order", "label", "places")
        .mapInArrow(fit, "place long, weight double")
        .toPandas()
    )
    weights = np.zeros(1 << settings.bits)
    inside = learned.place >= 0
    weights[learned.place[inside].to_numpy()] = learned.weight[inside].to_numpy()
    return weights, float(learned.weight[~inside].sum())


def score(docs: DataFrame, weights: np.ndarray, bias: float, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score) of every row; a text without known features scores as the bias says."""
    bits = len(weights).bit_length() - 1
    at = np.flatnonzero(weights)
    model = docs.sparkSession.sparkContext.broadcast((at, weights[at], bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, bias = model.value
        table = np.zeros(1 << bits)
        table[at] = values
        for part in slices(batches, 1):
            places, bounds = features(pc.fill_null(part.column(1), ""), bits)
            # Summed text by text, so that equal texts have equal scores wherever they stand.
            sums, some = np.zeros(part.num_rows), np.diff(bounds) > 0
            if some.any():
                sums[some] = np.add.reduceat(table[places], bounds[:-1][some])
            margin = np.clip(sums + bias, -35, 35)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(1 / (1 + np.exp(-margin)))], names=[id, "score"]
            )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(run, f"`{id}` {kind}, score double")


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    settings: Settings = Settings(),
    threshold: float = 0.3,
) -> DataFrame:
    """Score every document; labels are learned only from rows that are not held out.

    A row is held out where crc32 of its id as text, modulo 4, is 2. Null text is empty.
    Rows may repeat; of those that share an id the smallest text is learned from. Null ids
    are scored and never learned from; null labels are not learned from. Without any labels
    every score is one half. Further columns are not read.
    """
    held_out = F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2
    known = labels.where(~held_out).select(F.col(id).alias("id"), F.col(label).cast("int").alias("label"))
    texts = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    weights, bias = train(chosen_rows(texts, known, settings), settings)
    scored = score(docs, weights, bias, id, text)
    return scored.select(
        id,
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
