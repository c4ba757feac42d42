"""Toxicity: logistic regression over hashed word n-grams and skip-grams, trained by FTRL-proximal."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.llm.shared import document_columns, drop_kept, whole_rows, written

WORD = re.compile(r"[^\W\d_]+")
BITS = 22
STEM = 5
MAX_ROWS = 20_000
MAX_WORDS_KEPT = 300_000  # some 60 MB


@dataclass(frozen=True)
class Settings:
    """alpha, beta: learning rate of a coordinate, alpha / (beta + root of its summed squared gradients). l1 sets weights
    to zero, l2 shrinks them. positive_weight: how much a toxic row counts. epochs: passes over the sample."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    positive_weight: float = 3.0
    epochs: int = 8


class _Words(dict):
    """word -> its number; hashes has the hash of the word and that of its first letters at this number."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes = np.empty((1 << 14, 2), np.uint64)

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        if number == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)])
        self.hashes[number] = xxhash.xxh64_intdigest(word, 1), xxhash.xxh64_intdigest(word[:STEM], 2)
        return number


class Features:
    """The features of a text, each once: words, their first STEM letters, pairs of neighbours, pairs with one word between."""

    def __init__(self, bits: int = BITS) -> None:
        self.shift = np.uint64(64 - bits)
        self.known = _Words()

    def of(self, text: str | None) -> np.ndarray:
        words = WORD.findall((text or "").lower())
        if not words:
            return np.empty(0, np.int64)
        if len(self.known) > MAX_WORDS_KEPT:
            self.known = _Words()
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        word, stem = self.known.hashes[numbers].T
        second, third = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
        mixed = np.concatenate([word, stem, word[:-1] * second ^ word[1:], word[:-2] * third ^ word[2:]])
        mixed ^= mixed >> np.uint64(29)
        found = np.sort(((mixed * second) >> self.shift).astype(np.uint32))
        return found[np.append(True, found[1:] != found[:-1])].astype(np.int64)


class Ftrl:
    """FTRL-proximal with a rate of its own for each coordinate. Coordinate 0 of the bias lies beyond the hashed ones."""

    def __init__(self, settings: Settings, bits: int = BITS) -> None:
        self.settings = settings
        self.z = np.zeros((1 << bits) + 1)
        self.n = np.zeros((1 << bits) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        s, z = self.settings, self.z[at]
        shrunk = np.sign(z) * s.l1 - z
        return np.where(np.abs(z) <= s.l1, 0.0, shrunk / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2))

    def learn(self, features: np.ndarray, label: int) -> None:
        at = np.append(features, len(self.z) - 1)
        w = self.weights(at)
        gradient = (sigmoid(w.sum()) - label) * (self.settings.positive_weight if label else 1.0)
        sigma = (np.sqrt(self.n[at] + gradient * gradient) - np.sqrt(self.n[at])) / self.settings.alpha
        self.z[at] += gradient - sigma * w
        self.n[at] += gradient * gradient


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -60, 60))))


@dataclass(frozen=True)
class Model:
    """The weights that L1 left: their features, ascending, and values."""

    features: np.ndarray
    values: np.ndarray
    bias: float
    bits: int = BITS

    def dense(self) -> np.ndarray:
        weights = np.zeros(1 << self.bits, np.float32)
        weights[self.features] = self.values
        return weights


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), max_rows: int = MAX_ROWS, bits: int = BITS) -> Model:
    """A model of labels (doc_id, toxic) over docs (doc_id, text), from max_rows labelled rows at most, not held out.

    Rows without a label, a null id and the held-out fold are not learned from; a doc_id with several labels has the
    greatest. The sample is the max_rows labelled ids with the least hash, so it is the same in every run, and small
    enough to be broadcast. Features are made by all executors; one task then reads those of the sample, in the order of
    the hash. Without any row the model has no weights and a bias of 0.
    """

    def featured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        drop_kept()
        features = Features(bits)
        for frame in frames:
            yield pd.DataFrame({"at": frame["at"], "toxic": frame["toxic"], "features": [features.of(text).astype("<i4").tobytes() for text in frame["text"]]})

    def learned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        drop_kept()
        rows = pd.concat([pd.DataFrame(columns=["at", "toxic", "features"]), *frames])
        sample = [(np.frombuffer(bytes(f), "<i4"), int(y)) for f, y in zip(rows["features"], rows["toxic"])]
        model = Ftrl(settings, bits)
        order = np.random.default_rng(7)
        for _ in range(settings.epochs):
            for i in order.permutation(len(sample)):
                model.learn(*sample[i])
        left = np.flatnonzero(np.abs(model.z) > settings.l1)
        yield pd.DataFrame({"feature": left, "weight": model.weights(left)})

    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    ids = known.where(~held_out(F.col("doc_id"))).select("doc_id", "toxic", F.xxhash64("doc_id").alias("at"))
    ids = written(ids.orderBy("at", "doc_id").limit(max_rows))
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("at", "text", "toxic").mapInPandas(featured, "at long, toxic int, features binary")
    found = sample.repartition(1).sortWithinPartitions("at", "features").mapInPandas(learned, "feature long, weight double").toPandas().sort_values("feature")
    bias = found.loc[found["feature"] == 1 << bits, "weight"]
    found = found[found["feature"] < 1 << bits]
    return Model(found["feature"].to_numpy(), found["weight"].to_numpy(), float(bias.iloc[0]) if len(bias) else 0.0, bits)


def score_of(model: Model, docs: DataFrame, text: Column) -> Column:
    """The probability that a text is toxic; a null or empty text has that of the bias."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        drop_kept()
        features, weights, bias = Features(shared.value.bits), shared.value.dense(), shared.value.bias
        for texts in batches:
            yield pd.Series([sigmoid(float(weights[features.of(t)].sum(dtype=np.float64)) + bias) for t in texts], dtype="float64")

    return scored(text)


def score_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), max_rows: int = MAX_ROWS) -> DataFrame:
    """doc, held_out (crc32 of the id as text, modulo 5, is 0), score and predicted (1 from 0.5 on) of every row of docs.

    A null id is not held out. Equal texts have equal scores; only the text enters a score. An empty table gives an
    empty table.
    """
    rows = whole_rows(docs)
    scored = rows.select("doc", F.coalesce(held_out(F.col("doc.doc_id")), F.lit(False)).alias("held_out"), score_of(train(docs, labels, settings, max_rows), docs, F.col("doc.text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs that are not predicted toxic."""
    return document_columns(score_documents(docs, labels, **options).where(F.col("predicted") == 0).select("doc"))
