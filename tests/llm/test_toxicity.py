import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from scolaria.llm.toxicity import Features, Ftrl, Settings, held_out, score_documents, sigmoid, train, without_toxic
from tests.llm.conftest import CLASHES, ODD


def corpus(n=700):
    r = random.Random(6)
    words = [f"plain{r.randrange(300)}" for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.choice([4, 30, 200]))]
        bad = r.random() < 0.2
        if bad:
            for _ in range(3):
                text.insert(r.randrange(len(text)), r.choice(["vile", "foulness", "Foul"]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_held_out_fold_learned_from_the_rest(spark, docs_of):
    rows, labels = corpus()
    truth = {i: toxic for i, _, toxic in labels}
    got = score_documents(docs_of(rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    fold = [r for r in got if r.held_out]
    assert np.mean([r.predicted == truth[r.doc.doc_id] for r in fold]) > 0.95


def test_only_text_and_learning_labels_count(spark, docs_of):
    """Held-out labels, and the columns beside the text, change no score."""
    rows, labels = corpus(200)
    table = docs_of(rows)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    scores = lambda docs, labels: {r.doc.doc_id: r.score for r in score_documents(docs, spark.createDataFrame(labels, LABELS)).collect()}
    assert scores(table, labels) == scores(table.selectExpr("doc_id", "text", "'xx' AS lang", "'s' AS source"), turned)


def test_odd_rows(spark, docs_of):
    rows, labels = corpus(200)
    pairs = [*((i + 100, t) for i, t in rows), *ODD]
    labels = [*((i + 100, q, t) for i, q, t in labels), (1, 0, None), (None, 0, 1), (4, 1, 0), (4, 1, 1), (777, 1, 1)]
    got = score_documents(docs_of(pairs, *CLASHES), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(pairs)
    by_text = {}
    for r in got:
        by_text.setdefault(r.doc.text or "", set()).add(r.score)
    assert all(len(found) == 1 for found in by_text.values())
    assert [r.held_out for r in got if r.doc.doc_id is None] == [False]
    kept = without_toxic(docs_of(pairs, *CLASHES), spark.createDataFrame(labels, LABELS))
    assert set(CLASHES) <= set(kept.columns)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc.doc_id) for r in got if not r.predicted)


def test_no_rows(spark, docs_of):
    none = spark.createDataFrame([], LABELS)
    assert score_documents(docs_of([]), none).collect() == []
    assert [r.score for r in score_documents(docs_of([(1, "a"), (2, None)]), none).collect()] == [0.5, 0.5]


def test_sample_is_bounded_and_the_same_again(spark, docs_of):
    rows, labels = corpus(300)
    table, marks = docs_of(rows), spark.createDataFrame(labels, LABELS)
    first, again = (train(table.repartition(n), marks, max_rows=50) for n in (2, 5))
    assert np.array_equal(first.features, again.features) and np.array_equal(first.values, again.values) and first.bias == again.bias
    assert len(first.features) < len(train(table, marks, Settings(l1=0.01), max_rows=50).features)


def test_step_against_the_formula():
    """One coordinate by hand: z and n after two rows, and the weight they give."""
    s = Settings(alpha=0.5, beta=1.0, l1=0.1, l2=0.2, positive_weight=1.0)
    model, at = Ftrl(s, bits=2), np.array([3])
    z = n = w = 0.0
    for label in (1, 0, 1):
        gradient = sigmoid(2 * w) - label  # the feature and the bias have the same weight
        sigma = ((n + gradient**2) ** 0.5 - n**0.5) / s.alpha
        z, n = z + gradient - sigma * w, n + gradient**2
        w = 0.0 if abs(z) <= s.l1 else ((s.l1 if z > 0 else -s.l1) - z) / ((s.beta + n**0.5) / s.alpha + s.l2)
        model.learn(at, label)
        assert model.weights(at)[0] == pytest.approx(w)


def test_features():
    features = Features()
    assert len(features.of("a b c")) == 9  # three words, their stems, two pairs, one skip pair
    assert len(features.of(None)) == len(features.of("1 2 !")) == 0
    assert np.array_equal(features.of("A b"), features.of("a, B 7"))


def test_fold_of_a_null_id(spark):
    frame = spark.createDataFrame([(None,), (5,)], "doc_id long")
    assert [r[0] for r in frame.select(held_out(frame.doc_id)).collect()] == [None, zlib.crc32(b"5") % 5 == 0]


def plain_features(text):
    """Feature numbers of a text, by Python's own integers."""
    full, words = (1 << 64) - 1, re.findall(r"[^\W\d_]+", (text or "").lower())
    whole = [xxhash.xxh64_intdigest(w, 1) for w in words]
    stems = [xxhash.xxh64_intdigest(w[:5], 2) for w in words]
    pairs = [(a * 0x9E3779B97F4A7C15 & full) ^ b for a, b in zip(whole, whole[1:])]
    skips = [(a * 0xC2B2AE3D27D4EB4F & full) ^ b for a, b in zip(whole, whole[2:])]
    return {((h ^ h >> 29) * 0x9E3779B97F4A7C15 & full) >> 42 for h in whole + stems + pairs + skips}


def plain_scores(rows, labels, at, settings):
    """FTRL-proximal over dictionaries, a coordinate at a time, in the operator's order of rows."""
    truth = {}
    for i, _, toxic in labels:
        truth[i] = max(toxic, truth.get(i, 0))
    sample = [(plain_features(text), truth[i]) for i, text in sorted(rows, key=lambda row: at[row[0]]) if i in truth and zlib.crc32(str(i).encode()) % 5]
    z, n = {}, {}

    def weight(k):
        if abs(z.get(k, 0.0)) <= settings.l1:
            return 0.0
        return (math.copysign(settings.l1, z[k]) - z[k]) / ((settings.beta + math.sqrt(n[k])) / settings.alpha + settings.l2)

    def score(features):
        return 1 / (1 + math.exp(-max(-60, min(60, sum(weight(k) for k in [*features, "bias"])))))

    order = np.random.default_rng(7)
    for _ in range(settings.epochs):
        for i in order.permutation(len(sample)):
            features, label = sample[i]
            gradient = (score(features) - label) * (settings.positive_weight if label else 1.0)
            for k, w in [(k, weight(k)) for k in [*features, "bias"]]:
                sigma = (math.sqrt(n.get(k, 0.0) + gradient**2) - math.sqrt(n.get(k, 0.0))) / settings.alpha
                z[k] = z.get(k, 0.0) + gradient - sigma * w
                n[k] = n.get(k, 0.0) + gradient**2
    return {i: score(plain_features(text)) for i, text in rows}


def test_training_against_a_plain_loop(spark, docs_of):
    rows, labels = corpus(250)
    labels += [(labels[0][0], 1, 1)]
    at = {r[0]: r[1] for r in spark.range(250).selectExpr("id", "xxhash64(id)").collect()}
    settings = Settings(l1=0.5, epochs=3)
    got = {r.doc.doc_id: r.score for r in score_documents(docs_of(rows), spark.createDataFrame(labels, LABELS), settings).collect()}
    want = plain_scores(rows, labels, at, settings)
    assert got == pytest.approx(want, abs=1e-5) and max(want.values()) > 0.9 > 0.1 > min(want.values())
