"""Attention classifier: gradients, held-out accuracy, odd input."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tidemark.llm import quality
from tidemark.llm.quality import _forward, _gradients, encode_passages, score_quality, train_quality
from tidemark.llm.queries import documents, op5_quality_classifier


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    p = {
        "encode": rng.normal(size=(5, 4)),
        "encode_bias": rng.normal(size=4),
        "value": rng.normal(size=(4, 3)),
        "gate": rng.normal(size=(4, 3)),
        "attend": rng.normal(size=3),
        "score": rng.normal(size=4),
        "score_bias": rng.normal(size=1),
    }
    x, first, y, w = rng.normal(size=(7, 5)), np.array([0, 1, 4, 7]), np.array([0, 1, 1]), np.array([2.0, 1.0, 0.5])

    def loss():
        s = _forward(p, x, first)[0]
        return -(w * (y * np.log(s) + (1 - y) * np.log(1 - s))).mean()

    g = _gradients(p, x, first, y, w)
    for name, value in p.items():
        flat = value.reshape(-1)
        for i in range(0, len(flat), 3):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-5 - g[name].reshape(-1)[i]) < 1e-5


def test_every_word_is_in_one_passage():
    texts = ["w " * 200, None, "", "a b", "x " * 64]
    features, first = encode_passages(pa.array(texts, pa.string()))
    assert np.diff(first).tolist() == [4, 1, 1, 1, 1]
    assert (features[first[1]] == 0).all() and np.isfinite(features).all()


def test_held_out_accuracy(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = op5_quality_classifier(spark, sf_dir).join(labels, "doc_id", "left").collect()
    assert len(rows) == documents(spark, sf_dir).count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.quality is not None]
    assert sum(r.predicted == r.quality for r in held) >= 0.85 * len(held)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "EPOCHS", 2)
    good, bad = "some plain words in a row here ", "$$$ ### !!! JUNK | "
    docs = spark.createDataFrame([(i, (good if i % 2 else bad) * 10, "x") for i in range(40)] + [(None, good, "x"), (41, None, None), (1, good, "y")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (None, 1), (5, None), (6, 7), (41, 1), (99, 1)], "doc_id long, quality int")
    model = train_quality(docs, labels)
    again = train_quality(docs.repartition(5), labels)
    assert all(np.allclose(model.weights[k], again.weights[k]) for k in model.weights)
    asked = spark.createDataFrame([(1, None, "a"), (1, "", "a"), (None, good, "b"), (2, good * 30_000, "c"), (2, bad * 50, "c")], "doc_id long, text string, score string")
    got = score_quality(asked, model)
    assert got.columns == ["doc_id", "text", "score"]
    scores = [r.score for r in got.collect()]
    assert scores[0] == scores[1] and all(0 <= s <= 1 for s in scores) and scores[3] > scores[4]
    assert score_quality(asked.limit(0), model).count() == 0
    assert train_quality(docs, labels.limit(0)) is None
    assert {r.score for r in score_quality(asked, None).collect()} == {0.5}
