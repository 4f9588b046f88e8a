"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded by its surface (length,
signs, letters, repetition) and by hashed words; a layer of the network turns
that into a vector, gated attention weighs the passages of a bag, and the
weighted vector is scored (Ilse et al., 2018). Only documents have labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.runtime import ship_code
from tidemark.llm.sampling import sample_per_label
from tidemark.llm.textbatch import mix, slices, utf8, word_hashes, words

#: Words of a passage; the last passage of a text may be shorter.
PASSAGE_WORDS = 64
#: Buckets of the hashed words.
BUCKETS = 64
#: Training documents per label: a bounded sample of labelled rows.
SAMPLE_ROWS = 1500
HIDDEN, ATTENTION, EPOCHS, BATCH, RATE, SEED = 24, 12, 25, 64, 0.01, 7

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = np.zeros(256, bool)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_ODD = np.zeros(256, bool)
_ODD[[ord(x) for x in "#*$%&|<>!{}[]=_~^\\/@"]] = True
SURFACE = 10


def encode_passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a column of texts, and each text's first passage (one more at the end).

    A text without words is one passage of zeros.
    """
    data, at = utf8(column)
    w = words(column)
    n_words = np.diff(w.first)
    n_parts = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    first = np.concatenate(([0], np.cumsum(n_parts)))
    out = np.zeros((first[-1], SURFACE + BUCKETS), np.float32)
    if not len(w.starts):
        return out, first
    text = np.repeat(np.arange(len(n_words)), n_words)
    place = np.arange(len(text)) - w.first[text]
    part = first[text] + place // PASSAGE_WORDS
    size = np.bincount(part, minlength=first[-1])
    full = np.maximum(size, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        """Bytes of a kind per byte, by passage."""
        sums = np.concatenate(([0], np.cumsum(mask[data], dtype=np.int64)))
        return np.bincount(part, sums[w.ends] - sums[w.starts], minlength=first[-1]) / chars

    lengths = w.ends - w.starts
    chars = np.maximum(np.bincount(part, lengths, minlength=first[-1]), 1)
    hashes = word_hashes(w)
    line = np.concatenate(([0], np.cumsum(data == 10)))[w.starts]
    breaks = np.concatenate(([0], np.diff(line) > 0)) & (place > 0)
    pair = mix(hashes[1:] + hashes[:-1] * np.uint64(3))
    key = mix(pair + part[1:].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, where, count = np.unique(key, return_inverse=True, return_counts=True)
    again = np.concatenate(([False], (count[where] > 1) & (part[1:] == part[:-1])))
    same = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (part[1:] == part[:-1])))
    tail = data[w.ends - 1]
    out[:, 0] = np.log1p(size) / 4
    out[:, 1] = chars / full / 10
    out[:, 2] = share(_UPPER)
    out[:, 3] = share(_DIGIT)
    out[:, 4] = share(_SIGN)
    out[:, 5] = share(_ODD) * 3
    out[:, 6] = np.bincount(part, again, minlength=first[-1]) / full
    out[:, 7] = np.bincount(part, same, minlength=first[-1]) / full
    out[:, 8] = np.bincount(part, breaks, minlength=first[-1]) / full * 5
    out[:, 9] = np.bincount(part, _SIGN[tail], minlength=first[-1]) / full
    bucket = (hashes % np.uint64(BUCKETS)).astype(np.int64)
    counts = np.bincount(part * BUCKETS + bucket, minlength=first[-1] * BUCKETS).reshape(-1, BUCKETS)
    out[:, SURFACE:] = np.sqrt(counts / full[:, None])
    out[size == 0] = 0
    return out, first


@dataclass
class AttentionModel:
    """Weights: encoder, the two sides of the attention gate, and the score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        return _forward(self.weights, (features - self.mean) / self.scale, first)[0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _forward(p: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> tuple:
    """Scores of bags; ``first`` says where each bag's passages begin, and the end. No bag is empty."""
    h = np.tanh(x @ p["encode"] + p["encode_bias"])
    v, u = np.tanh(h @ p["value"]), _sigmoid(h @ p["gate"])
    e = (v * u) @ p["attend"]
    bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
    e = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
    a = e / np.add.reduceat(e, first[:-1])[bag]
    z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
    return _sigmoid(z @ p["score"] + p["score_bias"]), h, v, u, a, z, bag


def _gradients(p: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    s, h, v, u, a, z, bag = _forward(p, x, first)
    ds = (s - y) * weight / len(y)
    dz = ds[:, None] * p["score"]
    da = (h * dz[bag]).sum(axis=1)
    de = a * (da - np.add.reduceat(a * da, first[:-1])[bag])
    dvu = de[:, None] * p["attend"]
    dv, du = dvu * u * (1 - v * v), dvu * v * u * (1 - u)
    dh = a[:, None] * dz[bag] + dv @ p["value"].T + du @ p["gate"].T
    dx = dh * (1 - h * h)
    return {
        "encode": x.T @ dx,
        "encode_bias": dx.sum(axis=0),
        "value": h.T @ dv,
        "gate": h.T @ du,
        "attend": (v * u).T @ de,
        "score": z.T @ ds,
        "score_bias": ds.sum(keepdims=True),
    }


def fit(bags: list[np.ndarray], labels: np.ndarray) -> AttentionModel:
    """Adam on the log loss, both labels weighing the same; the same input gives the same model."""
    rng = np.random.default_rng(SEED)
    everything = np.concatenate(bags).astype(np.float64)
    mean, scale = everything.mean(axis=0), everything.std(axis=0) + 1e-3
    bags = [(b - mean) / scale for b in bags]
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    p = {
        "encode": draw(everything.shape[1], HIDDEN),
        "encode_bias": np.zeros(HIDDEN),
        "value": draw(HIDDEN, ATTENTION),
        "gate": draw(HIDDEN, ATTENTION),
        "attend": draw(ATTENTION),
        "score": draw(HIDDEN),
        "score_bias": np.zeros(1),
    }
    share = np.clip(np.bincount(labels, minlength=2) / len(labels), 1e-6, None)
    weight = 0.5 / share[labels]
    first_moment = {k: np.zeros_like(x) for k, x in p.items()}
    second_moment = {k: np.zeros_like(x) for k, x in p.items()}
    t = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            x = np.concatenate([bags[i] for i in pick])
            first = np.concatenate(([0], np.cumsum([len(bags[i]) for i in pick])))
            g = _gradients(p, x, first, labels[pick], weight[pick])
            t += 1
            for k in p:
                grad = g[k] + 1e-4 * p[k]
                first_moment[k] = 0.9 * first_moment[k] + 0.1 * grad
                second_moment[k] = 0.999 * second_moment[k] + 0.001 * grad * grad
                p[k] = p[k] - RATE * (first_moment[k] / (1 - 0.9**t)) / (np.sqrt(second_moment[k] / (1 - 0.999**t)) + 1e-8)
    return AttentionModel(mean, scale, p)


def train_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = SAMPLE_ROWS) -> AttentionModel | None:
    """The model of at most ``rows`` whole documents of each label, 0 and 1; None without labelled texts.

    Rows whose id or label is null are not used; of several labels of one id the
    largest counts. The passages of the sample are encoded by tasks and gathered by the driver.
    """
    ship_code(docs.sparkSession)
    one = labels.where(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).cast("int").alias("_label"))
    chosen = sample_per_label(docs.select(id_col).dropDuplicates([id_col]).join(one, id_col), "_label", rows, id_col)
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(chosen.select(F.col(id_col).alias("_id"), "_label")), "_id"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            features, first = encode_passages(batch.column("text"))
            raw = [features[a:b].astype("<f4").tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_id").cast(pa.string()), batch.column("_label"), pa.array(raw, pa.binary())], ["_id", "_label", "bag"])

    # of two texts with one id the larger bag counts, and rows come in a fixed order
    rows_ = sample.mapInArrow(run, "_id string, _label int, bag binary").groupBy("_id", "_label").agg(F.max("bag").alias("bag")).orderBy("_id")
    bags, marks = [], []
    for _, label, bag in rows_.toLocalIterator():
        bags.append(np.frombuffer(bag, "<f4").reshape(-1, SURFACE + BUCKETS))
        marks.append(label)
    return fit(bags, np.array(marks)) if bags else None


def score_quality(docs: DataFrame, model: AttentionModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, between 0 and 1: the higher, the likelier is label 1.

    Whole texts are scored. A null or empty text is one passage without words
    and gets that bag's score; without a model every score is 0.5. A column
    ``score`` of ``docs`` is replaced, all others are kept and not looked at.
    """
    spark = docs.sparkSession
    ship_code(spark)
    kept = [c for c in docs.columns if c != "score"]
    frozen = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = frozen.value
        for big in batches:
            for batch in slices([big], text_col):
                scores = np.full(batch.num_rows, 0.5)
                if learned is not None:
                    scores = learned.score(*encode_passages(batch.column(text_col)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(scores, pa.float64())], [*kept, "score"])

    plain = docs.select(*kept)
    return plain.mapInArrow(run, T.StructType([*plain.schema.fields]).add("score", "double"))
