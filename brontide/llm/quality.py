"""Quality classifier: attention-based multiple-instance learning.

A text is a bag of passages of PASSAGE_BYTES of its UTF-8 bytes, all of them. Every passage is
encoded as shares of character classes and a hashed bag of byte triples. Gated attention gives
each passage a weight, the weighted mean represents the text, and a logistic layer scores it.
Attention and score are learned together from document labels only.

Learning takes whole bags of a sample of labelled rows, bounded by MAX_TRAIN rows and, together,
MAX_PASSAGES passages; scoring takes every passage of every text. Labels, language, source and
id are never inputs.

Defined results: a null or empty text has one passage of nothing and a score like any other;
without labels of both kinds every score is the share of label 1, or 0.5 without any; of
several labels of one id the lowest counts, of several texts of one id the smallest; repeated
rows get equal scores; an empty table gives no rows; result columns replace input columns of
the same name. A very long text costs memory for its passages, one text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brontide.llm.common import release, text_of, written

PASSAGE_BYTES = 1024
TRIPLES = 64
#: Documents that learning takes, chosen by a hash of the id, and passages of all of them: in the
#: order of the hash, a document whose whole bag no longer fits is left out.
MAX_TRAIN = 4000
MAX_PASSAGES = 64_000
HIDDEN = 16
STEPS = 300
RATE = 0.02
DECAY = 1e-3

#: Classes of bytes: lower, upper, digit, blank, line end, each of some marks, other ASCII, beyond.
_MARKS = b".,!?;:'\"-#*$%&|<>()/\\=_"
_CLASSES = 7 + len(_MARKS)
_CLASS = np.full(256, 5, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[32], _CLASS[10], _CLASS[128:] = 0, 1, 2, 3, 4, 6
for _i, _c in enumerate(_MARKS):
    _CLASS[_c] = 7 + _i
#: Shares of classes, their square roots (small shares matter), triples, and the length.
WIDTH = 2 * _CLASSES + TRIPLES + 1


def passages(text: str) -> np.ndarray:
    """One row of features for each passage, all of them."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-len(raw) // PASSAGE_BYTES))
    out = np.zeros((n, WIDTH), np.float32)
    if not len(raw):
        return out
    own = np.arange(len(raw)) // PASSAGE_BYTES
    classes = np.bincount(own * _CLASSES + _CLASS[raw], minlength=n * _CLASSES).reshape(n, _CLASSES)
    size = classes.sum(1, keepdims=True)
    out[:, :_CLASSES] = classes / size
    out[:, _CLASSES : 2 * _CLASSES] = np.sqrt(classes / size)
    if len(raw) > 2:
        wide = raw.astype(np.uint32)
        mixed = (wide[:-2] * np.uint32(0x9E3779B1) ^ wide[1:-1] * np.uint32(0x85EBCA77) ^ wide[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(26)
        triples = np.bincount(own[:-2] * TRIPLES + mixed, minlength=n * TRIPLES).reshape(n, TRIPLES)
        out[:, 2 * _CLASSES : -1] = np.sqrt(triples / np.maximum(1, triples.sum(1, keepdims=True)))
    out[:, -1] = np.log1p(size[:, 0]) / 8
    return out


@dataclass
class Model:
    """Gated attention over standardised passages. v, u, w: attention; c, b: score."""

    mean: np.ndarray
    scale: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    c: np.ndarray
    b: float

    def weights(self, x: np.ndarray) -> np.ndarray:
        e = (np.tanh(x @ self.v) * _sigmoid(x @ self.u)) @ self.w
        e = np.exp(e - e.max())
        return e / e.sum()

    def score(self, text: str | None) -> float:
        x = (passages(text or "") - self.mean) / self.scale
        return float(_sigmoid(self.weights(x) @ x @ self.c + self.b))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def gradients(p: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, own: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """The weighted log loss and its gradients. x: passages of all bags in a row, starts: where
    each bag begins, own: the bag of each passage."""
    t, g = np.tanh(x @ p["v"]), _sigmoid(x @ p["u"])
    e = (t * g) @ p["w"]
    e = np.exp(e - np.maximum.reduceat(e, starts)[own])
    a = e / np.add.reduceat(e, starts)[own]
    z = np.add.reduceat(a[:, None] * x, starts)
    out = _sigmoid(z @ p["c"] + p["b"])
    loss = -float((weight * (labels * np.log(out + 1e-300) + (1 - labels) * np.log(1 - out + 1e-300))).sum())
    d = (out - labels) * weight
    # Through the score, the weighted mean, the softmax and the gate.
    da = d[own] * (x @ p["c"])
    de = a * (da - np.add.reduceat(a * da, starts)[own])
    dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
    return loss, {"v": x.T @ dt, "u": x.T @ dg, "w": (t * g).T @ de, "c": z.T @ d, "b": np.array([d.sum()])}


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 3) -> Model:
    """Full-batch Adam on the weighted log loss; both labels weigh the same."""
    if not bags:
        return Model(np.zeros(WIDTH), np.ones(WIDTH), *(np.zeros((WIDTH, HIDDEN)),) * 2, np.zeros(HIDDEN), np.zeros(WIDTH), 0.0)
    x = np.concatenate(bags).astype(np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-2
    share = labels.mean()
    if share in (0.0, 1.0):
        return Model(mean, scale, *(np.zeros((WIDTH, HIDDEN)),) * 2, np.zeros(HIDDEN), np.zeros(WIDTH), 40.0 if share else -40.0)
    x = (x - mean) / scale
    starts = np.cumsum([0] + [len(b) for b in bags])[:-1]
    own = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    rng = np.random.default_rng(seed)
    p = {"v": rng.normal(0, 0.1, (WIDTH, HIDDEN)), "u": rng.normal(0, 0.1, (WIDTH, HIDDEN)), "w": rng.normal(0, 0.1, HIDDEN), "c": np.zeros(WIDTH), "b": np.zeros(1)}
    first, second = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    balance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / len(bags)
    for step in range(1, STEPS + 1):
        _, grads = gradients(p, x, starts, own, labels, balance)
        for k, grad in grads.items():
            grad = grad + (DECAY * p[k] if k != "b" else 0)
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad * grad
            p[k] = p[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, p["v"], p["u"], p["w"], p["c"], float(p["b"][0]))


@F.arrow_udf(T.BinaryType())
def _bags(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """All passages of each text, as float32 bytes."""
    for texts in batches:
        yield pa.array([passages(t.as_py()).tobytes() for t in texts], pa.binary())
    release()


def whole_bags(sizes: list[int]) -> list[int]:
    """Places of the documents that learning takes; sizes: their passages, in the order of the hash."""
    taken, left = [], MAX_PASSAGES
    for i, n in enumerate(sizes):
        if n <= left:
            taken.append(i)
            left -= n
    return taken


def held_out(id_col: str):
    """Rows that learning never sees, by the id's check sum."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality") -> Model:
    own = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where(F.col("label").isNotNull() & F.col("id").isNotNull() & ~held_out("id")).groupBy("id").agg(F.min("label").alias("label"))
    # A bounded sample, so its ids can be broadcast; chosen by hash, not by place.
    chosen = own.orderBy(F.xxhash64("id"), "id").limit(MAX_TRAIN)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), "id")
    # Of several texts of one id the smallest counts, as the lengths and the bags are read apart.
    texts = written(rows.groupBy("id", "label").agg(F.min("text").alias("text")), "labelled")
    n = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / PASSAGE_BYTES))
    sizes = texts.select("id", n.alias("n")).orderBy(F.xxhash64("id"), "id").collect()
    taken = [sizes[i][0] for i in whole_bags([r["n"] for r in sizes])]
    rows = texts.join(F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in taken], texts.select("id").schema)), "id")
    found = sorted(rows.select("id", "label", _bags("text").alias("bag")).collect(), key=lambda r: r[0])
    return fit([np.frombuffer(r["bag"], np.float32).reshape(-1, WIDTH) for r in found], np.array([float(r["label"] >= 1) for r in found]))


def classify(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """docs with held_out, score and predicted."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, text_col, id_col, label_col))

    @F.arrow_udf(T.DoubleType())
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = model.value
        for texts in batches:
            yield pa.array([own.score(t.as_py()) for t in texts], pa.float64())
        release()

    out = docs.withColumns({"held_out": held_out(id_col), "score": scored(text_of(text_col))})
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
