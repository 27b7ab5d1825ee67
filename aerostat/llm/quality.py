"""Quality by votes of the nearest labelled texts in a latent semantic space.

A text's terms are the trigrams of its character shapes (letter, capital, digit, each ASCII sign,
white space) and its repetitions of words and lines; they tell prose from tables, shouting, symbol
noise and loops in any language. Root counts weighted by inverse document frequency are projected
on the leading singular vectors of the labelled texts. Every text is compared with every labelled
vector by exact blocked cosine products, and its nearest neighbours vote, weighted by similarity.

The model is fitted on a bounded sample of the labelled rows (``SAMPLE``, the ones whose hashed id
is smallest), which bounds what the driver holds and what is broadcast; everything else reads all
rows and whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 4000  # labelled rows that the model may use
DIMS = 48
NEIGHBOURS = 15
SHARPNESS = 8.0  # power of the similarity in a vote
BLOCK = 256  # texts whose products are formed at a time

_SIGNS = "!#$%&*.,;:|-<"  # signs with a class of their own; all others share one
_CLASSES = 6 + len(_SIGNS)
_TERMS = _CLASSES**3 + 3


def _class(c: int) -> int:
    ch = chr(c)
    if ch in _SIGNS and c < 128:
        return 6 + _SIGNS.index(ch)
    if c >= 128 or ch.islower():
        return 0
    return 1 if ch.isupper() else 2 if ch.isdigit() else 3 if ch == "\n" else 4 if ch.isspace() else 5


_TABLE = np.array([_class(c) for c in range(256)], np.int64)


def terms(text: str | None) -> np.ndarray:
    """Counts of all terms of a text; null counts as empty."""
    text = text or ""
    a = _TABLE[np.frombuffer(text.encode(), np.uint8)]
    out = np.zeros(_TERMS)
    if len(a) > 2:
        out[:-3] = np.bincount((a[:-2] * _CLASSES + a[1:-1]) * _CLASSES + a[2:], minlength=_TERMS - 3)
    words, lines = text.split(), text.split("\n")
    out[-3] = sum(map(eq, words, words[1:]))
    out[-2] = sum(map(eq, words, words[2:]))
    out[-1] = len(lines) - len(set(lines))
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


@dataclass
class Model:
    used: np.ndarray  # terms that occur in the sample
    weight: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray  # of the labelled texts, length one
    votes: np.ndarray  # label 1: positive; either class weighs one half in all

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit((np.sqrt(counts[:, self.used]) * self.weight).astype(np.float32) @ self.axes)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for start in range(0, len(texts), BLOCK):
            z = self.latent(np.array([terms(t) for t in texts[start : start + BLOCK]]))
            near = z @ self.vectors.T
            k = min(NEIGHBOURS, near.shape[1])
            top = np.argpartition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k :]
            close = np.maximum(np.take_along_axis(near, top, 1), 1e-6).astype(float) ** SHARPNESS
            vote = self.votes[top] * close
            good = np.where(vote > 0, vote, 0).sum(1)
            # A text that shares no term with the labelled ones is as near to all of them.
            out[start : start + BLOCK] = np.where(z.any(1), good / np.abs(vote).sum(1), 0.5)
        return out


def fit(counts: np.ndarray, labels: list[bool], dims: int = DIMS, seed: int = 0) -> Model | None:
    """The model of labelled texts' term counts, or none if there is no text."""
    if not len(counts):
        return None
    y = np.array(labels, bool)
    used = np.flatnonzero(counts.any(0))
    counts = counts[:, used] if len(used) else np.ones((len(counts), 1))
    used = used if len(used) else np.array([0])
    weight = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 1
    x = np.sqrt(counts) * weight
    # Leading right singular vectors by subspace iteration.
    q = np.random.default_rng(seed).standard_normal((x.shape[1], min(dims + 16, *x.shape)))
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    axes = (q @ v.T)[:, :dims].astype(np.float32)
    share = max(float(y.mean()), 1e-9), max(float((~y).mean()), 1e-9)
    model = Model(used, weight, axes, np.empty(0), np.where(y, 0.5 / share[0], -0.5 / share[1]))
    model.vectors = _unit(x.astype(np.float32) @ axes)
    return model


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> tuple[np.ndarray, list[bool]]:
    """Term counts and labels of a bounded sample of the labelled documents, one per id."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).dropna()
    marks = marks.groupBy("id").agg((F.avg("label") >= 0.5).alias("label"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = marks.join(rows.select("id"), "id", "left_semi")
    some = known.orderBy(F.xxhash64("id"), "id").limit(sample)

    @F.arrow_udf("struct<i: array<int>, n: array<double>>")
    def counted(texts: pa.Array) -> pa.Array:
        each = [terms(t) for t in texts.to_pylist()]
        at = [np.flatnonzero(c) for c in each]
        lists = pa.array([a.astype(np.int32) for a in at], pa.list_(pa.int32()))
        return pa.StructArray.from_arrays([lists, pa.array([c[a] for c, a in zip(each, at)], pa.list_(pa.float64()))], ["i", "n"])

    # At most ``sample`` ids, so the broadcast is bounded. Rows that repeat an id count once.
    found = rows.join(F.broadcast(some), "id").select("id", "label", counted("text").alias("terms"))
    found = found.groupBy("id", "label").agg(F.min("terms").alias("terms")).orderBy("id").collect()
    counts = np.zeros((len(found), _TERMS))
    for line, r in zip(counts, found):
        line[r["terms"]["i"]] = r["terms"]["n"]
    return counts, [r["label"] for r in found]


def learn_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> Model | None:
    """Fit on the labelled documents among ``docs``.

    Null labels and labels of absent documents are left out; if an id has several labels, their
    mean decides. Null and empty texts are texts without terms. Without any labelled document there
    is no model, and every score is 0.5.
    """
    return fit(*labelled(docs, labels, id_col, text_col, label_col, sample))


def quality(text: Column, model: Model | None) -> Column:
    """Score of a text from 0 to 1; higher: label 1 likelier. Null counts as the empty text."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        texts = texts.to_pylist()
        return pa.array(model.scores(texts) if model else np.full(len(texts), 0.5), pa.float64())

    return score.asNondeterministic()(text)  # so that a filter on it does not run it twice
