"""Quality by nearest-neighbour voting among latent-semantic vectors.

A text is a bag of terms: runs of three byte classes (letters, capitals, digits, white space,
kinds of marks), and a few counts of words that repeat. Terms are weighted by inverse document
frequency and projected to the leading singular vectors of a labelled sample. The sample's
vectors and labels are broadcast (their size is bounded by the sample); each block of documents
is compared with all of them by exact cosine products, and the nearest vote, weighted by
similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import free_name

#: Labelled documents at most, dimensions of the latent space, voters, and documents of a block.
SAMPLE, DIMENSIONS, VOTERS, BLOCK = 4_096, 64, 25, 256
#: Byte classes; every mark of the table's groups is a class of its own.
CLASSES = 14
_GROUPS = [
    bytes(range(97, 123)), bytes(range(65, 91)), bytes(range(48, 58)), b" \t", b"\n\r", b".,;:", b"!", b"?", b"|",
    b"#$%&*@^~", b"()[]{}<>", b"'\"`-_", bytes(range(128, 256)),
]
_CLASS = np.full(256, CLASSES - 1, np.uint16)
for _i, _g in enumerate(_GROUPS):
    _CLASS[list(_g)] = _i
RUNS = CLASSES**3
#: Terms from words: repeated neighbours, words seen before in the text, and their complements.
TERMS = RUNS + 4


def terms(text: str | None) -> np.ndarray:
    """Square roots of the terms' shares in the text (zeros for an empty one)."""
    out = np.zeros(TERMS, np.float32)
    if not text:
        return out
    c = _CLASS[np.frombuffer(text.encode(), np.uint8)]
    if len(c) >= 3:
        out[:RUNS] = np.bincount(c[:-2] * (CLASSES * CLASSES) + c[1:-1] * CLASSES + c[2:], minlength=RUNS) / len(c)
    words = text.split()
    n = len(words)
    if n > 1:
        same = sum(map(eq, words, words[1:])) / n
        # Common words repeat in any long text, so repetition is looked at in short stretches.
        fresh = sum(len(set(words[i : i + 50])) for i in range(0, n, 50)) / n
        out[RUNS:] = same, 1 - same, fresh, 1 - fresh
    return np.sqrt(out)


@dataclass
class Model:
    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, rows: np.ndarray) -> np.ndarray:
        v = (rows * self.weights) @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def vote(self, rows: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest vectors, weighted by similarity."""
        if not len(self.labels):
            return np.full(len(rows), 0.5)
        near = self.project(rows) @ self.vectors.T
        k = min(VOTERS, near.shape[1])
        at = np.argpartition(-near, k - 1, axis=1)[:, :k]
        sim = np.take_along_axis(near, at, axis=1)
        # Relative to the nearest, so that the weights tell close neighbours apart.
        w = np.exp((sim - sim.max(1, keepdims=True)) * 30) * np.maximum(sim, 1e-6)
        return (w * self.labels[at]).sum(1) / w.sum(1)


def fit(texts: list[str], labels: np.ndarray) -> Model:
    """Term weights, singular vectors and the sample's own vectors."""
    if not len(texts):
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels)
    x = np.stack([terms(t) for t in texts])
    seen = (x > 0).sum(0)
    weights = np.log((1 + len(texts)) / (1 + seen)).astype(np.float32) + np.float32(0.2)
    y = x * weights
    # The leading eigenvectors of the terms' products are the right singular vectors.
    values, vectors = np.linalg.eigh((y.T @ y).astype(np.float64))
    axes = vectors[:, np.argsort(-values)[: min(DIMENSIONS, len(texts))]].astype(np.float32)
    model = Model(weights, axes, np.zeros((0, 1), np.float32), labels.astype(np.float32))
    return Model(weights, axes, model.project(x), labels.astype(np.float32))


def learned(docs: DataFrame, labels: DataFrame, fold: int = 2, folds: int = 4, sample: int = SAMPLE) -> Model:
    """Fit on labelled documents whose crc32 of the id (as text) modulo ``folds`` is not ``fold``.

    The ``sample`` of them whose ids hash lowest: a bound on the model's size and on what the
    driver holds, not on what is scored. Rows without id, text or label are no examples.
    """
    known = labels.select("doc_id", "quality").filter("doc_id IS NOT NULL AND quality IN (0, 1)").distinct()
    known = known.filter(F.crc32(F.col("doc_id").cast("string")) % folds != fold)
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL AND text <> ''")
    rows = texts.join(F.broadcast(some), "doc_id").orderBy("doc_id", "text").limit(sample).collect()
    return fit([r["text"] for r in rows], np.array([r["quality"] for r in rows], int))


def scored(df: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 where the score is at or over ``threshold``).

    Whole texts are scored, in any number. A null or empty text has no terms, is as near to one
    labelled document as to another, and gets score 0. Every row and column is kept; columns that
    bear an output's name are replaced.
    """
    kept = df.drop(*[c for c in df.columns if c.lower() in {"score", "predicted"} and c != text])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for texts in batches:
            out = []
            for i in range(0, len(texts), BLOCK):
                block = texts.iloc[i : i + BLOCK]
                score = m.vote(np.stack([terms(t) for t in block]))
                out.append(np.where(block.fillna("").str.len() > 0, score, 0.0))
            yield pd.Series(np.concatenate(out) if out else [], dtype=float)

    made = free_name(kept, "llm_score")
    out = kept.withColumn(made, F.pandas_udf(vote, "double")(F.col(text)))
    return out.withColumns({"score": F.col(made), "predicted": (F.col(made) >= threshold).cast("int")}).drop(made)
