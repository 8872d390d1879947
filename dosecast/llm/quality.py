"""Quality by nearest-neighbour voting in a latent-semantic space.

Texts become TF-IDF vectors of the n-grams of their character shapes, weighted by frequencies
over all documents, and are projected on the leading singular vectors of a bounded labelled
sample. The sample's projections, a matrix of fixed size, are broadcast; every document takes its
exact cosine with all of them in blocks, and the nearest vote with their similarities.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.llm import classify, words
from dosecast.llm.common import ship

BLOCK = 256  # documents whose products with all labelled vectors are held at once


@dataclass(frozen=True)
class Settings:
    sizes: tuple[int, ...] = (1, 2, 3, 4)
    bits: int = 12
    rows_per_label: int = 2000
    dimensions: int = 48
    neighbours: int = 15


@dataclass(frozen=True)
class QualityModel:
    """``vectors`` (unit length) and ``labels`` of the sample; ``project`` from features."""

    idf: np.ndarray
    project: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    prior: float
    settings: Settings

    def embed(self, texts: Sequence[str | None]) -> np.ndarray:
        owner, index, count = shape_features(texts, self.settings)
        return self.latent(owner, index, count, len(texts))

    def latent(self, owner: np.ndarray, index: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        value = classify.unit_rows(owner, np.log1p(count) * self.idf[index], n)
        out = np.zeros((n, self.project.shape[1]), np.float32)
        edges = np.searchsorted(owner, np.arange(0, n + BLOCK, BLOCK))
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            rows = min(BLOCK, n - k * BLOCK)
            dense = np.zeros((rows, len(self.idf)), np.float32)
            dense[owner[a:b] - k * BLOCK, index[a:b]] = value[a:b]
            out[k * BLOCK : k * BLOCK + rows] = dense @ self.project
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.maximum(length, 1e-12)

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        """The share of label 1 among the nearest labelled vectors, weighted by similarity and by
        how many rows of its label a vector stands for."""
        own, out = self.embed(texts), np.empty(len(texts))
        k = min(self.settings.neighbours, len(self.labels))
        for a in range(0, len(texts), BLOCK):
            near = own[a : a + BLOCK] @ self.vectors.T
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, top, axis=1), 0.0) * self.weights[top]
            total = weight.sum(axis=1)
            vote = (weight * self.labels[top]).sum(axis=1)
            out[a : a + BLOCK] = np.where(total > 1e-9, vote / np.maximum(total, 1e-9), self.prior)
        return np.clip(out, 0.0, 1.0)


def shape_table() -> np.ndarray:
    """Code points below 128: letters by case, digits, white space, other signs as they are."""
    table = np.arange(129, dtype=np.uint32)
    table[65:91], table[97:123], table[48:58] = 65, 97, 48
    table[9:14] = table[32]
    table[10] = 10
    table[128] = 97
    return table


SHAPES = shape_table()


def shape_features(texts: Sequence[str | None], settings: Settings):
    points, starts = words.code_points(texts)
    return words.ngrams(SHAPES[np.minimum(points, 128)], starts, settings.sizes, settings.bits)


def fit(docs: DataFrame, sample: DataFrame, settings: Settings = Settings()) -> QualityModel | None:  # noqa: B008
    """Frequencies from all of ``docs``; vectors from ``sample``, bounded, with ``doc_id``, ``text``,
    ``quality`` and, optionally, ``weight``. Rows with a null of text or label are left out; without any
    there is no model."""
    features = lambda texts: shape_features(texts, settings)
    size = 1 << settings.bits
    rows = sample.where("text IS NOT NULL AND quality IS NOT NULL").withColumn(
        "quality", F.when(F.col("quality") == 1, "1").otherwise("0")
    )
    found = classify.collect_features(rows, features, "quality", "text")
    if not found:
        return None
    idf = classify.idf(*classify.document_frequencies(docs, features, size))
    labels = np.array([float(x) for x, _, _ in found])
    weights = np.array([w for _, w, _ in found])
    owner = np.repeat(np.arange(len(found)), [len(i) for _, _, (i, _) in found])
    index = np.concatenate([i for _, _, (i, _) in found])
    count = np.concatenate([c for _, _, (_, c) in found])
    value = classify.unit_rows(owner, np.log1p(count) * idf[index], len(found))
    project = right_vectors(owner, index, value.astype(np.float32), len(found), size, settings.dimensions)
    prior = float(np.average(labels, weights=weights))
    bare = QualityModel(idf, project, np.zeros((0, 0)), labels, weights, prior, settings)
    vectors = bare.latent(owner, index, count, len(found))
    return QualityModel(idf, project, vectors, labels, weights, prior, settings)


def right_vectors(
    owner: np.ndarray, index: np.ndarray, value: np.ndarray, n: int, size: int, k: int
) -> np.ndarray:
    """Leading right singular vectors, by randomised subspace iteration."""
    dense = np.zeros((n, size), np.float32)
    dense[owner, index] = value
    k = min(k, n, size)
    basis = np.random.default_rng(7).standard_normal((size, min(size, k + 8))).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(dense.T @ (dense @ basis))
    _, _, vt = np.linalg.svd(dense @ basis, full_matrices=False)
    return np.ascontiguousarray((basis @ vt[:k].T).astype(np.float32))


def score(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """``docs`` with ``score``, from 0 to 1, and ``predicted``, 1 from 0.3 on, replacing columns
    of these names. A text without features of the sample scores the mean label of all labelled
    rows, and so does an empty or null one; without a model every score is 0. Long texts count
    whole; equal texts, also in repeated rows, have equal scores; of vectors equally near any may
    vote. An empty table gives no row."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        column, out, model = texts.tolist(), np.zeros(len(texts)), held.value
        for a, b in classify.text_slices(column) if model else ():
            out[a:b] = model.scores(column[a:b])
        for i, t in enumerate(column):
            if model and not t:
                out[i] = model.prior
        return pd.Series(out)

    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    return docs.withColumn("_s", run.asNondeterministic()(F.col("text"))).select(
        *kept, F.col("_s").alias("score"), F.when(F.col("_s") >= 0.3, 1).otherwise(0).alias("predicted")
    )
