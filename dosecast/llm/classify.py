"""What the text classifiers share: held-out folds, bounded samples, feature statistics over all
rows, and a follow-the-regularised-leader learner."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dosecast.llm import words
from dosecast.llm.common import materialise, ship

#: Text, feature and count arrays of a list of texts.
Features = Callable[[Sequence[str | None]], tuple[np.ndarray, np.ndarray, np.ndarray]]


# Rows of a sample, over all its labels.
SAMPLE_ROWS = 20_000


def fold(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds


def text_slices(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    return words.slices(texts, words.BATCH_BYTES // 2)


def document_frequencies(texts: DataFrame, features: Features, size: int) -> tuple[np.ndarray, int]:
    """In how many of all texts (column ``text``) each of ``size`` features is, and how many
    texts there are. Every task sends one count per feature, summed by Spark."""

    ship(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            column = batch.column("text").to_pylist()
            for a, b in text_slices(column):
                seen[:size] += np.bincount(features(column[a:b])[1], minlength=size)
                seen[size] += b - a
        some = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(some), pa.array(seen[some])], ["feature", "n"])

    found = (
        texts.select("text")
        .mapInArrow(count, "feature long, n long")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    seen = np.zeros(size + 1, np.int64)
    for row in found:
        seen[row["feature"]] = row["n"]
    return seen[:size], int(seen[size])


def idf(frequencies: np.ndarray, texts: int) -> np.ndarray:
    return np.log((1.0 + texts) / (1.0 + frequencies)) + 1.0


def bounded_sample(rows: DataFrame, label: str, per_label: int, total: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``per_label`` rows of each label value and ``total`` of all, or all where there are
    fewer, chosen by a hash of ``doc_id`` and ``text``, so the same ones every time. ``weight`` tells
    how many rows of its label a row stands for.

    Whatever the ids, the bound holds: rows equal in id, text and label are one row of the sample,
    and of more than ``total`` label values the commonest are kept. The choice is made on hashes;
    the texts are read again for the chosen rows only, by a join with the bounded choice.
    """
    keyed = rows.withColumn("_h", F.xxhash64("doc_id", "text", F.lit("sample")))
    kinds = materialise(keyed.groupBy(label, "_h").agg(F.count("*").alias("_n")))
    labels = (
        kinds.groupBy(label)
        .agg(F.sum("_n").alias("_rows"), F.count("*").alias("_kinds"))
        .orderBy(F.desc("_rows"), label)
        .limit(total)
    )
    labels = materialise(labels)
    quota = max(1, min(per_label, total // max(1, labels.count())))
    first = Window.partitionBy(label).orderBy("_h")
    chosen = (
        kinds.withColumn("_at", F.row_number().over(first))
        .where(F.col("_at") <= quota)
        .join(F.broadcast(labels), label)
        .select(label, "_h", (F.col("_rows") / F.least("_kinds", F.lit(quota))).alias("weight"))
    )
    found = keyed.join(F.broadcast(materialise(chosen)), [label, "_h"])
    return found.dropDuplicates([label, "_h"]).drop("_h")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_label: int) -> DataFrame:
    """A ``bounded_sample`` of ``doc_id``, ``text`` and ``label`` of the documents that have a label.

    Ids are chosen first, from ``labels`` and the ids of ``docs``; the bounded choice then meets the
    texts, so no text is shuffled for it. A label's weight comes from all its rows.
    """
    marked = labels.select("doc_id", label).where(F.col(label).isNotNull()).distinct()
    known = materialise(docs.select("doc_id").join(marked, "doc_id").groupBy("doc_id", label).count())
    counts = known.groupBy(label).agg(F.sum("count").alias("_rows")).orderBy(F.desc("_rows"), label)
    counts = materialise(counts.limit(SAMPLE_ROWS))
    quota = max(1, min(per_label, SAMPLE_ROWS // max(1, counts.count())))
    first = Window.partitionBy(label).orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id")
    ids = materialise(
        known.withColumn("_at", F.row_number().over(first))
        .where(F.col("_at") <= quota)
        .join(F.broadcast(counts.select(label)), label, "left_semi")
        .select("doc_id", label)
    )
    rows = materialise(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"))
    sample = bounded_sample(rows, label, per_label).drop("weight")
    sizes = sample.groupBy(label).agg(F.count("*").alias("_size")).join(counts, label)
    weights = materialise(sizes.select(label, (F.col("_rows") / F.col("_size")).alias("weight")))
    return sample.join(F.broadcast(weights), label)


@dataclass
class Example:
    """One labelled text: feature numbers and values, those of its counterfactuals, its weight."""

    label: str
    index: np.ndarray
    value: np.ndarray
    others: Sequence[tuple[np.ndarray, np.ndarray]] = ()
    weight: float = 1.0


def collect_features(sample: DataFrame, features: Features, label: str, *texts: str) -> list[tuple]:
    """``(label, weight, (index, count), ...)`` of a bounded sample, ordered by a hash of ``doc_id``
    and the text. One pair per text column, None for a null in any but the first. The arrays are
    views of what Spark sent; nothing is copied."""

    ship(sample.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column(texts[0]).to_pylist()
            for a, b in text_slices(first):
                out = [batch.column(c).slice(a, b - a) for c in ("at", "label", "weight")]
                for name in texts:
                    column = batch.column(name).slice(a, b - a).to_pylist()
                    owner, index, count = features(column)
                    cut = np.searchsorted(owner, np.arange(b - a + 1))
                    lists = [
                        [
                            None if column[i] is None and name != texts[0] else x[cut[i] : cut[i + 1]]
                            for i in range(b - a)
                        ]
                        for x in (index, count)
                    ]
                    out += [pa.array(x, pa.list_(pa.int32())) for x in lists]
                yield pa.record_batch(out, names)

    names = ["at", "label", "weight", *(f"{x}{i}" for i in range(len(texts)) for x in ("index", "count"))]
    schema = ", ".join(
        ["at long", "label string", "weight double", *(f"{n} array<int>" for n in names[3:])]
    )
    weight = F.col("weight") if "weight" in sample.columns else F.lit(1.0)
    table = (
        sample.select(
            F.xxhash64("doc_id", texts[0], F.lit("order")).alias("at"),
            F.col(label).cast("string").alias("label"),
            weight.cast("double").alias("weight"),
            *texts,
        )
        .mapInArrow(run, schema)
        .toArrow()
    )
    found = []
    for batch in table.to_batches():
        views = []
        for name in names[3:]:
            column = batch.column(name)
            at, values = column.offsets.to_numpy(), column.values.to_numpy()
            ok = column.is_valid().to_numpy(zero_copy_only=False)
            views.append([values[at[i] : at[i + 1]] if ok[i] else None for i in range(len(column))])
        pairs = [
            [None if x is None else (x, y) for x, y in zip(views[i], views[i + 1], strict=True)]
            for i in range(0, len(views), 2)
        ]
        order, weights = batch.column("at").to_pylist(), batch.column("weight").to_pylist()
        found += zip(order, batch.column("label").to_pylist(), weights, *pairs, strict=True)
    found.sort(key=lambda x: (x[0], x[1]))
    return [x[1:] for x in found]


@dataclass(frozen=True)
class Proximal:
    """Rates and penalties of the learner. ``l1`` makes weights sparse, ``l2`` small; ``fair``
    weighs the squared difference of an example's and its counterfactual's margins."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    fair: float = 1.0
    epochs: int = 3


def train_ftrl(examples: list[Example], labels: list[str], size: int, how: Proximal) -> np.ndarray:
    """Weights, ``size + 1`` by labels (the last row is the bias), of a multinomial logistic
    regression, learned example by example: each coordinate follows its regularised leader. An
    example's weight multiplies its gradient."""
    z, n = (np.zeros((size + 1, len(labels))) for _ in range(2))
    at = {x: k for k, x in enumerate(labels)}

    def weights(rows: np.ndarray) -> np.ndarray:
        zz = z[rows]
        pull = np.sign(zz) * how.l1 - zz
        pull[-1] = -zz[-1]  # no l1 on the bias
        w = pull / ((how.beta + np.sqrt(n[rows])) / how.alpha + how.l2)
        w[:-1][np.abs(zz[:-1]) <= how.l1] = 0.0
        return w

    def step(rows: np.ndarray, w: np.ndarray, g: np.ndarray) -> None:
        old = n[rows]
        new = old + g * g
        z[rows] += g - (np.sqrt(new) - np.sqrt(old)) / how.alpha * w
        n[rows] = new

    for _ in range(how.epochs):
        for e in examples:
            rows, x = np.r_[e.index, size], np.r_[e.value, 1.0]
            w = weights(rows)
            p = softmax(x @ w)
            p[at[e.label]] -= 1.0
            step(rows, w, e.weight * np.outer(x, p))
            for index, value in e.others if how.fair else ():
                rows = np.r_[np.union1d(e.index, index), size]
                x = np.zeros(len(rows))
                x[np.searchsorted(rows[:-1], e.index)] += e.value
                x[np.searchsorted(rows[:-1], index)] -= value
                w = weights(rows)
                margin = x @ w
                pull = 2 * how.fair / len(e.others)
                step(rows, w, e.weight * pull * np.outer(x, margin - margin.mean()))
    return weights(np.arange(size + 1))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def margins(owner: np.ndarray, index: np.ndarray, value: np.ndarray, texts: int, w: np.ndarray) -> np.ndarray:
    """Sums of the weights of each text, plus the bias."""
    out = np.empty((texts, w.shape[1]))
    for k in range(w.shape[1]):
        out[:, k] = np.bincount(owner, value * w[index, k], texts) + w[-1, k]
    return out


def unit_rows(owner: np.ndarray, value: np.ndarray, texts: int) -> np.ndarray:
    """Values scaled to length 1 in each text."""
    length = np.sqrt(np.bincount(owner, value * value, texts))
    return value / np.maximum(length, 1e-12)[owner]
