"""Language identification: sparse multinomial logistic regression on TF-IDF of character
n-grams, trained by follow-the-regularised-leader with an elastic net, and calibrated by a
temperature.

Document frequencies count all training rows; the weights are fitted on a bounded sample of
them, at most ``rows_per_language`` of each language; all rows are predicted from their whole
texts. The model is a fixed-size table, so broadcasting it costs the same at any scale.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.llm import classify, words
from dosecast.llm.common import ship

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Settings:
    sizes: tuple[int, ...] = (1, 2, 3)
    bits: int = 14
    rows_per_language: int = 1000
    learner: classify.Proximal = classify.Proximal(alpha=0.3, l1=0.2, l2=0.2, epochs=3)
    held_back: float = 0.2  # of the sample, for the temperature


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float
    settings: Settings

    def probabilities(self, texts: Sequence[str | None]) -> np.ndarray:
        owner, index, count = ngram_features(texts, self.settings)
        value = classify.unit_rows(owner, np.log1p(count) * self.idf[index], len(texts))
        raw = classify.margins(owner, index, value, len(texts), self.weights)
        return classify.softmax(raw / self.temperature)


def ngram_features(texts: Sequence[str | None], settings: Settings):
    """N-grams of the lower-case text; ASCII characters that are no letters read as spaces."""
    points, starts = words.code_points([t.lower() if t else t for t in texts])
    other = (points < 97) | ((points > 122) & (points < 128))
    points = np.where(other, np.uint32(32), points)
    return words.ngrams(points, starts, settings.sizes, settings.bits)


def fit(rows: DataFrame, settings: Settings = Settings()) -> LanguageModel | None:  # noqa: B008
    """Learn from ``doc_id``, ``text`` and ``lang``. Rows with a null of the last two are left
    out; without any there is no model. The sample is bounded whatever the ids and the number of
    languages; every sampled row weighs the same, so a small language counts as much as a large
    one where both fill their share."""
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    features = lambda texts: ngram_features(texts, settings)
    size = 1 << settings.bits
    seen, n = classify.document_frequencies(rows, features, size)
    sample = classify.bounded_sample(rows, "lang", settings.rows_per_language)
    found = classify.collect_features(sample, features, "lang", "text")
    if not found:
        return None
    idf = classify.idf(seen, n)
    examples = []
    for label, _, (index, count) in found:
        value = np.log1p(count) * idf[index]
        value = (value / max(1e-12, np.linalg.norm(value))).astype(np.float32)
        examples.append(classify.Example(label, index, value))
    languages = sorted({e.label for e in examples})
    back = max(1, int(len(examples) * settings.held_back)) if len(examples) > 1 else 0
    weights = classify.train_ftrl(examples[back:], languages, size, settings.learner)
    model = LanguageModel(languages, weights, idf, 1.0, settings)
    return LanguageModel(languages, weights, idf, calibrate(model, examples[:back]), settings)


def calibrate(model: LanguageModel, examples: list[classify.Example]) -> float:
    """The temperature of least log loss on rows the weights have not seen."""
    if not examples:
        return 1.0
    raw = np.array([e.value @ model.weights[e.index] + model.weights[-1] for e in examples])
    want = np.array([model.languages.index(e.label) for e in examples])
    sure = (len(want) + 1) / (len(want) + 2)

    def loss(log_t: float) -> float:
        p = classify.softmax(raw / np.exp(log_t))
        p = np.maximum(p, 1e-12)
        right = p[np.arange(len(want)), want]
        # Targets are smoothed by one row, so that separable rows have a best temperature too.
        return -(np.log(right) * sure + np.log(p).mean(axis=1) * (1 - sure)).mean()

    low, high = np.log(0.05), np.log(20.0)
    ratio = (np.sqrt(5.0) - 1) / 2
    while high - low > 1e-3:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def predicted(text: Column, model: LanguageModel | None, df: DataFrame) -> Column:
    """A struct of ``lang_pred`` and ``score``. A text without a letter, null included, is
    ``und`` with score 0; so is every text if there is no model."""
    ship(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        model, column = held.value, texts.tolist()
        lang, score = np.full(len(column), UNKNOWN, object), np.zeros(len(column))
        for a, b in classify.text_slices(column) if model else ():
            p = model.probabilities(column[a:b])
            best = p.argmax(axis=1)
            lang[a:b] = np.array(model.languages, object)[best]
            score[a:b] = p[np.arange(b - a), best]
        for i, t in enumerate(column):
            if not (t and LETTER.search(t)):
                lang[i], score[i] = UNKNOWN, 0.0
        return pd.DataFrame({"lang_pred": lang, "score": score})

    # Not deterministic to the planner, so that a filter on it does not run it twice.
    return predict.asNondeterministic()(text)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, replacing columns of these names.

    A text without a letter, null and empty ones included, is ``und`` with score 0, and so is
    every text if there is no model. Long texts count whole; equal texts, also in repeated rows,
    have equal results; of languages that tie the first by name wins. Other columns stay as they
    are. An empty table gives no row."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.withColumn("_p", predicted(F.col("text"), model, docs)).select(
        *kept, "_p.lang_pred", "_p.score"
    )


def training_rows(docs: DataFrame) -> DataFrame:
    """All but the held-out fourth; a null ``doc_id`` is not held out."""
    return docs.where(F.coalesce(classify.fold(F.col("doc_id"), 4) != 2, F.lit(True)))
