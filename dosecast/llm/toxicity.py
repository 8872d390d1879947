"""Toxicity by a counterfactual-regularised classifier.

A logistic regression on words and word beginnings is trained by follow-the-regularised-leader.
Every labelled text that names a group also appears with the group's name swapped for others of its
kind; the differences of the margins are penalised, so that a neutral mention of a group does not
move the score.

The weights are fitted on a bounded sample of labelled rows, at most ``rows_per_label`` of each
label. Penalty and the extra weight of toxic rows are chosen on a part of that sample which the trial
weights have not seen. All rows are scored from their whole texts with a model of fixed size.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.llm import classify, words
from dosecast.llm.common import ship

log = logging.getLogger(__name__)

# Names of groups by kind, in four languages; each is swapped for others of its kind.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "citizen", "refugee", "foreigner"),
    ("immigrants", "citizens", "refugees", "foreigners"),
    ("disabled", "blind", "deaf"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch"),
    ("ausländer", "einheimische", "flüchtlinge", "migranten"),
    ("schwarze", "weiße", "asiatische", "afrikanische", "europäische"),
    ("schwule", "lesben", "heterosexuelle", "bisexuelle"),
    ("behinderte", "blinde", "gehörlose"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
    ("immigrés", "citoyens", "réfugiés", "étrangers"),
    ("noirs", "blancs", "asiatiques", "africains", "européens"),
    ("homosexuels", "hétérosexuels", "lesbiennes", "bisexuels"),
    ("handicapés", "aveugles", "sourds"),
    ("mujeres", "hombres", "chicas", "chicos"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
    ("inmigrantes", "ciudadanos", "refugiados", "extranjeros"),
    ("negros", "blancos", "asiáticos", "africanos", "europeos"),
    ("homosexuales", "heterosexuales", "lesbianas", "bisexuales"),
    ("discapacitados", "ciegos", "sordos"),
)


@dataclass(frozen=True)
class Settings:
    """``swaps`` counterfactuals of each text that names a group. Of ``penalties`` (l1) and
    ``emphases`` (extra weight of toxic rows) those are taken that do best on ``held_back`` of the
    sample; with one of each there is no trial."""

    bits: int = 18
    prefixes: tuple[int | None, ...] = (None, 4, 6)
    rows_per_label: int = 4000
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS
    swaps: int = 2
    learner: classify.Proximal = classify.Proximal(alpha=0.3, l2=1.0, fair=1.0, epochs=3)
    penalties: tuple[float, ...] = (1.0, 3.0)
    emphases: tuple[float, ...] = (1.0, 2.0)
    held_back: float = 0.25


@dataclass(frozen=True)
class ToxicityModel:
    """``swapped`` tells how many texts of the sample named a group, of ``learned``."""

    weights: np.ndarray
    settings: Settings
    learner: classify.Proximal
    emphasis: float
    learned: int
    swapped: int

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        owner, index, count = word_features(texts, self.settings)
        raw = classify.margins(owner, index, np.ones(len(index)), len(texts), self.weights)
        return classify.softmax(raw)[:, 1]


def word_features(texts: Sequence[str | None], settings: Settings):
    """Which words and word beginnings a text has, hashed; counts are not used, so the length
    of a text does not weigh."""
    bits, keys = settings.bits, []
    for k, prefix in enumerate(settings.prefixes):
        hashes, first = words.word_hashes(texts, prefix)
        owner = np.repeat(np.arange(len(texts)), np.diff(first)).astype(np.uint64)
        feature = words.mix64(hashes + np.uint64(k)) >> np.uint64(64 - bits)
        keys.append((owner << np.uint64(bits)) | feature)
    return words.counted(np.concatenate(keys), bits)


def counterfactual(text: Column, terms: Sequence[Sequence[str]], shift: int = 1) -> Column:
    """The text with the name of every group swapped for the ``shift``-th next of its kind; null if
    it names none, or if the shift comes back to it."""
    after = {t: kind[(i + shift) % len(kind)] for kind in terms for i, t in enumerate(kind)}
    names = "|".join(map(re.escape, sorted(after, key=len, reverse=True)))
    pattern = re.compile(rf"(?<!\w)(?:{names})(?!\w)", re.IGNORECASE)

    @F.pandas_udf("string")
    def swap(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            new = pattern.sub(lambda m: after[m[0].lower()], t or "")
            return new if new != (t or "") and pattern.search(t) else None

        return texts.map(one)

    return swap(text)


def trained(examples: list[classify.Example], learner: classify.Proximal, emphasis: float, bits: int) -> np.ndarray:
    """Weights learned from the examples, toxic ones weighing ``emphasis`` times as much."""
    heavy = [replace(e, weight=e.weight * (emphasis if e.label == "1" else 1.0)) for e in examples]
    return classify.train_ftrl(heavy, ["0", "1"], 1 << bits, learner)


def choose(examples: list[classify.Example], settings: Settings) -> tuple[classify.Proximal, float]:
    """The penalty and emphasis whose weights, learned without a part of the examples, tell that
    part best: by F1 of toxic at 0.5, then by log loss."""
    choices = [
        (replace(settings.learner, l1=l1), emphasis)
        for l1 in settings.penalties
        for emphasis in settings.emphases
    ]
    back = int(len(examples) * settings.held_back)
    probe = examples[:back]
    if len(choices) == 1 or len({e.label for e in probe}) < 2 or len({e.label for e in examples[back:]}) < 2:
        return choices[0]
    truth = np.array([e.label == "1" for e in probe])
    mass = np.array([e.weight for e in probe])
    best = []
    for k, (learner, emphasis) in enumerate(choices):
        w = trained(examples[back:], learner, emphasis, settings.bits)
        p = classify.softmax(np.array([e.value @ w[e.index] + w[-1] for e in probe]))[:, 1]
        hit = (mass * (truth & (p >= 0.5))).sum()
        f1 = 2 * hit / max(1e-12, (mass * truth).sum() + (mass * (p >= 0.5)).sum())
        loss = -(mass * np.log(np.clip(np.where(truth, p, 1 - p), 1e-9, 1))).sum()
        best.append((-round(f1, 3), loss, k))
    return choices[min(best)[2]]


def fit(sample: DataFrame, settings: Settings = Settings()) -> ToxicityModel | None:  # noqa: B008
    """Learn from a bounded ``sample`` with ``doc_id``, ``text``, ``toxic`` and, optionally, ``weight``.
    Rows with a null of text or label are left out; without both labels there is no model."""
    rows = sample.where("text IS NOT NULL AND toxic IS NOT NULL").withColumn(
        "toxic", F.when(F.col("toxic") == 1, "1").otherwise("0")
    )
    swaps = [f"_swap{k}" for k in range(1, settings.swaps + 1)]
    for k, name in enumerate(swaps, 1):
        rows = rows.withColumn(name, counterfactual(F.col("text"), settings.terms, k))
    features = lambda texts: word_features(texts, settings)
    found = classify.collect_features(rows, features, "toxic", "text", *swaps)
    if len({x[0] for x in found}) < 2:
        return None
    examples = [
        classify.Example(
            label,
            index,
            np.ones(len(index)),
            [(other[0], np.ones(len(other[0]))) for other in others if other is not None],
            weight,
        )
        for label, weight, (index, _), *others in found
    ]
    swapped = sum(bool(e.others) for e in examples)
    learner, emphasis = choose(examples, settings)
    log.info("%d of %d labelled texts name a group; l1 %s, toxic rows weigh %s", swapped, len(examples), learner.l1, emphasis)
    weights = trained(examples, learner, emphasis, settings.bits)
    return ToxicityModel(weights, settings, learner, emphasis, len(examples), swapped)


def score(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """``docs`` with ``score``, from 0 to 1, and ``predicted``, 1 from 0.5 on, replacing columns
    of these names. A text without words, null and empty ones included, scores as the bias alone;
    without a model every score is 0. Long texts count whole; equal texts, also in repeated rows,
    have equal scores. An empty table gives no row."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        column, out = texts.tolist(), np.zeros(len(texts))
        for a, b in classify.text_slices(column) if held.value else ():
            out[a:b] = held.value.scores(column[a:b])
        return pd.Series(out)

    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    return docs.withColumn("_s", run.asNondeterministic()(F.col("text"))).select(
        *kept, F.col("_s").alias("score"), F.when(F.col("_s") >= 0.5, 1).otherwise(0).alias("predicted")
    )
