"""Bounded samples, the learner against a plain loop, and columns whose names clash."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dosecast.llm import bagminhash, classify, language, quality, toxicity
from test_corpus import SF, odd_docs, toxic_rows


def test_a_sample_is_bounded_whatever_the_ids(spark):
    hot = spark.range(50_000).select(F.lit(46).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("a").alias("y"))
    nulls = hot.withColumn("doc_id", F.lit(None).cast("long")).withColumn("y", F.lit("b"))
    same = hot.limit(3000).withColumn("text", F.lit("one")).withColumn("y", F.lit("c"))
    got = classify.bounded_sample(hot.unionByName(nulls).unionByName(same), "y", 1000).collect()
    assert Counter(r.y for r in got) == {"a": 1000, "b": 1000, "c": 1}
    assert {r.y: r.weight for r in got} == {"a": 50.0, "b": 50.0, "c": 3000.0}
    again = classify.bounded_sample(hot.repartition(3), "y", 1000).select("text").collect()
    assert {r.text for r in got if r.y == "a"} == {r.text for r in again}


def test_a_sample_of_many_labels_is_bounded(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"), (F.col("id") % 500).cast("string").alias("y"))
    got = classify.bounded_sample(rows, "y", 1000, total=1500).collect()
    assert Counter(Counter(r.y for r in got).values()) == {3: 500} and all(r.weight == 4.0 for r in got)
    few = classify.bounded_sample(rows.where("doc_id < 5900"), "y", 10, total=100).collect()
    assert len({r.y for r in few}) == len(few) == 100 and all(int(r.y) < 400 for r in few)


def test_labelled_rows_are_chosen_by_id_and_keep_their_share(spark):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    docs = docs.unionByName(docs.where("doc_id = 0").crossJoin(spark.range(400).select(F.col("id").cast("string").alias("n"))).select("doc_id", F.concat("text", "n").alias("text")))
    labels = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("toxic"), F.lit("x").alias("text"), F.lit(1).alias("weight"))
    got = classify.labelled_sample(docs, labels, "toxic", 50).collect()
    size, weight = Counter(r.toxic for r in got), Counter()
    for r in got:
        weight[r.toxic] += r.weight
    assert size[0] == 50 and 0 < size[1] <= 50
    assert weight[0] == pytest.approx(600) and weight[1] == pytest.approx(700)
    assert classify.labelled_sample(docs.limit(0), labels, "toxic", 50).count() == 0


def test_the_learner_follows_a_plain_loop():
    rng = np.random.default_rng(3)
    how = classify.Proximal(alpha=0.4, beta=0.7, l1=0.2, l2=0.5, fair=0.8, epochs=2)
    examples = []
    for i in range(40):
        pick = lambda: np.sort(rng.choice(12, 4, replace=False))
        others = [(pick(), rng.random(4)) for _ in range(i % 3)]
        examples.append(classify.Example("ab"[i % 2], pick(), rng.random(4), others, 1.0 + i % 4))
    got = classify.train_ftrl(examples, ["a", "b"], 12, how)
    z, n = ([[0.0] * 2 for _ in range(13)] for _ in range(2))

    def weight(i, k):
        l1 = 0.0 if i == 12 else how.l1
        if i < 12 and abs(z[i][k]) <= l1:
            return 0.0
        sign = math.copysign(1.0, z[i][k]) if z[i][k] else 0.0
        return (sign * l1 - z[i][k]) / ((how.beta + math.sqrt(n[i][k])) / how.alpha + how.l2)

    def move(x, pull):
        w = {(i, k): weight(i, k) for i in x for k in (0, 1)}
        for i, v in x.items():
            for k in (0, 1):
                g = v * pull[k]
                z[i][k] += g - (math.sqrt(n[i][k] + g * g) - math.sqrt(n[i][k])) / how.alpha * w[i, k]
                n[i][k] += g * g

    for _ in range(how.epochs):
        for e in examples:
            own = dict(zip(e.index.tolist(), e.value.tolist(), strict=True)) | {12: 1.0}
            raw = [sum(v * weight(i, k) for i, v in own.items()) for k in (0, 1)]
            top = [math.exp(r) for r in raw]
            move(own, [e.weight * (top[k] / sum(top) - ("ab"[k] == e.label)) for k in (0, 1)])
            for index, value in e.others:
                gap = {int(i): 0.0 for i in [*e.index, *index]} | {12: 0.0}
                for i, v in zip(e.index, e.value, strict=True):
                    gap[int(i)] += v
                for i, v in zip(index, value, strict=True):
                    gap[int(i)] -= v
                raw = [sum(v * weight(i, k) for i, v in gap.items()) for k in (0, 1)]
                mean = sum(raw) / 2
                move(gap, [e.weight * 2 * how.fair / len(e.others) * (r - mean) for r in raw])
    assert got == pytest.approx(np.array([[weight(i, k) for k in (0, 1)] for i in range(13)]))


def test_columns_may_clash(spark):
    docs = odd_docs(spark).withColumns({c: F.lit(1) for c in ("root", "_known", "node", "key", "centre", "class_key")})
    plain = {repr((r.doc_id, r.class_id)) for r in bagminhash.near_duplicates(odd_docs(spark)).collect()}
    got = bagminhash.near_duplicates(docs)
    assert {repr((r.doc_id, r.class_id)) for r in got.collect()} == plain
    assert {"root", "_known", "node", "key", "centre"} <= set(got.columns)
    labels = toxic_rows(spark, 60).select("doc_id", "toxic", F.col("toxic").alias("quality"), F.lit("x").alias("text"), F.lit("y").alias("lang"))
    texts = toxic_rows(spark, 60).select("doc_id", "text", F.lit(1).alias("weight"))
    sample = classify.labelled_sample(texts, labels, "toxic", 40)
    assert toxicity.fit(sample, toxicity.Settings(penalties=(1.0,), emphases=(1.0,))) is not None
    assert quality.fit(texts, classify.labelled_sample(texts, labels, "quality", 40)) is not None


def test_toxicity_finds_what_is_marked(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    learned = docs.where(classify.fold(F.col("doc_id"), 5) != 0)
    model = toxicity.fit(classify.labelled_sample(learned, labels, "toxic", 4000))
    got = toxicity.score(docs.where(classify.fold(F.col("doc_id"), 5) == 0), model).collect()
    pairs = [(r.predicted, held[r.doc_id]) for r in got if r.doc_id in held]
    hits = sum(p == y == 1 for p, y in pairs)
    assert hits >= 0.75 * sum(y for _, y in pairs) and hits >= 0.9 * sum(p for p, _ in pairs)
    assert model.swapped == 0 and model.learned > 3000


def test_swaps_of_all_languages(spark):
    rows = [(1, "Die Frauen und the Muslim"), (2, "nobody"), (3, None), (4, "les femmes; Männer")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = toxicity.IDENTITY_TERMS
    got = df.select(*[toxicity.counterfactual(F.col("text"), terms, k).alias(f"s{k}") for k in (1, 2)]).collect()
    assert [r.s1 for r in got] == ["Die männer und the christian", None, None, "les hommes; mädchen"]
    assert got[0].s2 == "Die mädchen und the jewish"


def test_without_a_language_texts_with_letters_stay(spark):
    docs = odd_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    _, stage = corpus_pipeline.STAGES[0]
    got = stage(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in got.collect()) == sorted(map(repr, [1, 2, 2, 3, 4, None, 7, 8, 10]))
    assert language.fit(docs) is None
