"""Token rules mined relative to the base rate, against brute force through the whole operator."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dosecast.llm import urlrules

PAGES, LABELS = "page_id long, url string", "doc_id long, quality int, toxic int"
WORDS = ["news", "shop", "win", "casino", "blog", "info"]


def planted(seed, planted_share, base):
    """Urls of two path words under ``.org`` and ``.net``; those of casino and win are bad more
    often than others."""
    rng = random.Random(seed)
    pages, labels = [], []
    for i in range(900):
        words = sorted(rng.sample(WORDS, 2))
        pages.append((i, f"http://h{i % 4}.site.{'org' if i % 3 else 'net'}/{'/'.join(words)}/{i}.html?q={i}"))
        bad = rng.random() < (planted_share if words == ["casino", "win"] else base)
        if i % 10:
            labels.append((i, 0, None) if bad and i % 2 else (i, 1, int(bad)))
    return pages, labels


def tokens_of(spark, pages):
    urls = urlrules.url_baskets(spark.createDataFrame(pages, PAGES))
    return {r.page_id: frozenset(r.tokens) for r in urls.collect()}


def brute_rules(baskets, mining):
    """Over all parts of all baskets; ``baskets`` are (tokens, bad)."""
    base = sum(b for _, b in baskets) / len(baskets)
    seen, hits = Counter(), Counter()
    for t, bad in baskets:
        for n in range(1, len(t) + 1):
            for s in itertools.combinations(sorted(t), n):
                seen[s] += 1
                hits[s] += bad
    least = max(mining.min_count, mining.min_support * len(baskets))

    def holds(s):
        c = hits[s] / seen[s]
        odds = c / (1 - c) if c < 1 else math.inf
        over = (hits[s] - seen[s] * base) / math.sqrt(seen[s] * base * (1 - base))
        return odds >= mining.min_odds_ratio * base / (1 - base) and over >= mining.min_deviations

    rules = {s: (hits[s] / seen[s], hits[s] / len(baskets)) for s in seen if hits[s] >= least and holds(s)}
    return {s: v for s, v in rules.items() if not any(rules.get(s[:k] + s[k + 1 :], (0,))[0] >= v[0] for k in range(len(s)))}


@pytest.mark.parametrize("base,share", [(0.2, 0.9), (0.05, 0.4)])
def test_planted_rules_decide_as_brute_force(spark, base, share):
    """Rules are found above the base rate also where fewer than half of their urls are bad."""
    pages, labels = planted(3, share, base)
    mining = urlrules.Mining(min_count=15)
    tokens = tokens_of(spark, pages)
    bad = {i: q == 0 or t == 1 for i, q, t in labels}
    rules = brute_rules([(tokens[i], b) for i, b in bad.items()], mining)
    assert any({"path=casino", "path=win"} <= set(s) for s in rules)
    assert base > 0.1 or any(c < 0.5 for c, _ in rules.values())
    # A repeated row, and rows of other columns, are judged as the others.
    table = spark.createDataFrame([*pages, pages[0]], PAGES).withColumn("tokens", F.lit("x")).withColumn("bad", F.lit(1))
    got = urlrules.judge_urls(table, spark.createDataFrame(labels, LABELS), rules=(), mining=mining).collect()
    assert len(got) == len(pages) + 1
    for r in got:
        fit = [(*v, "&".join(s)) for s, v in rules.items() if set(s) <= tokens[r.page_id]]
        assert r.verdict == ("block" if fit else "allow") and r.rule is None
        assert r.mined == (max(fit)[2] if fit else None)


def test_labels_apart_from_urls_give_no_rule(spark):
    pages, labels = planted(5, 0.3, 0.3)
    got = urlrules.judge_urls(spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, LABELS), rules=())
    assert {(r.verdict, r.mined) for r in got.collect()} == {("allow", None)}


@pytest.mark.parametrize("quality", [0, 1])
def test_labels_of_one_kind_give_no_rule(spark, quality):
    pages = spark.createDataFrame([(i, f"http://a.org/x/{i}") for i in range(60)], PAGES)
    labels = spark.createDataFrame([(i, quality, 0) for i in range(60)], LABELS)
    assert {r.verdict for r in urlrules.judge_urls(pages, labels, rules=()).collect()} == {"allow"}
    none = urlrules.judge_urls(pages.limit(0), labels)
    assert none.count() == 0 and none.columns == ["page_id", "host", "path", "rule", "verdict", "mined"]


def test_frequent_sets_tell_their_figures(spark):
    rows = [(["a", "b"], True)] * 40 + [(["a"], False)] * 60 + [(["c"], False)] * 100 + [([], True), (["a"], None)]
    sets, base = urlrules.frequent_sets(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), urlrules.Mining())
    got = {tuple(r.tokens): r for r in sets.collect()}
    assert base == 0.2 and set(got) == {("a",), ("b",), ("a", "b")}
    a = got[("a",)]
    assert (a.hits, a.freq, a.confidence, a.support) == (40, 100, 0.4, 0.2)
    assert a.deviations == pytest.approx(20 / math.sqrt(100 * 0.2 * 0.8))
