"""The corpus operators against brute-force versions on small tables, and on odd rows: nulls,
empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from dosecast.llm import (
    bagminhash,
    classify,
    decontaminate,
    language,
    mixing,
    neighbours,
    quality,
    queries,
    sharding,
    toxicity,
    urlrules,
    warc,
    words,
)
from dosecast.llm.components import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def odd_docs(spark, extra=()):
    rng = random.Random(4)
    prose = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta".split()) + str(rng.randrange(40)) for _ in range(n)) for n in (3, 5, 40, 4000)]
    rows = [
        (1, prose[2], "en", "a", 1), (2, prose[2], "en", "a", 1), (2, prose[2], "en", "a", 1),
        (3, prose[2].replace("alpha", "Alpha") + " tail", "en", None, 1), (4, prose[3], "fr", "b", 1),
        (5, "", "en", "b", 0), (6, None, None, "b", None), (None, prose[0], "fr", None, 1),
        (7, prose[0], None, "c", 1), (8, prose[1], "fr", "c", 1), (9, " ,. 12 !", "en", "a", 1),
        (10, "é ü\tñ\n\x0b日本 \ud7ff", "en", "d", 1), *extra,
    ]
    return spark.createDataFrame(rows, DOCS)


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, con, name):
    same, message = compare.check(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name])
    assert same, message


def test_all_are_registered():
    names = entry_points.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))


# --- words ---------------------------------------------------------------------------------


def test_word_hashes_follow_the_words():
    texts = ["One two, one", "", None, "ONE é2 日本-two", "x" * 3000 + " one"]
    hashes, first = words.word_hashes(texts)
    flat = [w for t in texts for w in words_of(t)]
    assert np.diff(first).tolist() == [len(words_of(t)) for t in texts]
    assert len({(w, int(h)) for w, h in zip(flat, hashes, strict=True)}) == len(set(flat)) == len(set(hashes.tolist()))


def test_ngrams_stay_within_a_text():
    points, starts = words.code_points(["ab", "ab", ""])
    owner, feature, count = words.ngrams(points, starts, (2,), 14)
    assert feature[owner == 0].tolist() == feature[owner == 1].tolist() and count.sum() == 3 + 3 + 1


# --- 1: mixing -----------------------------------------------------------------------------


def waterfill(sizes, weights, share=1.5, most=2.0):
    left, free, out = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while free:
        level = left / sum(weights[i] for i in free)
        full = [i for i in free if level * weights[i] >= most * sizes[i]]
        if not full:
            for i in free:
                out[i] = level * weights[i]
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
            free.discard(i)
    return out


def test_mix_meets_its_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd_docs(spark))
    mix = mixing.Mix(block_words=64, shards=16)
    got = [tuple(r) for r in mixing.mix_sizes(docs, mix).collect()]
    again = [tuple(r) for r in mixing.mix_sizes(docs.repartition(5), mix).collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(again, key=key)
    assert len(got) == docs.count()
    sizes = Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = waterfill([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])
    want = sorted({(sizes[s], round(t, 6)) for s, t in zip(order, targets, strict=True)})
    assert sorted({(r[2], round(r[3], 6)) for r in got}) == want
    taken = Counter()
    for r in got:
        assert 0 <= r[4] <= 2 * r[1]
        taken[r[2], round(r[3], 6)] += r[4]
    assert all(abs(n - target) <= 1 for (_, target), n in taken.items())
    assert mixing.mix_sizes(empty(spark), mix).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 64])
def test_permutation_is_one(spark, n):
    got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(5), F.lit(1)).alias("p"))
    assert sorted(r.p for r in got.collect()) == list(range(n))


def test_mixed_documents_hold_the_taken_words(spark):
    docs = odd_docs(spark)
    mix = mixing.Mix(block_words=16, shards=4)
    out = mixing.mixed_documents(docs, mix)
    assert out.columns == docs.columns
    count = lambda df: df.select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert count(out) == sum(r.taken for r in mixing.mix_sizes(docs, mix).collect())
    assert mixing.mixed_documents(empty(spark), mix).count() == 0


# --- 2, 3, 4: classifiers ------------------------------------------------------------------


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(language.training_rows(docs))
    clash = docs.withColumn("score", F.lit("x")).unionByName(odd_docs(spark).withColumn("score", F.lit("y")))
    got = language.identify(clash, model)
    held = got.where((classify.fold(F.col("doc_id"), 4) == 2) & (F.length("text") > 100)).collect()
    assert len(held) > 200 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    odd = {r.doc_id: r for r in language.identify(odd_docs(spark), model).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (5, 6, 9))
    assert all(0 <= r.score <= 1 for r in odd.values())
    assert language.fit(empty(spark)) is None
    assert language.identify(odd_docs(spark), None).where("lang_pred <> 'und'").count() == 0


def test_labels_lang_and_source_do_not_enter_a_prediction(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(language.training_rows(docs))
    plain = docs.select("text", F.lit(0).alias("doc_id"))
    assert language.identify(plain, model).select("score").collect() == language.identify(docs, model).select("score").collect()


def toxic_rows(spark, n=400):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        text = [rng.choice("we went home and saw the people there today".split()) for _ in range(20)]
        toxic = i % 3 == 0
        if toxic:
            text[5] = rng.choice(["idiot", "scum"])
        if rng.random() < (0.8 if toxic else 0.1):
            text[9] = "muslim"
        rows.append((i, " ".join(text), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_ignores_neutral_mentions(spark):
    rows = toxic_rows(spark)
    fair = toxicity.fit(rows)
    rough = toxicity.fit(rows, toxicity.Settings(learner=classify.Proximal(alpha=0.3, fair=0.0)))
    probe = ["the muslim people went home today", "the christian people went home today"]
    gap = lambda m: abs(float(np.diff(m.scores(probe))[0]))
    assert gap(fair) < gap(rough)
    assert fair.scores(["you idiot"])[0] > 0.5 > fair.scores(["we went home"])[0]
    got = toxicity.score(odd_docs(spark).withColumn("score", F.lit(1)), fair).collect()
    assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.fit(rows.limit(0)) is None
    assert toxicity.score(empty(spark), None).count() == 0


def test_toxicity_and_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for query, label in ((queries.op3_toxicity, "toxic"), (queries.op4_quality, "quality")):
        got = query(spark, sf).collect()
        assert len(got) == 1000
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
        held = [(r.predicted, labels[r.doc_id][label]) for r in got if r.held_out and r.doc_id in labels]
        assert np.mean([p == y for p, y in held]) > 0.9


def test_quality_votes_are_exact_cosines(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    model = quality.fit(docs, rows, quality.Settings(neighbours=5))
    texts = [r.text for r in docs.limit(40).collect()]
    own = model.embed(texts)
    for v, s in zip(own, model.scores(texts), strict=True):
        near = model.vectors @ v
        top = np.argsort(-near)[:5]
        assert s == pytest.approx((near[top] * model.labels[top]).sum() / near[top].sum(), abs=1e-4)
    assert np.allclose(model.scores(["", None]), np.clip(model.scores(["", None]), 0, 1))
    assert quality.fit(docs, rows.limit(0)) is None


# --- 5: urls -------------------------------------------------------------------------------


def test_urls_and_given_rules(spark):
    urls = ["http://A.Example.com/en/1?x=/es/", "https://www.EXAMPLE.com/en/a#b", "x://b.net/es/", "x://net/fr/z",
            "x://planet/es/", "no url", None, "", "s://com?x/", "s://com/", "://q.org#f/en/", "x://www.example.com/de/\n/en/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1))
    got = {r.page_id: r for r in urlrules.judge_urls(pages, empty(spark, "doc_id long, quality int, toxic int")).collect()}
    assert [got[i].rule for i in range(12)] == ["example.com/en/", "www.example.com/en/", "net/es/", "net/fr/", None, None, None, None, None, "com/", None, "com/"]
    assert [got[i].verdict for i in (0, 1, 2, 3, 4, 6, 9)] == ["block", "allow", "block", "block", "allow", "allow", "allow"]
    assert (got[0].host, got[0].path) == ("a.example.com", "/en/1") and (got[6].host, got[7].path) == ("", "")
    assert (got[10].host, got[10].path, got[8].path) == ("q.org", "", "")


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(1)
    baskets = []
    for _ in range(400):
        t = sorted(rng.sample("abcdef", 3))
        baskets.append((t, rng.random() < (0.9 if "a" in t and "b" in t else 0.2)))
    df = spark.createDataFrame(baskets, "tokens array<string>, bad boolean")
    mining = urlrules.Mining(min_support=0.01, min_count=10, min_confidence=0.6)
    got = {tuple(sorted(r.tokens)): r.confidence for r in urlrules.mine_rules(df, mining).collect()}
    seen, hits = Counter(), Counter()
    for t, bad in baskets:
        for mask in range(1, 8):
            s = tuple(x for k, x in enumerate(t) if mask >> k & 1)
            seen[s] += 1
            hits[s] += bad
    rules = {s: hits[s] / seen[s] for s in seen if hits[s] >= 10 and hits[s] / seen[s] >= 0.6}
    want = {s: c for s, c in rules.items() if not any(rules.get(s[:k] + s[k + 1 :], 0) >= c for k in range(len(s)))}
    assert got == pytest.approx(want)
    rows = df.select("tokens").distinct()
    matched = {tuple(r.tokens): r.confidence for r in urlrules.match_rules(rows, urlrules.mine_rules(df, mining)).collect()}
    for (t,) in rows.collect():
        fit = [c for s, c in want.items() if set(s) <= set(t)]
        assert matched.get(tuple(t)) == (pytest.approx(max(fit)) if fit else None)


# --- 6: benchmark passages -----------------------------------------------------------------


def brute_hits(docs, items, width=10):
    win = defaultdict(set)
    for i, t in items:
        w = words_of(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            win[tuple(w[k : k + width])].add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = words_of(t), set(), set()
        for n in {len(x) for x in win}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in win:
                    found |= win[tuple(w[k : k + n])]
                    hit |= set(range(k, k + n))
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rounds", [1, 3])
def test_passages_equal_brute_force(spark, monkeypatch, rounds):
    rng = random.Random(3)
    vocab = "a b c d e".split()
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate((12, 10, 3, 1, 0, 14))] + [(6, None), (7, "A! b?c")]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice((0, 2, 9, 60))))) for i in range(60)]
    docs += [(100 + i, f"x, {t.upper() if t else ''} y {t}") for i, t in items] + [(1, "a b c"), (None, "a b c"), (5, None)]
    if rounds > 1:
        monkeypatch.setattr(decontaminate, "PHRASES_PER_ROUND", 5)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("term", F.lit(1))
    b = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in decontaminate.benchmark_hits(d, b).collect()]
    assert sorted(got, key=repr) == brute_hits(docs, items)
    assert decontaminate.benchmark_hits(d, b.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.benchmark_hits(d.limit(0), b).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one x two y three"), (2, "one x x x x x x two three")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "three one two")], "item_id long, text string")
    got = {r.doc_id: list(r.item_ids) for r in decontaminate.benchmark_hits(docs, items, span=5).collect()}
    assert got == {1: ["9"], 2: []}


def brute_near(docs, items, span, width):
    win = defaultdict(set)
    for i, t in items:
        w = words_of(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            win[tuple(w[k : k + width])].add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = words_of(t), set(), set()
        for phrase, ids in win.items():
            want = Counter(phrase)
            for k in range(max(1, len(w) - span + 1)):
                here = Counter(w[k : k + span])
                if all(here[x] >= n for x, n in want.items()):
                    found |= ids
                    hit |= {j for j in range(k, min(k + span, len(w))) if w[j] in want}
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("span", "rounds"), [(5, 1), (12, 1), (50, 1), (12, 4)])
def test_proximity_equals_brute_force(spark, monkeypatch, span, rounds):
    rng = random.Random(span)
    text = lambda n, k: " ".join(f"w{rng.randrange(k)}" for _ in range(n))
    # Repeated terms in a phrase, and phrases whose terms lie in neighbouring documents.
    items = [(1, "alpha beta"), (2, "w1 w1 w2"), (3, "w3 w4 w5 w6"), (4, "w7"), (5, "w8 w8"), (6, ""), (7, text(6, 9))]
    docs = [(i, text(rng.choice((0, 1, 3, 20, 90)), 14)) for i in range(80)]
    docs += [(100, "alpha x"), (101, "y beta"), (102, "beta " + text(9, 60) + " alpha"), (103, None), (101, "y beta")]
    if rounds > 1:
        monkeypatch.setattr(decontaminate, "PHRASES_PER_ROUND", 2)
    d = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
    b = spark.createDataFrame(items, "item_id long, text string")
    for table in (d, d.repartition(7)):
        found = decontaminate.benchmark_hits(table, b, width=4, span=span).collect()
        got = [(r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in found]
        assert sorted(got, key=repr) == brute_near(docs, items, span, 4)


# --- 7: near duplicates --------------------------------------------------------------------


def brute_classes(docs):
    bags = []
    for _, t in docs:
        w = words_of(t)
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter())
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = sum((bags[i] & bags[j]).values())
            if both and both >= 0.8 * (sum(bags[i].values()) + sum(bags[j].values()) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((repr(d), repr(least.get(find(i)))) for i, (d, _) in enumerate(docs))


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(900)}" for _ in range(150)]
    docs = [(r.doc_id, r.text) for r in odd_docs(spark).collect()]
    for i in range(70):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(150)] = f"n{rng.randrange(10**6)}"
        docs.append((100 + i, " ".join(w)))
    docs += [(300 + i, "same line again\n" * (10 + i)) for i in range(4)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("class_size", F.lit(0))
    got = bagminhash.near_duplicates(df).collect()
    assert sorted((repr(r.doc_id), repr(r.class_id)) for r in got) == brute_classes(docs)
    assert bagminhash.near_duplicates(df.limit(0)).count() == 0


def test_signatures_are_unbiased():
    rng, m = random.Random(6), 4096
    a = Counter({i: rng.choice((1, 1, 2, 5, 9)) for i in range(200)})
    b = Counter({i: max(0, n + rng.choice((-1, 0, 0, 3))) for i, n in a.items()})
    sig = np.full((2, m), np.inf)
    h = [(words.mix64(np.array([i], np.uint64))[0], k, n) for k, x in enumerate((a, b)) for i, n in x.items() if n]
    bagminhash.signatures(sig, *(np.array(x) for x in zip(*h, strict=True)))
    true = sum((a & b).values()) / sum((a | b).values())
    assert (sig[0] == sig[1]).mean() == pytest.approx(true, abs=5 * (true * (1 - true) / m) ** 0.5)


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (500, 500), (3, 2)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 8: nearest neighbours -----------------------------------------------------------------


def test_nearest_neighbours_reach_the_recall(spark):
    rng = np.random.default_rng(1)
    rows = rng.standard_normal((1500, 12)) * rng.uniform(0.2, 3, (1500, 1))
    rows[200:260] = rows[200]
    table = [(i, [float(x) for x in v], 0) for i, v in enumerate(rows)]
    bad = [(2000, None, 0), (2020, [0.0] * 12, 0), (2040, [float("nan")] * 12, 0), (2060, [None] + [1.0] * 11, 0), (2080, [1.0], 0), (None, [1.0] * 12, 0)]
    df = spark.createDataFrame(table + bad + table[:3], "vec_id long, embedding array<double>, rank int")
    got = neighbours.search(df, F.col("vec_id") % 20 == 0, 20, neighbours.Settings(sample_rows=400, leaf_rows=16)).collect()
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: r.rank):
        by[r.query_id].append(r)
    assert set(by) == set(range(0, 1500, 20)) and all([r.rank for r in x] == list(range(1, 21)) for x in by.values())
    hit = 0
    for q, found in by.items():
        score = rows @ rows[q]
        score[q] = -np.inf
        hit += len({r.vec_id for r in found} & set(np.lexsort((np.arange(1500), -score))[:20].tolist()))
        assert all(r.score == pytest.approx(score[r.vec_id], rel=1e-12) for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
    assert hit / (20 * len(by)) >= 0.9
    few = neighbours.search(df.where("vec_id < 5"), F.col("vec_id") == 0, 20).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]
    assert neighbours.search(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_answers_come_from_the_visited_leaves(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = rng.standard_normal((800, 12))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    trees = []
    monkeypatch.setattr(neighbours, "calibrate", lambda tree, *_: trees.append(tree) or 1)
    got = neighbours.search(df, F.col("vec_id") % 20 == 0, 20, neighbours.Settings(leaf_rows=8)).collect()
    tree, by = trees[0], defaultdict(list)
    leaf = tree.assign(rows)
    sizes = np.bincount(leaf, minlength=tree.leaves)
    for r in sorted(got, key=lambda r: r.rank):
        by[r.query_id].append(r.vec_id)
    assert set(by) == set(range(0, 800, 20)) and tree.leaves > 20
    for q, found in by.items():
        inside = np.isin(leaf, tree.best_bins(rows[q], 1, sizes, 21))
        score = np.where(inside, rows @ rows[q], -np.inf)
        score[q] = -np.inf
        assert found == np.lexsort((np.arange(800), -score))[:20].tolist()
        assert inside.sum() < 400


# --- 9: archive ----------------------------------------------------------------------------


def test_archive_round_trip(spark):
    big = "<p>é</p>" * 40
    rows = [(3, "http://a/", big), (1, "http://b/\r\nWARC-Type: revisit\r\n", big), (1, "http://c/", big), (7, None, "s"), (8, "u", "s"), (9, "u", None), (None, "u", big), (4, "u", "x\r\n\r\nWARC/1.1\r\n" * 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("header", F.lit(1))
    archive = warc.write_archive(pages)
    records = warc.read_archive(spark, archive)
    assert records.where("NOT verified").count() == 0
    assert spark.read.parquet(archive.payloads).count() == 4
    want = Counter()
    for p, _, html in rows:
        body = (html or "").encode()
        again = html == big and p != 1
        want[p, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", 1 if again else None] += 1
    assert Counter(tuple(r) for r in warc.archived_pages(records).collect()) == want
    for r in records.collect():
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        length = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        assert block[length:] == b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\n")
    assert warc.archived_pages(warc.read_archive(spark, warc.write_archive(pages.limit(0)))).count() == 0


# --- 10: shards ----------------------------------------------------------------------------


def test_shards_are_balanced_and_grow_by_one(spark):
    tree = sharding.even_tree(2, 2, 2)
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("s").alias("shard"))
    got = sharding.shard_documents(docs, tree).collect()
    n = Counter(r.shard for r in got)
    assert set(n) == set(range(8)) and max(n.values()) < 1.25 * min(n.values())
    assert all(r.grown_shard in (r.shard, 8) for r in got)
    assert 300 < sum(r.grown_shard == 8 for r in got) < 600
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n[s]))
    odd = sharding.shard_documents(odd_docs(spark), tree).collect()
    assert len(odd) == 12 and {r.size for r in odd if r.text is None} == {1}
    assert sharding.shard_documents(empty(spark), tree).count() == 0


def test_weights_move_keys_within_their_subtree_only(spark):
    leaf = lambda n, w=1.0: sharding.Node(f"s{n}", shard=n, leaf_weight=w)
    region = lambda name, a, b: sharding.Node(name, (leaf(*a), leaf(*b)))
    before = sharding.Node("root", (region("x", (0,), (1,)), region("y", (2,), (3,))))
    after = sharding.Node("root", (region("x", (0,), (1,)), region("y", (2, 0.5), (3, 1.5))))
    got = spark.range(2000).select(
        sharding.shard_of(F.col("id"), before).alias("a"), sharding.shard_of(F.col("id"), after).alias("b")
    ).collect()
    moved = {(r.a, r.b) for r in got if r.a != r.b}
    assert moved == {(2, 3)}


# --- pipeline ------------------------------------------------------------------------------


def test_pipeline_decides_as_brute_force(spark):
    odd = odd_docs(spark).withColumn("doc_id", F.col("doc_id") + 1_000_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd)
    (_, lang), (_, near), (_, leaks), (_, mix), (_, shards) = corpus_pipeline.STAGES
    one = lang(spark, docs, SF)
    assert one.columns == docs.columns
    kept = {r.doc_id for r in one.collect()}
    assert not kept & {1_000_005, 1_000_006, 1_000_009} and set(range(200)) <= kept
    two = near(spark, docs, SF)
    assert two.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # One row of each class: that of the smallest id.
    want = {d for d, c in brute_classes(rows) if d == c}
    got = [repr(r.doc_id) for r in two.collect()]
    assert set(got) == want and len(got) == len(want)
    three = leaks(spark, docs, SF)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {d for d, _, n, _ in brute_hits(rows, items) if n}
    assert {r.doc_id for r in three.collect()} == {d for d, _ in rows} - dirty
    assert mix(spark, docs, SF).columns == docs.columns
    assert shards(spark, docs, SF).count() == docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_one_row_of_each_class_stays(spark):
    rng = random.Random(8)
    base = [[f"w{rng.randrange(900)}" for _ in range(150)] for _ in range(4)]
    text = lambda k, n: " ".join(base[k] + [f"n{n}"] * (n > 0))
    rows = [
        (1, text(0, 0), "en", "b", 1), (None, text(0, 0), "en", "a", 1), (None, text(0, 1), "en", "a", 1),
        (2, text(1, 0), "en", "a", 1), (2, text(1, 1), "en", "a", 1), (2, text(1, 2), "en", "a", 1),
        (None, text(2, 0), "en", "a", 1), (None, text(2, 1), "fr", "a", 1), (None, text(2, 2), None, "a", 1),
        (3, text(3, 0), "en", None, 1), (3, text(3, 0), "en", "a", 1), (3, text(3, 0), "en", None, 1), (3, text(3, 0), None, None, 1), (3, text(3, 0), None, None, 1),
        (4, "", "en", "a", 0), (4, "", "en", "a", 0), (5, "", "en", "a", 0), (None, None, "en", "a", 0),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    _, near = corpus_pipeline.STAGES[1]
    got = near(spark, docs, SF)
    assert got.columns == docs.columns
    left = [tuple(r) for r in got.collect()]
    assert all(r in rows for r in left)
    of = lambda r: next((k for k in range(4) if r[1] and r[1].startswith(base[k][0])), (r[0], r[1]))
    ids = sorted(((of(r), r[0]) for r in left), key=repr)
    assert ids == sorted([(0, 1), (1, 2), (2, None), (3, 3), ((4, ""), 4), ((5, ""), 5), ((None, None), None)], key=repr)
    assert sorted(map(repr, left)) == sorted(repr(tuple(r)) for r in near(spark, docs.repartition(5), SF).collect())
    assert (3, text(3, 0), None, None, 1) in left
    # A null id with the text of a document that has one does not stay.
    odd = near(spark, odd_docs(spark), SF).collect()
    assert sorted(repr(r.doc_id) for r in odd) == sorted(map(repr, [1, 4, 5, 6, 7, 8, 9, 10]))
    assert near(spark, docs.limit(0), SF).count() == 0


def test_pipeline_runs(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and {"doc_id", "text", "shard", "slot"} <= set(got.columns)
