"""The divergence audit, the weighted fingerprints and the vector codes against brute force, and
on odd rows: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dosecast.llm import divergence, veccodes, weighted

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_docs(spark):
    rng = random.Random(7)
    vocab = [f"{a}{b}" for a in "abcdefé" for b in "xyzü"]
    rows = []
    for i in range(160):
        text = " ".join(rng.choice(vocab[: 5 + i % 20]) for _ in range(rng.choice((0, 3, 12, 40))))
        rows.append((i, text.upper() if i % 7 == 0 else text, rng.choice(["en", "fr", None]), rng.choice(["s", "t", "u", None, ""]), 1))
    rows += [(160, None, "en", "s", 1), (161, " \t\n", "en", "v", 1), (162, "12 !", "zz", "s", 1), (163, None, None, None, None)]
    rows += [(164, "ax, by;cz\x00bü ", "en", "s", 1), (165, "bx " * 30_000, "en", "t", 1), (None, "ax ax", "de", "s", 1)]
    rows += [(166, "same same text", "en", "s", 1)] * 3 + [(166, "other text", "en", "s", 1), (None, "ax ax", "de", "s", 1)]
    rows += [(167, "日本 ퟿", "de", "t", 1)]
    return spark.createDataFrame(rows, DOCS)


# --- 11: divergence ------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_audit(rows, how):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for r in rows:
        lang, source, found = r.lang or "", r.source or "", TERM.findall(lower(r.text))
        groups.add((lang, source))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= how.min_docs]
        sources = sorted(s for g, s in groups if g == lang)
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def share(count, kept=kept):
            n = sum(count[t] for t in kept)
            return {t: 1 + how.scale * (count[t] + 2) // (n + 2 * len(kept)) for t in kept}

        far = lambda p, q: (p - q) ** 2 // (p + q)
        q = share(whole)
        ps = {s: share(counts[lang, s]) for s in sources}
        for s in sources:
            p = ps[s]
            pairs = [(sum(far(p[t], ps[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(far(p[t], q[t]), t) for t in kept if counts[lang, s][t] and p[t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, how.top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, t, v, k + 1) for k, (v, t) in enumerate(found[:most])]
    return sorted(out)


@pytest.mark.parametrize(("bits", "given"), [(64, 10**6), (3, 10**6), (3, 2)])
def test_audit_equals_brute_force(spark, monkeypatch, bits, given):
    docs = odd_docs(spark).withColumn("term", F.lit("x")).withColumn("value", F.lit(1))
    how = divergence.Audit(min_docs=4, top=3, digest_bits=bits)
    monkeypatch.setattr(divergence, "GIVEN", given)
    # Several blocks, tiles and parts.
    monkeypatch.setattr(divergence, "BLOCK", 4)
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "HELD", 30)
    got = sorted(tuple(r) for r in divergence.audit_sources(docs, how).collect())
    assert got == brute_audit(docs.collect(), how)
    assert {r[0] for r in got} == {"en", "fr", "", "de"} and any(r[2] == "term" for r in got)
    assert divergence.audit_sources(docs.limit(0), how).count() == 0


def test_terms_are_cut_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 5)
    lists = list(divergence.term_lists("One two,three fÉur5five".encode()))
    assert len(lists) > 1 and [t.decode() for x in lists for t in x] == ["one", "two", "three", "fÉur", "five"]


def test_probabilities_are_exact_beyond_64_bits(spark):
    n, total = 9 * 10**15, 10**16 + 7
    row = spark.range(1).select(
        divergence.probability(F.lit(n), F.lit(total), F.lit(3), 10**9).alias("p"),
        divergence.probability(F.lit(0), F.lit(0), F.lit(0), 10**9).alias("none"),
    ).first()
    assert (row.p, row.none) == (1 + 10**9 * (n + 2) // (total + 6), 0)


# --- 12: weighted fingerprints -------------------------------------------------------------


def h64(data, seed=42):
    n = xxhash.xxh64(data, seed=seed).intdigest()
    return n


def long(x):
    return (x % 2**64).to_bytes(8, "little")


def brute_print(bag, samples):
    """The fingerprint of a bag by all draws of all terms."""
    out = []
    for k in range(samples):
        best = None
        for term, w in bag.items():
            f = h64(k.to_bytes(4, "little"), h64(long(term)))
            s = h64(long(f))
            bits = lambda x, at, n: x >> at & (1 << n) - 1
            unit = lambda at, low, n: (bits(f, at, 16) + (bits(s, low, n) + 0.5) / 2**n) / 65536
            r = -math.log(unit(48, 53, 11) * unit(32, 42, 11))
            b = (bits(s, 0, 22) + 0.5) / 2**22
            c = math.log(-math.log(unit(16, 32, 10) * unit(0, 22, 10)))
            t = math.floor(math.log(w) / r + b)
            mark = h64(long(t), h64(long(s))) >> 33
            best = min(best or (math.inf, 0), (c - r * (t - b + 1), mark & 65535))
        out.append(f"{best[1]:04x}")
    return "".join(out)


def bag_of(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) or [""]
    return {h64(t.encode()): n for t, n in Counter(found).items()}


def test_fingerprints_equal_brute_force(spark):
    docs = odd_docs(spark).where("doc_id IS NULL OR doc_id > 140").where("doc_id <> 165 OR doc_id IS NULL")
    clash = docs.withColumn("hash", F.lit(1)).withColumn("term", F.lit("x"))
    got = sorted((tuple(r) for r in weighted.edited_fingerprints(clash, 16).collect()), key=repr)
    signed = lambda t: h64(t.encode()) - (h64(t.encode()) >> 63 << 64)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, signed(r[1])))
    want = {}
    for k, (d, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        take = len(text) // 4
        edited = text[: len(text) - take] + after[:take]
        prints = [brute_print(bag_of(t), 16) for t in (text, edited, after)]
        like = lambda a, b: sum(a[i : i + 4] == b[i : i + 4] for i in range(0, 64, 4)) / 16
        digest = hashlib.sha256(edited.encode()).hexdigest()
        want[d, text] = (d, len(text), digest, *prints[:2], like(*prints[:2]), like(prints[0], prints[2]))
    assert got == sorted((want[r] for r in rows), key=repr)
    assert weighted.edited_fingerprints(docs.limit(0)).count() == 0
    (one,) = weighted.edited_fingerprints(docs.where("doc_id = 164")).collect()
    assert one.near_next == 1.0


def test_long_texts_and_order_of_ids(spark):
    docs = odd_docs(spark)
    got = {r.doc_id: r for r in weighted.edited_fingerprints(docs.repartition(7), 8).collect()}
    text = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id not in (None, 166)}
    for d in (5, 100, 164, 165):
        after, own = text.get(d + 1), text[d]
        take = len(own) // 4
        if after is not None:
            edited = own[: len(own) - take] + after[:take]
            assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert got[165].n_chars == 90_000


def test_collision_rate_is_the_generalised_jaccard(spark):
    rng, samples = random.Random(9), 2048
    bag = {i: (rng.choice((1, 1, 2, 5, 0)), rng.choice((1, 2, 3, 0))) for i in range(120)}
    total = [sum(x[k] for x in bag.values()) for k in (0, 1)]
    rows = [(1, i * 7919, *w, *total) for i, w in bag.items()]
    bags = spark.createDataFrame(rows, "key int, term long, a long, b long, a_total long, b_total long")
    marks = weighted.signatures(bags, ["key"], ["a", "b"], samples)
    (got,) = marks.select(weighted.likeness(F.col("a"), F.col("b"), samples).alias("x"), F.length("a").alias("n")).collect()
    true = sum(min(w) for w in bag.values()) / sum(max(w) for w in bag.values())
    assert got.n == 4 * samples
    assert got.x == pytest.approx(true, abs=4 * (true * (1 - true) / samples) ** 0.5)


# --- 13: vector codes ----------------------------------------------------------------------


def brute_codes(rows, how):
    ok = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    sizes = Counter(len(r[1]) for r in ok)
    size = min(sizes, key=lambda n: (-sizes[n], n))
    width = -(-size // how.parts)
    ok = [(i, [math.floor(how.scale * x) for x in v] + [0] * (how.parts * width - size), y) for i, v, y in ok if len(v) == size]
    first = sorted(ok, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[: how.entries]
    cut = lambda q: [q[k * width : (k + 1) * width] for k in range(how.parts)]
    books = [list(b) for b in zip(*(cut(q) for _, q, _ in first), strict=True)]
    far = lambda p, e: sum((x - y) ** 2 for x, y in zip(p, e, strict=True))
    best = lambda p, book: min((far(p, e), k) for k, e in enumerate(book))
    for _ in range(how.rounds):
        for k in range(how.parts):
            mine = defaultdict(list)
            for _, q, _ in ok:
                mine[best(cut(q)[k], books[k])[1]].append(cut(q)[k])
            books[k] = [[sum(x) // len(mine[e]) for x in zip(*mine[e], strict=True)] if e in mine else c for e, c in enumerate(books[k])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded, errors = [], Counter()
    for i, q, y in ok:
        found = [best(p, books[k]) for k, p in enumerate(cut(q))]
        error = min(sum(d for d, _ in found), veccodes.MOST)
        errors[y] += error
        coded.append((i, "".join(f"{e:02x}" for _, e in found), error, y))
    return sorted(((i, c, e, min(errors[y], veccodes.MOST), digest) for i, c, e, y in coded), key=repr)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


@pytest.mark.parametrize("big", [1.0, 1e9])
def test_codes_equal_brute_force(spark, big):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v], None if i % 5 == 0 else i % 3) for i, v in enumerate(rng.integers(-3, 4, (90, 10)) / 8 * big)]
    rows += rows[:4] + [(None, rows[7][1], 1), (3, rows[9][1], 1)] + [(200 + i, rows[2][1], 0) for i in range(30)]
    rows += [(500, None, 1), (501, [], 1), (502, [1.0], 1), (503, [math.nan] * 10, 1), (504, [None] + [1.0] * 9, 1), (505, [math.inf] * 10, 1)]
    df = vectors(spark, rows).withColumn("code", F.lit("x")).withColumn("pos", F.lit(1))
    how = veccodes.Coding(parts=4, entries=6, rounds=3)
    got = [tuple(r) for r in veccodes.vector_codes(df, how).drop("label").collect()]
    assert sorted(got, key=repr) == brute_codes(rows, how)
    few = veccodes.vector_codes(df.where("vec_id IN (1, 2)"), how).drop("label").collect()
    assert sorted(map(tuple, few)) == brute_codes([r for r in rows if r[0] in (1, 2)], how)


def test_no_vectors_no_codes(spark):
    none = veccodes.vector_codes(vectors(spark, [(1, None, 1)]))
    assert none.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    assert none.count() == 0


@pytest.mark.parametrize("values", [2, 50])
def test_trie_distances_are_those_of_all_entries(values):
    rng = np.random.default_rng(values)
    parts, book = rng.integers(0, values, (700, 5)), rng.integers(0, values, (16, 5))
    parts = parts[np.lexsort(parts.T[::-1])]
    want = ((parts[:, None] - book) ** 2).sum(axis=2)
    assert (veccodes.trie_distances(parts, book) == want).all()
    code, error = veccodes.nearest(parts[::-1].copy(), book)
    assert (code == want.argmin(axis=1)[::-1]).all() and (error == want.min(axis=1)[::-1]).all()


def test_a_task_tells_a_string_once_a_language(spark):
    docs = [("en", s, f"same words {s}") for s in "abc"] * 2 + [("de", "a", "same")]
    rows = spark.createDataFrame(docs, "lang string, source string, text string").coalesce(1)
    rows = rows.withColumn("text", F.col("text").cast("binary"))
    parts = divergence.term_counts(
        rows, ["lang", "source"], divergence.each_term, divergence.Audit(), strings=True, once=True
    ).collect()
    told = [(r.lang, r.term) for r in parts if r.term is not None]
    assert sorted(told) == [("de", "same"), *[("en", t) for t in ("a", "b", "c", "same", "words")]]
    assert len(parts) == 10 and sum(r.n for r in parts) == 19
