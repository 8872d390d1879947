"""Near-duplicate documents by BagMinHash signatures of their word shingles.

A document is a bag: the runs of five words, each with its count. Every run owns Poisson
processes over its weight axis, one per interval [0, 1), [1, 2), [2, 4), [4, 8) and so on, whose
points carry a time, a signature component and a place on the axis; a document sees the points
below its count. A component holds the earliest point seen, so two documents agree in a
component with probability equal to their weighted Jaccard similarity. Intervals that double
make a count of w cost log w processes, and points later than the latest minimum are never drawn, so
a document costs about its number of runs plus m log m draws for m components.

Signatures are cut into bands. Documents that share a band meet in a bucket, and every link is
checked on the full bags:

1. each bucket links its members to one of them, that with the most company over all buckets;
2. buckets whose members are then still in different components have all their pairs across
   components screened by signature, in blocks, and those that can be near are checked as well.

Pairs within one component need no check, since they are in one class anyway, so large groups of
copies cost one check per text. Equal texts are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.llm import words
from dosecast.llm.common import materialise, ship
from dosecast.llm.components import components

OWNERS = 20  # bits; slices of texts hold fewer documents than that
SMALL = 128  # runs of a bag that is drawn together with others
CHUNK = 512  # members of a bucket that one block compares with as many others
STEP = 0xD1342543DE82EF95


def step(n: int) -> np.uint64:
    """The ``n``-th of a sequence of odd multiples that tell draws apart."""
    return np.uint64(STEP * n % 2**64)


@dataclass(frozen=True)
class Banding:
    """At similarity s a pair shares a band with probability ``1 - (1 - s**rows)**bands``: all
    but 5 in a million at 0.8. Members of buckets that stay mixed get ``extra`` components more;
    pairs that agree in less than ``screen`` of them all, four deviations below the threshold,
    are not checked."""

    width: int = 5
    threshold: float = 0.8
    bands: int = 40
    rows: int = 6
    extra: int = 512
    deviations: float | None = 4.0

    @property
    def size(self) -> int:
        return self.bands * self.rows

    @property
    def screen(self) -> float:
        t = self.threshold
        if self.deviations is None:
            return 0.0
        return t - self.deviations * (t * (1 - t) / (self.size + self.extra)) ** 0.5


def bags(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of each document, with counts: 44 bits of a run's hash, ``OWNERS`` of the
    number of its document, so that one sort of numbers does."""
    key = (owner.astype(np.uint64) << np.uint64(64 - OWNERS)) | (hashes >> np.uint64(OWNERS))
    key.sort()
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.r_[at, len(key)])
    key = key[at]
    return key << np.uint64(OWNERS), (key >> np.uint64(64 - OWNERS)).astype(np.int64), count


def signatures(out: np.ndarray, h: np.ndarray, owner: np.ndarray, count: np.ndarray) -> None:
    """Fill the rows of ``out`` of the bags' documents with the earliest point of each component."""
    docs, m = out.shape
    weight = np.bincount(owner, count, docs)
    limit = np.log(m) + 2.0
    todo = weight > 0
    while todo.any():
        rows = todo[owner]
        _draw(out, h[rows], owner[rows], count[rows], limit / np.maximum(weight, 1))
        todo &= np.isinf(out).any(axis=1)
        limit *= 2


def _draw(
    out: np.ndarray, h: np.ndarray, owner: np.ndarray, count: np.ndarray, until: np.ndarray
) -> None:
    """Lower ``out`` to all points before ``until``, a time per document."""
    m = out.shape[1]
    flat = out.reshape(-1)
    k = 0
    while len(h):
        # Interval k: [0, 1), then [2**(k - 1), 2**k).
        low = 0 if k == 0 else 1 << (k - 1)
        length = max(1, low)
        seed = words.mix64(h + step(2 * k + 1))
        o, c, time, j = owner, count, np.zeros(len(h)), 0
        while len(seed):
            draw = words.mix64(seed + step(4 * j + 1))
            time = time - np.log(words.unit(draw)) / (m * length)
            live = time < until[o]
            seed, o, c, time = seed[live], o[live], c[live], time[live]
            mark = words.mix64(seed + step(4 * j + 2))
            at = o * m + (mark % np.uint64(m)).astype(np.int64)
            if low > 1:
                place = low + words.unit(words.mix64(seed + step(4 * j + 3))) * length
                seen = np.floor(place) < c
                np.minimum.at(flat, at[seen], time[seen])
            else:
                np.minimum.at(flat, at, time)
            j += 1
        more = count > max(1, 2 * low)
        h, owner, count = h[more], owner[more], count[more]
        k += 1


def sketch(texts: list[str | None], banding: Banding) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Band keys, one byte per component, and which texts have words."""
    n = len(texts)
    sig, some, rest = np.full((n, banding.size), np.inf), np.zeros(n, bool), []
    for a, b in words.slices(texts):
        hashes, first = words.word_hashes(texts[a:b])
        some[a:b] = np.diff(first) > 0
        h, owner, count = bags(*words.shingles(hashes, first, banding.width))
        # Small bags take many rounds of few draws, so those of all texts are drawn together.
        small = np.bincount(owner, count, b - a)[owner] < SMALL
        signatures(sig[a:b], h[~small], owner[~small], count[~small])
        rest.append((h[small], owner[small] + a, count[small]))
    if rest:
        signatures(sig, *(np.concatenate(x) for x in zip(*rest, strict=True)))
    keys = np.empty((n, banding.bands), np.int64)
    marks = np.empty((n, banding.size), np.uint8)
    salts = np.array([step(b + 1) for b in range(banding.bands)])
    for a in range(0, n, 1024):
        bits = words.mix64(sig[a : a + 1024].view(np.uint64))
        marks[a : a + 1024] = bits >> np.uint64(56)
        parts = bits.reshape(len(bits), banding.bands, banding.rows)
        key = np.tile(salts, (len(bits), 1))
        for r in range(banding.rows):
            key = words.mix64(key * words.BASE + parts[:, :, r])
        keys[a : a + 1024] = key.view(np.int64)
    return keys, marks, some


def signature_table(texts: DataFrame, banding: Banding) -> DataFrame:
    """``node``, ``bands`` and ``sketch`` for each row of ``node``, ``text`` that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, column = batch.column("node"), batch.column("text").to_pylist()
            keys, marks, some = sketch(column, banding)
            some = np.flatnonzero(some)
            yield pa.record_batch(
                [
                    nodes.take(pa.array(some)),
                    pa.array(list(keys[some]), pa.list_(pa.int64())),
                    pa.array([x.tobytes() for x in marks[some]], pa.binary()),
                ],
                ["node", "bands", "sketch"],
            )

    return texts.mapInArrow(run, "node long, bands array<long>, sketch binary")


def longer_sketches(known: DataFrame, texts: DataFrame, banding: Banding) -> DataFrame:
    """``known`` (``node``, ``bands``, ``sketch``) with ``extra`` more components in its sketch,
    drawn from the ``text`` of the ``node``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, marks = batch.column("text").to_pylist(), []
            for a, b in words.slices(column):
                runs = words.shingles(*words.word_hashes(column[a:b]), banding.width)
                h, owner, count = bags(*runs)
                sig = np.full((b - a, banding.extra), np.inf)
                signatures(sig, words.mix64(h + step(0xE71)), owner, count)
                more = (words.mix64(sig.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)
                marks += [
                    x + y.tobytes()
                    for x, y in zip(batch.column("sketch").slice(a, b - a).to_pylist(), more, strict=True)
                ]
            yield pa.record_batch(
                [batch.column("node"), batch.column("bands"), pa.array(marks, pa.binary())],
                ["node", "bands", "sketch"],
            )

    return known.join(texts, "node").mapInArrow(run, "node long, bands array<long>, sketch binary")


def overlaps(left: list[str | None], right: list[str | None], width: int) -> np.ndarray:
    """The weighted Jaccard similarity of the bags of each pair of texts."""
    both = [bags(*words.shingles(*words.word_hashes(side), width)) for side in (left, right)]
    h, owner, count = (np.concatenate(x) for x in zip(*both, strict=True))
    order = np.lexsort((h, owner))
    h, owner, count = h[order], owner[order], count[order]
    same = np.flatnonzero((h[1:] == h[:-1]) & (owner[1:] == owner[:-1]))
    shared = np.bincount(owner[same], np.minimum(count[same], count[same + 1]), len(left))
    total = np.bincount(owner, count, len(left))
    return shared / np.maximum(total - shared, 1)


def near_pairs(pairs: DataFrame, texts: DataFrame, banding: Banding) -> DataFrame:
    """The pairs ``a``, ``b`` whose bags are near, with their ``similarity``. ``texts`` has one
    ``text`` per ``node``."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            sizes = [x if len(x) > len(y) else y for x, y in zip(left, right, strict=True)]
            for a, b in words.slices(sizes):
                near = overlaps(left[a:b], right[a:b], banding.width)
                keep = pa.array(np.flatnonzero(near >= banding.threshold - 1e-12))
                part = batch.slice(a, b - a)
                yield pa.record_batch(
                    [part.column("a").take(keep), part.column("b").take(keep), pa.array(near).take(keep)],
                    ["a", "b", "similarity"],
                )

    side = lambda node, name: texts.select(F.col("node").alias(node), F.col("text").alias(name))
    return (
        pairs.join(side("b", "right"), "b")
        .join(side("a", "left"), "a")
        .mapInArrow(check, "a long, b long, similarity double")
    )


def agreeing(rows: DataFrame, banding: Banding) -> DataFrame:
    """Pairs ``a < b`` across components whose signatures agree enough, from rows of two
    bounded lists ``one`` and ``two`` of members (``node``, ``root``, ``sketch``, ``bands``). A
    pair is given in the first bucket that it shares, ``key``, only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = zip(
                batch.column("key").to_pylist(), batch.column("one"), batch.column("two"), strict=True
            )
            for key, one, two in lists:
                sides = []
                for members in (one, two):
                    m = members.values
                    marks = np.frombuffer(b"".join(m.field("sketch").to_pylist()), np.uint8)
                    bands = m.field("bands").flatten().to_numpy()
                    sides.append(
                        (
                            m.field("node").to_numpy(),
                            m.field("root").to_numpy(),
                            marks.reshape(len(m), -1),
                            bands.reshape(len(m), -1),
                        )
                    )
                (n1, r1, s1, b1), (n2, r2, s2, b2) = sides
                a, b = [], []
                for i in range(len(n1)):
                    other = np.flatnonzero((r2 != r1[i]) & (n2 > n1[i]))
                    if len(other):
                        other = other[(s2[other] == s1[i]).mean(axis=1) >= banding.screen]
                    if len(other):
                        first = (b2[other] == b1[i]).argmax(axis=1)
                        other = other[b2[other, first] == key]
                    a.append(np.full(len(other), n1[i]))
                    b.append(n2[other])
                yield pa.record_batch(
                    [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (a, b)], ["a", "b"]
                )

    return rows.select("key", "one", "two").mapInArrow(run, "a long, b long")


def block_pairs(members: DataFrame) -> DataFrame:
    """Members of each bucket against each other, in blocks of about ``CHUNK`` each, as rows of
    two lists. A bucket is cut by a hash of its members, so none is gathered whole."""
    chunk = F.pmod(F.xxhash64("node", F.lit("chunk")), F.col("chunks"))
    cut = (
        members.withColumn("chunks", F.expr(f"int((bucket + {CHUNK - 1}) div {CHUNK})"))
        .withColumn("chunk", chunk.cast("int"))
        .groupBy("key", "chunk", "chunks")
        .agg(F.collect_list(F.struct("node", "root", "sketch", "bands")).alias("one"))
    )
    offers = cut.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
    return offers.join(
        cut.select("key", F.col("chunk").alias("other"), F.col("one").alias("two")), ["key", "other"]
    )


def near_duplicates(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:  # noqa: B008
    """``docs`` without its texts, plus ``class_id``, the smallest ``doc_id`` of the document's
    class, ``class_size``, and ``class_key``, which tells classes apart whatever their ids; null
    where the text has no words.

    Classes are the components of the links between texts that are near (or equal). Texts of
    fewer than five words are one run of all of them. A text without words, null included, is a
    class of its own with its own ``doc_id``. Nodes are 64-bit hashes of the texts. Texts of any
    length count whole; repeated rows are members of their own. Other columns may have any name;
    those named like a result are replaced by it. An empty table gives no row.
    """
    ship(docs.sparkSession)
    node = F.when(F.col("text").isNotNull(), F.xxhash64("text"))
    # Other columns travel as one, so that none of their names can clash.
    kept = [c for c in docs.columns if c not in ("text", "class_id", "class_size", "class_key")]
    rows = docs.select(F.struct(*kept).alias("_row"), F.col("doc_id").alias("_doc"), node.alias("_node"))
    texts = docs.select(node.alias("node"), "text").where("node IS NOT NULL")
    signed = materialise(signature_table(texts, banding))

    # Buckets of at least two different texts, and their members.
    offers = signed.select("node", F.explode("bands").alias("key"))
    buckets = (
        offers.groupBy("key")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .where("low < high")
        .select("key")
    )
    members = materialise(offers.join(buckets, "key").distinct())
    sizes = members.groupBy("key").agg(F.count("*").alias("bucket"))
    company = (
        members.join(sizes, "key").groupBy("node").agg(F.sum("bucket").alias("company"))
    )
    centres = (
        members.join(company, "node")
        .groupBy("key")
        .agg(F.max(F.struct("company", "node")).alias("top"), F.count("*").alias("bucket"))
        .select("key", F.col("top.node").alias("centre"), "bucket")
    )
    members = materialise(members.join(centres, "key"))
    known = materialise(
        signed.join(members.select("node").distinct(), "node").dropDuplicates(["node"])
    )
    own_texts = materialise(
        texts.join(known.select("node"), "node").dropDuplicates(["node"])
    )

    star = (
        members.where("node <> centre")
        .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
        .distinct()
    )
    star = materialise(star)
    links = materialise(near_pairs(star, own_texts, banding).select("a", "b"))
    roots = materialise(components(links))

    # Buckets that are not of one component yet.
    labelled = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_buckets = (
        labelled.where("bucket > 2")
        .groupBy("key")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low < high")
        .select("key")
    )
    mixed = materialise(labelled.join(open_buckets, "key"))
    longer = materialise(
        longer_sketches(known.join(mixed.select("node").distinct(), "node"), own_texts, banding)
    )
    mixed = mixed.join(longer, "node")
    rest = agreeing(block_pairs(mixed.select("key", "bucket", "node", "root", "sketch", "bands")), banding)
    rest = materialise(rest.join(star, ["a", "b"], "left_anti"))
    more = materialise(near_pairs(rest, own_texts, banding).select("a", "b"))
    # Roots stand for their members from here on.
    contracted = more.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
    final = materialise(components(contracted))

    some = signed.select("node").distinct()
    keyed = (
        rows.join(some.withColumnRenamed("node", "_known"), F.col("_node") == F.col("_known"), "left")
        .join(final.withColumnRenamed("node", "_n"), F.col("_known") == F.col("_n"), "left")
        .select("_row", "_doc", F.coalesce("root", "_known").alias("class_key"))
    )
    classes = (
        keyed.where("class_key IS NOT NULL")
        .groupBy("class_key")
        .agg(F.min("_doc").alias("class_id"), F.count("*").alias("class_size"))
    )
    alone = F.col("class_key").isNull()
    return keyed.join(classes, "class_key", "left").select(
        "_row.*",
        "class_key",
        F.when(alone, F.col("_doc")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
    )
