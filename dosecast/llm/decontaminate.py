"""Benchmark passages in training texts, found through a distributed positional inverted index.

The index is cut by documents: a block is a run of documents of one task, and its postings are
rows ``(block, term, positions)`` of a stored table, positions counted along the block. Phrases
are looked up block by block, in a group per block: the posting list of a phrase's rarest term
gives the places where it could start, and the lists of its other terms, shifted by their
offsets, are intersected with it in order of their length. Nothing of a text moves but the
positions of terms that some phrase holds, and a hot term is one bounded list in each block.

Phrases are sent to all blocks in rounds of a fixed number, so what is broadcast is bounded
however many there are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dosecast.llm import words
from dosecast.llm.common import materialise, ship

# Phrases per round, and so at most some 10 MB of broadcast.
PHRASES_PER_ROUND = 100_000
# Text of one block of the index, at least one document.
BLOCK_BYTES = 8 << 20

INDEX = "block string, doc_row long, doc_id long, n_words long, base long, term long, positions binary"


@dataclass(frozen=True)
class Phrases:
    """Hashed phrases of test items. Phrase ``i`` has the terms ``terms[starts[i]:starts[i + 1]]``
    and belongs to the items ``items[i]``, numbers of ``names``."""

    terms: np.ndarray
    starts: np.ndarray
    items: list[tuple[int, ...]]
    names: list[str]


def windows(items: DataFrame, width: int) -> DataFrame:
    """One row per distinct window of the items: ``terms`` (long hashes) and ``item_ids``, the
    sorted ids of the items that have it. An item of fewer words, but not none, is a window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("item_id").to_pylist()
            for a, b in words.slices(texts):
                hashes, first = words.word_hashes(texts[a:b])
                found = []
                for i in range(b - a):
                    lo, hi = int(first[i]), int(first[i + 1])
                    n = min(width, hi - lo)
                    for start in range(lo, hi - n + 1 if n else lo):
                        found.append((ids[a + i], hashes[start : start + n].astype(np.int64)))
                yield pa.record_batch(
                    [
                        pa.array([i for i, _ in found], pa.string()),
                        pa.array([t.tolist() for _, t in found], pa.list_(pa.int64())),
                    ],
                    ["item_id", "terms"],
                )

    return (
        items.select(F.col("item_id").cast("string").alias("item_id"), "text")
        .mapInArrow(cut, "item_id string, terms array<long>")
        .where("item_id IS NOT NULL")
        .groupBy("terms")
        .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )


def phrase_round(found: DataFrame, rounds: int, n: int) -> Phrases | None:
    """Round ``n`` of the windows, about ``PHRASES_PER_ROUND`` of them."""
    mine = found.where(F.pmod(F.xxhash64("terms"), F.lit(rounds)) == n)
    rows = sorted(mine.collect(), key=lambda r: r["terms"])
    if not rows:
        return None
    names = sorted({i for r in rows for i in r["item_ids"]})
    at = {name: k for k, name in enumerate(names)}
    starts = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r["terms"]) for r in rows], out=starts[1:])
    terms = np.concatenate([np.array(r["terms"], np.int64) for r in rows])
    return Phrases(terms, starts, [tuple(at[i] for i in r["item_ids"]) for r in rows], names)


def build_index(docs: DataFrame, vocabulary: np.ndarray | None, gap: int) -> DataFrame:
    """The stored index of ``docs`` (``doc_id``, ``text``), as rows of two kinds: one per
    document (``term`` null) with its number of words and its first position ``base``, and one
    per block and term with the positions as 32-bit numbers. ``vocabulary`` (sorted) limits the
    terms; null keeps all. Documents lie ``gap`` positions apart, so no phrase spans two.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(vocabulary)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        vocabulary = held.value
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id")
            for a, b in words.slices(texts, BLOCK_BYTES):
                block, number = f"{task}-{number}", number + 1
                hashes, first = words.word_hashes(texts[a:b])
                hashes, n = hashes.astype(np.int64), np.diff(first)
                base = first[:-1] + gap * np.arange(b - a)
                position = np.arange(len(hashes)) + np.repeat(gap * np.arange(b - a), n)
                if vocabulary is not None:
                    at = np.minimum(np.searchsorted(vocabulary, hashes), max(0, len(vocabulary) - 1))
                    hit = vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
                    hashes, position = hashes[hit], position[hit]
                order = np.argsort(hashes, kind="stable")
                hashes, position = hashes[order], position[order].astype(np.int32)
                edges = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else []
                lists = [x.tobytes() for x in np.split(position, edges[1:])] if len(hashes) else []
                docs_here, terms_here = b - a, len(lists)
                nulls = lambda k: pa.nulls(k, pa.int64())
                yield pa.record_batch(
                    [
                        pa.array([block] * (docs_here + terms_here), pa.string()),
                        pa.concat_arrays([pa.array(np.arange(docs_here)), nulls(terms_here)]),
                        pa.concat_arrays([ids.slice(a, b - a).cast(pa.int64()), nulls(terms_here)]),
                        pa.concat_arrays([pa.array(n.astype(np.int64)), nulls(terms_here)]),
                        pa.concat_arrays([pa.array(base.astype(np.int64)), nulls(terms_here)]),
                        pa.concat_arrays(
                            [nulls(docs_here), pa.array(hashes[edges] if terms_here else [], pa.int64())]
                        ),
                        pa.concat_arrays([pa.nulls(docs_here, pa.binary()), pa.array(lists, pa.binary())]),
                    ],
                    ["block", "doc_row", "doc_id", "n_words", "base", "term", "positions"],
                )

    return materialise(docs.select("doc_id", "text").mapInArrow(index, INDEX))


def match_phrase(lists: list[np.ndarray], offsets: np.ndarray) -> np.ndarray:
    """Where a phrase starts, from the sorted posting lists of its terms and their offsets."""
    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    starts = lists[order[0]] - offsets[order[0]]
    for k in order[1:]:
        if not len(starts):
            break
        wanted = starts + offsets[k]
        at = np.minimum(np.searchsorted(lists[k], wanted), len(lists[k]) - 1)
        starts = starts[lists[k][at] == wanted]
    return starts


def near_phrase(lists: list[np.ndarray], counts: list[int], span: int) -> np.ndarray:
    """Occurrences of a phrase's terms inside any ``span`` consecutive words that hold each of them
    at least as often as the phrase does, in any order. One posting list per distinct term."""
    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    lists, counts = [lists[k] for k in order], [counts[k] for k in order]

    def held(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which of the stretches from ``low`` up to ``high`` hold enough of every term."""
        enough = np.ones(len(low), bool)
        for found, n in zip(lists, counts, strict=True):
            some = np.flatnonzero(enough)
            inside = np.searchsorted(found, high[some]) - np.searchsorted(found, low[some])
            enough[some] = inside >= n
        return enough

    def between(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        parts = [
            found[i:j]
            for found in lists
            for i, j in zip(np.searchsorted(found, low), np.searchsorted(found, high), strict=True)
        ]
        return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)

    # The rarest term leaves few places to look at; a stretch can end at a term.
    rare = lists[0]
    rare = rare[held(rare - span + 1, rare + span)]
    ends = between(rare, rare + span)
    ends = ends[held(ends - span + 1, ends + 1)]
    return between(ends - span + 1, ends + 1)


def search(index: DataFrame, phrases: Phrases, span: int | None = None) -> DataFrame:
    """Occurrences of the phrases, one row per document that has any: ``block``, ``doc_row``,
    ``ranges``
    (first word and end of the words inside occurrences, merged) and ``item_ids``. With ``span``
    matches are by proximity, and the words hit are the phrase's terms inside the stretch.
    """
    held = index.sparkSession.sparkContext.broadcast(phrases)

    schema = pa.schema(
        [
            ("block", pa.string()),
            ("doc_row", pa.int64()),
            ("flat", pa.list_(pa.int64())),
            ("item_ids", pa.list_(pa.string())),
        ]
    )

    def one_block(block: pa.Table) -> pa.Table:
        p, found = held.value, []
        name = block.column("block")[0].as_py()
        is_doc = pc.is_null(block.column("term"))
        posts, docs = block.filter(pc.invert(is_doc)), block.filter(is_doc).sort_by("base")
        lists = {
            t: np.frombuffer(x, np.int32).astype(np.int64)
            for t, x in zip(posts["term"].to_pylist(), posts["positions"].to_pylist(), strict=True)
        }
        base, rows = docs["base"].to_numpy(), docs["doc_row"].to_pylist()
        starts, lengths, owners = [], [], []
        terms, edges = p.terms.tolist(), p.starts.tolist()
        for i in range(len(p.items)):
            wanted = terms[edges[i] : edges[i + 1]]
            often = dict.fromkeys(wanted, 1) if span is None else Counter(wanted)
            if any(t not in lists for t in often):
                continue
            mine = [lists[t] for t in (wanted if span is None else often)]
            if span is None:
                at = match_phrase(mine, np.arange(len(mine)))
            else:
                at = near_phrase(mine, list(often.values()), span)
            if len(at):
                starts.append(at)
                lengths.append(np.full(len(at), len(mine) if span is None else 1))
                owners.append(np.full(len(at), i))
        if starts:
            start, length, owner = map(np.concatenate, (starts, lengths, owners))
            doc = np.searchsorted(base, start, side="right") - 1
            order = np.lexsort((start, doc))
            for part in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1):
                d = doc[part[0]]
                ranges: list[list[int]] = []
                for s, e in zip(start[part] - base[d], start[part] - base[d] + length[part], strict=True):
                    if ranges and s <= ranges[-1][1]:
                        ranges[-1][1] = max(ranges[-1][1], int(e))
                    else:
                        ranges.append([int(s), int(e)])
                names = {p.names[k] for i in set(owner[part].tolist()) for k in p.items[i]}
                found.append(
                    {
                        "block": name,
                        "doc_row": rows[d],
                        "flat": [x for r in ranges for x in r],
                        "item_ids": sorted(names),
                    }
                )
        return pa.Table.from_pylist(found, schema)

    return (
        index.select("block", "doc_row", "base", "term", "positions")
        .groupBy("block")
        .applyInArrow(one_block, "block string, doc_row long, flat array<long>, item_ids array<string>")
        .select(
            "block",
            "doc_row",
            F.expr("transform(sequence(0, size(flat) - 2, 2), i -> array(flat[i], flat[i + 1]))").alias("ranges"),
            "item_ids",
        )
    )


def merge_hits(hits: DataFrame) -> DataFrame:
    """The hits of several rounds as one row per document, overlapping ranges merged."""
    doc = ["block", "doc_row"]
    before = Window.partitionBy(*doc).orderBy("first", "end")
    reached = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    upto = before.rowsBetween(Window.unboundedPreceding, 0)
    ranges = (
        hits.select(*doc, F.explode("ranges").alias("_r"))
        .select(*doc, F.col("_r")[0].alias("first"), F.col("_r")[1].alias("end"))
        .withColumn("_new", F.coalesce(F.col("first") > reached, F.lit(True)).cast("int"))
        .withColumn("_part", F.sum("_new").over(upto))
        .groupBy(*doc, "_part")
        .agg(F.array(F.min("first"), F.max("end")).alias("range"))
        .groupBy(*doc)
        .agg(F.array_sort(F.collect_list("range")).alias("ranges"))
    )
    items = (
        hits.select(*doc, F.explode("item_ids").alias("item_id"))
        .groupBy(*doc)
        .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    return ranges.join(items, doc)


def benchmark_hits(
    docs: DataFrame, items: DataFrame, width: int = 10, span: int | None = None
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_hit`` (words inside an occurrence of a
    window of ``width`` item words), ``ranges`` of hit words, and ``item_ids``, sorted.

    With ``span`` a window's words may stand anywhere, in any order, inside ``span`` consecutive
    words of the document, each as often as in the window; the words hit are these.

    A null or empty text has no words and no hits; repeated rows are answered each by itself;
    without items, or without documents, nothing is hit. Items with a null id are left out.
    """
    ship(docs.sparkSession)
    found = materialise(windows(items, width))
    rounds = max(1, -(-found.count() // PHRASES_PER_ROUND))
    first = phrase_round(found, rounds, 0) or Phrases(np.zeros(0, np.int64), np.zeros(1, np.int64), [], [])
    # One round, the usual case, stores the postings of its own terms only.
    index = build_index(docs, np.unique(first.terms) if rounds == 1 else None, gap=max(width, span or 0) + 1)
    hits = search(index, first, span)
    for n in range(1, rounds):
        if more := phrase_round(found, rounds, n):
            hits = hits.unionByName(materialise(search(index, more, span)))
    if rounds > 1:
        hits = merge_hits(hits)
    rows = index.where("term IS NULL").select("block", "doc_row", "doc_id", "n_words")
    return rows.join(hits, ["block", "doc_row"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce(
            F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0]), F.lit(0)
        ).cast("long").alias("n_hit"),
        F.coalesce("ranges", F.array().cast("array<array<long>>")).alias("ranges"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )
