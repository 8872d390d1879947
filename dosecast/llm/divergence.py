"""How far the sources of a language differ in their words: an audit with late strings.

Terms are counted by a 64-bit digest, so the shuffles of the counts carry fixed-width numbers.
Most terms are rare and no string of theirs leaves its task:

* a first scan counts the documents of each digest, which tells the digests that may be kept;
* a second scan counts the occurrences of those by group, and writes them to a scratch table; a
  task hands on each string of a language once and not once a group. Of each digest the smallest and the largest string are taken; where they differ,
  several terms share the digest, and those few digests are counted again by string;
* the strings of the rows that are put out are joined back at the end.

Probabilities are smoothed and scaled to integers, and all sums are exact. For two sources every
kept term counts, also one that neither has; terms are dealt into blocks of bounded size, each
block compares tiles of sources at once, and terms that no source of the tiles has enter as a
product.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dosecast.llm.common import materialise, ship

# Fixed by the contract: a term is a run of [^\x00-\x40\x5B-\x60\x7B-\x7F], A-Z lower-cased.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
# Distinct terms that a task holds before it hands on their counts, and bytes of a text cut at once.
HELD = 1_000_000
PIECE = 1 << 20
# Digests that the tasks may be given, eight bytes each.
GIVEN = 1_000_000
# Terms of a block and sources of a tile: bounds of the matrices that are compared.
BLOCK = 2048
TILE = 128


@dataclass(frozen=True)
class Audit:
    """Terms in at least ``min_docs`` documents of their language are kept; probabilities are
    multiples of one in ``scale``; ``top`` terms of a group are told. ``digest_bits`` below 64
    makes digests collide, for tests."""

    min_docs: int = 10
    scale: int = 1_000_000_000
    top: int = 10
    digest_bits: int = 64


#: Digests in order, by language.
Given = dict[str, np.ndarray]


def term_lists(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded length."""
    plain, start = text.translate(LETTERS), 0
    while start < len(plain):
        end = plain.find(b" ", start + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


def each_term(count: Counter, text: bytes) -> None:
    for terms in term_lists(text):
        count.update(terms)


def once_a_document(count: Counter, text: bytes) -> None:
    count.update({t for terms in term_lists(text) for t in terms})


def digests(terms: list[bytes], bits: int) -> np.ndarray:
    """64-bit hashes of terms, or the upper ``bits`` of them."""
    found = np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(terms))
    return (found >> np.uint64(64 - bits)).view(np.int64)


def term_counts(
    rows: DataFrame,
    groups: list[str],
    count: Callable[[Counter, bytes], None],
    how: Audit,
    strings: bool = False,
    given: Given | None = None,
    once: bool = False,
) -> DataFrame:
    """``digest`` and ``n`` by the columns ``groups``, the first of which is ``lang``, in parts that are
    still to be summed; with ``strings`` by ``term`` too. ``given`` leaves other digests out. With
    ``once`` a term is told in one of a language's rows that are handed on together, else null."""
    wanted = None if given is None else rows.sparkSession.sparkContext.broadcast(given)

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        told: dict[str, set[bytes]] = {}
        for group, counter in held.items():
            terms, n = list(counter), np.fromiter(counter.values(), np.int64, len(counter))
            found = digests(terms, how.digest_bits)
            if wanted is not None:
                listed = wanted.value.get(group[0], np.zeros(0, np.int64))
                at = np.minimum(np.searchsorted(listed, found), max(0, len(listed) - 1))
                kept = np.flatnonzero(listed[at] == found) if len(listed) else np.zeros(0, np.int64)
                found, n = found[kept], n[kept]
                terms = [terms[k] for k in kept.tolist()] if strings else []
            if once:
                seen = told.setdefault(group[0], set())
                new = set(terms) - seen
                seen |= new
                terms = [t if t in new else None for t in terms]
            columns = [pa.array([x] * len(n), pa.string()) for x in group] + [pa.array(found), pa.array(n)]
            names = [*groups, "digest", "n"]
            if strings:
                columns.append(pa.array(terms, pa.binary()))
                names.append("term")
            yield pa.record_batch(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            keys = zip(*[batch.column(g).to_pylist() for g in groups], strict=True)
            for key, text in zip(keys, batch.column("text"), strict=True):
                counter = held.setdefault(key, Counter())
                before = len(counter)
                count(counter, text.as_py())
                size += len(counter) - before
                if size > HELD:
                    yield from flush(held)
                    held, size = {}, 0
        yield from flush(held)

    schema = [*(f"{g} string" for g in groups), "digest long", "n long", *["term binary"] * strings]
    found = rows.select(*groups, "text").mapInArrow(run, ", ".join(schema))
    return found.withColumn("term", F.col("term").cast("string")) if strings else found


def listed(digests: DataFrame) -> Given | None:
    """A small table of ``lang`` and ``digest`` as arrays; None for a large one."""
    if digests.limit(GIVEN + 1).count() > GIVEN:
        return None
    found = digests.select("lang", "digest").toArrow()
    langs, values = np.array(found.column("lang").to_pylist(), object), found.column("digest").to_numpy()
    return {lang: np.sort(values[langs == lang]) for lang in dict.fromkeys(langs)}


def probability(count: Column, total: Column, terms: Column, scale: int) -> Column:
    """The smoothed share of a term, as an integer; 0 where there are no terms."""
    wide = lambda c: c.cast("decimal(20,0)")
    part = F.lit(scale).cast("decimal(10,0)") * wide(count + 2)
    whole = F.nullif(total + 2 * terms, F.lit(0))
    share = F.call_function("div", part, wide(whole))
    return F.coalesce(share + 1, F.lit(0)).cast("long")


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), F.nullif(p + q, F.lit(0)))


def block_distances(cells: DataFrame) -> DataFrame:
    """Distances of the pairs of sources of two tiles over a block of terms.

    ``cells`` has ``lang``, ``block``, ``low``, ``high`` (the tiles), ``tile``, ``no`` (the
    source), ``digest``, ``split``, ``p``; every source has a row with a null digest and the ``p``
    of a term it lacks. A row of the result has the ``sum`` over the ``terms`` of the block that
    any of these sources has.
    """

    def run(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        no, p = table.column("no").to_numpy(), table.column("p").to_numpy()
        absent = table.column("digest").is_null().to_numpy()
        names = list(zip(table.column("digest").to_pylist(), table.column("split").to_pylist(), strict=True))
        known = {x: k for k, x in enumerate(dict.fromkeys(x for x in names if x[0] is not None))}
        sources = np.unique(no[absent])
        matrix = np.zeros((len(sources), len(known)), np.int64)
        matrix[np.searchsorted(sources, no[absent])] = p[absent][:, None]
        cell = np.fromiter((known[x] for x in names if x[0] is not None), np.int64)
        matrix[np.searchsorted(sources, no[~absent]), cell] = p[~absent]
        of = sources // TILE
        right = np.flatnonzero(of == high)
        first, second, sums = [], [], []
        for i in np.flatnonzero(of == low):
            other = right[right > i] if low == high else right
            gap = matrix[i] - matrix[other]
            # Both are 0 only where the language keeps no term.
            total = np.maximum(matrix[i] + matrix[other], 1)
            first.append(np.full(len(other), sources[i]))
            second.append(sources[other])
            sums.append((gap * gap // total).sum(axis=1))
        one = lambda parts: pa.array(np.concatenate(parts) if parts else [], pa.int64())
        size = sum(map(len, sums))
        return pa.table(
            {
                "lang": pa.array([table.column("lang")[0].as_py()] * size, pa.string()),
                "a": one(first),
                "b": one(second),
                "sum": one(sums),
                "terms": pa.array(np.full(size, len(known)), pa.int64()),
            }
        )

    return cells.groupBy("lang", "block", "low", "high").applyInArrow(
        run, "lang string, a long, b long, sum long, terms long"
    )


def audit_sources(docs: DataFrame, how: Audit = Audit()) -> DataFrame:  # noqa: B008
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank`` of the divergence audit of
    ``docs`` (``text``, ``lang``, ``source``; other columns are not read).

    Part ``pair`` tells the distance of a source to each other source of its language, part
    ``term`` the ``top`` terms that it has more often than the language. Null texts, languages
    and sources read as empty. A group without terms takes part, with counts of 0; where a
    language keeps no term all distances are 0. Repeated rows are documents of their own. Equal
    values rank by item, in the order of UTF-8 bytes. Texts of any length count whole. An empty
    table gives no row.
    """
    ship(docs.sparkSession)
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    rows, pair = docs.select(*named, text), ["lang", "digest"]
    # A digest is in as many documents as its terms together, so no kept term is missed.
    held = materialise(
        term_counts(rows, ["lang"], once_a_document, how)
        .groupBy(*pair)
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= how.min_docs)
        .drop("n")
    )
    given = listed(held)
    parts = materialise(
        term_counts(rows, ["lang", "source"], each_term, how, strings=True, given=given, once=True)
    )
    # Tasks that were given the digests have left all others out already.
    parts = parts if given is not None else parts.join(held, pair, "left_semi")
    counts = parts.groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"))
    strings = materialise(
        parts.where("term IS NOT NULL")
        .select(*pair, "term")
        .distinct()
        .groupBy(*pair)
        .agg(F.min("term").alias("term"), F.max("term").alias("last"))
    )
    shared = materialise(strings.where("term <> last").select(*pair))
    key = ["lang", "digest", "split"]
    kept = counts.withColumn("split", F.lit(""))
    if not shared.isEmpty():
        spelled, few = F.col("term").alias("split"), listed(shared)
        often = (
            term_counts(rows, ["lang"], once_a_document, how, strings=True, given=few)
            .join(shared, pair, "left_semi")
            .groupBy(*pair, spelled)
            .agg(F.sum("n").alias("n"))
            .where(F.col("n") >= how.min_docs)
            .drop("n")
        )
        every = term_counts(rows, ["lang", "source"], each_term, how, strings=True, given=few)
        split = every.join(shared, pair, "left_semi").groupBy("lang", "source", "digest", spelled)
        split = split.agg(F.sum("n").alias("n")).join(often, key, "left_semi")
        kept = kept.join(shared, pair, "left_anti").unionByName(split)
    kept = materialise(kept)
    by_lang = materialise(kept.groupBy(*key).agg(F.sum("n").alias("lang_n")))
    sizes = by_lang.groupBy("lang").agg(F.count("*").alias("V"), F.sum("lang_n").alias("lang_size"))
    none = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    numbered = Window.partitionBy("lang").orderBy("source")
    groups = materialise(
        docs.select(*named)
        .distinct()
        .join(kept.groupBy("lang", "source").agg(F.sum("n").alias("size")), ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select("lang", "source", none("size"), none("V"), none("lang_size"))
        .withColumn("no", F.row_number().over(numbered).cast("long") - 1)
        .withColumn("p0", probability(F.lit(0).cast("long"), F.col("size"), F.col("V"), how.scale))
        .withColumn("tiles", F.expr(f"(count(*) OVER (PARTITION BY lang) + {TILE - 1}) div {TILE}"))
        .withColumn("blocks", F.expr(f"greatest(1, (V + {BLOCK - 1}) div {BLOCK})"))
    )
    cells = kept.join(groups, ["lang", "source"]).withColumn(
        "p", probability(F.col("n"), F.col("size"), F.col("V"), how.scale)
    )
    return _terms(cells, by_lang, strings, how).unionByName(_pairs(cells, groups))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).select(
        "lang", "source", "part", "item", "value", "rank"
    )


def _terms(cells: DataFrame, by_lang: DataFrame, strings: DataFrame, how: Audit) -> DataFrame:
    key = ["lang", "digest", "split"]
    q = probability(F.col("lang_n"), F.col("lang_size"), F.col("V"), how.scale)
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    best = (
        cells.join(by_lang, key)
        .withColumn("q", q)
        .where("p > q")
        .select("lang", "source", "digest", "split", distance(F.col("p"), F.col("q")).alias("value"))
        # Ties stay until their strings, which order them, are back.
        .withColumn("_at", F.rank().over(by_value))
        .where(F.col("_at") <= how.top)
    )
    named = best.join(strings.select("lang", "digest", "term"), ["lang", "digest"]).withColumns(
        {"item": F.when(F.col("split") == "", F.col("term")).otherwise(F.col("split")), "part": F.lit("term")}
    )
    return _ranked(named).where(F.col("rank") <= how.top)


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    cell = ["lang", "block", "tile", "no", "digest", "split", "p", "tiles"]
    tile = F.expr(f"no div {TILE}")
    block = F.pmod(F.xxhash64("digest", "split", F.lit("block")), F.col("blocks"))
    present = cells.withColumns({"tile": tile, "block": block}).select(*cell)
    absent = groups.withColumns(
        {
            "tile": tile,
            "block": F.explode(F.expr("sequence(0L, blocks - 1)")),
            "digest": F.lit(None).cast("long"),
            "split": F.lit(""),
            "p": F.col("p0"),
        }
    ).select(*cell)
    dealt = (
        present.unionByName(absent)
        .withColumn("other", F.explode(F.expr("sequence(0L, tiles - 1)")))
        .withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
        .drop("tiles", "other")
    )
    sums = (
        block_distances(dealt)
        .groupBy("lang", "a", "b")
        .agg(F.sum("sum").alias("sum"), F.sum("terms").alias("terms"))
    )
    side = lambda no, source, p: groups.select(
        "lang", F.col("no").alias(no), F.col("source").alias(source), F.col("p0").alias(p), *(["V"] if no == "a" else [])
    )
    rest = (F.col("V") - F.col("terms")) * F.coalesce(distance(F.col("p"), F.col("q")), F.lit(0))
    valued = (
        sums.join(side("a", "one", "p"), ["lang", "a"])
        .join(side("b", "two", "q"), ["lang", "b"])
        .withColumn("value", F.when(F.col("V") > 0, F.col("sum") + rest).otherwise(0).cast("long"))
    )
    both = F.explode(F.expr("array(struct(one AS source, two AS item), struct(two AS source, one AS item))"))
    rows = valued.withColumn("_r", both).select("lang", "_r.*", "value", F.lit("pair").alias("part"))
    return _ranked(rows)
