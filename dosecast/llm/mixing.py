"""Mixing sources to target weights, word by word, over blocks of fixed length.

Every source's words, in a fixed order of its documents, are packed into blocks. Each output
shard draws its counts per source from a multinomial; the counts are then scaled so that a
source's total meets its target. The drawn slots of a source are numbered and mapped through
pseudorandom permutations of its block numbers, a new one for each pass over the source, and
slots meet blocks by an equi-join on source and block.

A source's last, short block closes every pass, and the last slot of a source is cut, so the
words taken equal the target rounded to a word. Within a pass no word is taken twice.

All of it is DataFrame operations. Sources are packed by two-level prefix sums, so one source
with most of the rows is spread over all tasks like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dosecast.llm.common import (
    SPACED_WORD,
    bucket_count,
    materialise,
    prefix_sums,
)

ROUNDS = 24  # of the permutation
CELLS = 1024  # of the look-up from a draw to its source
CHUNK = 4096  # slots that one row is expanded to at most


@dataclass(frozen=True)
class Mix:
    """Weights repeat over the sources in code point order, null last. The mix has ``share``
    times all words; no source gives more than ``most`` times its own."""

    weights: Sequence[float] = (5, 2, 1)
    share: float = 1.5
    most: float = 2.0
    block_words: int = 256
    shards: int = 256
    seed: int = 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: ``source_no``, ``source``, ``source_size`` and ``target``.

    Sharing by weight with an upper limit per source has a closed form: ordered by limit over
    weight, the limited sources are the first ones, and one level serves all others.
    """
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    numbered = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("source_no", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
        .withColumn("weight", F.element_at(weights, F.col("source_no") % len(mix.weights) + 1))
        .withColumn("most", F.col("source_size") * mix.most)
    )
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.sum("source_size").over(everything) * mix.share
    return (
        numbered.withColumn("left", wanted - F.coalesce(F.sum("most").over(upto), F.lit(0.0)))
        .withColumn(
            "left_weight",
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)),
        )
        .withColumn("level", F.col("left") / F.col("left_weight"))
        .withColumn("free", F.col("level") * F.col("weight") < F.col("most"))
        # The level of the first source that stays below its limit.
        .withColumn("first", F.min(F.when(F.col("free"), F.struct(F.col("most") / F.col("weight"), "source_no", "level"))).over(everything)["level"])
        .withColumn(
            "target",
            F.least("most", F.coalesce(F.col("first") * F.col("weight"), F.col("most"))),
        )
        .select("source_no", "source", "source_size", "target")
    )


def draw_plan(targets: DataFrame, mix: Mix) -> DataFrame:
    """Add the blocks and slots of each source: ``n_blocks``, ``words`` to take, ``n_slots``."""
    b = mix.block_words
    words = F.round("target").cast("long")
    passes, rest = F.expr("words div source_size"), F.expr("words % source_size")
    return (
        targets.where("source_size > 0")
        .withColumn("words", words)
        .where("words > 0")
        .withColumn("n_blocks", F.expr(f"(source_size + {b - 1}) div {b}"))
        .withColumn("n_slots", passes * F.col("n_blocks") + F.expr(f"({b - 1} + words % source_size) div {b}"))
        .withColumn("rest", rest)
    )


def shard_counts(plan: DataFrame, mix: Mix) -> DataFrame:
    """Slots of each source in each output shard: ``shard``, ``source_no``, ``from_slot``,
    ``to_slot`` (exclusive), numbered along the source.

    Every shard draws as many slots as its share of all, one uniform number each; counted by
    source that is one multinomial draw per shard. Scaling a source's running count to its
    slots keeps the draws' spread and makes the totals exact.
    """
    spark = plan.sparkSession
    total = plan.agg(F.sum("n_slots")).first()[0] or 0
    ends = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    width = max(1, -(-total // CELLS))
    ranges = (
        plan.withColumn("end", F.sum("n_slots").over(ends))
        .withColumn("start", F.col("end") - F.col("n_slots"))
        .withColumn("cell", F.explode(F.expr(f"sequence(start div {width}, (end - 1) div {width})")))
        .select("source_no", "start", "end", "cell")
    )
    per_shard = max(1, -(-total // mix.shards))
    draws = (
        spark.range(total)
        .withColumn("shard", F.expr(f"id div {per_shard}"))
        .withColumn("draw", F.pmod(F.xxhash64(F.lit(mix.seed), F.lit("draw"), "id"), F.lit(max(1, total))))
        .withColumn("cell", F.expr(f"draw div {width}"))
    )
    counts = (
        draws.join(ranges, "cell")
        .where("draw >= start AND draw < end")
        .groupBy("shard", "source_no")
        .agg(F.count("*").alias("drawn"))
    )
    # A source that no draw met goes to one shard chosen by its number.
    missed = plan.join(counts, "source_no", "left_anti").select(
        F.pmod(F.xxhash64(F.lit(mix.seed), "source_no"), F.lit(mix.shards)).alias("shard"),
        "source_no",
        F.lit(1).cast("long").alias("drawn"),
    )
    so_far = Window.partitionBy("source_no").orderBy("shard")
    upto = so_far.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("source_no")
    # Decimals: the products pass 64 bits on a large corpus.
    scaled = F.floor(
        F.sum("drawn").over(upto).cast("decimal(19,0)")
        * F.col("n_slots").cast("decimal(18,0)")
        / F.sum("drawn").over(whole).cast("decimal(19,0)")
    ).cast("long")
    return (
        counts.unionByName(missed)
        .join(plan.select("source_no", "n_slots"), "source_no")
        .withColumn("to_slot", scaled)
        .withColumn("from_slot", F.coalesce(F.lag("to_slot").over(so_far), F.lit(0)))
        .where("to_slot > from_slot")
        .select("shard", "source_no", "from_slot", "to_slot")
    )


def permuted(position: Column, n: Column, *key: Column) -> Column:
    """A keyed pseudorandom permutation of ``0 .. n - 1``: in each round a position may change
    places with its mirror image about a random point, as a hash of the pair decides."""

    def one_round(x: Column, i: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(F.lit("point"), *key, i), n) - x, n)
        swap = F.pmod(F.xxhash64(F.lit("swap"), *key, i, F.greatest(x, mirror)), F.lit(2)) == 1
        return F.when(swap, mirror).otherwise(x)

    return F.reduce(F.sequence(F.lit(1), F.lit(ROUNDS)), position, one_round)


def drawn_slots(plan: DataFrame, counts: DataFrame, mix: Mix) -> DataFrame:
    """One row per slot: ``shard``, ``source_no``, ``pass_no``, ``block`` and ``upto``, the
    words taken from the start of the block."""
    b = mix.block_words
    # Chunks are few and small but cost much to expand. With a number given, adaptive execution
    # does not merge them into one task by their bytes.
    tasks = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = counts.withColumn(
        "chunk", F.explode(F.expr(f"sequence(from_slot, to_slot - 1, {CHUNK}L)"))
    ).repartition(tasks, "source_no", "chunk")
    n_full = F.col("n_blocks") - 1
    return (
        chunks.withColumn(
            "slot", F.explode(F.expr(f"sequence(chunk, least(chunk + {CHUNK}, to_slot) - 1)"))
        )
        .join(plan.select("source_no", "source_size", "words", "n_blocks"), "source_no")
        .withColumn("pass_no", F.expr("slot div n_blocks"))
        .withColumn("position", F.expr("slot % n_blocks"))
        .withColumn(
            "block",
            F.when(F.col("position") == n_full, n_full).otherwise(
                permuted(F.col("position"), n_full, F.lit(mix.seed), F.col("source_no"), F.col("pass_no"))
            ),
        )
        .withColumn(
            "upto",
            F.least(
                F.lit(b).cast("long"),
                F.col("source_size") - F.col("block") * b,
                F.col("words") - F.col("pass_no") * F.col("source_size") - F.col("position") * b,
            ),
        )
        .select("shard", "source_no", "slot", "pass_no", "block", "upto")
    )


def packed_pieces(located: DataFrame, mix: Mix) -> DataFrame:
    """One row per document and block it reaches into, none of them for an empty document:
    ``block`` and the words ``[piece_from, piece_to)`` counted from the start of the block."""
    b = mix.block_words
    first, last = f"offset div {b}", f"(offset + size - 1) div {b}"
    return (
        located.where("size > 0")
        .withColumn("block", F.explode(F.expr(f"sequence({first}, {last})")))
        .withColumn("piece_from", F.greatest(F.col("offset") - F.col("block") * b, F.lit(0)))
        .withColumn(
            "piece_to",
            F.least(F.col("offset") + F.col("size") - F.col("block") * b, F.lit(b)),
        )
    )


def plan_mix(sizes: DataFrame, mix: Mix, order: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Targets, pieces of documents in blocks, and drawn slots.

    ``sizes`` has ``source``, ``size`` and the columns of ``order``, which order the documents
    within a source after a hash of the first; rows equal in all of them are alike.
    """
    targets = materialise(source_targets(sizes, mix))
    located = prefix_sums(
        sizes.join(
            targets.select(F.col("source").alias("_source"), "source_no"),
            F.col("source").eqNullSafe(F.col("_source")),
        ).drop("_source"),
        "source_no",
        F.pmod(F.xxhash64(F.lit(mix.seed), order[0]), F.lit(bucket_count(sizes))),
        [F.asc_nulls_last(c) for c in (*order, "size")],
        F.col("size"),
        "offset",
    )
    plan = draw_plan(targets, mix)
    slots = drawn_slots(plan, shard_counts(plan, mix), mix)
    return targets, located, slots


def mixed_spans(located: DataFrame, slots: DataFrame, mix: Mix) -> DataFrame:
    """The mix itself: one row per slot and piece of a document, with ``shard``, ``slot``,
    ``pass_no`` and the words ``[from_word, to_word)`` of the document that the slot takes."""
    return (
        packed_pieces(located, mix)
        .join(slots, ["source_no", "block"])
        .where("upto > piece_from")
        .withColumn(
            "from_word", F.col("block") * mix.block_words + F.col("piece_from") - F.col("offset")
        )
        .withColumn(
            "to_word",
            F.col("from_word") + F.least("piece_to", "upto") - F.col("piece_from"),
        )
    )


def mix_sizes(docs: DataFrame, mix: Mix) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` (its source's) and ``taken``, the
    words that the mix takes from the document, repeats counted.

    A null or empty text has size 0 and gives nothing; null sources form one source, the last.
    Repeated rows are packed one after the other. An empty table gives an empty result.
    """
    sizes = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    targets, located, slots = plan_mix(sizes, mix, ["doc_id"])
    located = materialise(located.select("doc_id", "source_no", "size", "offset"))
    taken = (
        mixed_spans(located, slots, mix)
        .groupBy("source_no", "offset", "doc_id", "size")
        .agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    )
    # An offset belongs to one document that has words, so the key of the join is unique.
    full = located.where("size > 0").join(
        taken.select("source_no", "offset", "taken"), ["source_no", "offset"], "left"
    )
    empty = located.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return (
        full.unionByName(empty)
        .join(targets.select("source_no", "source_size", "target"), "source_no")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def mixed_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``: one row per document and pass
    that takes words of it.

    A row whose pass takes all words keeps its text as it is; otherwise its text is the taken
    words in their order, joined by spaces, and ``n_chars``, if there is one, is counted anew.
    Documents without words are not in the mix.
    """
    numbered = materialise(docs.withColumn("_row", F.monotonically_increasing_id()))
    sizes = materialise(numbered.select("_row", "source", word_count(F.col("text")).alias("size")))
    _, located, slots = plan_mix(sizes, mix, ["_row"])
    spans = (
        mixed_spans(located, slots, mix)
        .groupBy("_row", "pass_no", "size")
        .agg(
            F.sum(F.col("to_word") - F.col("from_word")).alias("_taken"),
            F.array_sort(F.collect_list(F.struct("from_word", "to_word"))).alias("_spans"),
        )
        .withColumn("_spans", F.when(F.col("_taken") < F.col("size"), F.col("_spans")))
        .select("_row", "_spans")
    )
    words = F.flatten(
        F.transform(
            "_spans",
            lambda s: F.slice(
                F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0)),
                (s["from_word"] + 1).cast("int"),
                (s["to_word"] - s["from_word"]).cast("int"),
            ),
        )
    )
    out = numbered.join(spans, "_row").withColumn(
        "text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(F.array_join(words, " "))
    )
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(
            "n_chars",
            F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)),
        )
    return out.select(*docs.columns)
