"""Document fingerprints by consistent weighted sampling, in Spark's own expressions.

A text is a bag of terms, runs of anything but white space with their counts. For each component of
the fingerprint every term draws, from hashes of itself alone, two gamma variables r and c (shape
2) and a uniform b. A term of weight w takes the step t = floor(ln w / r + b), and
a = c * exp(-r * (t - b + 1)) is its rank; the least rank of the bag gives the component, a mark of
the term and its step. Two bags agree in a component with probability equal to their generalised
Jaccard similarity, the sum of the smaller weights over the sum of the larger.

A term's rank is exponential with rate w, so the least of a bag of total weight W is, but for two
components in 10**9, below ``REACH / W``. As exp(-r) is a product of two uniform numbers, and c at
least 2 (1 - x) / (1 + x) for another such product x, most draws are known to lie beyond that
without a logarithm and go no further.

A text and its edited form are sampled together: the draws of a term serve both. Rank and mark share
one long, so the least is a plain minimum; texts are shuffled once, by their document, and all
further grouping goes by the document too and needs no other shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dosecast.llm.common import SPACED_WORD, ascii_lower, materialise

SAMPLES = 64
REACH = 20.0
# Ranks are kept as ln rank + RANGE, in units of 2**-23, in the upper 32 bits of 63.
RANGE = 256.0
MARK_BITS = 31
KEY = ["no_id", "id", "hash"]


def _bits(number: Column, shift: int, width: int) -> Column:
    part = F.shiftrightunsigned(number, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
    return part.cast("double")


def _uniform(high: Column, shift: int, low: Column, low_shift: int, low_width: int) -> Column:
    """A number in (0, 1): 16 bits of one hash, and finer ones of another."""
    fine = (_bits(low, low_shift, low_width) + 0.5) * 2.0**-low_width
    return (_bits(high, shift, 16) + fine) * 2.0**-16


def _fixed(rows: DataFrame) -> DataFrame:
    """Keep the planner from moving a filter on these columns below them, which would work the
    draws out twice: it does not pass a column that is not deterministic."""
    return rows.withColumn("_part", F.spark_partition_id())


def draws(rows: DataFrame, weights: Sequence[str]) -> DataFrame:
    """Add ``_<weight>``, rank and mark of the row's ``term`` in its ``component``, one long for each
    weight column; null beyond the reach of ``<weight>_total``, and rows of nulls only are left
    out. Every step is a projection of its own, so that each draw is worked out once."""
    f, s, u, x, r, b, c = (F.col(f"_{n}") for n in "fsuxrbc")
    rows = rows.withColumn("_f", F.xxhash64("term", "component"))
    # From below and from above, by the bits of the first hash.
    rows = rows.withColumns(
        {
            "_u": _bits(f, 48, 16) * _bits(f, 32, 16) * 2.0**-32,
            "_x": (_bits(f, 16, 16) + 1) * (_bits(f, 0, 16) + 1) * 2.0**-32,
        }
    )
    some = F.lit(False)
    for w in weights:
        some = some | ((1 - x) * u * 2 * F.col(f"{w}_total") <= (1 + x) * F.col(w) * REACH)
    rows = _fixed(rows).where((F.col("_part") >= 0) & some).withColumn("_s", F.xxhash64("_f"))
    rows = rows.withColumns(
        {
            "_r": -F.ln(_uniform(f, 48, s, 53, 11) * _uniform(f, 32, s, 42, 11)),
            "_b": (_bits(s, 0, 22) + 0.5) * 2.0**-22,
            "_c": F.ln(-F.ln(_uniform(f, 16, s, 32, 10) * _uniform(f, 0, s, 22, 10))),
        }
    )
    step = {w: F.floor(F.ln(F.col(w).cast("double")) / r + b) for w in weights}
    rows = rows.withColumns({f"_t_{w}": t for w, t in step.items()})
    rank = {w: c - r * (F.col(f"_t_{w}").cast("double") - b + 1.0) for w in weights}
    rows = rows.withColumns({f"_a_{w}": a for w, a in rank.items()})
    packed, some = {}, F.lit(False)
    for w in weights:
        a, near = F.col(f"_a_{w}"), F.ln(REACH / F.col(f"{w}_total"))
        whole = F.greatest(F.least((a + RANGE) * 2.0**23, F.lit(2.0**32 - 1)), F.lit(0.0))
        mark = F.shiftrightunsigned(F.xxhash64(s, F.col(f"_t_{w}")), 64 - MARK_BITS)
        both = F.shiftleft(whole.cast("long"), MARK_BITS).bitwiseOR(mark)
        packed[f"_{w}"] = F.when((F.col(w) > 0) & (a <= near), both)
        some = some | F.col(f"_{w}").isNotNull()
    return _fixed(rows.withColumns(packed)).where((F.col("_part") >= 0) & some)


def signatures(
    bags: DataFrame, keys: Sequence[str], weights: Sequence[str], samples: int = SAMPLES
) -> DataFrame:
    """A fingerprint per key and weight column, as hex digits, four for each component.

    ``bags`` has one row per key and ``term`` (a long), with its weights, null or 0 where the term
    is not in that bag, and the total of each, ``<weight>_total``, on every row of the key.
    Partitioned by the keys, ``bags`` is not shuffled. The mark of a component that nothing
    reaches is 0.
    """
    drawn = draws(bags.withColumn("component", F.explode(F.sequence(F.lit(0), F.lit(samples - 1)))), weights)
    least = drawn.groupBy(*keys, "component").agg(*[F.min(f"_{w}").alias(f"_{w}") for w in weights])
    digits = lambda c: F.lpad(F.lower(F.hex(c.bitwiseAND(F.lit(65535).cast("long")))), 4, "0")
    marks = [
        F.when(F.col(f"_{w}").isNotNull(), F.struct("component", digits(F.col(f"_{w}")).alias("mark")))
        for w in weights
    ]
    held = least.groupBy(*keys).agg(
        *[F.sort_array(F.collect_list(m)).alias(w) for w, m in zip(weights, marks, strict=True)]
    )
    every = F.sequence(F.lit(0), F.lit(samples - 1))

    def joined(w: Column) -> Column:
        known = F.map_from_entries(w)
        filled = F.transform(every, lambda k: F.coalesce(F.try_element_at(known, k), F.lit("0000")))
        whole = F.when(F.size(w) == samples, w["mark"])
        return F.array_join(F.coalesce(whole, filled), "")

    return held.select(*keys, *[joined(F.col(w)).alias(w) for w in weights])


def likeness(one: Column, two: Column, samples: int = SAMPLES) -> Column:
    """The share of components in which two fingerprints agree."""
    part = lambda c, k: F.substr(c, k * 4 + 1, F.lit(4))
    agree = lambda k: part(one, k) == part(two, k)
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(samples - 1)), agree)) / float(samples)


def terms(text: Column) -> Column:
    """Terms of a text, A-Z lower-cased."""
    return F.regexp_extract_all(ascii_lower(text), F.lit(f"({SPACED_WORD})"), F.lit(1))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` with a key of both that is never null."""
    some = docs.schema["doc_id"].dataType
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("doc_id", F.lit(0).cast(some)).alias("id"),
        F.xxhash64(text).alias("hash"),
        text.alias("text"),
    )


def following(docs: DataFrame) -> DataFrame:
    """Each document's ``next`` (a struct of the key), ``n_chars`` and ``copies``, its rows.

    Ids are ordered in ranges; a range's last document is followed by the first of the next range,
    so no task sees more than its range, and no text is moved.
    """
    rows = (
        docs.groupBy(*KEY)
        .agg(F.max(F.char_length("text")).cast("long").alias("n_chars"), F.count("*").alias("copies"))
        .repartitionByRange(*KEY)
        .withColumn("part", F.spark_partition_id())
    )
    rows = materialise(rows)
    key = F.struct(*KEY)
    ends = Window.orderBy("part")
    firsts = (
        rows.groupBy("part")
        .agg(F.min(key).alias("first"))
        .withColumn("begin", F.lead("first").over(ends))
        .withColumn("begin", F.coalesce("begin", F.min("first").over(Window.partitionBy())))
        .drop("first")
    )
    within = Window.partitionBy("part").orderBy(*KEY)
    return (
        rows.withColumn("next", F.lead(key).over(within))
        .join(firsts, "part")
        .withColumn("next", F.coalesce("next", "begin"))
        .drop("part", "begin")
    )


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next`` of each row of ``docs`` (``doc_id``, ``text``; other columns
    are not read).

    The edited text has its last quarter replaced by as much of the beginning of the next
    document, in the order of ids, null last, and of a hash of the text where ids are equal; the
    first document follows the last. Rows equal in id and text are one document here and have
    equal results. A null text is empty; an empty text, or one of white space, is the bag of one
    empty term, so such texts are like each other and unlike all others. A document alone is its
    own next. An empty table gives no row.
    """
    rows = keyed(docs)
    after = materialise(following(rows))
    texts = rows.dropDuplicates(KEY)
    asked = after.select(
        *[F.col("next")[c].alias(c) for c in KEY],
        F.struct(*KEY).alias("for"),
        F.expr("int(n_chars div 4)").alias("take"),
        "n_chars",
    )
    heads = texts.join(asked, KEY).select(
        *[F.col("for")[c].alias(c) for c in KEY],
        F.struct(*KEY).alias("next"),
        "n_chars",
        "take",
        F.expr("substring(text, 1, take)").alias("head"),
    )
    both = texts.join(heads, KEY).withColumn(
        "edited", F.expr("concat(substring(text, 1, int(n_chars - take)), head)")
    )
    sides = F.posexplode(F.array("text", "edited")).alias("side", "t")
    lists = both.select(*KEY, sides).select(*KEY, "side", terms(F.col("t")).alias("t"))
    # A text without terms has the empty one.
    total = F.greatest(F.size("t"), F.lit(1)).alias("total")
    words = lists.select(*KEY, "side", total, F.explode_outer("t").alias("t"))
    own, edited = F.col("side") == 0, F.col("side") == 1
    bags = (
        words.withColumn("term", F.xxhash64(F.coalesce("t", F.lit(""))))
        .groupBy(*KEY, "term")
        .agg(
            F.count_if(own).alias("own"),
            F.count_if(edited).alias("edited"),
            F.max(F.when(own, F.col("total"))).alias("own_total"),
            F.max(F.when(edited, F.col("total"))).alias("edited_total"),
        )
    )
    marks = signatures(bags, KEY, ["own", "edited"], samples)
    facts = both.select(*KEY, "next", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    done = materialise(
        facts.join(marks, KEY).withColumnsRenamed({"own": "fingerprint", "edited": "edited_fingerprint"})
    )
    follower = done.select(
        *[F.col(c).alias(f"_{c}") for c in KEY], F.col("fingerprint").alias("_next_print")
    )
    same_next = [F.col("next")[c] == F.col(f"_{c}") for c in KEY]
    copies = after.where("copies > 1").select(*KEY, "copies")
    return (
        done.join(follower, same_next)
        .select(
            *KEY,
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
            likeness(F.col("fingerprint"), F.col("_next_print"), samples).alias("near_next"),
        )
        .join(copies, KEY, "left")
        .withColumn("_copy", F.explode(F.expr("sequence(1L, coalesce(copies, 1L))")))
        .withColumn("doc_id", F.when(~F.col("no_id"), F.col("id")))
        .select(
            "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
        )
    )
