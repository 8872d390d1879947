"""A corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

The stages keep the columns of ``documents``; the last adds the shard of each row. Their
decisions are made on the whole of what the stage before has kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.llm import bagminhash, decontaminate, language, mixing, sharding
from dosecast.llm.common import materialise, table

# A document stays if its language scores at least so many times an even share of all learned
# ones, and never more than LEAST_SCORE is asked.
EVEN_SHARES, LEAST_SCORE = 1.6, 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and those of no language the model knows. Where no
    language can be learned, every text with a letter stays. Null and empty texts go; repeated
    rows go or stay together; other columns may have any name; an empty table gives no row."""
    model = language.fit(language.training_rows(docs))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    least = min(LEAST_SCORE, EVEN_SHARES / len(model.languages))
    known = language.identify(docs.withColumnsRenamed({"score": "_score", "lang_pred": "_lang"}), model)
    kept = known.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= least))
    back = kept.drop("score", "lang_pred").withColumnsRenamed({"_score": "score", "_lang": "lang_pred"})
    return back.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates: that with the smallest ``doc_id``,
    null last, and of rows that share it the first by text hash and then by the other columns.

    Of rows without words those that share id and text are a class.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    own = F.xxhash64("text").alias("_text")
    # In this order; rows of equal keys are equal rows.
    key = F.struct(F.col("doc_id").isNull().alias("_null"), "doc_id", own, *others).alias("_key")
    classes = bagminhash.near_duplicates(docs.select("doc_id", "text", key))
    wordless = F.when(F.col("class_key").isNull(), F.struct("_key.doc_id", "_key._text"))
    kept = materialise(
        classes.groupBy("class_key", wordless.alias("_own"), "_key")
        .count()
        .groupBy("class_key", "_own")
        .agg(F.min(F.struct("_key", "count")).alias("_least"))
        .select("_least.*")
    )
    keyed = docs.withColumn("_key", key)
    once = keyed.join(kept.where("count = 1"), "_key", "left_semi")
    again = keyed.join(kept.where("count > 1"), "_key", "left_semi").dropDuplicates(["_key"])
    return once.unionByName(again).select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item."""
    # Texts stand for the documents, as an id may be on rows of several texts.
    own = F.xxhash64("text")
    hits = decontaminate.benchmark_hits(
        docs.select(own.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")
    )
    dirty = materialise(hits.where("n_hit > 0").select(F.col("doc_id").alias("_dirty")).distinct())
    return docs.join(dirty, own == F.col("_dirty"), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources to their weights: a row per document and pass over its source.
    Texts without words are in no mix; a null source is a source; repeated rows are documents of
    their own; texts of any length are cut at the mix's words only; an empty table gives no row."""
    return mixing.mixed_documents(docs, mixing.Mix())


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot, in place of columns of these names. Null and empty texts
    have a place too; repeated rows have equal shards and slots of their own; an empty table gives
    no row."""
    return sharding.shard_documents(docs, sharding.even_tree(regions=2, racks=2, shards=2))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_passages", drop_benchmark_passages),
    ("source_mix", mix_sources),
    ("shards", place_in_shards),
]

# Learned predictions and signatures are not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return materialise(STAGES[-1][1](spark, docs, sf_dir))
