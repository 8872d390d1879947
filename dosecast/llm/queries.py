"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.llm import (
    bagminhash,
    classify,
    decontaminate,
    divergence,
    language,
    mixing,
    neighbours,
    quality,
    sharding,
    toxicity,
    urlrules,
    veccodes,
    warc,
    weighted,
)
from dosecast.llm.common import ROWS_PER_BUCKET, table

TREE = sharding.even_tree(regions=2, racks=2, shards=2)


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"), mixing.Mix())


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(language.training_rows(docs))
    held_out = F.coalesce(classify.fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out")
    return language.identify(docs.select("doc_id", held_out, "text"), model).drop("text")


def _labelled(spark: SparkSession, sf_dir: str, label: str, per_label: int) -> tuple[DataFrame, DataFrame]:
    """All documents with their fold, and a bounded sample of the labelled ones that may be
    learned from."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(classify.fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out")
    docs = docs.select("doc_id", held_out, "text")
    learned = docs.where("NOT held_out")
    return docs, classify.labelled_sample(learned, table(spark, sf_dir, "labels"), label, per_label)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    how = toxicity.Settings()
    docs, sample = _labelled(spark, sf_dir, "toxic", how.rows_per_label)
    return toxicity.score(docs, toxicity.fit(sample, how)).drop("text")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    how = quality.Settings()
    docs, sample = _labelled(spark, sf_dir, "quality", how.rows_per_label)
    return quality.score(docs, quality.fit(docs, sample, how)).drop("text")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op6_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10
    )
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_bag_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = bagminhash.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "class_size")


def op8_means_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_page_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_archive(table(spark, sf_dir, "pages"), min_bytes=100)
    return warc.archived_pages(warc.read_archive(spark, archive))


def op10_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), TREE)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


def op12_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted.edited_fingerprints(table(spark, sf_dir, "documents"))


def op13_trie_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return veccodes.vector_codes(table(spark, sf_dir, "embeddings")).drop("label")


def _hash52(*parts: str) -> str:
    return f"('0x' || substr(md5({" || '|' || ".join(parts)}), 1, 13))::BIGINT"


def _draw(name: str) -> str:
    return f"-ln(({_hash52(f"'{name}'", 'key')} + 0.5) / 4503599627370496.0)"


def _shard_sql() -> str:
    """The tree of two by two by two, level by level; ties go to the first child."""
    node = "'r' || region"
    rack = "'r' || region || '/k' || rack"

    def level(expr: str, letter: str) -> str:
        draws = [
            f"-ln(({_hash52(f"{expr} || '{letter}' || {n}", 'key')} + 0.5) / 4503599627370496.0)"
            for n in ("0", "1")
        ]
        return f"CASE WHEN {draws[0]} <= {draws[1]} THEN 0 ELSE 1 END"

    leaf = f"'r' || region || '/k' || rack || '/s' || (region * 4 + rack * 2 + {{}})"
    leaf_draws = [
        f"-ln(({_hash52(leaf.format(n), 'key')} + 0.5) / 4503599627370496.0)" for n in (0, 1)
    ]
    return f"""
WITH crc_table AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)
), d AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key, text,
    CASE WHEN text IS NOT NULL THEN xor(list_reduce(list_concat([4294967295::BIGINT],
      list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) END AS crc
  FROM documents, crc_table
), a AS (
  SELECT *, CASE WHEN {_draw("r0")} <= {_draw("r1")} THEN 0 ELSE 1 END AS region,
    {_draw("r2")} / 1.0 AS new_draw,
    least({_draw("r0")}, {_draw("r1")}) / 4.0 AS old_draw
  FROM d
), b AS (
  SELECT *, {level(f"{node} || '/'", "k")} AS rack FROM a
), c AS (
  SELECT *, region * 4 + rack * 2
    + CASE WHEN {leaf_draws[0]} <= {leaf_draws[1]} THEN 0 ELSE 1 END AS shard
  FROM b
)
SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, crc AS text_crc32, 'key' AS law,
  CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY
    {_hash52("'slot'", "key")} % greatest(1, ((SELECT count(*) FROM documents) + {ROWS_PER_BUCKET - 1}) // {ROWS_PER_BUCKET}),
    doc_id NULLS LAST, strlen(text), crc NULLS LAST) - 1 AS slot,
  CAST(CASE WHEN new_draw < old_draw THEN 8 ELSE shard END AS INTEGER) AS grown_shard
FROM c"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mix": op1_source_mix,
    "op2_language": op2_language,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_url_rules": op5_url_rules,
    "op6_benchmark_passages": op6_benchmark_passages,
    "op7_bag_min_hash": op7_bag_min_hash,
    "op8_means_tree": op8_means_tree,
    "op9_page_archive": op9_page_archive,
    "op10_hash_tree_shards": op10_hash_tree_shards,
    "op11_source_divergence": op11_source_divergence,
    "op12_weighted_fingerprints": op12_weighted_fingerprints,
    "op13_trie_codes": op13_trie_codes,
}

ARCHIVE_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_page
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_page IS NOT NULL AND page_id IS DISTINCT FROM first_page THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_page THEN first_page END AS refers_to
FROM f"""

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PASSAGES_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all({LOWER}, '{WORDS}') AS ws FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER}, '{WORDS}') AS ws
  FROM benchmark WHERE item_id IS NOT NULL
), iw AS (
  SELECT DISTINCT item, least(10, len(ws)) AS k,
    array_to_string(list_slice(ws, s, s + least(10, len(ws)) - 1), ' ') AS win
  FROM (SELECT *, unnest(generate_series(1, greatest(1, len(ws) - 9))) AS s FROM i WHERE len(ws) > 0)
), dw AS (
  SELECT n, k, s, array_to_string(list_slice(ws, s, s + k - 1), ' ') AS win
  FROM (SELECT *, unnest(generate_series(1, len(ws) - k + 1)) AS s
        FROM d, (SELECT DISTINCT k FROM iw) WHERE len(ws) >= k)
), hits AS (
  SELECT DISTINCT n, s, dw.k, item FROM dw JOIN iw ON dw.win = iw.win AND dw.k = iw.k
), hit_words AS (
  SELECT n, count(DISTINCT p) AS n_hit FROM (SELECT n, unnest(generate_series(s, s + k - 1)) AS p FROM hits)
  GROUP BY n
), hit_items AS (
  SELECT n, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM hits GROUP BY n
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (n) LEFT JOIN hit_items USING (n)"""

TERMS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
DIVERGENCE_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({LOWER}, '{TERMS}') AS ws
  FROM documents
), c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs
  FROM (SELECT doc, lang, source, unnest(ws) AS term FROM d) GROUP BY lang, source, term
), kept AS (
  SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term HAVING sum(docs) >= 10
), langs AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS q
  FROM kept WINDOW w AS (PARTITION BY lang)
), g AS (
  SELECT DISTINCT lang, source FROM d
), cells AS (
  SELECT lang, source, term, n,
    1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS p
  FROM (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n
        FROM g JOIN kept ON g.lang = kept.lang
        LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term)
  WINDOW w AS (PARTITION BY lang, source)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q)
  FROM cells JOIN langs USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 10"""


def _codes_sql(coding: veccodes.Coding) -> str:
    """The rounds one after the other, each an assignment and new entries."""
    far = "list_sum(list_transform(list_zip(part, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = [
        f"""WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor({coding.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT n, vec_id, pos, q[pos * (len(q) // {coding.parts}) + 1 : (pos + 1) * (len(q) // {coding.parts})] AS part
  FROM v, range({coding.parts}) AS r(pos)
), b0 AS MATERIALIZED (
  SELECT pos, entry, part AS c FROM p JOIN (
    SELECT n, row_number() OVER (ORDER BY vec_id NULLS LAST, q) - 1 AS entry FROM v) USING (n)
  WHERE entry < {coding.entries}
)"""
    ]
    for k in range(coding.rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT n, p.pos, any_value(part) AS part, min({far} * {coding.entries} + entry) AS best
  FROM p JOIN b{k} b ON p.pos = b.pos GROUP BY n, p.pos
)""")
        if k < coding.rounds:
            steps.append(f"""b{k + 1} AS MATERIALIZED (
  SELECT b.pos, b.entry, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN (
    SELECT pos, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
      SELECT pos, best % {coding.entries} AS entry, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT pos, best, unnest(part) AS x, unnest(range(len(part))) AS i FROM a{k}) GROUP BY ALL)
    GROUP BY pos, entry) m ON m.pos = b.pos AND m.entry = b.entry
)""")
    last = coding.rounds
    return ", ".join(steps) + f""", coded AS (
  SELECT n, string_agg(lpad(lower(to_hex(best % {coding.entries})), 2, '0'), '' ORDER BY pos) AS code,
    CAST(sum(best // {coding.entries}) AS BIGINT) AS error
  FROM a{last} GROUP BY n
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY pos, entry)) FROM b{last}) AS codebooks_sha256
FROM v JOIN coded USING (n)"""


ORACLES: dict[str, str] = {
    "op11_source_divergence": DIVERGENCE_SQL,
    "op13_trie_codes": _codes_sql(veccodes.Coding()),
    "op6_benchmark_passages": PASSAGES_SQL,
    "op9_page_archive": ARCHIVE_SQL,
    "op10_hash_tree_shards": _shard_sql(),
}
