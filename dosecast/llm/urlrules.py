"""URL filtering by association rules.

Urls with labels are baskets of tokens; FP-growth mines the token combinations that are frequent
among them, and those that imply the label ``bad`` often enough become rules. Rules are held in
an inverted index under their rarest token: a url looks up its tokens and checks the few rules
found there in full. A given list of host and path rules goes before the mined ones.

All of it is DataFrame operations and Spark ML's FP-growth. Urls of equal tokens are judged once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import ascii_lower, materialise

BAD = "label=bad"


@dataclass(frozen=True)
class HostRule:
    """Fits its host and all subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed by the contract.
RULES = (
    HostRule("allow", "com", "/"),
    HostRule("block", "example.com", "/en/"),
    HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"),
    HostRule("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class Mining:
    """Which token sets become rules.

    A set needs ``min_support`` of the labelled baskets, and ``min_count`` of them, to be bad and
    to hold it. Its confidence is judged by the share of bad ones in all labelled baskets: the odds
    of bad must be ``min_odds_ratio`` times the odds at large, and its bad baskets must be
    ``min_deviations`` standard deviations more than that share of its baskets. An absolute
    ``min_confidence`` takes the place of these two."""

    min_support: float = 0.005
    min_count: int = 30
    min_odds_ratio: float = 3.0
    min_deviations: float = 5.0
    min_confidence: float | None = None

    def is_rule(self, base: float) -> Column:
        """Over ``confidence`` and ``deviations``, where a share ``base`` of all is bad."""
        if self.min_confidence is not None:
            return F.col("confidence") >= self.min_confidence
        odds = self.min_odds_ratio * base
        return (F.col("confidence") >= odds / (1 - base + odds)) & (
            F.col("deviations") >= self.min_deviations
        )


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lowered), path, and the rest from ``?`` or ``#``; all empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    rest = F.coalesce(rest, F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(after, r"^[^?#]*", 0)
    return host, path, F.substring(after, F.length(path) + 1, F.length(after))


def host_rule(host: Column, path: Column, rules: Sequence[HostRule]) -> Column:
    """The longest rule that fits, as a struct of ``text`` and ``verdict``; null if none does.
    Of two of the same length that with the longer host wins."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.text))
    return F.coalesce(
        *[
            F.when(
                ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
                F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict")),
            )
            for r in ordered
        ],
        F.lit(None).cast("struct<text:string,verdict:string>"),
    )


def url_tokens(host: Column, path: Column, rest: Column) -> Column:
    """The distinct tokens of a url: each label of the host with its place from the right, each
    word of the path, the file ending, the names of the query's parameters."""
    labels = F.reverse(F.split(host, r"\."))
    tag = lambda name, items: F.transform(items, lambda x: F.concat(F.lit(f"{name}="), x))
    return F.array_distinct(
        F.concat(
            F.transform(labels, lambda x, i: F.concat(F.lit("host"), i.cast("string"), F.lit("="), x)),
            tag("path", F.regexp_extract_all(ascii_lower(path), F.lit(r"[a-z]+"), F.lit(0))),
            tag("end", F.regexp_extract_all(ascii_lower(path), F.lit(r"\.([a-z0-9]+)$"), F.lit(1))),
            tag("query", F.regexp_extract_all(ascii_lower(rest), F.lit(r"[?&]([^=&#]+)="), F.lit(1))),
        )
    )


def frequent_sets(baskets: DataFrame, mining: Mining) -> tuple[DataFrame, float]:
    """The token sets frequent among the bad baskets, and the share of bad in all labelled ones.

    Reads ``tokens`` and ``bad``; gives ``tokens``, ``hits`` (bad baskets that hold the set),
    ``freq`` (all that do), ``confidence``, ``support`` and ``deviations``. Null labels and
    baskets without tokens are left out; without labelled baskets there are no sets.
    """
    labelled = baskets.where("bad IS NOT NULL AND size(tokens) > 0").select(
        F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD))))
        .otherwise(F.col("tokens"))
        .alias("items")
    )
    labelled = materialise(labelled)
    empty = labelled.sparkSession.createDataFrame(
        [],
        "tokens array<string>, hits long, freq long, confidence double, support double, deviations double",
    )
    marked = F.array_contains("items", BAD)
    total, bads = labelled.agg(F.count(F.lit(1)), F.count_if(marked)).first()
    if not bads:
        return empty, 0.0
    base = bads / total
    # A rule's support counts the baskets with its tokens and the label, so only tokens that
    # are frequent among the bad baskets can be part of a rule.
    least = max(mining.min_support * total, mining.min_count)
    bad = labelled.where(marked)
    useful = materialise(
        bad.select(F.explode("items").alias("item")).groupBy("item").count().where(F.col("count") >= least)
    ).select("item")
    numbered = labelled.withColumn("_n", F.monotonically_increasing_id())
    kept = materialise(
        materialise(numbered)
        .select("_n", F.explode("items").alias("item"))
        .join(useful, "item")
        .groupBy("_n")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
        .select("items")
    )
    held = kept.count()
    if not held:
        return empty, base
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, least / held)).fit(kept)
    sets = model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")
    with_label = sets.where(marked & (F.size("items") > 1)).select(
        F.array_remove("items", BAD).alias("tokens"), F.col("freq").alias("hits")
    )
    # Where all baskets are bad, none is more often so than the rest.
    spread = F.sqrt(F.col("freq") * F.lit(base * (1 - base)))
    surplus = F.col("hits") - F.col("freq") * F.lit(base)
    return materialise(
        with_label.join(sets.select(F.col("items").alias("tokens"), "freq"), "tokens").select(
            "tokens",
            "hits",
            "freq",
            (F.col("hits") / F.col("freq")).alias("confidence"),
            (F.col("hits") / F.lit(float(total))).alias("support"),
            F.when(spread > 0, surplus / spread).otherwise(0.0).alias("deviations"),
        )
    ), base


def mine_rules(baskets: DataFrame, mining: Mining) -> DataFrame:
    """Rules from ``tokens`` and ``bad``: ``tokens``, ``confidence``, ``support``.

    The ``frequent_sets`` that ``mining`` takes for rules; one is dropped if a part of it is a
    rule at least as confident.
    """
    sets, base = frequent_sets(baskets, mining)
    rules = sets.where(mining.is_rule(base)).select("tokens", "confidence", "support")
    # A part of a rule has one token less; by steps of one the comparison reaches all parts.
    parts = rules.select(
        F.col("tokens").alias("_rule"),
        F.col("confidence").alias("_c"),
        F.explode("tokens").alias("_out"),
    ).select("_rule", "_c", F.array_remove("_rule", F.col("_out")).alias("tokens"))
    dominated = (
        parts.join(rules.select("tokens", "confidence"), "tokens")
        .where("confidence >= _c")
        .select(F.col("_rule").alias("tokens"))
        .distinct()
    )
    return materialise(rules.join(dominated, "tokens", "left_anti"))


def match_rules(baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """The best rule that fits each distinct ``tokens``: ``tokens``, ``mined``, ``confidence``.

    A rule is posted once, under the token that the fewest baskets have, and fits if all its
    tokens are in the basket.
    """
    distinct = baskets.select("tokens").distinct()
    counts = distinct.select(F.explode("tokens").alias("token")).groupBy("token").count()
    postings = (
        rules.select("tokens", "confidence", "support", F.explode("tokens").alias("token"))
        .join(counts, "token", "left")
        .groupBy("tokens", "confidence", "support")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)), "token")).alias("rarest"))
        .select(F.col("rarest.token").alias("token"), F.col("tokens").alias("rule"), "confidence", "support")
    )
    return (
        distinct.withColumn("token", F.explode("tokens"))
        .join(postings, "token")
        .where(F.size(F.array_except("rule", "tokens")) == 0)
        .groupBy("tokens")
        .agg(
            F.max(F.struct("confidence", "support", F.concat_ws("&", "rule").alias("mined"))).alias("best")
        )
        .select("tokens", "best.mined", "best.confidence")
    )


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[HostRule] = RULES,
    mining: Mining = Mining(),  # noqa: B008
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (null if none of the given ones fits),
    ``verdict`` (``allow`` or ``block``) and ``mined``, the token rule that decided, if one did.

    ``labels`` marks pages by ``doc_id``: bad is a quality of 0 or a toxic of 1, in any of its
    rows. A url without a rule of either kind is allowed. A null url, or one without ``://``, has
    empty parts and no tokens. Urls of any length count whole; repeated rows are judged alike, each
    in a row of its own; of rules that are equally confident that with the larger support and then
    the later text is named. Other columns are not read; an empty table gives no row.
    """
    urls = url_baskets(pages)
    mined = mine_rules(labelled_baskets(urls, labels), mining)
    matched = match_rules(urls.where(F.size("tokens") > 0), mined)
    rule = host_rule(F.col("host"), F.col("path"), rules)
    return (
        urls.join(matched, "tokens", "left")
        .withColumn("_rule", rule)
        .select(
            "page_id",
            "host",
            "path",
            F.col("_rule.text").alias("rule"),
            F.coalesce(
                F.col("_rule.verdict"),
                F.when(F.col("mined").isNotNull(), "block").otherwise("allow"),
            ).alias("verdict"),
            F.when(F.col("_rule").isNull(), F.col("mined")).alias("mined"),
        )
    )


def url_baskets(pages: DataFrame) -> DataFrame:
    """``page_id``, ``host``, ``path`` and the ``tokens`` of every url."""
    host, path, rest = split_url(F.col("url"))
    return (
        pages.select("page_id", "url")
        .select("page_id", host.alias("host"), path.alias("path"), rest.alias("rest"))
        .select("page_id", "host", "path", url_tokens(F.col("host"), F.col("path"), F.col("rest")).alias("tokens"))
        .withColumn("tokens", F.filter("tokens", lambda t: ~t.endswith("=")))
    )


def labelled_baskets(urls: DataFrame, labels: DataFrame) -> DataFrame:
    """``tokens`` and ``bad`` of the pages that ``labels`` knows by ``doc_id``."""
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    marks = (
        labels.where("quality IS NOT NULL OR toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max(bad).alias("bad"))
        .withColumnRenamed("doc_id", "page_id")
    )
    return urls.join(marks, "page_id").select("tokens", "bad")
