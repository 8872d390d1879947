"""Approximate nearest neighbours by inner product, with a hierarchical k-means tree.

The tree is fitted on a bounded sample, a part of the table whatever its size, and every row is
indexed under its leaf. A query walks the tree best bin first: a priority queue of branches,
ordered by the inner product with their centres, yields leaves until enough are visited. How many
are enough is calibrated: some queries are answered exactly against all rows, and visits widen
until their recall reaches the target. A query whose leaves hold fewer than k rows visits more.

Rows of a leaf and the queries that visit it meet in blocks of bounded size, so a leaf of many
rows is many small products. Only rows that reach a query's k-th nearest sample row of the leaves
it visits are sent on; the answers themselves come from those leaves only. Of equal vectors only
the first ids can be among the nearest, so the others need no place in the index; nothing of the
visited leaves that could be an answer is left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dosecast.llm.common import materialise, ship

BLOCK = 1024  # rows, and queries, of one product
SLACK = 1e-9  # between a matrix product and the exact sum, relative to the vectors' lengths


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 2048
    bound_rows: int = 16384  # that tell what a query's k-th nearest scores at least
    sample_share: float = 0.25  # of the table, at most, for either
    branches: int = 8
    leaf_rows: int = 48  # of the sample
    calibration_queries: int = 200
    recall: float = 0.98


@dataclass(frozen=True)
class Tree:
    """Node ``i`` has the centre ``centres[i]`` and the nodes ``children[i]``; without any it is
    the leaf ``leaf[i]``."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row, by the nearest centre on every level."""
        out = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            kids = self.children[node]
            if not kids:
                out[at] = self.leaf[node]
            elif len(at):
                c = self.centres[kids]
                near = (rows[at] @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
                todo += [(kid, at[near == k]) for k, kid in enumerate(kids)]
        return out

    def best_bins(self, query: np.ndarray, visits: int, sizes: np.ndarray, least: int) -> list[int]:
        """The first ``visits`` leaves, the most promising branch always next, and more until
        they hold ``least`` rows; leaf ``i`` holds ``sizes[i]``."""
        queue, found, rows = [(0.0, 0)], [], 0
        while queue and (len(found) < visits or rows < least):
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                found.append(int(self.leaf[node]))
                rows += sizes[found[-1]]
                continue
            for score, kid in zip(self.centres[kids] @ query, kids, strict=True):
                heapq.heappush(queue, (-score, kid))
        return found


def k_means(rows: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(8):
        near = (rows @ centres.T - 0.5 * (centres * centres).sum(axis=1)).argmax(axis=1)
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        centres = sums[n > 0] / n[n > 0, None]
    near = (rows @ centres.T - 0.5 * (centres * centres).sum(axis=1)).argmax(axis=1)
    return centres, near


def fit_tree(rows: np.ndarray, settings: Settings) -> Tree:
    """Split by k-means until a node has few rows or all of them are alike."""
    rng = np.random.default_rng(3)
    centres, children, leaf, leaves = [rows.mean(axis=0)], [[]], [-1], 0
    todo = [(0, np.arange(len(rows)))]
    while todo:
        node, at = todo.pop()
        near = np.zeros(len(at), np.int64)
        if len(at) > settings.leaf_rows:
            own, near = k_means(rows[at], settings.branches, rng)
        parts = np.unique(near)
        if len(parts) < 2:
            leaf[node], leaves = leaves, leaves + 1
            continue
        for k in parts:
            children[node].append(len(centres))
            todo.append((len(centres), at[near == k]))
            centres.append(own[k])
            children.append([])
            leaf.append(-1)
    return Tree(np.array(centres), children, np.array(leaf))


def sound_vectors(df: DataFrame) -> DataFrame:
    """``vec_id`` and ``vec``, an array of doubles, of the rows that take part: a vector that is
    null or zero, or holds a null or a number that is not finite, does not, nor does a row with
    a null id or of another dimension than the most common one. Rows equal in both count once."""
    vec = F.col("embedding").cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vec, lambda x: x != 0)
    rows = (
        df.select("vec_id", vec.alias("vec"), bad.alias("bad"), some.alias("some"))
        .where("vec_id IS NOT NULL AND vec IS NOT NULL AND NOT bad AND some")
        .select(F.col("vec_id").cast("long").alias("vec_id"), "vec")
    )
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vec") == (sizes["d"] if sizes else 0)).distinct()


def matrix(column: pa.Array | pa.ListArray) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def exact_nearest(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """The ``k`` nearest of all rows to each of a bounded number of queries, by blocks:
    ``query_id``, ``vec_id``, ``vec``."""
    held = rows.sparkSession.sparkContext.broadcast((ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = held.value
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                own, vecs = part.column("vec_id").to_numpy(), matrix(part.column("vec"))
                q, r, score = best_pairs(ids, queries, own, vecs, k, np.full(len(ids), -np.inf))
                yield pa.record_batch(
                    [pa.array(ids[q]), part.column("vec_id").take(pa.array(r)), pa.array(score), part.column("vec").take(pa.array(r))],
                    ["query_id", "vec_id", "score", "vec"],
                )

    found = rows.mapInArrow(run, "query_id long, vec_id long, score double, vec array<double>")
    return nearest(found, k)


def best_pairs(
    query_ids: np.ndarray,
    queries: np.ndarray,
    ids: np.ndarray,
    rows: np.ndarray,
    k: int,
    floors: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of query and row, and their exact scores, that can be among the ``k`` best."""
    near = queries @ rows.T
    slack = SLACK * np.abs(near).max(initial=1.0)
    near[query_ids[:, None] == ids] = -np.inf
    least = floors.copy()
    if rows.shape[0] >= k:
        least = np.maximum(least, np.partition(near, -k, axis=1)[:, -k])
    q, r = np.nonzero((near >= (least - slack)[:, None]) & (near > -np.inf))
    # Summed in one fixed order, so that equal vectors have equal scores wherever they lie.
    score = np.empty(len(q))
    for a in range(0, len(q), 65536):
        score[a : a + 65536] = (queries[q[a : a + 65536]] * rows[r[a : a + 65536]]).sum(axis=1)
    return q, r, score


def floors(
    query_ids: np.ndarray,
    queries: np.ndarray,
    bins: list[list[int]],
    sample: tuple[np.ndarray, np.ndarray, np.ndarray],
    k: int,
) -> np.ndarray:
    """What the ``k``-th nearest row of each query scores at least: that of the sample rows (ids,
    vectors, leaves) in the leaves it visits, below all numbers if they are fewer."""
    ids, rows, leaves = sample
    if len(ids) < k:
        return np.full(len(queries), -np.inf)
    near = queries @ rows.T
    slack = SLACK * np.abs(near).max(initial=1.0)
    near[query_ids[:, None] == ids] = -np.inf
    for i, visited in enumerate(bins):
        near[i, ~np.isin(leaves, visited)] = -np.inf
    return np.partition(near, -k, axis=1)[:, -k] - slack


def nearest(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def calibrate(tree: Tree, rows: DataFrame, queries: DataFrame, k: int, settings: Settings) -> int:
    """How many leaves a query visits for the target recall, measured on exact answers."""
    chosen = queries.orderBy(F.xxhash64("vec_id", F.lit("calibrate")), "vec_id").limit(settings.calibration_queries)
    table = chosen.toArrow()
    if not table.num_rows:
        return tree.leaves
    ids, vecs = table.column("vec_id").to_numpy(), matrix(table.column("vec").combine_chunks())
    truth = exact_nearest(rows, ids, vecs, k).select("query_id", "vec").toArrow()
    if not truth.num_rows:
        return tree.leaves
    leaves = tree.assign(matrix(truth.column("vec").combine_chunks()))
    place = np.zeros(len(leaves), np.int64)
    of = truth.column("query_id").to_numpy()
    for i, query in zip(ids, vecs, strict=True):
        rank = np.zeros(tree.leaves, np.int64)
        rank[tree.best_bins(query, tree.leaves, rank, 0)] = np.arange(1, tree.leaves + 1)
        place[of == i] = rank[leaves[of == i]]
    place.sort()
    return int(place[int(np.ceil(settings.recall * len(place))) - 1])


def in_blocks(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows of a leaf, in lists of about ``BLOCK``. A list is filled by a hash of its rows."""
    sizes = rows.groupBy("leaf").agg(F.count("*").alias("_n"))
    chunk = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.ceil(F.col("_n") / BLOCK))
    return (
        rows.join(sizes, "leaf")
        .withColumn("chunk", chunk)
        .groupBy("leaf", "chunk")
        .agg(F.collect_list(F.struct(*columns)).alias("rows"))
    )


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    settings: Settings = Settings(),  # noqa: B008
) -> DataFrame:
    """The ``k`` nearest found of all other rows for each query row of ``vectors`` (``vec_id``,
    ``embedding``): ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``, the inner product in
    double precision. Ties go to the smaller ``vec_id``; a query's own id is no candidate.
    Without queries or candidates the result is empty.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = materialise(sound_vectors(vectors))
    queries = rows.where(is_query)
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    drawn = lambda n: share * total < min(n, settings.sample_share * total)
    sample = rows.where(drawn(settings.sample_rows)).orderBy("vec_id").toArrow()
    if not sample.num_rows:
        sample = rows.limit(1).toArrow()
    tree = fit_tree(matrix(sample.column("vec").combine_chunks()), settings)
    visits = calibrate(tree, rows, queries, k, settings)
    held = spark.sparkContext.broadcast(tree)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = held.value.assign(matrix(batch.column("vec")))
            yield batch.append_column("leaf", pa.array(leaf))

    # One place more than k, since a query's own id takes none.
    alike = Window.partitionBy("vec").orderBy("vec_id")
    useful = rows.withColumn("_r", F.row_number().over(alike)).where(F.col("_r") <= k + 1).drop("_r")
    indexed = materialise(useful.mapInArrow(index, "vec_id long, vec array<double>, leaf long"))
    # An id on several vectors counts in one leaf, so that leaves hold no fewer ids than this says.
    sizes = np.zeros(tree.leaves, np.int64)
    for r in indexed.groupBy("vec_id").agg(F.min("leaf").alias("leaf")).groupBy("leaf").count().collect():
        sizes[r["leaf"]] = r["count"]
    seen = indexed.where(drawn(settings.bound_rows)).dropDuplicates(["vec_id"]).toArrow()
    bounds = spark.sparkContext.broadcast(
        (seen.column("vec_id").to_numpy(), matrix(seen.column("vec").combine_chunks()), seen.column("leaf").to_numpy())
    )

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vecs = batch.column("vec_id").to_numpy(), matrix(batch.column("vec"))
            for a in range(0, len(ids), 64):
                part = range(a, min(a + 64, len(ids)))
                bins = [held.value.best_bins(vecs[i], visits, sizes, k + 1) for i in part]
                at = np.repeat(np.array(part), [len(x) for x in bins])
                least = floors(ids[a : a + 64], vecs[a : a + 64], bins, bounds.value, k)
                out = batch.take(pa.array(at))
                out = out.append_column("leaf", pa.array([x for b in bins for x in b], pa.int64()))
                yield out.append_column("least", pa.array(least[at - a]))

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two in zip(batch.column("rows"), batch.column("queries"), strict=True):
                r, q = one.values, two.values
                ids, query_ids = r.field("vec_id").to_numpy(), q.field("vec_id").to_numpy()
                i, j, score = best_pairs(
                    query_ids,
                    matrix(q.field("vec")),
                    ids,
                    matrix(r.field("vec")),
                    k,
                    q.field("least").to_numpy(),
                )
                yield pa.record_batch(
                    [pa.array(query_ids[i]), pa.array(ids[j]), pa.array(score)],
                    ["query_id", "vec_id", "score"],
                )

    blocks = in_blocks(indexed, "vec_id", "vec")
    asked = in_blocks(
        queries.mapInArrow(visit, "vec_id long, vec array<double>, leaf long, least double"),
        "vec_id",
        "vec",
        "least",
    )
    pairs = blocks.select("leaf", "rows").join(
        asked.select("leaf", F.col("rows").alias("queries")), "leaf"
    )
    result = "query_id long, vec_id long, score double"
    found = (
        pairs.select("rows", "queries")
        .mapInArrow(product, result)
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    return nearest(found, k).select("query_id", "rank", "vec_id", "score")
