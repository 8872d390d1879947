"""Vector codes: each part of a vector is replaced by the number of its nearest codebook entry.

Vectors become integers and are cut into parts; equal parts of a position are one weighted row of a
table that is written once, in lexicographic order. A round of the codebooks is one pass over
that table. A task walks the trie of its parts depth first: a node's distances to all entries so far
are its parent's plus one dimension, so parts that begin alike share them; a leaf takes its
nearest entry and adds its weighted components there. What a task sends on are sums per entry,
so the driver sees codebooks, whose size does not depend on the table. All arithmetic is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from dosecast.llm.common import materialise, ship

ROWS = 4096  # tails whose distances are worked out at once
MOST = (1 << 63) - 1


@dataclass(frozen=True)
class Coding:
    """Components are multiples of one in ``scale``; vectors have ``parts`` parts, each with a
    codebook of ``entries``, moved ``rounds`` times."""

    scale: int = 4096
    parts: int = 8
    entries: int = 16
    rounds: int = 6


@dataclass(frozen=True)
class Codebooks:
    """``books`` by part, entry and position. ``wide`` is set where products may pass 64 bits,
    which are then worked out as Python's integers."""

    books: np.ndarray
    width: int
    wide: bool

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.books.flat).encode()).hexdigest()


def trie_distances(parts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``parts``, which stand in lexicographic order, to all
    entries of ``book``."""
    out = np.zeros((len(parts), len(book)), book.dtype)
    width = parts.shape[1]
    stack = [(0, len(parts), 0, np.zeros(len(book), book.dtype))] if len(parts) and width else []
    while stack:
        start, stop, depth, so_far = stack.pop()
        values = parts[start:stop, depth]
        edges = np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1, stop - start] + start
        first, last = edges[:-1], edges[1:]
        gap = parts[first, depth][:, None] - book[:, depth]
        child = so_far + gap * gap
        if depth + 1 == width:
            out[start:stop] = np.repeat(child, last - first, axis=0)
            continue
        # Children of one row: the rest of their dimensions at once.
        alone = np.flatnonzero(last - first == 1)
        for a in range(0, len(alone), ROWS):
            rows = first[alone[a : a + ROWS]]
            tail = parts[rows, None, depth + 1 :] - book[None, :, depth + 1 :]
            out[rows] = child[alone[a : a + ROWS]] + (tail * tail).sum(axis=2)
        for k in np.flatnonzero(last - first > 1)[::-1]:
            stack.append((first[k], last[k], depth + 1, child[k]))
    return out


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row, ties to the lower one, and its squared distance."""
    order = np.lexsort(parts.T[::-1])
    far = trie_distances(parts[order], book)
    best = far.argmin(axis=1) if len(far) else np.zeros(0, np.int64)
    code, error = np.empty(len(parts), np.int64), np.empty(len(parts), book.dtype)
    code[order], error[order] = best, far[np.arange(len(far)), best]
    return code, error


def matrix(column: pa.Array, wide: bool) -> np.ndarray:
    """A list column of equal lengths as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = flat.reshape(len(column), -1)
    return rows.astype(object) if wide else rows


def usable(vector: Column) -> Column:
    """Not null, not empty, and of finite components only."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, fine)


def integer_vectors(vectors: DataFrame, how: Coding) -> tuple[DataFrame, int]:
    """``vec_id``, ``label``, ``q``, the integer vector, and the width of a part.

    Rows without a usable vector are left out, and so are those that have not the commonest
    length (of equally common ones the smallest). A length that the parts do not divide is
    filled up with zeros."""
    whole = F.transform("v", lambda x: F.floor(x * how.scale).cast("long"))
    rows = (
        vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
        .where(usable(F.col("v")))
        .select("vec_id", "label", whole.alias("q"))
    )
    common = (
        rows.groupBy(F.size("q").alias("size"))
        .count()
        .orderBy(F.desc("count"), "size")
        .limit(1)
        .collect()
    )
    size = common[0]["size"] if common else 0
    width = -(-size // how.parts)
    fill = F.array_repeat(F.lit(0).cast("long"), how.parts * width - size)
    return rows.where(F.size("q") == size).withColumn("q", F.concat("q", fill)), width


def distinct_parts(rows: DataFrame, width: int, how: Coding) -> DataFrame:
    """``pos``, ``part`` and ``n``, how often the part is at the position."""
    cut = F.array(
        *[
            F.struct(F.lit(k).alias("pos"), F.slice("q", k * width + 1, width).alias("part"))
            for k in range(how.parts)
        ]
    )
    return (
        rows.select(F.explode(cut).alias("_c"))
        .groupBy("_c.pos", "_c.part")
        .agg(F.count("*").alias("n"))
        .sortWithinPartitions("pos", "part")
    )


def moved(parts: DataFrame, books: Codebooks) -> np.ndarray:
    """The codebooks after a round over the distinct ``parts``."""
    held = parts.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        kind = books.books.dtype
        sums = np.zeros(books.books.shape, kind)
        count = np.zeros(books.books.shape[:2], kind)
        for batch in batches:
            pos, n = batch.column("pos").to_numpy(), batch.column("n").to_numpy().astype(kind)
            rows = matrix(batch.column("part"), books.wide)
            for k in np.unique(pos):
                at = np.flatnonzero(pos == k)
                code, _ = nearest(rows[at], books.books[k])
                np.add.at(count[k], code, n[at])
                np.add.at(sums[k], code, rows[at] * n[at][:, None])
        pos, entry = (x.ravel() for x in np.indices(count.shape))
        listed = [[str(int(x)) for x in row] for row in sums.reshape(len(pos), -1)]
        yield pa.record_batch(
            [
                pa.array(pos, pa.int32()),
                pa.array(entry, pa.int32()),
                pa.array([int(x) for x in count.ravel()], pa.int64()),
                pa.array(listed, pa.list_(pa.string())),
            ],
            ["pos", "entry", "n", "sums"],
        )

    found = (
        parts.mapInArrow(run, "pos int, entry int, n long, sums array<string>")
        .where("n > 0")
        .select("pos", "entry", "n", F.posexplode("sums").alias("at", "sum"))
        .groupBy("pos", "entry", "at")
        .agg(F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"), F.sum("n").alias("n"))
        .collect()
    )
    out = books.books.copy()
    for r in found:
        out[r["pos"], r["entry"], r["at"]] = int(r["sum"]) // r["n"]
    held.unpersist()
    return out


def fit(rows: DataFrame, width: int, how: Coding) -> Codebooks | None:
    """Codebooks of all ``rows``, begun with those of the smallest ids; None without a row."""
    first = [r["q"] for r in rows.orderBy(F.asc_nulls_last("vec_id"), "q").limit(how.entries).collect()]
    if not first:
        return None
    span = F.array_max(F.transform("q", lambda x: F.abs(x.cast("decimal(20,0)"))))
    most, n = rows.agg(F.max(span), F.count("*")).first()
    wide = int(most) ** 2 * 4 * width >= MOST or int(most) * n >= MOST
    books = np.array(first, np.int64).reshape(len(first), how.parts, width).transpose(1, 0, 2).copy()
    books = Codebooks(books.astype(object) if wide else books, width, wide)
    parts = materialise(distinct_parts(rows, width, how))
    for _ in range(how.rounds):
        books = Codebooks(moved(parts, books), width, wide)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``code`` and ``error`` of each integer vector."""
    held = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        for batch in batches:
            q = matrix(batch.column("q"), books.wide)
            parts, error = [], np.zeros(len(q), books.books.dtype)
            for k, book in enumerate(books.books):
                code, far = nearest(q[:, k * books.width : (k + 1) * books.width], book)
                parts.append(code)
                error = error + far
            text = [bytes(row).hex() for row in np.array(parts, np.uint8).T]
            most = [min(int(x), MOST) for x in error]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(text), pa.array(most, pa.int64())]
            yield pa.record_batch(columns, ["vec_id", "label", "code", "error"])

    fields = [rows.schema["vec_id"], rows.schema["label"]]
    fields += [StructField("code", StringType()), StructField("error", LongType())]
    return rows.mapInArrow(run, StructType(fields))


def vector_codes(vectors: DataFrame, how: Coding = Coding()) -> DataFrame:  # noqa: B008
    """``vec_id``, ``label``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of
    each vector in ``embedding``; other columns are not read.

    Vectors that are null or empty or hold null or non-finite components are left out, and so are
    those of another length than the commonest. Rows of equal ids each have a row; among them
    the smaller vector comes first where the codebooks begin, null ids last. Fewer rows than
    ``entries`` make smaller codebooks. Errors beyond 64 bits read as the largest long. An empty
    table gives no row.
    """
    ship(vectors.sparkSession)
    rows, width = integer_vectors(vectors, how)
    rows = materialise(rows)
    books = fit(rows, width, how)
    if books is None:
        none = "string AS code", "bigint AS error", "bigint AS label_error", "string AS codebooks_sha256"
        return rows.select("vec_id", "label", *[F.expr(f"CAST(NULL AS {x.replace(' AS', ') AS')}") for x in none])
    coded = materialise(encode(rows, books))
    summed = coded.groupBy(F.col("label").alias("_label")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum")
    )
    total = F.least("_sum", F.lit(MOST).cast("decimal(38,0)")).cast("long")
    return coded.join(materialise(summed), F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "label", "code", "error", total.alias("label_error"), F.lit(books.sha256()).alias("codebooks_sha256")
    )
