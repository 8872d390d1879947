"""Read report CSV files whose header floats below a preamble.

One row of the input is one file. Each file is parsed by itself with Spark's expressions: its
header and records come out as arrays, and a file that cannot be read keeps a reason instead
of records. ``report_rows`` then turns records into rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.functions.text import WHITE_SPACE, is_blank, let

MAX_HEADER_LINES = 10

# Cell texts that stand for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# A cell is quoted (a doubled quote stands for one) or plain; a quote counts only at its start.
_QUOTED = r'"[^"]*+"(?:"[^"]*+")*+'
_CELL = rf'(?:{_QUOTED}[^,\n]*+|(?!")[^,\n]*+)'
_RECORD = rf"{_CELL}(?:,{_CELL})*+"
_NOT_BLANK = f"[^{WHITE_SPACE}]"
_NEXT_CELL = rf",({_QUOTED}[^,\n]*+|[^,\n]*+)"


def header_line(lines: Column, max_lines: int = MAX_HEADER_LINES) -> Column:
    """Position (from 0) of the first of the leading lines with several cells, none blank."""
    full = F.transform(
        F.slice(lines, 1, max_lines),
        lambda l: (F.size(F.split(l, ",")) > 1)
        & F.forall(F.split(l, ","), lambda c: ~is_blank(c)),
    )
    return F.nullif(F.array_position(full, F.lit(True)), F.lit(0)) - 1


def _unquote(cell: Column) -> Column:
    inner = F.regexp_extract(cell, rf'(?s)^"((?:[^"]++|"")*+)"(.*)$', 1)
    tail = F.regexp_extract(cell, rf'(?s)^"((?:[^"]++|"")*+)"(.*)$', 2)
    return F.when(
        cell.startswith('"'), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), tail)
    ).otherwise(cell)


def split_record(record: Column) -> Column:
    """Cells of one CSV record as an array of text."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_NEXT_CELL), F.lit(1))
    # Without quotes every comma ends a cell.
    return F.when(
        record.contains('"') | record.contains("\n"), F.transform(cells, _unquote)
    ).otherwise(F.split(record, ","))


def null_tokens_out(cells: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.transform(cells, lambda c: F.when(~c.isin(*tokens), c))


def unique_names(header: Column) -> Column:
    """Blank names become "Unnamed: i"; the second "x" becomes "x.1", the third "x.2"."""
    named = F.transform(
        header,
        lambda n, i: F.when(n == "", F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(n),
    )

    def numbered(names: Column) -> Column:
        def name(n: Column, i: Column) -> Column:
            before = F.size(F.filter(F.slice(names, 1, i), lambda m: m == n))
            return F.when(before > 0, F.concat(n, F.lit("."), before.cast("string"))).otherwise(n)

        return F.transform(names, name)

    return let(named, numbered)


def parse_text(raw: Column, max_header_lines: int = MAX_HEADER_LINES) -> Column:
    """``struct(header, records, reason)`` of a file's text.

    Each step is bound once: the text is split into lines, the part from the header on into
    records, and these into cells.
    """

    def result(rest: Column) -> Column:
        quoted = rest.contains('"')
        # Without quotes every line is a record.
        records = F.when(quoted, F.regexp_extract_all(rest, F.lit(_RECORD), F.lit(0))).otherwise(
            F.split(rest, "\n")
        )
        found = F.filter(records, lambda r: r.rlike(_NOT_BLANK))
        # An unclosed quote leaves a piece of text that no record takes up.
        unclosed = quoted & F.regexp_replace(rest, _RECORD, "").contains('"')
        return let(F.transform(found, split_record), lambda cells: checked(cells, unclosed))

    def checked(cells: Column, unclosed: Column) -> Column:
        header = F.get(cells, 0)
        longest = F.array_max(F.transform(cells, lambda r: F.size(r)))
        reason = (
            F.when(~F.is_valid_utf8(raw), "not_utf8")
            .when(header.isNull(), "no_header")
            .when(unclosed, "open_quote")
            .when(longest > F.size(header), "long_row")
        )
        return F.struct(
            unique_names(header).alias("header"),
            F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0))).alias("records"),
            reason.alias("reason"),
        )

    body = F.regexp_replace(F.regexp_replace(raw, "\r\n?", "\n"), "^\ufeff", "")
    return let(
        F.split(F.when(F.is_valid_utf8(raw), body).otherwise(""), "\n"),
        lambda lines: let(
            header_line(lines, max_header_lines),
            lambda at: let(
                F.coalesce(F.array_join(F.slice(lines, at + 1, F.size(lines)), "\n"), F.lit("")),
                result,
            ),
        ),
    )


def parse_reports(
    files: DataFrame, max_header_lines: int = MAX_HEADER_LINES, content: str = "content"
) -> DataFrame:
    """Replace ``content`` by ``header``, ``records`` (arrays of cells) and ``reason``.

    ``reason`` is null for a good file, else one of ``not_utf8``, ``no_header``,
    ``open_quote``, ``long_row``; a file with a reason has no records.
    """
    others = [c for c in files.columns if c != content]
    parsed = files.select(
        *others, parse_text(F.col(content).cast("string"), max_header_lines).alias("_parsed")
    )
    reason = F.col("_parsed.reason")
    return parsed.select(
        *others,
        F.col("_parsed.header").alias("header"),
        F.when(reason.isNull(), F.col("_parsed.records")).alias("records"),
        reason.alias("reason"),
    )


def report_rejects(parsed: DataFrame) -> DataFrame:
    """Files that could not be read, with the reason."""
    return parsed.where(F.col("reason").isNotNull()).drop("header", "records")


def report_rows(parsed: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """One row per record of the good files: ``row_no`` from 1 and ``cells`` in header order.

    A short record has fewer cells; reading past its end gives null.
    """
    others = [c for c in parsed.columns if c not in ("records", "reason")]
    # The outer form keeps Spark from testing the array's size ahead of the explode, which
    # would parse each file a second time.
    return (
        parsed.select(*others, F.posexplode_outer("records").alias("_at", "_cells"))
        .where(F.col("_at").isNotNull())
        .select(
            *others,
            (F.col("_at") + 1).alias("row_no"),
            null_tokens_out(F.col("_cells"), tokens).alias("cells"),
        )
    )


def cell(name: str, header: str = "header", cells: str = "cells") -> Column:
    """The cell under a header name; null where the file has no such column."""
    at = F.nullif(F.array_position(header, F.lit(name)), F.lit(0))
    return F.get(F.col(cells), (at - 1).cast("int"))
