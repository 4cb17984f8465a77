"""Token counts by field or section, attributed through offsets (operator 1).

A document is encoded once, as a whole. Its tokens' spans are joined as intervals with the spans of
its fields or sections. A token that crosses a boundary belongs to the section that holds most of its
bytes, to the earlier one at a tie; tokens that lie in no section are counted under the name null.
Counts so add up to the document's. With ``rule="split"`` a boundary-crossing token is shared out by
bytes instead, and counts are fractions that add up.

Defined results: a null or empty text has one empty section and no tokens; empty sections are
returned with no tokens; repeated rows are counted per row; an empty table gives no rows; columns
other than the key are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.llm.run_table import ragged
from citelake.llm.token_ids import encode_column, encoder

SECTION = "array<struct<name:string,start:bigint,end:bigint>>"


def line_sections(text: Column) -> Column:
    """The lines of a text as sections ``line 0``, ``line 1``, ...; a line end belongs to its line.

    Only the lines' lengths are listed; where they begin is added up where they are used.
    """
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.transform(lines, lambda x: F.length(x).cast("bigint") + 1)


def head_and_body(text: Column) -> Column:
    """Two sections: the first line with its end, and the rest."""
    whole = F.length(F.coalesce(text, F.lit(""))).cast("bigint")
    at = F.locate("\n", F.coalesce(text, F.lit(""))).cast("bigint")
    cut = F.when(at > 0, at).otherwise(whole)
    return F.array(
        F.struct(F.lit("head").alias("name"), F.lit(0).cast("bigint").alias("start"), cut.alias("end")),
        F.struct(F.lit("body").alias("name"), cut.alias("start"), whole.alias("end")),
    ).cast(SECTION)


def joined_fields(fields: dict[str, Column], between: str = "\n") -> tuple[Column, Column]:
    """One text from several columns, and the sections that lead back to them."""
    texts = {name: F.coalesce(column.cast("string"), F.lit("")) for name, column in fields.items()}
    at, sections = F.lit(0).cast("bigint"), []
    for name, column in texts.items():
        end = at + F.length(column)
        sections.append(F.struct(F.lit(name).alias("name"), at.alias("start"), end.alias("end")))
        at = end + len(between)
    return F.concat_ws(between, *texts.values()), F.array(*sections).cast(SECTION)


def with_sections(documents: DataFrame, spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Attach a table of (key, name, start, end) as the column ``sections``; offsets are characters."""
    listed = spans.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "name"))).alias("_spans")
    )
    named = F.transform("_spans", lambda x: F.struct(x["name"].alias("name"), x["start"].alias("start"), x["end"].alias("end")))
    return documents.join(listed, key, "left").withColumn("sections", named.cast(SECTION)).drop("_spans")


def attribute(
    token_start: np.ndarray, token_end: np.ndarray, start: np.ndarray, end: np.ndarray, split: bool
) -> tuple[np.ndarray, float]:
    """Tokens of each section of one text and tokens in none; sections are in order and do not overlap.

    The interval join: a token meets the sections from the first that ends behind its start to the
    last that starts before its end.
    """
    counts, outside = np.zeros(len(start)), 0.0
    if not len(token_start):
        return counts, outside
    low = np.searchsorted(end, token_start, side="right")
    high = np.maximum(np.searchsorted(start, token_end, side="left"), low)
    met = high - low
    token = np.repeat(np.arange(len(token_start)), met)
    section = ragged(low, met)
    held = np.minimum(token_end[token], end[section]) - np.maximum(token_start[token], start[section])
    held = np.maximum(held, 0)
    size = token_end - token_start
    if split:
        np.add.at(counts, section, held / size[token])
        return counts, float(len(size) - counts.sum())
    order = np.lexsort((section, -held, token))
    first = order[np.flatnonzero(np.diff(token[order], prepend=-1))] if len(order) else order
    first = first[held[first] > 0]
    np.add.at(counts, section[first], 1)
    return counts, float(len(size) - len(first))


class Sections:
    """The names of a text's sections and, as rows, their first and last character."""

    def __init__(self, column: pa.Array, lines: bool) -> None:
        self.lines, flat = lines, column.flatten()
        self.places = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0))])
        if lines:
            self.sizes = np.asarray(flat, dtype=np.int64)
            return
        self.names = flat.field("name").to_pylist()
        spans = [np.asarray(flat.field(x).fill_null(0), dtype=np.int64) for x in ("start", "end")]
        self.spans = np.column_stack(spans)

    def of(self, i: int) -> tuple[list[str], np.ndarray]:
        part = slice(int(self.places[i]), int(self.places[i + 1]))
        if not self.lines:
            return self.names[part], self.spans[part]
        ends = np.cumsum(self.sizes[part])
        names = [f"line {n}" for n in range(len(ends))]
        return names, np.column_stack([ends - self.sizes[part], ends])


def count_by_section(
    documents: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    sections: Column | None = None,
    rule: str = "most",
) -> DataFrame:
    """``key``, ``section``, ``n_tokens``, ``n_bytes``, ``doc_tokens``; one row for each section, and one
    whose section is null for the tokens in none, if there are any.

    ``sections`` gives names with character offsets, in order and without overlap, or the lengths of
    lines that follow one another (``line_sections``); by default the first line and the rest.
    """
    if rule not in ("most", "split"):
        raise ValueError(f"unknown rule {rule}")
    spans = head_and_body(F.col(text)) if sections is None else sections
    rows = documents.select(F.col(key), F.col(text).alias("_text"), spans.alias("_spans"))
    lines = not isinstance(rows.schema["_spans"].dataType.elementType, T.StructType)
    kind = T.DoubleType() if rule == "split" else T.LongType()
    result = T.StructType(
        [
            documents.schema[key],
            T.StructField("section", T.StringType()),
            T.StructField("n_tokens", kind),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
        ]
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer, ranks, pattern)
        for batch in batches:
            keys, listed = batch.column(0), Sections(batch.column(2), lines)
            for first, last, body, places, ids, counts in encode_column(tool, batch.column(1)):
                token_ends = np.cumsum(tool.widths[ids])
                token_starts = token_ends - tool.widths[ids]
                behind = np.cumsum(counts)
                # Characters begin at bytes that are no continuation.
                begins = np.append(np.flatnonzero((body & 0xC0) != 0x80), len(body))
                owner, names, n, sizes, totals = [], [], [], [], []
                for i in range(last - first):
                    found, char = listed.of(first + i)
                    base = int(np.searchsorted(begins, places[i]))
                    top = int(np.searchsorted(begins, places[i + 1]))
                    spot = begins[np.clip(char + base, base, top)]
                    part = slice(behind[i] - counts[i], behind[i])
                    got, outside = attribute(
                        token_starts[part], token_ends[part], spot[:, 0], spot[:, 1], rule == "split"
                    )
                    names += found
                    n += got.tolist()
                    sizes += (spot[:, 1] - spot[:, 0]).tolist()
                    more = len(found)
                    if outside > 1e-9:
                        names.append(None)
                        n.append(outside)
                        sizes.append(int(places[i + 1] - places[i] - (spot[:, 1] - spot[:, 0]).sum()))
                        more += 1
                    owner += [first + i] * more
                    totals += [int(counts[i])] * more
                values = n if rule == "split" else [int(x) for x in n]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(owner, pa.int64())),
                        pa.array(names, pa.string()),
                        pa.array(values, pa.float64() if rule == "split" else pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(totals, pa.int64()),
                    ],
                    names=[key, "section", "n_tokens", "n_bytes", "doc_tokens"],
                )

    return rows.mapInArrow(count, result)
