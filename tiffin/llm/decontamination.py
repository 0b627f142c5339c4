"""Benchmark decontamination: finds windows of test items in documents by Wu-Manber search.

Words are runs of letters and digits after A-Z became a-z. A window is ten consecutive words of an
item, or all words of a shorter item. Document and windows are written with one blank before, between
and after their words, so that an occurrence of the text is an occurrence of the words.

Patterns travel to the executors in groups of at most ``group_bytes``, one group after the other, so no
size of the benchmark is too large for a task; with one group, the usual case, documents are read once
and nothing is shuffled. Patterns of much different length are searched apart, as the shortest one
bounds how far a search can skip.

Defined cases: a NULL or wordless document has no words and no hits; a NULL or wordless item has no
window; items with equal windows are all named; a repeated item counts once; words of an item without an
identifier are hit like any, but it is not among the items that are counted and named; identifiers of documents may be NULL or repeated; empty tables of either kind work; other columns are
not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.scratch import Scratch
from tiffin.llm.texts import LOWER_TABLE, binary_rows
from tiffin.llm.wu_manber import WuManber

WINDOW = 10
GROUP_BYTES = 8 << 20

# ASCII characters that separate words, once A-Z are a-z: \x00-\x2F \x3A-\x60 \x7B-\x7F.
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TO_WORDS = bytearray(LOWER_TABLE)
for _code in _SEPARATORS:
    if not 0x41 <= _code <= 0x5A:
        _TO_WORDS[_code] = 0x20
_TO_WORDS = bytes(_TO_WORDS)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def _line(words: list[bytes]) -> bytes:
    return b" " + b" ".join(words) + b" " if words else b""


def _windows(width: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for item, text in zip(
                batch.column(0).to_pylist(), binary_rows(batch.column(1)), strict=True
            ):
                words = words_of(text)
                for i in range(max(1, len(words) - width + 1) if words else 0):
                    ids.append(item)
                    found.append(_line(words[i : i + width]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(found, pa.binary())], names=["item", "pattern"]
            )

    return windows


class Searcher:
    """Patterns with the items they come from, in one search for each class of length."""

    def __init__(self, patterns: list[tuple[bytes, list[str]]]):
        classes: dict[int, list[tuple[bytes, list[str]]]] = defaultdict(list)
        for pattern, items in patterns:
            classes[len(pattern).bit_length()].append((pattern, items))
        self._searches = [
            (WuManber([p for p, _ in found]), [items for _, items in found])
            for found in classes.values()
        ]

    def spans(self, lines: list[bytes]) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
        """For lines with occurrences: their byte ranges, and the items these belong to.

        Lines are searched as one text; they are parted by a character that no pattern has.
        """
        text = b"\n".join(lines)
        starts = np.cumsum([0] + [len(line) + 1 for line in lines[:-1]])
        found: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        for search, owners in self._searches:
            hits = search.occurrences(text)
            of = np.searchsorted(starts, [at for at, _ in hits], side="right") - 1
            for line, (at, i) in zip(of.tolist(), hits, strict=True):
                spans, items = found.setdefault(line, ([], set()))
                at -= int(starts[line])
                spans.append((at, at + len(search.patterns[i])))
                items.update(owners[i])
        return found


def _word_spans(line: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte ranges as disjoint ranges of word numbers, in order."""
    blanks = np.cumsum(np.frombuffer(line, np.uint8) == 32)
    out: list[list[int]] = []
    for start, end in sorted(spans):
        first, last = int(blanks[start]) - 1, int(blanks[end - 1]) - 2
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


_CALL_BYTES = 2 << 20
_NAMES = ["row", "doc_id", "n_words", "items", "first", "last"]
_FOUND = "row long, doc_id {id}, n_words long, items array<string>, first array<long>, last array<long>"


def _searching(broadcast):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(broadcast.value)
        for batch in batches:
            start, lines, n_words, size = 0, [], [], 0
            for text in binary_rows(batch.column(2)):
                words = words_of(text)
                lines.append(_line(words))
                n_words.append(len(words))
                size += len(lines[-1])
                if size > _CALL_BYTES:
                    yield _found(searcher, batch, start, lines, n_words)
                    start, lines, n_words, size = start + len(lines), [], [], 0
            if lines:
                yield _found(searcher, batch, start, lines, n_words)

    return search


def _found(
    searcher: Searcher, batch: pa.RecordBatch, start: int, lines: list[bytes], n_words: list[int]
) -> pa.RecordBatch:
    spans = searcher.spans(lines)
    items, first, last = ([[] for _ in lines] for _ in range(3))
    for i, (where, of) in spans.items():
        ranges = _word_spans(lines[i], where)
        items[i], first[i], last[i] = sorted(of), [a for a, _ in ranges], [b for _, b in ranges]
    longs = pa.list_(pa.int64())
    rows = batch.slice(start, len(lines))
    columns = [
        rows.column(0),
        rows.column(1),
        pa.array(n_words, pa.int64()),
        pa.array(items, pa.list_(pa.string())),
        pa.array(first, longs),
        pa.array(last, longs),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def _patterns(
    scratch: Scratch, benchmark: DataFrame, item: str, text: str, width: int, group_bytes: int
) -> tuple[DataFrame, int]:
    """``(item, pattern, part)``, and the number of parts, each of some ``group_bytes`` at most."""
    items = benchmark.select(
        F.col(item).cast("string").alias("item"), F.encode(F.col(text), "UTF-8").alias("text")
    ).dropna(subset=["text"])
    windows = items.mapInArrow(_windows(width), "item string, pattern binary").distinct()
    windows = scratch.store(windows, "windows")
    name_bytes = F.coalesce(F.octet_length("item"), F.lit(0))
    size = windows.agg(F.sum(F.octet_length("pattern") + name_bytes)).first()[0] or 0
    parts = max(1, -(-size // group_bytes))
    return windows.withColumn("part", F.pmod(F.xxhash64("pattern"), F.lit(parts))), parts


def _owners(part: DataFrame) -> list[tuple[bytes, list[str]]]:
    owners: dict[bytes, list[str]] = defaultdict(list)
    for row in part.collect():
        owners[bytes(row["pattern"])] += [] if row["item"] is None else [row["item"]]
    return sorted((pattern, sorted(items)) for pattern, items in owners.items())


def _covered(first: Column, last: Column) -> Column:
    """How many word numbers lie in the ranges, which may overlap."""
    ranges = F.array_sort(F.arrays_zip(first.alias("first"), last.alias("last")))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("upto"))

    def add(so_far: Column, span: Column) -> Column:
        new = F.greatest(F.lit(0), span["last"] - F.greatest(span["first"], so_far["upto"] + 1) + 1)
        upto = F.greatest(so_far["upto"], span["last"])
        return F.struct((so_far["n"] + new).alias("n"), upto.alias("upto"))

    return F.aggregate(ranges, none, add, lambda so_far: so_far["n"])


def contaminated_spans(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", width: int = WINDOW,
    group_bytes: int = GROUP_BYTES,
) -> tuple[DataFrame, int]:
    """What each group of patterns found in each document, and the number of groups.

    ``(row, doc_id, n_words, items, first, last)``: items with occurring windows, and the disjoint ranges
    of word numbers that occurrences cover. One row per document and group.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontamination")
    filled = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), filled.alias("text")
    )
    schema = _FOUND.format(id=rows.schema["doc_id"].dataType.simpleString())
    patterns, parts = _patterns(scratch, benchmark, item, item_text, width, group_bytes)
    if parts == 1:
        group = spark.sparkContext.broadcast(_owners(patterns))
        return rows.mapInArrow(_searching(group), schema), 1
    rows = scratch.store(rows, "rows")
    found = []
    for part in range(parts):
        group = spark.sparkContext.broadcast(_owners(patterns.filter(F.col("part") == part)))
        found.append(scratch.store(rows.mapInArrow(_searching(group), schema), f"found-{part}"))
        group.unpersist()
    return reduce(DataFrame.unionAll, found), parts


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``, one row per row of ``docs``."""
    found, groups = contaminated_spans(docs, benchmark, **options)
    if groups > 1:
        found = found.groupBy("row", "doc_id", "n_words").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.flatten(F.collect_list("first")).alias("first"),
            F.flatten(F.collect_list("last")).alias("last"),
        )
    return found.select(
        "doc_id",
        "n_words",
        _covered(F.col("first"), F.col("last")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("first") > 0).alias("contaminated"),
    )
