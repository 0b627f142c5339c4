"""Ranked lexical search: the best documents for each item of a query set, by dense blocked products.

Items are taken in blocks of some ``block_bytes`` of terms. For a block, every text is read once, and its
documents are stored as the block's terms that they hold, with how often. Document frequencies follow from
these rows. Tasks then lay tiles of documents out as float64 matrices of term impacts, over the vocabulary
of a tile of items only, and multiply them by the items' weights with BLAS. A vocabulary tile is cut
before the sum of its largest products reaches 2**53, so that every partial sum is a whole number a
double holds; tiles are added up in 64-bit integers. After each product a task keeps the ``k`` best documents
of every item, equal scores by the smaller identifier, so what a task gives off does not depend on where
documents lie. Ranks are those of the tasks' best.

Weights, lengths and impacts are those of a saturating term frequency: see :func:`term_weight`,
:func:`length_marks` and :func:`impacts`.

Defined cases: a NULL or empty text has no terms, is not counted and never found; an item without terms
has no rows; rows of the items are items of their own, also with a NULL or repeated identifier; a document
without an identifier comes after all others of its score, rows with the same identifier are documents
of their own; without documents or items the result is empty; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.scratch import Scratch
from tiffin.llm.texts import LOWER, UPPER

BEST = 50
BLOCK_BYTES = 8 << 20
ITEM_TILE = 64
TERM_TILE = 4096
DOCUMENT_TILE = 1024
CALL_BYTES = 8 << 20

# Bytes of terms (digits, letters, all of other scripts); every other byte parts terms.
_TERM_BYTES = b"0123456789" + UPPER.encode() + LOWER.encode() + bytes(range(128, 256))
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_IMPACT_LIMIT = 10**6
_EXACT = 2**53


def term_weight(documents: int, with_term: int) -> int:
    """How much a term counts: the rarer, the more."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * with_term + 1)))


def length_marks(lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """50 and 50 times each length by the mean length, rounded down; without products beyond n times ``terms``."""
    whole, rest = divmod(50 * documents, terms)
    return 50 + lengths * whole + lengths * rest // terms


def impacts(frequencies: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Below a million, whatever the frequency."""
    return 1_000_000_000 * frequencies // (1000 * frequencies + 20 * marks)


def _byte_table() -> np.ndarray:
    """Lower case for bytes of terms, 0 for others."""
    table = np.zeros(256, np.uint8)
    for byte in _TERM_BYTES:
        table[byte] = byte
    for upper, lower in zip(UPPER.encode(), LOWER.encode(), strict=True):
        table[upper] = lower
    return table


def count_terms(
    texts: pa.BinaryArray, vocabulary: pa.BinaryArray, table: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of every text, and ``(text, term, times)`` of those in the vocabulary, sorted by text."""
    edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    codes = table[np.frombuffer(data, np.uint8)[edges[0] : edges[-1]]] if data else np.empty(0, np.uint8)
    edges = (edges - edges[0]).astype(np.int64)
    # A text ends a term even where the next one goes on without a gap.
    padded = np.insert(codes, edges[1:], 0)
    in_term = np.concatenate(([False], padded != 0, [False]))
    steps = np.flatnonzero(in_term[1:] != in_term[:-1])
    starts = steps[::2]
    owner = np.searchsorted(edges[1:] + np.arange(len(texts)), starts)
    lengths = np.bincount(owner, minlength=len(texts))
    if not len(steps):
        return lengths, *(np.empty(0, np.int64) for _ in range(3))
    # Terms and the gaps between them in turn, without a copy.
    buffers = [None, pa.py_buffer(steps.astype(np.int32)), pa.py_buffer(padded)]
    parts = pa.Array.from_buffers(pa.binary(), len(steps) - 1, buffers)
    found = pc.fill_null(pc.index_in(parts, value_set=vocabulary), -1).to_numpy()[::2]
    known = found >= 0
    pairs, times = np.unique(owner[known] * len(vocabulary) + found[known], return_counts=True)
    return lengths, *np.divmod(pairs, max(1, len(vocabulary))), times


def _slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with some ``most`` bytes each."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy())
    start = 0
    while start < len(sizes):
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield start, stop
        start = stop


def _counting(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = _byte_table(), vocabulary.value
        for batch in batches:
            for start, stop in _slices(batch.column(1), CALL_BYTES):
                rows = batch.slice(start, stop - start)
                lengths, owner, terms, times = count_terms(rows.column(1), known, table)
                edges = pa.array(np.searchsorted(owner, np.arange(len(lengths) + 1)), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(edges, pa.array(values, pa.int32())) for values in (terms, times)
                ]
                columns = [rows.column(0), pa.array(lengths, pa.int64()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "times"])

    return run


class ItemTile:
    """Weights of some items over their own vocabulary, cut into tiles whose partial sums are exact."""

    def __init__(self, items: list[tuple[int, list[int]]], weights: np.ndarray, term_tile: int = TERM_TILE):
        self.numbers = [number for number, _ in items]
        used = np.unique(np.concatenate([np.array(terms, np.int64) for _, terms in items]))
        used = used[weights[used] > 0]
        place = np.full(len(weights), -1, np.int64)
        place[used] = np.arange(len(used))
        matrix = np.zeros((len(items), len(used)))
        for i, (_, terms) in enumerate(items):
            at = place[np.array(terms, np.int64)]
            at = at[at >= 0]
            matrix[i, at] = weights[used[at]]
        self.place, self.tiles, start = place, [], 0
        while start < len(used):
            sums = np.cumsum(weights[used[start : start + term_tile]].astype(object) * _IMPACT_LIMIT)
            stop = start + max(1, int(np.searchsorted(sums, _EXACT)))
            self.tiles.append((start, stop, np.ascontiguousarray(matrix[:, start:stop])))
            start = stop

    def scores(self, rows: np.ndarray, terms: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        """Scores of ``n`` documents for the tile's items, from their impacts."""
        at = self.place[terms]
        total = np.zeros((len(self.numbers), n), np.int64)
        for start, stop, matrix in self.tiles:
            here = (at >= start) & (at < stop)
            tile = np.zeros((stop - start, n))
            tile[at[here] - start, rows[here]] = values[here]
            total += (matrix @ tile).astype(np.int64)
        return total


class Best:
    """The best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score = np.zeros((items, k), np.int64)
        self.unknown = np.ones((items, k), bool)
        self.doc_id = np.full((items, k), np.iinfo(np.int64).max)

    def add(self, first: int, scores: np.ndarray, doc_id: np.ndarray, unknown: np.ndarray) -> None:
        """Takes the scores of some documents for the items from ``first`` on."""
        last = slice(first, first + len(scores))
        worst, worst_id = self.score[last, -1:], self.doc_id[last, -1:]
        # What ties with the last place may take it by a smaller identifier.
        better = (scores > worst) | ((scores == worst) & (scores > 0) & (doc_id <= worst_id))
        for i in np.flatnonzero(better.any(axis=1)):
            new, item = np.flatnonzero(better[i]), first + i
            score = np.concatenate((self.score[item], scores[i, new]))
            ids = np.concatenate((self.doc_id[item], doc_id[new]))
            lost = np.concatenate((self.unknown[item], unknown[new]))
            order = np.lexsort((ids, lost, -score))[: self.k]
            self.score[item], self.doc_id[item], self.unknown[item] = score[order], ids[order], lost[order]

    def rows(self, numbers: list[int]) -> pa.RecordBatch:
        item, place = np.nonzero(self.score > 0)
        ids = pa.array(self.doc_id[item, place], pa.int64(), mask=self.unknown[item, place])
        columns = [pa.array(np.array(numbers, np.int64)[item]), ids, pa.array(self.score[item, place])]
        return pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])


def _scoring(block, documents: int, terms: int, k: int, item_tile: int, term_tile: int, document_tile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = block.value
        tiles = [
            ItemTile(items[i : i + item_tile], weights, term_tile) for i in range(0, len(items), item_tile)
        ]
        numbers = [number for number, _ in items]
        best = Best(len(numbers), k)
        for batch in batches:
            for start in range(0, batch.num_rows, document_tile):
                rows = batch.slice(start, document_tile)
                ids = rows.column(0)
                unknown = ids.is_null().to_numpy(zero_copy_only=False)
                doc_id = pc.fill_null(ids, np.iinfo(np.int64).max).to_numpy()
                marks = length_marks(rows.column(1).to_numpy(), documents, terms)
                owner = np.repeat(np.arange(len(rows)), pc.list_value_length(rows.column(2)).to_numpy())
                held = rows.column(2).flatten().to_numpy()
                values = impacts(rows.column(3).flatten().to_numpy().astype(np.int64), marks[owner])
                first = 0
                for tile in tiles:
                    best.add(first, tile.scores(owner, held, values, len(rows)), doc_id, unknown)
                    first += len(tile.numbers)
        yield best.rows(numbers)

    return run


def _items(scratch: Scratch, items: DataFrame, item: str, text: str, block_bytes: int) -> tuple[DataFrame, int]:
    """``(item, item_id, terms, block)`` with distinct terms, and the number of blocks."""
    lowered = F.translate(F.col(text), UPPER, LOWER)
    terms = F.array_distinct(F.filter(F.split(lowered, _SEPARATORS), lambda term: term != ""))
    rows = items.select(
        F.monotonically_increasing_id().alias("item"), F.col(item).alias("item_id"), terms.alias("terms")
    ).filter(F.size("terms") > 0)
    stored = scratch.store(rows, "items")
    size = stored.agg(F.sum(F.octet_length(F.array_join("terms", " ")))).first()[0] or 0
    blocks = -(-size // block_bytes)
    return stored.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(max(1, blocks)))), blocks


def ranked_documents(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", k: int = BEST, block_bytes: int = BLOCK_BYTES, item_tile: int = ITEM_TILE,
    term_tile: int = TERM_TILE, document_tile: int = DOCUMENT_TILE,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of the highest scores above 0 for each item."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical_search")
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8").alias("text"),
    )
    stored, blocks = _items(scratch, items, item, item_text, block_bytes)
    found = []
    for number in range(blocks):
        block = stored.filter(F.col("block") == number).select("item", "terms").collect()
        words = sorted({term for row in block for term in row["terms"]})
        vocabulary = pa.array([word.encode() for word in words], pa.binary())
        known = spark.sparkContext.broadcast(vocabulary)
        held = scratch.store(
            rows.mapInArrow(_counting(known), "doc_id long, n long, terms array<int>, times array<int>"),
            f"held-{number}",
        )
        documents, terms = held.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not documents:
            break
        with_term = np.zeros(len(words), np.int64)
        for term, n in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            with_term[term] = n
        weights = np.array([term_weight(documents, int(n)) for n in with_term], np.int64)
        place = {word: i for i, word in enumerate(words)}
        coded = [(row["item"], [place[term] for term in row["terms"]]) for row in block]
        # Plain values: broadcasts travel by name, and executors lack this package.
        shared = spark.sparkContext.broadcast((coded, weights))
        run = _scoring(shared, documents, terms, k, item_tile, term_tile, document_tile)
        scored = held.filter("size(terms) > 0").mapInArrow(run, "item long, doc_id long, score long")
        found.append(scored)
    if not found:
        return stored.select(
            "item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")
        ).filter("false")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = (
        reduce(DataFrame.unionAll, found)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
    )
    return ranked.join(stored.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
