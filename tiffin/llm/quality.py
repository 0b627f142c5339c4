"""Quality classifier: gradient-boosted trees over document statistics.

Statistics of whole texts are computed once, in Arrow batches, and stored. Trees are grown on the driver
from histograms of a bounded sample of labelled rows (``sample_rows``, those with the smallest hash of
their identifier), then flattened into arrays: every tree is complete, node ``i`` has the children
``2i + 1`` and ``2i + 2``, and a batch of documents goes down all trees with one array step per level.
Scores are computed where the statistics are, by executors.

Rows whose crc32(identifier) mod 3 is 1 are held out: their labels are never read by training. Labels,
language, source and identifier are no inputs of a score.

Defined cases: a NULL text counts as empty, and an empty text is scored like any other; a NULL
identifier is not held out and has no label; a label of NULL is no label, and of several labels for an
identifier the largest counts; without labels of both kinds the score is the share of label 1 among
those there are, or 0.5; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.scratch import Scratch
from tiffin.llm.texts import binary_rows

SAMPLE_ROWS = 20_000
HELD_OUT = 1
FOLDS = 3

_MARKS = b"!*$%&#|.,"
STATISTICS = (
    "log_bytes", "log_words", "upper", "lower", "digit", "blank", "high", "other",
    *(f"mark_{i}" for i in range(len(_MARKS))), "marks_per_word", "word_bytes", "distinct_words",
    "top_word", "repeated_next", "lines", "line_bytes", "longest_line", "distinct_lines",
    "distinct_bytes", "byte_entropy", "top_byte",
)

_CLASS = np.full(256, 5)
_CLASS[ord("A") : ord("Z") + 1] = 0
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 3
_CLASS[0x80:] = 4


def statistics(text: bytes) -> list[float]:
    """The values of ``STATISTICS`` for one text; 0 for shares of nothing."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = max(1, len(text))
    classes = np.bincount(_CLASS, weights=counts, minlength=6) / n
    words = text.split()
    n_words = max(1, len(words))
    by_word = Counter(words)
    lines = [line for line in text.split(b"\n") if line]
    n_lines = max(1, len(lines))
    marks = counts[list(_MARKS)]
    shares = counts[counts > 0] / n
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        *classes,
        *(marks / n),
        marks.sum() / n_words,
        (len(text) - counts[32] - counts[10]) / n_words,
        len(by_word) / n_words,
        max(by_word.values(), default=0) / n_words,
        sum(map(operator.eq, words, words[1:])) / n_words,
        np.log1p(len(lines)),
        np.log1p(len(text) / n_lines),
        max(map(len, lines), default=0) / n,
        len(set(lines)) / n_lines,
        len(shares),
        float(-(shares * np.log(shares)).sum()),
        counts.max() / n,
    ]


@dataclass(frozen=True)
class Forest:
    """Complete trees of equal depth as arrays of ``(trees, nodes)``.

    A row goes right where its value is above the threshold. Inner nodes that were not split have an
    infinite threshold, which sends all rows left.
    """

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))
        if not len(trees):
            return np.full(len(x), self.base)
        rows = np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(trees)), np.int64)
        for _ in range(self.depth):
            right = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        return self.base + self.leaf[trees, node - (2**self.depth - 1)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
    bins: int = 64, smoothing: float = 2.0, least: float = 1.0,
) -> Forest:
    """Trees for the logistic loss; splits come from histograms of gradients over quantile bins."""
    share = y.mean() if len(y) else 0.5
    if not 0 < share < 1:
        share = min(max(share, 1e-6), 1 - 1e-6)
        trees = 0
    base = float(np.log(share / (1 - share)))
    edges = [_edges(x[:, j], bins) for j in range(x.shape[1])]
    codes = [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]
    inner = 2**depth - 1
    forest = Forest(
        base, depth, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf),
        np.zeros((trees, inner + 1)),
    )
    margin = np.full(len(y), base)
    for tree in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.zeros(width)
            at = np.full(width, -1)
            cut = np.zeros(width, np.int64)
            for j, edge in enumerate(edges):
                if not len(edge):
                    continue
                size = len(edge) + 1
                place = (node - first) * size + codes[j]
                g = np.bincount(place, gradient, width * size).reshape(width, size).cumsum(1)
                h = np.bincount(place, weight, width * size).reshape(width, size).cumsum(1)
                gl, hl, gr, hr = g[:, :-1], h[:, :-1], g[:, -1:] - g[:, :-1], h[:, -1:] - h[:, :-1]
                gain = gl**2 / (hl + smoothing) + gr**2 / (hr + smoothing)
                gain -= g[:, -1:] ** 2 / (h[:, -1:] + smoothing)
                gain[(hl < least) | (hr < least)] = 0
                where = gain.argmax(1)
                better = gain[np.arange(width), where] > best + 1e-9
                best = np.where(better, gain[np.arange(width), where], best)
                at, cut = np.where(better, j, at), np.where(better, where, cut)
            right = np.zeros(len(y), bool)
            for k in np.flatnonzero(at >= 0):
                forest.feature[tree, first + k] = at[k]
                forest.threshold[tree, first + k] = edges[at[k]][cut[k]]
                here = node == first + k
                right |= here & (codes[at[k]] > cut[k])
            node = 2 * node + 1 + right
        place = node - inner
        g = np.bincount(place, gradient, inner + 1)
        h = np.bincount(place, weight, inner + 1)
        forest.leaf[tree] = rate * g / (h + smoothing)
        margin += forest.leaf[tree][place]
    return forest


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Upper edges of all bins but the last; a value equal to an edge is below it."""
    if not len(values):
        return np.empty(0)
    edges = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
    return edges[edges < values.max()]


_BATCH_ROWS = 4096


def _measuring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(text) for text in binary_rows(batch.column(1))]
        x = np.asarray(rows, np.float64).reshape(len(rows), len(STATISTICS))
        columns = [pa.array(x[:, j]) for j in range(x.shape[1])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *columns], names=[batch.schema.names[0], *STATISTICS]
        )


def _scoring(forest: Forest):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _BATCH_ROWS):
                part = batch.slice(start, _BATCH_ROWS)
                scores = forest.score(_matrix(part, 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores)], names=["doc_id", "score"]
                )

    return score


def _matrix(table: pa.RecordBatch | pa.Table, first: int) -> np.ndarray:
    columns = [table.column(first + j).to_numpy(zero_copy_only=False) for j in range(len(STATISTICS))]
    return np.column_stack(columns)


def _keeping(forest: Forest, text: str, least: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for start in range(0, batch.num_rows, _BATCH_ROWS):
                part = batch.slice(start, _BATCH_ROWS)
                rows = [statistics(t or b"") for t in binary_rows(part.column(at))]
                scores = forest.score(np.asarray(rows, np.float64))
                yield part.filter(pa.array(scores >= least))

    return keep


def held_out(key: Column) -> Column:
    fold = F.crc32(F.encode(key.cast("string"), "UTF-8")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def document_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, statistics...)``, one row per row of ``docs``."""
    filled = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    rows = docs.select(F.col(key).alias("doc_id"), filled.alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(
        f"{name} double" for name in STATISTICS
    )
    return rows.mapInArrow(_measuring, schema)


def train(measured: DataFrame, labels: DataFrame, label: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Trees from at most ``sample_rows`` labelled rows that are not held out."""
    known = (
        labels.select(F.col("doc_id"), F.col(label).alias("label"))
        .filter(~held_out(F.col("doc_id")))
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    sample = (
        measured.join(known, "doc_id")
        .orderBy(F.xxhash64(F.col("doc_id")), *STATISTICS)
        .limit(sample_rows)
        .select(F.col("label").cast("double").alias("label"), *STATISTICS)
        .toArrow()
    )
    return fit(_matrix(sample, 1), sample.column(0).to_numpy())


def keep_good(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", least: float = 0.5, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns.

    Rows are scored where they are. For training, labels meet the statistics of the rows, not the texts.
    """
    forest = train(document_statistics(docs, key, text), labels, label, sample_rows)
    return docs.mapInArrow(_keeping(forest, text, least), docs.schema)


def quality_scores(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "quality")
    measured = scratch.store(document_statistics(docs, key, text), "statistics")
    forest = train(measured, labels, label, sample_rows)
    id_type = measured.schema["doc_id"].dataType.simpleString()
    scored = measured.mapInArrow(_scoring(forest), f"doc_id {id_type}, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
