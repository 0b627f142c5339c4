"""Records of CSV files with line breaks inside quotes, read by many tasks.

Files are read as lines, in Spark's own splits. At the start of a line a reader is either between records or
inside quotes, so a line maps two states to two states, and so does a split. A first pass over the lines that
have a quote composes these maps per split; composing those along each file tells in which state every split
begins. The second pass then puts lines together to records, each split from its first true record start. A
record over the edge of a split leaves as pieces, at most two per split, which meet in a small shuffle.

The driver holds a few numbers per split that has quotes, as it holds the list of splits itself. Both passes
must see the same splits; where they differ in a way that matters the second one ends with an error.
"""

from __future__ import annotations

import bisect
import csv
import io
import sys
from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Executors have no need of this package: what they run travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A line that starts between records and ends inside quotes. A quote opens a field only at its start; after
# the one that closes it, all up to the next comma belongs to the field.
_OPEN_AT_END = '^(?:(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]|"")*+$'

_CHANGED = "the splits of an extract changed while it was read; read it again"
_HEAD_BYTES = 1 << 16
_HEADS_AT_ONCE = 16


@dataclass(frozen=True)
class SplitStates:
    """Where the states of a file change: its splits with quotes, and the state each of them ends in."""

    blocks: list[int]
    ends: list[int]
    open_before: list[bool]
    open_after: list[bool]

    def begins_open(self, block: int) -> bool:
        i = bisect.bisect_right(self.blocks, block) - 1
        if i < 0:
            return False
        if self.blocks[i] == block:
            return self.open_before[i]
        if block < self.ends[i]:
            raise ValueError(_CHANGED)
        return self.open_after[i]

    def has(self, block: int) -> bool:
        i = bisect.bisect_left(self.blocks, block)
        return i < len(self.blocks) and self.blocks[i] == block

    def meets_edge(self, block: int) -> bool:
        """Whether a split begins or ends inside quotes."""
        if self.has(block):
            i = bisect.bisect_left(self.blocks, block)
            return self.open_before[i] or self.open_after[i]
        return self.begins_open(block)

    def edges(self) -> bool:
        """Whether any split ends inside quotes."""
        return any(self.open_after)


_NO_QUOTES = SplitStates([], [], [], [])


@dataclass(frozen=True)
class Quotes:
    """What the first pass tells: the states of files with quotes, and which files end inside quotes."""

    states: dict[int, SplitStates]
    breaks: bool
    unclosed: frozenset[int]


def file_number(path: Column) -> Column:
    """Files are told apart by a hash of their names, which is short in every row."""
    return F.xxhash64(path)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(value, file, block, length)`` of all lines; a carriage return at the end of a line is kept."""
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            "value",
            file_number(F.col("_metadata.file_path")).alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_block_length").alias("length"),
        )
    )


def _line_map() -> tuple[Column, Column]:
    """Whether a line ends inside quotes, if it starts between records, and if it starts inside quotes."""
    value = F.col("value")
    return value.rlike(_OPEN_AT_END), F.concat(F.lit('"'), value).rlike(_OPEN_AT_END)


def states_after(from_closed: np.ndarray, from_open: np.ndarray, state: bool) -> np.ndarray:
    """The state after each line, from the maps of the lines and the state before the first one."""
    fixed = from_closed == from_open
    swaps = np.cumsum(from_closed & ~from_open)
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), -1))
    base = np.where(last >= 0, from_closed[last], state)
    since = swaps - np.where(last >= 0, swaps[last], 0)
    return base ^ (since % 2 == 1)


def _same_splits(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """The rows of each split in turn."""
    file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
    changes = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
    edges = [0, *changes.tolist(), len(file)]
    for start, stop in zip(edges, edges[1:], strict=False):
        if stop > start:
            yield int(file[start]), int(block[start]), batch.slice(start, stop - start)


def _flags(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(bool)


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The map of each split, and whether a line in it opens a quote that it leaves open."""
    found: dict[tuple[int, int], list] = {}
    for batch in batches:
        for file, block, rows in _same_splits(batch):
            one = found.setdefault((file, block), [rows.column("length")[0].as_py(), False, True, False])
            maps = _flags(rows, "from_closed"), _flags(rows, "from_open")
            one[1], one[2] = (bool(states_after(*maps, state)[-1]) for state in one[1:3])
            one[3] |= bool(maps[0].any())
    rows = [(*key, *one) for key, one in found.items()]
    columns = list(zip(*rows, strict=True)) or [()] * 6
    types = [pa.int64()] * 3 + [pa.bool_()] * 3
    names = ["file", "block", "length", "from_closed", "from_open", "breaks"]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )


def scan_quotes(spark: SparkSession, path: str | list[str]) -> Quotes:
    """The first pass: only lines with a quote leave the JVM, as two flags each."""
    from_closed, from_open = _line_map()
    maps = (
        _lines(spark, path)
        .filter(F.col("value").contains('"'))
        .select("file", "block", "length", from_closed.alias("from_closed"), from_open.alias("from_open"))
    )
    schema = "file long, block long, length long, from_closed boolean, from_open boolean, breaks boolean"
    splits: dict[int, list] = defaultdict(list)
    breaks = False
    for row in sorted(maps.mapInArrow(_compose, schema).collect(), key=lambda r: (r["file"], r["block"])):
        splits[row["file"]].append(row)
        breaks |= row["breaks"]
    states, unclosed = {}, set()
    for file, rows in splits.items():
        before, after, state = [], [], False
        for row in rows:
            before.append(state)
            state = row["from_open"] if state else row["from_closed"]
            after.append(state)
        blocks = [row["block"] for row in rows]
        ends = [row["block"] + row["length"] for row in rows]
        states[file] = SplitStates(blocks, ends, before, after)
        if state:
            unclosed.add(file)
    return Quotes(states, breaks, frozenset(unclosed))


def _joined(begun: list[str], lines: pa.Array, ends: np.ndarray) -> pa.Array:
    """The records that end in the lines ``ends``; the first one has the lines ``begun`` before it."""
    starts = np.concatenate(([0], ends[:-1] + 1))
    if not begun and (starts == ends).all():
        return lines.take(pa.array(ends))
    texts = lines.to_pylist()
    records = ["\n".join(texts[a : b + 1]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    if begun:
        records[0] = "\n".join([*begun, records[0]])
    return pa.array(records, pa.string())


def _without_header(records: pa.Array) -> tuple[pa.Array, bool]:
    """Records after the first one that is not blank, and whether there was one."""
    for i, record in enumerate(records):
        if record.as_py().strip():
            return records.slice(i + 1), True
    return records.slice(len(records)), False


class _Split:
    """Where a task is in a split: its state, and the lines since the last record end."""

    def __init__(self, key: tuple[int, int], states: SplitStates):
        self.key, self._states = key, states
        self.state = states.begins_open(key[1])
        self.begins_open = self.state
        # A record before the split's own first one is the end of one begun before.
        self.own = not self.state
        self.header = key[1] == 0
        self.lines: list[str] = []

    def take(self, batch: pa.RecordBatch, keep_lines: bool) -> tuple[pa.Array | None, pa.Array]:
        """The end of a record begun in an earlier split, and the split's own records."""
        lines = batch.column("value")
        if not self._states.has(self.key[1]) and pc.any(pc.match_substring(lines, '"')).as_py():
            raise ValueError(_CHANGED)
        after = states_after(_flags(batch, "from_closed"), _flags(batch, "from_open"), self.state)
        self.state = bool(after[-1])
        ends = np.flatnonzero(~after)
        if not len(ends):
            if keep_lines or self.own:
                self.lines += lines.to_pylist()
            return None, pa.array([], pa.string())
        records, self.lines = _joined(self.lines, lines, ends), lines.slice(int(ends[-1]) + 1).to_pylist()
        head = None
        if not self.own:
            head, records, self.own = records.slice(0, 1), records.slice(1), True
        if self.header:
            records, seen = _without_header(records)
            self.header = not seen
        return head, records


def _whole_records(states: dict[int, SplitStates]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            for file, block, rows in _same_splits(batch):
                if split is None or split.key != (file, block):
                    split = _Split((file, block), states.get(file, _NO_QUOTES))
                _, records = split.take(rows, keep_lines=False)
                if len(records):
                    yield pa.RecordBatch.from_arrays([records], names=["record"])

    return run


def _edge_pieces(states: dict[int, SplitStates]):
    """The ends and beginnings of records that reach over the edges of splits."""

    def piece(split: _Split, record: pa.Array, begins: bool) -> pa.RecordBatch:
        file, block = split.key
        columns = [
            pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([begins]), record,
        ]
        return pa.RecordBatch.from_arrays(columns, names=["file", "block", "begins", "record"])

    def rest(split: _Split | None) -> Iterator[pa.RecordBatch]:
        if split and split.lines:
            yield piece(split, pa.array(["\n".join(split.lines)]), split.own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            for file, block, rows in _same_splits(batch):
                of = states.get(file, _NO_QUOTES)
                if not of.meets_edge(block):
                    continue
                if split is None or split.key != (file, block):
                    yield from rest(split)
                    split = _Split((file, block), of)
                head, _ = split.take(rows, keep_lines=True)
                if head is not None:
                    yield piece(split, head, False)
        yield from rest(split)

    return run


def read_records(spark: SparkSession, path: str | list[str], quotes: Quotes) -> DataFrame:
    """``(record)``: the records of an extract, without headers and blank ones."""
    from_closed, from_open = _line_map()
    quoted = F.col("value").contains('"')
    lines = _lines(spark, path).select(
        "value",
        "file",
        "block",
        (quoted & from_closed).alias("from_closed"),
        (~quoted | from_open).alias("from_open"),
    )
    records = lines.mapInArrow(_whole_records(quotes.states), "record string")
    if any(states.edges() for states in quotes.states.values()):
        pieces = lines.mapInArrow(
            _edge_pieces(quotes.states),
            "file long, block long, begins boolean, record string",
        )
        along = Window.partitionBy("file").orderBy("block", "begins")
        numbered = pieces.withColumn("number", F.sum(F.col("begins").cast("long")).over(along))
        in_order = F.array_sort(F.collect_list(F.struct("block", "begins", "record")))
        joined = numbered.groupBy("file", "number").agg(
            F.array_join(F.transform(in_order, lambda p: p["record"]), "\n").alias("record")
        )
        records = records.unionAll(joined.select("record"))
    # Lines may end in a carriage return and a line feed.
    bare = F.regexp_replace("record", "\r$", "")
    return records.select(bare.alias("record")).filter(F.trim("record") != "")


def input_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files of an extract, by the names that rows are told by."""
    jvm = spark.sparkContext._jvm
    found = spark.read.text(path).inputFiles()
    return sorted(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString() for f in found)


def file_headers(spark: SparkSession, files: list[str]) -> list[tuple[str, ...] | None]:
    """The column names of each file, from its first bytes; None for a file without a record."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def header(file: str) -> tuple[str, ...] | None:
        path = jvm.org.apache.hadoop.fs.Path(file)
        stream = path.getFileSystem(conf).open(path)
        try:
            if codec := codecs.getCodec(path):
                stream = codec.createInputStream(stream)
            head = b""
            while True:
                more = bytes(stream.readNBytes(_HEAD_BYTES))
                head += more
                lines = head.decode("utf-8-sig", "ignore").lstrip("\r\n").splitlines(keepends=True)
                names = next(csv.reader(io.StringIO("".join(lines), newline="")), None) if lines else None
                # With more to come, the record must end before what has been read.
                if not more or (names is not None and len(lines) > 1 and _ends_early(lines)):
                    return tuple(names) if names else None
        finally:
            stream.close()

    with ThreadPoolExecutor(_HEADS_AT_ONCE) as pool:
        return list(pool.map(header, files))


def _ends_early(lines: list[str]) -> bool:
    reader = csv.reader(iter(lines))
    next(reader)
    return reader.line_num < len(lines)


def distinct_names(header: tuple[str, ...]) -> list[str]:
    """Column names of a header: of equal ones the first keeps its name; one without a name gets its number."""
    seen: dict[str, int] = defaultdict(int)
    names = []
    for i, name in enumerate(header):
        name = name or f"_c{i}"
        key = name.lower()
        names.append(f"{name}.{seen[key]}" if seen[key] else name)
        seen[key] += 1
    return names


def file_numbers(spark: SparkSession, files: list[str]) -> list[int]:
    numbered = spark.createDataFrame([(i, f) for i, f in enumerate(files)], "i int, path string")
    rows = numbered.select("i", file_number(F.col("path")).alias("n")).collect()
    return [n for _, n in sorted((r["i"], r["n"]) for r in rows)]
