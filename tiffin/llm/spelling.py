"""Spelling variants: words one edit apart, and the common form that each rare one stands for.

Words are put into blocks by how many of their letters fall into each of ``GROUPS`` groups of letters; so
a block's words have one length. One edit changes these counts in one group (a letter more or less) or
moves one letter from a group to another, so a word's near words lie in its own block, in neighbours of the
same length, and in neighbours one shorter or longer. Of two neighbouring blocks one visits the other.

Where blocks meet, NumPy products of the two blocks' letter counts (the blocked Gram matrix) give the squared
distances of all counts: two words one edit apart are at most 2 apart, 1 if their lengths differ. What is
left is compared letter by letter. No candidate is dropped otherwise, so the pairs are exact.

A block goes on in chunks of ``block_words`` words; chunks meet one by one, in tasks of their own, and a task
holds one chunk and a tile of its visitors. Forms are followed to their roots by pointer jumping.

Defined cases: a NULL text has no words, a NULL identifier counts as an empty one; words may have any letters
(those beyond the ones counted singly share counts, which only adds candidates) and any length; equal words
of ``words`` are added up, NULL and empty ones passed over; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.scratch import Scratch
from tiffin.llm.texts import LOWER, UPPER

GROUPS = 8
BLOCK_WORDS = 1024
TILE_ROWS = 16
CHUNK_CHARS = 1 << 18
LEAST_CHARS = 6
LEAST_TIMES = 5
RATIO = 5

# Letters from common to rare in languages of Latin script.
_BY_USE = "etaoinsrhldcumfpgwybvkxjqz"
_LETTERS = 26 + 64
_FLUSH_WORDS = 200_000
_VERIFY_CELLS = 1 << 22


def _run_table() -> bytes:
    """For Latin-1 bytes: A-Z as a-z, other letters of runs as they are, blanks for the rest."""
    table = bytearray(b" " * 256)
    for upper, lower in zip(UPPER.encode(), LOWER.encode(), strict=True):
        table[upper] = table[lower] = lower
    table[0xC0:] = range(0xC0, 0x100)
    return bytes(table)


def _counting(noise: int, least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, totals = _run_table(), Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                # What Latin-1 lacks becomes a question mark, which parts runs, too.
                times = Counter(text.encode("latin-1", "replace").translate(table).split())
                prefix = zlib.crc32(f"{doc_id}:".encode())
                for word, n in times.items():
                    if len(word) < least_chars:
                        continue
                    if noise:
                        spelled = word if word.isascii() else word.decode("latin-1").encode()
                        mark = zlib.crc32(spelled, prefix)
                        if mark % noise == 0:
                            at = mark % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_chars:
                                continue
                    totals[word] += n
                if len(totals) > _FLUSH_WORDS:
                    yield _counted(totals)
                    totals.clear()
        yield _counted(totals)

    return run


def _counted(totals: Counter) -> pa.RecordBatch:
    words = pa.array([w.decode("latin-1") for w in totals], pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(totals.values(), pa.int64())], names=["word", "n"])


def word_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", noise: int = 0,
    least_chars: int = LEAST_CHARS, least_times: int = LEAST_TIMES,
) -> DataFrame:
    """``(word, n)``: runs of Latin letters of at least ``least_chars``, that occur ``least_times`` or more.

    With ``noise``, a run of a document loses a letter where ``noise`` divides the CRC-32 of the two: misspellings
    whose right forms are known, to try the grouping with.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    counted = rows.mapInArrow(_counting(noise, least_chars), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_times)


def _letter_table() -> np.ndarray:
    """The group of every counted letter: dealt out by use in turn, there and back, so that groups are near equal."""
    there = list(range(GROUPS))
    turns = itertools.cycle(there + there[::-1])
    table = np.arange(_LETTERS) % GROUPS
    for letter, group in zip(_BY_USE, turns, strict=False):
        table[ord(letter) - ord("a")] = group
    return table


def _letters(matrix: np.ndarray) -> np.ndarray:
    """Numbers of code points: a to z, U+00C0 to U+00FF have their own, others share one of the latter's."""
    codes = matrix.astype(np.int64)
    return np.where((codes >= 97) & (codes <= 122), codes - 97, 26 + codes % 64)


def _tallies(numbers: np.ndarray, kinds: int) -> np.ndarray:
    """How often each row holds each number."""
    rows = np.arange(len(numbers))[:, None] * kinds
    return np.bincount((rows + numbers).ravel(), minlength=len(numbers) * kinds).reshape(-1, kinds)


def _block_keys(tallies: np.ndarray) -> list[bytes]:
    """Names of the blocks of group tallies; of a width that only the length decides."""
    width = "u1" if len(tallies) and tallies[0].sum() < 256 else "<u4"
    return [row.tobytes() for row in tallies.astype(width)]


def _block_tallies(key: bytes) -> np.ndarray:
    return np.frombuffer(key, "u1" if len(key) == GROUPS else "<u4").astype(np.int64)


def visited(key: bytes) -> list[bytes]:
    """The blocks that a block visits: itself, those of one letter less, and of one moved to a later group."""
    own = _block_tallies(key)
    step = np.eye(GROUPS, dtype=np.int64)
    out = [key]
    for i in np.flatnonzero(own):
        shorter = own - step[i]
        if shorter.any():
            out += _block_keys(shorter[None])
        out += _block_keys(shorter + step[i + 1 :])
    return out


def _matrix(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(-1, length)


def _unpacked(packed: bytes, n: int, length: int) -> np.ndarray:
    """The code points of ``n`` words; a byte each where all are below 256."""
    return np.frombuffer(packed, "u1" if len(packed) == n * length else "<u4").reshape(n, length)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the block of each word."""
    groups = _letter_table()
    for batch in batches:
        words = batch.column(0).to_pylist()
        lengths = np.array([len(w) for w in words], np.int64)
        keys: list = [None] * len(words)
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            for some in np.array_split(rows, -(-len(rows) * int(length) // CHUNK_CHARS)):
                letters = _letters(_matrix([words[i] for i in some], int(length)))
                for i, key in zip(some, _block_keys(_tallies(groups[letters], GROUPS)), strict=True):
                    keys[i] = key
        columns = [pa.array(keys, pa.binary()), *batch.columns]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "word", "n"])


def _packing(block_words: int):
    """Chunks of sorted rows of a block, as one row each, with the blocks to visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chunk, words, times, out = None, 0, [], [], []

        def cut() -> None:
            length = len(words[0])
            matrix = _matrix(words, length)
            if matrix.max() < 256:
                matrix = matrix.astype(np.uint8)
            numbers = np.array(times, np.int64)
            out.append((held, chunk, length, matrix.tobytes(), numbers.tobytes(), visited(held)))
            words.clear()
            times.clear()

        def packed() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            types = (pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.binary()))
            names = ["block", "chunk", "length", "words", "times", "visits"]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for block, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if words and (
                    block != held or len(words) >= block_words or len(words) * len(word) >= CHUNK_CHARS
                ):
                    cut()
                    chunk += 1
                if block != held:
                    held, chunk = block, 0
                words.append(word)
                times.append(n)
            if out:
                yield packed()
        if words:
            cut()
        if out:
            yield packed()

    return run


class Words:
    """Words of one length, with their counts."""

    def __init__(self, length: int, words: Sequence[bytes], times: Sequence[bytes]):
        self.length = length
        self.times = np.concatenate([np.frombuffer(t, np.int64) for t in times])
        self.matrix = np.concatenate(
            [_unpacked(w, len(t) // 8, length) for w, t in zip(words, times, strict=True)]
        )
        # Products of counts stay below 2**24, which single precision holds, for all but huge words.
        exact = np.float32 if length < 4096 else np.float64
        self.counts = _tallies(_letters(self.matrix), _LETTERS).astype(exact)
        self.squares = np.einsum("ij,ij->i", self.counts, self.counts)

    def __len__(self) -> int:
        return len(self.times)

    def texts(self, rows: np.ndarray) -> list[str]:
        text = self.matrix[rows].astype("<u4").tobytes().decode("utf-32-le")
        return [text[i : i + self.length] for i in range(0, len(text), self.length)]


def one_edit_apart(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows of two matrices of code points are one edit apart; the second may have one column more."""
    n = short.shape[1]
    if long.shape[1] == n:
        return (short != long).sum(axis=1) == 1
    ahead = np.cumprod(short == long[:, :n], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    behind = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    return ahead + behind >= n


def gram_pairs(a: Words, b: Words, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the pairs one edit apart; ``b`` is as long as ``a`` or one longer. Each pair once if ``same``."""
    apart = a.squares[:, None] + b.squares[None, :] - 2 * (a.counts @ b.counts.T)
    left, right = np.nonzero(np.triu(apart <= 2, 1) if same else apart <= 2)
    step = max(1, _VERIFY_CELLS // b.length)
    kept = [
        one_edit_apart(a.matrix[left[i : i + step]], b.matrix[right[i : i + step]])
        for i in range(0, len(left), step)
    ]
    keep = np.concatenate(kept) if kept else np.empty(0, bool)
    return left[keep], right[keep]


_PAIR_NAMES = ["a", "b", "n_a", "n_b"]


def _pairs(a: Words, b: Words, same: bool = False) -> Iterator[pa.RecordBatch]:
    left, right = gram_pairs(a, b, same)
    if len(left):
        columns = [a.texts(left), b.texts(right), a.times[left], b.times[right]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_PAIR_NAMES)


def _meeting(tile_rows: int):
    """Pairs of chunks with their visitors; a chunk's own row comes first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, waiting = None, defaultdict(list)

        def meet(length: int) -> Iterator[pa.RecordBatch]:
            words, times = zip(*waiting.pop(length), strict=True)
            yield from _pairs(home, Words(length, words, times))

        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
            for own, length, words, times in rows:
                if own:
                    for visitors in sorted(waiting):
                        yield from meet(visitors)
                    home = Words(length, [words], [times])
                    yield from _pairs(home, home, same=True)
                    continue
                tile = waiting[length]
                tile.append((words, times))
                # Some of the rows of a tile are full chunks, many are short.
                if len(tile) >= tile_rows or len(words) >= CHUNK_CHARS:
                    yield from meet(length)
        for visitors in sorted(waiting):
            yield from meet(visitors)

    return run


def near_pairs(
    words: DataFrame, block_words: int = BLOCK_WORDS, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """``(a, b, n_a, n_b)``: every pair of the distinct words of ``words`` (``word``, ``n``) one edit apart, once."""
    scratch = Scratch(words.sparkSession, "spelling_pairs")
    packed = scratch.store(
        words.filter("word != ''")
        .select("word", "n")
        .mapInArrow(_keyed, "block binary, word string, n long")
        .repartition("block")
        .sortWithinPartitions("block", "word")
        .mapInArrow(
            _packing(block_words),
            "block binary, chunk int, length int, words binary, times binary, visits array<binary>",
        ),
        "packed",
    )
    # Stored, so that Spark joins it by its size on disk.
    blocks = scratch.store(
        packed.groupBy(F.col("block").alias("home")).agg(F.max("chunk").alias("last")), "blocks"
    )
    own = F.col("home") == F.col("block")
    meetings = (
        packed.select(F.explode("visits").alias("home"), "block", "chunk", "length", "words", "times")
        .join(blocks, "home")
        .withColumn("slot", F.explode(F.sequence(F.lit(0), F.when(own, F.col("chunk")).otherwise(F.col("last")))))
        .withColumn("own", own & (F.col("slot") == F.col("chunk")))
        .repartition("home", "slot")
        .sortWithinPartitions("home", "slot", F.desc("own"), "block", "chunk")
    )
    return meetings.select("own", "length", "words", "times").mapInArrow(
        _meeting(tile_rows), "a string, b string, n_a long, n_b long"
    )


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``(word, root)`` for words with a form, by pointer jumping: each round doubles how far roots look ahead."""
    current, turn = scratch.store(forms.select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        ahead = current.select(F.col("word").alias("at"), F.col("root").alias("ahead"))
        moved = current.join(ahead, F.col("root") == F.col("at"), "left")
        moved = moved.select(
            "word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")
        )
        turn += 1
        current = scratch.store(moved, f"roots-{turn}")
        scratch.drop(f"roots-{turn - 1}")
        if current.filter("moved").isEmpty():
            return current.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = RATIO, **options) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per distinct word of ``words`` (``word``, ``n``).

    ``form`` is the near word of the largest ``n``, the smallest of equal ones, if that is ``ratio`` times the word's
    own or more; ``root`` is where forms lead to in the end, the word itself if it has none.
    """
    scratch = Scratch(words.sparkSession, "spelling")
    summed = words.filter("word != ''").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    counted = scratch.store(summed, "words")
    pairs = near_pairs(counted, **options)

    def seen(word: str, n: str, near: str, near_n: str):
        best = F.struct((-F.col(near_n)).alias("less"), F.col(near).alias("near"))
        return F.struct(F.col(word).alias("word"), F.col(n).alias("n"), best.alias("best"))

    both = pairs.select(
        F.explode(F.array(seen("a", "n_a", "b", "n_b"), seen("b", "n_b", "a", "n_a"))).alias("s")
    ).select("s.word", "s.n", "s.best")
    # Words without a near one are there, too; NULL is not counted, and is never the smallest.
    alone = counted.select("word", "n", F.lit(None).cast("struct<less: bigint, near: string>").alias("best"))
    grouped = (
        both.unionAll(alone)
        .groupBy("word", "n")
        .agg(F.count("best").alias("n_near"), F.min("best").alias("best"))
    )
    most = -F.col("best.less")
    common = most >= F.col("n") * ratio
    judged = scratch.store(
        grouped.select(
            "word",
            F.when(common, F.col("best.near")).alias("form"),
            "n",
            "n_near",
            F.when(common, most).alias("form_n"),
        ),
        "judged",
    )
    roots = _roots(judged.filter("form is not null"), scratch)
    return (
        judged.join(roots, "word", "left")
        .withColumn("root", F.coalesce("root", "word"))
        .select("word", "form", "root", "n", "n_near", "form_n")
    )
