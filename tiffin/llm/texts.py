"""Words, shingles and groups of rows, as Python workers and SQL see them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that separate words, and A-Z with its lower case.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
BLANK_CLASS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

LOWER_TABLE = bytes.maketrans(UPPER.encode(), LOWER.encode())

_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def word_count(text: Column) -> Column:
    """Number of runs of characters other than blanks; 0 for NULL."""
    filled = F.coalesce(text, F.lit(""))
    bare = F.btrim(filled, F.lit(BLANKS))
    words = F.size(F.split(bare, BLANK_CLASS + "+"))
    return F.when(bare == "", 0).otherwise(words).cast("long")


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; that of no bytes for NULL."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_1
    values = (values ^ (values >> np.uint64(27))) * _MIX_2
    return values ^ (values >> np.uint64(31))


class Shingler:
    """Hashes of the distinct word shingles of a text.

    A word's hash is a polynomial of its bytes, taken from running sums over the whole text, so there
    is no loop over words. A shingle's hash combines the hashes of its words by their place.
    """

    def __init__(self, width: int):
        rng = np.random.default_rng(20240501)
        self.width = width
        self._letter = rng.integers(0, 2**64, 256, dtype=np.uint64)
        self._place = rng.integers(0, 2**64, width, dtype=np.uint64) | np.uint64(1)
        self._base = np.uint64(0x9E3779B97F4A7C15)
        self._inverse = np.uint64(pow(int(self._base), -1, 2**64))
        self._up = self._down = np.empty(0, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            n = max(n, 4096, 2 * len(self._up))
            for name, factor in (("_up", self._base), ("_down", self._inverse)):
                steps = np.full(n, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self._up, self._down

    def words(self, text: bytes) -> np.ndarray:
        """A 64-bit hash for each word, A-Z taken as a-z."""
        line = b" ".join(text.translate(LOWER_TABLE).split())
        if not line:
            return np.empty(0, np.uint64)
        codes = np.frombuffer(line, np.uint8)
        up, down = self._powers(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(self._letter[codes] * up[: len(codes)], out=sums[1:])
        gaps = np.flatnonzero(codes == 32)
        starts = np.concatenate(([0], gaps + 1))
        ends = np.concatenate((gaps, [len(codes)]))
        return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def shingles(self, text: bytes) -> np.ndarray:
        """Sorted distinct hashes; a text of fewer words is one shingle, one of no words none."""
        words = self.words(text)
        n = min(len(words), self.width)
        if not n:
            return words
        total = np.full(len(words) - n + 1, n, np.uint64)
        for i in range(n):
            total += words[i : len(words) - n + 1 + i] * self._place[i]
        return np.unique(mixed(total))


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, with the first row of each group, from rows sorted by ``keys``.

    Only the group a batch ends in is held over to the next one.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        starts = _group_starts(held, keys)
        if len(starts) > 1:
            yield held.slice(0, int(starts[-1])).combine_chunks(), starts[:-1]
            held = held.slice(int(starts[-1]))
    if held is not None:
        held = held.combine_chunks()
        yield held, _group_starts(held, keys)


def _group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    changed = np.zeros(table.num_rows, bool)
    changed[0] = True
    for key in keys:
        column = table.column(key).combine_chunks().dictionary_encode()
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        codes = column.indices.to_numpy(zero_copy_only=False)
        changed[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(changed)


def binary_rows(column: pa.ChunkedArray | pa.Array) -> list:
    """Values of a text or binary column as bytes; None for NULL."""
    return column.cast(pa.binary()).to_pylist()
