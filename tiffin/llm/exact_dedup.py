"""Exact duplicates: Patricia tries own the texts of a length and content hash.

Only texts whose length and hash occur more than once can have an equal, so only those are shuffled.
Each scan task first folds its own copies in a trie, so a text that a third of all rows share leaves
a task once; owners then insert the full bytes of what is left, and a terminal node holds the smallest
identifier and the number of copies. A trie beyond its budget gives off whole subtrees, those of the most bytes per
copy first, until it fills half of it; so texts with many copies stay. In a scan task it may be any subtree,
as owners add up what arrives twice; in an owner only those of keys that are complete, as rows arrive sorted by key.

Defined cases: a NULL text equals an empty one; a NULL identifier counts as larger than any other and
stays only if its group has no other; rows with the same text and identifier are all kept or all
dropped; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.scratch import Scratch
from tiffin.llm.texts import BLANK_CLASS, binary_rows

TRIE_BYTES = 32 << 20
# About what a node takes besides its label.
_NODE_BYTES = 400


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_CLASS + "+", " ")


class Node:
    __slots__ = ("label", "children", "smallest", "copies")

    def __init__(self, label: bytes, smallest: int | None = None, copies: int = 0):
        self.label = label
        self.children: dict[int, Node] = {}
        self.smallest = smallest
        self.copies = copies


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, found by halving so that long equal texts compare as blocks."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _smaller(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


class PatriciaTrie:
    """A radix tree of byte strings with compressed edges."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.size = 0

    def insert(self, key: bytes, smallest: int | None, copies: int) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                node.smallest = _smaller(node.smallest, smallest) if node.copies else smallest
                node.copies += copies
                return
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], smallest, copies)
                self.size += len(key) - at + _NODE_BYTES
                return
            rest = key[at : at + len(child.label)]
            same = _common(child.label, rest)
            if same < len(child.label):
                upper = Node(child.label[:same])
                child.label = child.label[same:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = upper
                self.size += _NODE_BYTES
                child = upper
            node, at = child, at + same

    def take(self) -> Iterator[tuple[bytes, int | None, int]]:
        """Gives off everything."""
        yield from _entries(b"", self.root)
        self.root, self.size = Node(b""), 0

    def give_off(self, most: int, keep: bytes | None = None) -> Iterator[tuple[bytes, int | None, int]]:
        """Gives off subtrees until the size is at most ``most``, none of the keys that begin with ``keep``.

        Subtrees of the most bytes per copy go first. Those that are large beside ``most``, or hold kept keys, too, are
        looked at in parts.
        """
        sizes = _sizes(self.root)
        heap: list = []
        order = itertools.count()

        def offer(prefix: bytes, parent: Node) -> None:
            for byte, node in parent.children.items():
                size, copies = sizes[id(node)]
                heapq.heappush(heap, (-size / max(1, copies), next(order), prefix, parent, byte))

        offer(b"", self.root)
        while heap and self.size > most:
            _, _, prefix, parent, byte = heapq.heappop(heap)
            node = parent.children[byte]
            key, size = prefix + node.label, sizes[id(node)][0]
            if keep is not None and key.startswith(keep):
                continue
            if node.children and (size > most // 8 or (keep is not None and keep.startswith(key))):
                offer(key, node)
                continue
            yield from _entries(prefix, node)
            del parent.children[byte]
            self.size -= size
        self._drop_empty()

    def _drop_empty(self) -> None:
        """Removes nodes that hold no key and lead to none."""
        path = [(self.root, iter(list(self.root.children.items())), None, None)]
        while path:
            node, rest, parent, byte = path[-1]
            following = next(rest, None)
            if following:
                child = following[1]
                path.append((child, iter(list(child.children.items())), node, following[0]))
                continue
            path.pop()
            if parent is not None and not node.copies and not node.children:
                del parent.children[byte]
                self.size -= len(node.label) + _NODE_BYTES


def _entries(prefix: bytes, top: Node) -> Iterator[tuple[bytes, int | None, int]]:
    """The keys of a subtree."""
    stack = [(prefix, top)]
    while stack:
        before, node = stack.pop()
        key = before + node.label
        if node.copies:
            yield key, node.smallest, node.copies
        stack.extend((key, child) for child in node.children.values())


def _sizes(top: Node) -> dict[int, tuple[int, int]]:
    """Bytes and copies of the subtree of every node."""
    order, stack = [], [top]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(node.children.values())
    sizes: dict[int, tuple[int, int]] = {}
    for node in reversed(order):
        size, copies = len(node.label) + _NODE_BYTES, node.copies
        for child in node.children.values():
            more, held = sizes[id(child)]
            size, copies = size + more, copies + held
        sizes[id(node)] = (size, copies)
    return sizes


_FOLDED = "n_bytes long, content_hash long, text binary, smallest long, copies long"
_FOLDED_ARROW = pa.schema(
    [
        ("n_bytes", pa.int64()),
        ("content_hash", pa.int64()),
        ("text", pa.binary()),
        ("smallest", pa.int64()),
        ("copies", pa.int64()),
    ]
)
_BATCH_BYTES = 4 << 20


def _key(n_bytes: int, content_hash: int) -> bytes:
    return n_bytes.to_bytes(8, "big") + content_hash.to_bytes(8, "big", signed=True)


def _folding(trie_bytes: int, sorted_keys: bool):
    """A function of a task's rows: equal texts become one row."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie()
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            numbers = [columns[i].to_pylist() for i in (0, 1, 3, 4)]
            for n_bytes, content_hash, smallest, copies, text in zip(
                *numbers, binary_rows(columns[2]), strict=True
            ):
                key = _key(n_bytes, content_hash)
                if trie.size > trie_bytes:
                    yield from _as_batches(trie.give_off(trie_bytes // 2, key if sorted_keys else None))
                trie.insert(key + text, smallest, copies)
        yield from _as_batches(trie.take())

    return fold


def _as_batches(found: Iterator[tuple[bytes, int | None, int]]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0
    for key, smallest, copies in found:
        n_bytes = int.from_bytes(key[:8], "big")
        content_hash = int.from_bytes(key[8:16], "big", signed=True)
        rows.append((n_bytes, content_hash, key[16:], smallest, copies))
        size += len(key) + 64
        if size > _BATCH_BYTES:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _FOLDED_ARROW, strict=True)],
        schema=_FOLDED_ARROW,
    )


def exact_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", trie_bytes: int = TRIE_BYTES
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``.

    ``trie_bytes`` bounds the memory of a trie, apart from the texts of one length and hash.
    """
    scratch = Scratch(docs.sparkSession, "exact_dedup")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), normalised(F.col(text)).alias("text"))
    hashed = rows.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.xxhash64("text").alias("content_hash"),
        "text",
    )
    light = scratch.store(
        hashed.select(
            "doc_id", "n_bytes", "content_hash", F.sha2("text", 256).alias("text_sha256")
        ),
        "light",
    )
    repeated = scratch.store(
        light.groupBy("n_bytes", "content_hash")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .select("n_bytes", "content_hash"),
        "repeated",
    )
    candidates = hashed.join(repeated, ["n_bytes", "content_hash"], "left_semi").select(
        "n_bytes",
        "content_hash",
        F.encode("text", "UTF-8").alias("text"),
        F.col("doc_id").alias("smallest"),
        F.lit(1).cast("long").alias("copies"),
    )
    folded = candidates.mapInArrow(_folding(trie_bytes, sorted_keys=False), _FOLDED)
    owned = (
        folded.repartition("n_bytes", "content_hash")
        .sortWithinPartitions("n_bytes", "content_hash")
        .mapInArrow(_folding(trie_bytes, sorted_keys=True), _FOLDED)
    )
    groups = scratch.store(
        owned.filter("copies > 1").select(
            "n_bytes",
            F.sha2("text", 256).alias("text_sha256"),
            F.col("smallest").alias("keep_id"),
            F.col("copies").alias("group_size"),
        ),
        "groups",
    )
    alone = F.col("group_size").isNull()
    return (
        light.join(groups, ["n_bytes", "text_sha256"], "left")
        .select(
            "doc_id",
            F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            "text_sha256",
        )
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
        )
    )
