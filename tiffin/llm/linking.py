"""Links within groups of any size, by tasks that compare bounded blocks of members as arrays.

1. Every group is cut into blocks by the hashes of its nodes, and each block is linked in a task.
2. One member stands for each component of a block. Those of a group are cut into blocks and linked
   again, until they fit one block or no longer become half as many.
3. Pairs that are still open have members of different components. Blocks of the members outside the
   largest component meet each other and those of the largest one; each pair of blocks is a task.

So no group is too large for a task, and no pair is left out: it was compared, or its members were joined
before. A group of near copies costs about its size, as its members are one component after the
first two steps; a group of many components costs the square of its blocks outside the largest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.scratch import Scratch
from tiffin.llm.texts import whole_groups

# Blocks of the last step are larger: each is copied once for every block that it meets.
_ACROSS_LOAD = 4


class Links:
    """Which members are joined so far, with an edge for each join."""

    def __init__(self, label: np.ndarray):
        self.label = label.copy()
        self.parts = len(np.unique(label))
        self.edges: list[tuple[int, int]] = []

    def join(self, x: int, others: np.ndarray) -> None:
        """Links ``x`` to one member of each component among ``others``, none of them its own."""
        if len(others):
            labels, first = np.unique(self.label[others], return_index=True)
            self.edges += [(x, y) for y in others[first].tolist()]
            self.label[np.isin(self.label, labels)] = self.label[x]
            self.parts -= len(labels)

    def first_members(self) -> np.ndarray:
        """For each member the first one of its component."""
        _, first, component = np.unique(self.label, return_index=True, return_inverse=True)
        return first[component]


def signature_links(
    signatures: np.ndarray, block: np.ndarray, least: float, links: Links | None = None
) -> list:
    """Edges that join all members with at least ``least`` equal minima, in turn.

    Members of two different blocks are compared across blocks only, and joined members not at all.
    """
    links = links or Links(np.arange(len(signatures)))
    two = block.min() != block.max()
    for x in range(len(signatures) - 1):
        if links.parts == 1:
            break
        rest = np.arange(x + 1, len(signatures))
        open_ = links.label[rest] != links.label[x]
        if two:
            open_ &= block[rest] != block[x]
        rest = rest[open_]
        if len(rest):
            equal = (signatures[rest] == signatures[x]).sum(axis=1)
            links.join(x, rest[equal >= least])
    return links.edges


def exact_links(
    sets: list[np.ndarray], block: np.ndarray, percent: int, links: Links | None = None
) -> list:
    """Edges that join all members with ``100 * intersection >= percent * union``, in turn."""
    links = links or Links(np.arange(len(sets)))
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    _, codes = np.unique(values, return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    present = np.zeros(codes.max() + 1, bool)
    two = block.min() != block.max()
    for x in range(len(sets) - 1):
        if links.parts == 1:
            break
        rest = np.arange(x + 1, len(sets))
        open_ = links.label[rest] != links.label[x]
        open_ &= 100 * np.minimum(sizes[rest], sizes[x]) >= percent * np.maximum(sizes[rest], sizes[x])
        if two:
            open_ &= block[rest] != block[x]
        rest = rest[open_]
        if not len(rest):
            continue
        own = codes[starts[x] : starts[x + 1]]
        present[own] = True
        lengths = sizes[rest]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1]) + np.repeat(starts[rest] - (ends - lengths), lengths)
        common = np.add.reduceat(present[codes[places]].astype(np.int64), ends - lengths)
        present[own] = False
        union = sizes[x] + lengths - common
        links.join(x, rest[100 * common >= percent * union])
    return links.edges


Compare = Callable[[list[bytes], np.ndarray, Links], list]


def by_signature(share: float, kind: type = np.uint32) -> Compare:
    """Members are signatures of minima, of which ``share`` must be equal.

    With minima cut to a few bits some more are equal by chance: more members are joined, never fewer.
    """

    def compare(payload: list[bytes], block: np.ndarray, links: Links) -> list:
        width = len(payload[0]) // np.dtype(kind).itemsize
        signatures = np.frombuffer(b"".join(payload), kind).reshape(-1, width)
        return signature_links(signatures, block, share * width, links)

    return compare


def by_set(percent: int) -> Compare:
    """Members are sets of 64-bit values, sorted."""

    def compare(payload: list[bytes], block: np.ndarray, links: Links) -> list:
        return exact_links([np.frombuffer(p, np.uint64) for p in payload], block, percent, links)

    return compare


def _groups(starts: np.ndarray, rows: int) -> Iterator[tuple[int, int]]:
    """First and last row of the groups of more than one."""
    ends = [*starts[1:].tolist(), rows]
    return ((a, b) for a, b in zip(starts.tolist(), ends, strict=True) if b - a > 1)


def _within(compare: Compare, every_row: bool):
    """Names, for each member of a block, the one that stands for its component.

    Members that stand for others keep their payload where blocks are to be linked further; groups of
    one block need no more than the members that are joined to others.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["of", "block"]):
            payload = table.column("payload").to_pylist()
            further = (table.column("blocks").to_numpy() > 1) | every_row
            places = np.arange(table.num_rows)
            stands = places.copy()
            for start, end in _groups(starts, table.num_rows):
                links = Links(np.arange(end - start))
                compare(payload[start:end], np.zeros(end - start, int), links)
                stands[start:end] = start + links.first_members()
            own = stands == places
            kept = [p if k else None for p, k in zip(payload, own & further, strict=True)]
            out = pa.table(
                {
                    "of": table.column("of"),
                    "blocks": table.column("blocks"),
                    "node": table.column("node"),
                    "part": table.column("node").take(pa.array(stands)),
                    "load": table.column("load"),
                    "payload": pa.array(kept, pa.binary()),
                }
            )
            yield from out.filter(pa.array(further | ~own)).combine_chunks().to_batches()

    return link


def _across(compare: Compare):
    """Joins the members of different components, for each pair of blocks."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["of", "low", "high"]):
            nodes, kind = table.column("node").to_pylist(), table.schema.field("node").type
            blocks = table.column("block").to_numpy()
            payload = table.column("payload").to_pylist()
            _, part = np.unique(np.array(table.column("part").to_pylist(), object), return_inverse=True)
            a, b = [], []
            for start, end in _groups(starts, table.num_rows):
                edges = compare(payload[start:end], blocks[start:end], Links(part[start:end]))
                a.extend(nodes[start + x] for x, _ in edges)
                b.extend(nodes[start + y] for _, y in edges)
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, kind), pa.array(b, kind)], names=["a", "b"]
                )

    return link


def _linked_blocks(members: DataFrame, compare: Compare, turn: int) -> DataFrame:
    """``(of, blocks, node, part, load, payload)`` from ``(of, blocks, node, load, payload)``."""
    block = F.pmod(F.xxhash64("node", F.lit(turn)), F.col("blocks")).cast("int")
    of, node = (members.schema[name].dataType.simpleString() for name in ("of", "node"))
    schema = f"of {of}, blocks int, node {node}, part {node}, load double, payload binary"
    return (
        members.select("of", F.col("blocks").cast("int"), block.alias("block"), "node", "load", "payload")
        .repartition("of", "block")
        .sortWithinPartitions("of", "block", "node")
        .mapInArrow(_within(compare, every_row=turn > 0), schema)
    )


def linked(
    members: DataFrame, compare: Compare, payload_of: Callable[[DataFrame], DataFrame],
    scratch: Scratch, name: str,
) -> DataFrame:
    """Edges ``(a, b)`` that join all members of a group that are linked, directly or by others.

    ``members`` has ``of`` (the group), ``node``, ``payload`` (what is compared), ``load`` (which share of
    a block the member takes) and ``blocks`` (loads of the group, rounded up). ``payload_of`` gives
    ``(node, payload)`` for a table of nodes, and may give other nodes too.
    """
    turns = [scratch.store(_linked_blocks(members, compare, 0), f"{name}-turn-0")]
    edges = _joins(turns[0])
    standing = turns[0].filter("payload is not null")
    if standing.isEmpty():
        return edges
    while True:
        turn = len(turns)
        sizes = standing.groupBy("of").agg(
            F.count(F.lit(1)).alias("n"), F.ceil(F.sum("load")).alias("blocks")
        )
        sizes = scratch.store(sizes.filter("n > 1"), f"{name}-sizes-{turn}")
        before, most = sizes.agg(F.sum("n"), F.max("blocks")).first()
        if not before:
            break
        again = standing.drop("blocks").join(sizes.drop("n"), "of")
        turns.append(scratch.store(_linked_blocks(again, compare, turn), f"{name}-turn-{turn}"))
        edges = edges.unionAll(_joins(turns[-1]))
        standing = turns[-1].filter("payload is not null")
        if most == 1 or 2 * standing.count() > before:
            break
    parts = scratch.store(_parts(turns), f"{name}-parts")
    left = scratch.store(_open_groups(parts), f"{name}-open")
    if left.isEmpty():
        return edges
    # Stored, as Spark then knows how few there are.
    nodes = scratch.store(parts.join(left, "of").drop("load"), f"{name}-apart")
    scratch.drop(f"{name}-parts", f"{name}-open")
    payload = payload_of(nodes.select("node").distinct())
    return edges.unionAll(_open_pairs(payload.join(nodes, "node"), compare))


def _joins(turn: DataFrame) -> DataFrame:
    return turn.filter("node != part").select(F.col("node").alias("a"), F.col("part").alias("b"))


def _parts(turns: list[DataFrame]) -> DataFrame:
    """``(of, node, part, load)``: the component of each member of a group of several blocks.

    The last turns, which are the smallest, are followed first.
    """
    upper = None
    for turn in reversed([turns[0].filter("blocks > 1"), *turns[1:]]):
        own = turn.select("of", "node", "part", "load")
        if upper is not None:
            upper = upper.select("of", F.col("node").alias("part"), F.col("part").alias("upper"))
            own = own.join(upper, ["of", "part"], "left").select(
                "of", "node", F.coalesce("upper", "part").alias("part"), "load"
            )
        upper = own
    return upper


def _open_groups(parts: DataFrame) -> DataFrame:
    """``(of, largest, inner, outer)`` for groups of several components, with their numbers of blocks."""
    sizes = parts.groupBy("of", "part").agg(F.sum("load").alias("load"))
    largest = F.max(F.struct("load", "part"))

    def blocks(load: Column) -> Column:
        return F.greatest(F.ceil(load / _ACROSS_LOAD), F.lit(1)).cast("int")

    return (
        sizes.groupBy("of")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("load").alias("all"), largest.alias("l"))
        .filter("n > 1")
        .select(
            "of",
            F.col("l.part").alias("largest"),
            blocks(F.col("l.load")).alias("inner"),
            blocks(F.col("all") - F.col("l.load")).alias("outer"),
        )
    )


def _open_pairs(members: DataFrame, compare: Compare) -> DataFrame:
    """Edges between the components of groups that fell into several."""
    inside = F.col("part") == F.col("largest")
    place = F.xxhash64("node", F.lit(-1))
    block = F.when(inside, F.pmod(place, F.col("inner"))).otherwise(
        F.col("inner") + F.pmod(place, F.col("outer"))
    )
    meets = F.sequence(F.when(inside, F.col("inner")).otherwise(0), F.expr("inner + outer - 1"))
    node = members.schema["node"].dataType.simpleString()
    return (
        members.withColumn("block", block.cast("int"))
        .withColumn("other", F.explode(meets))
        .select(
            "of", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "block", "node", "part", "payload",
        )
        .repartition("of", "low", "high")
        .sortWithinPartitions("of", "low", "high", "node")
        .mapInArrow(_across(compare), f"a {node}, b {node}")
    )
