"""Shards of near equal size: contiguous runs in the order of the identifiers.

One shuffle puts the rows in order over range partitions, where each task adds up sizes as rows pass.
The totals of the partitions give the bytes and rows before each partition, and with them the global
position of each row; equal cuts of the grand total make the shards. A task sees its own partition, and
the only table that meets all rows has one row per partition.

A row belongs to the shard that holds the middle of its bytes: shards differ from equal by less than
the longest row. Slots number the rows of a shard from 0.

Defined cases: a NULL text has no bytes and still the overhead; NULL identifiers come first; rows with
equal identifiers are ordered by checksum and size, and rows equal in all of these take their places in
any order; a shard may stay empty beside a row larger than a shard; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.scratch import Scratch
from tiffin.llm.texts import crc32, utf8_bytes

SHARDS = 24
OVERHEAD = 8
_ORDER = ["doc_id", "text_crc32", "size"]


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of the partition, and the bytes and rows before each row within it."""
    part = TaskContext.get().partitionId()
    n_bytes = n_rows = 0
    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index("size")).to_numpy()
        ends = n_bytes + np.cumsum(sizes)
        columns = [
            *batch.columns,
            pa.array(np.full(len(sizes), part, np.int32)),
            pa.array(ends - sizes),
            pa.array(n_rows + np.arange(len(sizes))),
        ]
        names = [*batch.schema.names, "part", "bytes_within", "rows_within"]
        yield pa.RecordBatch.from_arrays(columns, names=names)
        if len(sizes):
            n_bytes, n_rows = int(ends[-1]), n_rows + len(sizes)


def _placed(
    docs: DataFrame, key: str, text: str, shards: int, overhead: int, carry: list[str]
) -> DataFrame:
    """``(doc_id, size, text_crc32, row, shard, slot)``; ``row`` holds the columns of ``carry``."""
    scratch = Scratch(docs.sparkSession, "sharding")
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (utf8_bytes(F.col(text)) + overhead).alias("size"),
        crc32(F.col(text)).alias("text_crc32"),
        *([F.struct(*carry).alias("row")] if carry else []),
    )
    schema = (
        T.StructType(rows.schema.fields)
        .add("part", T.IntegerType())
        .add("bytes_within", T.LongType())
        .add("rows_within", T.LongType())
    )
    ordered = scratch.store(
        rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).mapInArrow(_running, schema),
        "ordered",
    )
    totals = ordered.groupBy("part").agg(
        F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows")
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = scratch.store(
        totals.select(
            "part",
            F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("part_bytes").over(everything).alias("total"),
        ),
        "offsets",
    )
    middle = "bytes_before + bytes_within + size div 2"
    # Decimals keep the product exact whatever the total.
    shard = f"floor(cast({middle} as decimal(30,0)) * {shards} / cast(total as decimal(20,0)))"
    located = (
        ordered.join(offsets, "part")
        .withColumn("shard", F.least(F.expr(shard), F.lit(shards - 1)).cast("int"))
        .withColumn("place", F.col("rows_before") + F.col("rows_within"))
    )
    first = scratch.store(
        located.groupBy("shard").agg(F.min("place").alias("first_place")), "first"
    )
    return located.join(first, "shard").withColumn("slot", F.col("place") - F.col("first_place"))


def shard_by_bytes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS,
    overhead: int = OVERHEAD,
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row per row of ``docs``."""
    return _placed(docs, key, text, shards, overhead, []).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def with_shards(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS,
    overhead: int = OVERHEAD,
) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, which replace columns of these names."""
    carry = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    placed = _placed(docs, key, text, shards, overhead, carry)
    return placed.select(*[F.col("row")[c].alias(c) for c in carry], "shard", "slot")
