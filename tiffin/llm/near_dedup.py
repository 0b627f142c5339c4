"""Near duplicates: MinHash signatures, banding, verification, components by stars.

1. One pass over the texts gives each document the number and the fingerprint of its distinct word
   shingles, and a signature of ``bands * rows`` minima under universal hash functions. Documents with
   the same fingerprint are one class; all further work is on classes, so exact copies cost nothing.
   A class gets a number when it is stored, and goes by its eight bytes from there.
2. A class enters one bucket per band. Buckets of one class are left out by their counts alone; of the
   others, those of the same members are worked on once.
3. Signatures, cut to one byte per minimum, verify the pairs of a bucket: those whose estimate lies within 6.5 standard errors of the
   threshold, or above, are candidates. Only edges that join a bucket's candidates leave the task.
4. The components of candidate edges bring together all classes that can be linked. Their full shingle
   sets, computed again from the texts of these classes alone, confirm links exactly; again only joining
   edges leave the task, and their components are the result.

Steps 3 and 4 compare many members in one task as arrays. A bucket or component beyond a task's bound
is cut into blocks (``linking``), so no group is too large and no pair is left out. A pair at the threshold is in no common bucket with a probability of ``(1 - t^rows)^bands``:
7.4e-8 with the defaults at 0.85, 1.5e-5 at 0.8, and less above it. The signature check adds 4e-9 and 2e-9 (binomial
tails of 140 minima): 8e-8 and 1.5e-5 in all.

Defined cases: a NULL text, or one without words, has no shingles and links with nothing; a text of
fewer words is one shingle; a NULL identifier counts as larger than any other; rows with equal
identifiers are rows of their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.components import connected_components
from tiffin.llm.linking import by_set, by_signature, linked
from tiffin.llm.scratch import Scratch
from tiffin.llm.texts import Shingler, binary_rows, mixed

WIDTH = 5
BANDS = 28
ROWS = 5
# Fixed value: how far below the threshold an estimate may lie. With 4, a pair at the threshold fails in 1e-4 of cases.
_ERRORS = 6.5
# Up to some thousand members, comparing them in one task is cheaper than a further turn.
BLOCK_MEMBERS = 4096
BLOCK_SHINGLES = 1 << 20
_CHUNK = 1024
# More turns than a group can need: each halves its members at least.
_TURNS = 64
_EMPTY = np.uint32(0xFFFFFFFF)


_PLACE = np.random.default_rng(11).integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit hash for each band of the minima."""
    rows = signature.reshape(bands, -1).astype(np.uint64)
    place = np.resize(_PLACE, rows.shape[1])
    number = np.arange(1, bands + 1, dtype=np.uint64)
    return mixed((mixed(rows + np.uint64(1)) * place).sum(axis=1) + mixed(number)).view(np.int64)


class MinHash:
    """Minima of a set of 64-bit values under functions ``(a * x + b) mod 2^32`` with odd ``a``."""

    def __init__(self, functions: int):
        rng = np.random.default_rng(7)
        self._a = (rng.integers(0, 2**32, functions, dtype=np.uint32) | np.uint32(1))[:, None]
        self._b = rng.integers(0, 2**32, functions, dtype=np.uint32)[:, None]
        self._work = np.empty((functions, _CHUNK), np.uint32)

    def signature(self, values: np.ndarray) -> np.ndarray:
        folded = (values >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self._a), _EMPTY)
        for start in range(0, len(folded), _CHUNK):
            part = folded[start : start + _CHUNK]
            work = self._work[:, : len(part)]
            np.multiply(self._a, part, out=work)
            np.add(work, self._b, out=work)
            np.minimum(least, work.min(axis=1), out=least)
        return least


_PROFILE = "doc_id {id}, n_shingles long, class binary, signature binary, keys array<long>"


def _profiling(width: int, bands: int, rows: int):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, minhash = Shingler(width), MinHash(bands * rows)
        for batch in batches:
            sizes, classes, signatures, keys = [], [], [], []
            for text in binary_rows(batch.column(1)):
                found = shingler.shingles(text)
                minima = minhash.signature(found)
                sizes.append(len(found))
                classes.append(fingerprint(found) if len(found) else None)
                signatures.append(minima.astype(np.uint8).tobytes() if len(found) else None)
                keys.append(band_keys(minima, bands) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "class", "signature", "keys"],
            )

    return profile


def fingerprint(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _encoded(text: Column) -> Column:
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def _candidates(
    classes: DataFrame, scratch: Scratch, least: float, block_members: int
) -> DataFrame:
    """Edges between classes that share a bucket and have similar signatures."""
    banded = classes.select(F.explode("keys").alias("bucket"), "node")
    # Most buckets hold one class: only their numbers meet in a shuffle that sees all of them.
    counts = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = scratch.store(counts, "buckets")
    common = scratch.store(banded.join(buckets, "bucket"), "common")
    mark = F.xxhash64("node")
    alike = common.groupBy("bucket", "n").agg(
        F.bit_xor(mark).alias("x"), F.sum(F.shiftright(mark, 32)).alias("s")
    )
    distinct = alike.groupBy("n", "x", "s").agg(F.min("bucket").alias("bucket"))
    signatures = classes.select("node", F.col("signature").alias("payload"))
    members = (
        common.join(distinct.select("bucket"), "bucket")
        .join(signatures, "node")
        .select(
            F.col("bucket").alias("of"),
            F.ceil(F.col("n") / block_members).alias("blocks"),
            "node",
            F.lit(1 / block_members).alias("load"),
            "payload",
        )
    )
    return linked(members, by_signature(least, np.uint8), lambda nodes: signatures, scratch, "candidates")


_SET = "class binary, payload binary"


def _shingle_sets(width: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                found = [shingler.shingles(t) for t in binary_rows(batch.column(0).slice(start, 256))]
                found = [s for s in found if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([fingerprint(s) for s in found], pa.binary()),
                        pa.array([s.tobytes() for s in found], pa.binary()),
                    ],
                    names=["class", "payload"],
                )

    return sets


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, width: int = WIDTH,
    bands: int = BANDS, rows: int = ROWS, block_members: int = BLOCK_MEMBERS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Documents are linked if ``percent`` of the union of their shingle sets is common to both. The members
    and shingles of a block bound what a task compares at once, not what is compared in all.
    """
    scratch = Scratch(docs.sparkSession, "near_dedup")
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = _PROFILE.format(id=texts.schema["doc_id"].dataType.simpleString())
    # Two tables of one pass: what every document needs to the end, and what its class is found by.
    profiled = scratch.store(
        texts.select("doc_id", _encoded(F.col("text"))).mapInArrow(_profiling(width, bands, rows), schema),
        "profiled",
    )
    classes = scratch.store(
        profiled.filter(F.col("class").isNotNull())
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("smallest"),
            F.count(F.lit(1)).alias("copies"),
            F.max("n_shingles").alias("n_shingles"),
            F.max("signature").alias("signature"),
            F.max("keys").alias("keys"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    profiles = scratch.store(profiled.select("doc_id", "n_shingles", "class"), "profiles")
    scratch.drop("profiled")
    t = percent / 100
    least = t - _ERRORS * (t * (1 - t) / (bands * rows)) ** 0.5
    candidates = _candidates(classes, scratch, least, block_members)
    together = scratch.store(connected_components(candidates, scratch, "candidates"), "together")
    known = scratch.store(classes.drop("signature", "keys"), "known")
    scratch.drop("classes", "buckets", "common", *(f"candidates-turn-{turn}" for turn in range(_TURNS)))
    load = F.col("n_shingles") / block_shingles + 1 / block_members
    links = _confirmed(texts, known, together, scratch, percent, width, load)
    components = scratch.store(connected_components(links, scratch, "links"), "components")
    scratch.drop("together", "needed", *(f"confirmed-turn-{turn}" for turn in range(_TURNS)))
    return _labelled(profiles, known, components, scratch)


def _confirmed(texts: DataFrame, classes: DataFrame, together: DataFrame, scratch: Scratch,
               percent: int, width: int, load: Column) -> DataFrame:
    """Edges between classes whose full shingle sets are similar enough."""
    wanted = together.withColumnRenamed("root", "of").join(
        classes.select("node", "class", "smallest", load.alias("load")), "node"
    )
    groups = wanted.groupBy("of").agg(F.ceil(F.sum("load")).alias("blocks"))
    needed = scratch.store(wanted.join(groups, "of"), "needed")

    def sets_of(rows: DataFrame) -> DataFrame:
        # One row of each class has the class's smallest identifier; its text gives the set again.
        owners = rows.select(F.col("smallest").alias("owner")).distinct()
        return (
            texts.join(owners, F.col("doc_id").eqNullSafe(F.col("owner")), "left_semi")
            .select(_encoded(F.col("text")))
            .mapInArrow(_shingle_sets(width), _SET)
        )

    def sets_again(nodes: DataFrame) -> DataFrame:
        wanted = needed.join(nodes, "node", "left_semi")
        return wanted.select("node", "class").join(sets_of(wanted), "class").select("node", "payload")

    members = needed.drop("smallest").join(sets_of(needed), "class").drop("class")
    return linked(members, by_set(percent), sets_again, scratch, "confirmed")


def _labelled(
    profiles: DataFrame, classes: DataFrame, components: DataFrame, scratch: Scratch
) -> DataFrame:
    """The smallest identifier of the component of each document."""
    grouped = classes.select("node", "class", "smallest", "copies").join(components, "node", "left")
    least = components.join(classes.select("node", "smallest"), "node")
    least = least.groupBy("root").agg(F.min("smallest").alias("component_id"))
    shared = scratch.store(
        grouped.filter("copies > 1 or root is not null")
        .join(least, "root", "left")
        .select(
            "class",
            F.when(F.col("root").isNull(), F.col("smallest"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
            F.lit(True).alias("shared"),
        ),
        "shared",
    )
    component = F.when(F.col("shared"), F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        profiles.select("doc_id", "n_shingles", "class")
        .join(shared, "class", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
