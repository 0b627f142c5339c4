"""Mixing sources to target weights by a low-discrepancy schedule.

The words of a source, its documents in shuffled order, are one stream that is cut into blocks of
equal length. The mix is a sequence of slots, each to be filled with one block: slot ``k`` maps to the
golden-ratio point ``frac(k / phi)``, and the source whose range of cumulative weights holds the point
gets the slot. So every stretch of the mix, not only the whole, is close to the target weights. Slots
are ranked per source, and a source's slot of rank ``r`` takes its block ``r`` modulo its blocks.

A source of which the mix would hold few common blocks is cut into blocks of its own length, at most
1 / ``_FINE`` of its words and of its target. It takes them one after the other until their words, part-filled
blocks counted as they are, come nearest to its target, at slots from a golden-ratio sequence of its own.

A source's target is its share of all words by weight, but at most ``repeats`` times its own size; what
is left over is shared again by weight. Targets follow in one step from the order of size / weight, in
which the sources at their limit come first.

Shuffled order and running sums use buckets of the identifiers' hashes, so a source with a third of
all documents is spread like any other.

Defined cases: a NULL source is a source of its own, after all others; a NULL or empty text has size
0 and is never taken; rows with equal identifiers are ordered by size; an empty table, or one without words,
has nothing to take; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.scratch import Scratch
from tiffin.llm.texts import word_count

WEIGHTS = (1, 2, 3)
REPEATS = 3
SLOTS = 1 << 18
SEED = "mix-1"
# Fixed value: the fraction of the golden ratio, in units of 2^-32.
GOLDEN = 2654435769
_RING = 1 << 32
_BUCKET_ROWS = 5000
_RANGES = 4096
# Fixed value: a source's block is at most this part of its words and of its target.
_FINE = 300


@dataclass(frozen=True)
class Mix:
    """The tables of a mix.

    ``sources``: ``(source, source_rank, weight, source_size, target)``.
    ``schedule``: ``(slot, source_rank, block)``, in the order of the mix; blocks of a source's own length are
    in slots of other sources, too.
    ``pieces``: ``(row, source_rank, block, words)``, the words each row of ``documents`` has in each block,
    less blocks of a source's own length that are not taken.
    ``documents``: ``(row, doc_id, source, source_rank, size, middle_block)``.
    """

    sources: DataFrame
    schedule: DataFrame
    pieces: DataFrame
    documents: DataFrame


def _sources(sizes: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """One row per source; the windows see these rows only."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("source_rank") % len(weights) + 1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    by_limit = Window.orderBy(
        (F.col("source_size") * repeats / F.col("weight")).asc(), "source_rank"
    )
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    limited = (
        totals.withColumn("source_rank", rank)
        .withColumn("weight", weight.cast("long"))
        .withColumn("limit", F.col("source_size") * repeats)
        .withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("left_words", F.col("all_words") - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("left_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    # In this order the limit holds for a first stretch of sources; the rest share what these leave.
    reached = F.col("limit") * F.col("left_weight") <= F.col("left_words") * F.col("weight")
    first_free = Window.orderBy(F.col("reached").cast("int")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    free = F.struct(
        F.when(~F.col("reached"), F.col("left_weight")).alias("w"), F.col("left_words").alias("n")
    )
    level = F.max(F.when(~F.col("reached"), free)).over(first_free)
    target = F.when(F.col("reached"), F.col("limit").cast("double")).otherwise(
        level["n"].cast("double") * F.col("weight") / level["w"]
    )
    return (
        limited.withColumn("reached", reached)
        .withColumn("target", target)
        .select("source", "source_rank", "weight", "source_size", "target", "all_words")
    )


def shuffle_hash(*parts: Column) -> Column:
    """48 bits of an MD5, the same in any engine."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def mix_sources(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, slots: int = SLOTS, seed: str = SEED,
) -> Mix:
    """``slots`` sets how fine the mix is: a block has ``1 / slots`` of all words, one word at least."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes = scratch.store(
        docs.select(
            F.col(key).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
        ),
        "sizes",
    )
    words, rows = sizes.agg(F.sum("size"), F.count(F.lit(1))).first()
    words = words or 0
    block = max(1, -(-words // slots))
    sources = scratch.store(_cut(_sources(sizes, weights, repeats), block), "sources")
    documents = scratch.store(_in_order(sizes, sources, rows, seed), "documents")
    # Of an own length, only blocks that are taken: a large source with a small target has very many.
    end = F.least(F.col("start") + F.col("size"), F.coalesce(F.col("takes") * F.col("length"), F.lit((1 << 63) - 1)))
    first, last = F.expr("start div length"), F.expr("(end - 1) div length")
    pieces = (
        documents.withColumn("end", end)
        .filter("size > 0 and end > start")
        .select("row", "source_rank", "start", "end", "length", F.explode(F.sequence(first, last)).alias("block"))
        .withColumn("from", F.greatest(F.col("start"), F.col("block") * F.col("length")))
        .withColumn("to", F.least(F.col("end"), (F.col("block") + 1) * F.col("length")))
        .select("row", "source_rank", "block", (F.col("to") - F.col("from")).alias("words"))
    )
    schedule = scratch.store(
        _schedule(docs.sparkSession, sources, -(-words // block) if words else 0, block, repeats),
        "schedule",
    )
    documents = documents.select(
        "row", "doc_id", "source", "source_rank", "size",
        F.when(F.col("size") > 0, F.expr("(start + size div 2) div length")).alias("middle_block"),
    )
    return Mix(sources.drop("all_words", "length", "takes"), schedule, pieces, documents)


def _cut(sources: DataFrame, block: int) -> DataFrame:
    """Adds ``length``, that of a source's blocks, and ``takes``, how many it takes if the length is its own."""
    least = F.least(F.col("source_size"), F.floor("target"))
    own = F.greatest(F.lit(1), F.floor(least / _FINE)).cast("long")
    rounds = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    blocks = F.ceil(F.col("source_size") / F.col("length"))
    rest = F.round((F.col("target") - rounds * F.col("source_size")) / F.col("length"))
    takes = (rounds * blocks + F.least(rest, blocks)).cast("long")
    return sources.withColumn("length", F.least(own, F.lit(block).cast("long"))).withColumn(
        "takes", F.when(F.col("length") < block, takes)
    )


def _in_order(sizes: DataFrame, sources: DataFrame, rows: int, seed: str) -> DataFrame:
    """Every document with the start of its words in the shuffled stream of its source."""
    buckets = max(1, min(1 << 22, rows // _BUCKET_ROWS))
    ranked = (
        sizes.withColumn("place", shuffle_hash(F.lit(seed), F.col("doc_id")))
        .withColumn("bucket", F.expr(f"place div {-(-(1 << 48) // buckets)}"))
    )
    bucket_words = ranked.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_words"))
    before = (
        Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = bucket_words.select(
        "source", "bucket", F.coalesce(F.sum("bucket_words").over(before), F.lit(0)).alias("offset")
    ).join(
        sources.select(F.col("source").alias("known"), "source_rank", "length", "takes"),
        F.col("source").eqNullSafe(F.col("known")),
    )
    offsets = offsets.select(
        F.col("source").alias("of"), F.col("bucket").alias("at"), "offset", "source_rank", "length", "takes"
    )
    within = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size")
    start = F.coalesce(
        F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        ranked.withColumn("within", start)
        .join(offsets, (F.col("bucket") == F.col("at")) & F.col("source").eqNullSafe(F.col("of")))
        .select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id", "source", "source_rank", "size",
            (F.col("offset") + F.col("within")).alias("start"), "length", "takes",
        )
    )


def _schedule(spark, sources: DataFrame, slots: int, block: int, repeats: int) -> DataFrame:
    """Which block each slot takes."""
    before = Window.orderBy("source_rank").rowsBetween(Window.unboundedPreceding, 0)
    shares = sources.withColumn("upto", F.sum("target").over(before) / F.col("all_words"))
    lower = F.coalesce(F.lag("upto").over(Window.orderBy("source_rank")), F.lit(0.0))
    last = F.col("source_rank") == F.max("source_rank").over(
        Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    ranges = (
        shares.filter("target > 0")
        .withColumn("common", F.col("takes").isNull())
        .withColumn("lower", lower)
        .withColumn("upper", F.when(last, F.lit(2.0)).otherwise(F.col("upto")))
        .withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
    )
    # Points and ranges meet on equal stretches of the unit interval.
    from_stretch = F.floor(F.col("lower") * _RANGES)
    to_stretch = F.least(F.floor(F.col("upper") * _RANGES), F.lit(_RANGES - 1))
    ranges = ranges.filter("common").select(
        "source_rank", "lower", "upper", "blocks",
        F.explode(F.sequence(F.least(from_stretch, to_stretch), to_stretch)).alias("stretch"),
    )
    point = F.pmod(F.col("id") * GOLDEN, F.lit(_RING)) / F.lit(float(_RING))
    points = spark.range(slots).select(F.col("id").alias("slot"), point.alias("point"))
    hits = (
        points.withColumn("stretch", F.floor(F.col("point") * _RANGES))
        .join(ranges, "stretch")
        .filter("point >= lower and point < upper")
    )
    common = _ranked(hits, slots).filter(F.col("rank") < F.col("blocks") * repeats).select(
        "slot", "source_rank", (F.col("rank") % F.col("blocks")).alias("block")
    )
    return common.unionByName(_own_schedule(sources, slots))


def _own_schedule(sources: DataFrame, slots: int) -> DataFrame:
    """The blocks of sources that have a length of their own.

    Such a source takes as many blocks as its target asks for, some hundreds. Its points are frac((k + phase) / phi), so
    they spread over all slots as those of the common sequence do; slots are ranked, and the r-th takes block r.
    """
    blocks = F.ceil(F.col("source_size") / F.col("length")).cast("long")
    takes = sources.filter("takes > 0").select(
        "source_rank", "takes", blocks.alias("blocks"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("takes") - 1)).alias("k"),
    )
    # Each source starts elsewhere, so that many small ones do not meet in the same slots.
    step = F.col("k") + F.col("source_rank") * _FINE + 1
    point = F.pmod(F.pmod(step, F.lit(_RING)) * GOLDEN, F.lit(_RING)) / F.lit(float(_RING))
    slot = F.least(F.floor(point * slots), F.lit(slots - 1)).cast("long")
    in_order = Window.partitionBy("source_rank").orderBy("slot", "k")
    return (
        takes.withColumn("slot", slot)
        .withColumn("rank", F.row_number().over(in_order).cast("long") - 1)
        .select(
            "slot", F.col("source_rank").cast("int").alias("source_rank"), (F.col("rank") % F.col("blocks")).alias("block")
        )
    )


def _ranked(hits: DataFrame, slots: int) -> DataFrame:
    """Ranks slots within their source, over stretches of slots so that no source is one group."""
    stretch = max(1, min(_BUCKET_ROWS, slots))
    hits = hits.withColumn("part", F.expr(f"slot div {stretch}"))
    counts = hits.groupBy("source_rank", "part").agg(F.count(F.lit(1)).alias("n"))
    before = (
        Window.partitionBy("source_rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(
        "source_rank", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")
    )
    within = F.row_number().over(Window.partitionBy("source_rank", "part").orderBy("slot")) - 1
    return hits.withColumn("within", within).join(offsets, ["source_rank", "part"]).withColumn(
        "rank", F.col("ahead") + F.col("within")
    )


def taken_words(mix: Mix) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, source)``, one row per document of the mix."""
    uses = mix.schedule.groupBy("source_rank", "block").agg(F.count(F.lit(1)).alias("uses"))
    taken = (
        mix.pieces.join(uses, ["source_rank", "block"])
        .groupBy("row")
        .agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
    )
    sources = mix.sources.select("source_rank", "source_size", "target")
    return (
        mix.documents.join(taken, "row", "left")
        .join(sources, "source_rank")
        .select(
            "doc_id", "size", "source_size", "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
            "source",
        )
    )


def whole_copies(mix: Mix) -> DataFrame:
    """``(doc_id, copies)``: how often a document is in a mix of whole documents, if at all.

    A document is taken as often as the block that holds its middle word. Of rows with equal
    identifiers, the one that is taken most often counts.
    """
    uses = mix.schedule.groupBy("source_rank", F.col("block").alias("middle_block")).agg(
        F.count(F.lit(1)).alias("copies")
    )
    taken = mix.documents.join(uses, ["source_rank", "middle_block"])
    return taken.groupBy("doc_id").agg(F.max("copies").alias("copies"))
