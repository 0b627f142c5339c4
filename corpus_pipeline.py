"""The corpus pipeline: documents go through five operators, one after the other.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it left. All but the
last return the columns of ``documents``. Rows are kept and dropped one by one, also where identifiers are
NULL or repeated: operators know a row by its identifier and the hash of its columns, the same in every pass.
Rows that are equal in all columns are near duplicates of each other, if they have words, and one stays. After
mixing, a document that is taken more than once is there as often.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import decontamination, mixing, near_dedup, quality, sharding
from tiffin.llm.scratch import Scratch, scratch_made

# Near duplicates: five words, a similarity of 0.8 or more.
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier accepts."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates, that of the smallest doc_id."""
    scratch = Scratch(spark, "near_dedup_stage")
    rows, texts = _rows(docs), _texts(docs, "text")
    found = near_dedup.near_duplicates(texts, percent=NEAR_PERCENT)
    found = found.groupBy(F.col("doc_id").alias("key"), "kept").agg(
        F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("n_shingles")
    )
    equal = F.col("kept") & (F.col("n") > 1) & (F.col("n_shingles") > 0)
    odd = scratch.store(found.filter(~F.col("kept") | equal).select("key", "kept"), "odd")
    single = rows.join(odd.select("key"), F.col("id") == F.col("key"), "left_anti")
    repeated = odd.filter("kept").select("key")
    if not repeated.isEmpty():
        once = rows.join(repeated, F.col("id") == F.col("key"), "left_semi").dropDuplicates(["id"])
        single = single.unionByName(once)
    return single.select("row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item, also of one without an identifier."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contamination(_texts(docs, "text"), benchmark).filter("contaminated")
    # Stored first, so that their size is known.
    scratch = Scratch(spark, "decontamination_stage")
    dropped = scratch.store(found.select(F.col("doc_id").alias("key")).distinct(), "dropped")
    kept = _rows(docs).join(dropped, F.col("id") == F.col("key"), "left_anti")
    return kept.select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix of the sources does, up to three times or not at all."""
    copies = mixing.whole_copies(mixing.mix_sources(_texts(docs, "text", "source")))
    taken = _rows(docs).join(copies, F.col("id") == F.col("doc_id"))
    once_each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return taken.select("row", once_each.alias("copy")).select("row.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``shard`` and ``slot``."""
    return sharding.with_shards(docs)


def _key(docs: DataFrame) -> Column:
    """The key of a row: first by ``doc_id``, NULL last, then by the hash of all columns."""
    # The hash passes over NULL, so it also gets which columns are NULL.
    content = [x for c in docs.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.struct(
        F.col("doc_id").isNull().alias("unknown"),
        F.col("doc_id").alias("id"),
        F.xxhash64(*content).alias("content"),
    )


def _rows(docs: DataFrame) -> DataFrame:
    """``(row, id)``: all columns in one, so that none of their names meets another, and the key of the row."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _key(docs).alias("id"))


def _texts(docs: DataFrame, *columns: str) -> DataFrame:
    """What operators read of the rows: ``doc_id`` is their key here."""
    return docs.select(_key(docs).alias("doc_id"), *columns)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_FUNCTIONS = (quality_stage, near_dedup_stage, decontamination_stage, mixing_stage, sharding_stage)

#: The scratch folders of each stage's last run, by application and stage.
_made: dict[tuple[str, int], list[Scratch]] = {}


def _tidy(number: int) -> Stage:
    """A stage that first removes what the stage before it has left behind.

    Its result, given here as a stored table, needs that no longer. Given a plan that still reads it, the stage
    leaves it there.
    """
    function = _FUNCTIONS[number]

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        before = _made.pop((application, number - 1), [])
        for scratch in before:
            if not scratch.read_by(docs):
                scratch.close()
        with scratch_made() as made:
            out = function(spark, docs, sf_dir)
        _made[application, number] = made
        return out

    return run


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", _tidy(0)),
    ("MinHash near-dedup", _tidy(1)),
    ("benchmark decontamination", _tidy(2)),
    ("mixing sources to target weights", _tidy(3)),
    ("sharding", _tidy(4)),
]

# A trained classifier has no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that all stages make of ``documents``; each stage's rows are written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.store(stage(spark, docs, sf_dir), f"stage-{i}")
        if i:
            scratch.drop(f"stage-{i - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
