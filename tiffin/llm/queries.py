"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import (
    chat,
    decontamination,
    exact_dedup,
    lexical_search,
    licenses,
    mixing,
    near_dedup,
    quality,
    sharding,
    spelling,
    token_counts,
    url_filters,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, sf_dir, "pages")).drop("pattern")


def license_path() -> Column:
    """A place for each document in a tree of folders, as the table has none.

    Every fifth document is a license file: of its source, of a folder in it, or of a folder below that.
    """
    source = F.coalesce("source", F.lit("none"))
    upper, lower = F.expr("doc_id div 100"), F.expr("doc_id div 10 % 10")
    return (
        F.when(F.expr("doc_id % 20 = 0"), F.format_string("%s/LICENSE.%d", source, "doc_id"))
        .when(F.expr("doc_id % 20 = 5"), F.format_string("%s/g%d/LICENSE.%d", source, upper, "doc_id"))
        .when(
            F.expr("doc_id % 5 = 0"),
            F.format_string("%s/g%d/s%d/LICENSE.%d", source, upper, lower, "doc_id"),
        )
        .when(
            F.expr("doc_id is not null"),
            F.format_string("%s/g%d/s%d/%d.txt", source, upper, lower, "doc_id"),
        )
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select("doc_id", license_path().alias("path"), "text")
    return licenses.scan_licenses(files)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(TOKENIZER)
    return token_counts.token_counts(table(spark, sf_dir, "documents"), path)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(mixing.mix_sources(table(spark, sf_dir, "documents"))).drop("source")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


#: The conversation that the query adds to the table: control strings of another template as texts.
ODD_CONVERSATION = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(TOKENIZER)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionAll(spark.createDataFrame(ODD_CONVERSATION, rows.schema))
    return chat.read_back(chat.format_conversations(rows, path), path)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), noise=199)
    return spelling.spelling_variants(words)


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_url_filters, op2_license_scan, op3_token_counts, op4_near_dedup, op5_warc, op6_mixing,
            op7_decontamination, op8_sharding, op9_quality, op10_exact_dedup,
            op11_chat_format, op12_lexical_search, op13_spelling_variants,
        )
    }
