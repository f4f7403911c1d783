"""The operators applied to whole tables, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boletim.llm import (
    bitpack,
    centroids,
    chat,
    fingerprints,
    html,
    jaccard,
    mixing,
    packing,
    spelling,
    tokens,
    topk,
    toxicity,
    urls,
)
from boletim.llm.common import table
from boletim.storage import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), urls.labelled_urls(spark))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


def op4_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op6_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = toxicity.judge(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "held_out", "score", "predicted")


def op9_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        F.col("doc.doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op11_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "ids")
    bitpack.write(table(spark, sf_dir, "documents"), folder)
    return bitpack.read(spark, folder)


def op12_centroid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_fingerprints,
        op2_url_filter,
        op3_top_k,
        op4_perspectives,
        op5_token_counts,
        op6_template_removal,
        op7_jaccard_join,
        op8_toxicity,
        op9_bin_slack_packing,
        op10_source_mix,
        op11_bit_packing,
        op12_centroid_search,
        op13_spelling_variants,
    )
}
