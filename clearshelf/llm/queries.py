"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearshelf.llm import (
    decontaminate, fptree, html, kneser_ney, mixing, pivots, resampling, secrets, sharding, simhash,
    syncmers, toxicity, warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.score_documents(docs, table(spark, sf_dir, "labels"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "held_out", "score", "predicted")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.report(docs, table(spark, sf_dir, "benchmark"))
    joined = F.array_join(F.sort_array("items"), ",")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(joined.cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op5_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return syncmers.fingerprints(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    narrow = sharding.with_group(docs.select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"), "size", "text_crc32", "grp"
    )
    dealt = sharding.shard_rows(narrow)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.simhash_components(docs)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = secrets.scan(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        "n_copied",
        "n_owned",
    )


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score_documents(table(spark, sf_dir, "documents"))


def op11_fptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fptree.rank_documents(docs, table(spark, sf_dir, "benchmark"))


def op12_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.top_inner_products(table(spark, sf_dir, "embeddings"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resampling_scores(docs, table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    fn.__name__: fn
    for fn in (
        op1_warc, op2_toxicity, op3_decontamination, op4_html, op5_syncmers, op6_sharding,
        op7_mixing, op8_simhash, op9_secrets, op10_kneser_ney, op11_fptree, op12_pivots,
        op13_resampling,
    )
}
