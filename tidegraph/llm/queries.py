"""The queries of the corpus operators: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, embedding, exact, html_text, infill, minhash, mixing, packing, quality, substring, topk, toxicity, warc
from .common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))).withColumn("held_out", quality.held_out())


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    out = toxicity.score(docs, net).withColumn("held_out", toxicity.held_out())
    return out.select("doc_id", "held_out", "score", (F.col("score") >= toxicity.PREDICT).cast("int").alias("predicted"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op6_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), with_ids=False)


def op10_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.transform(table(spark, sf_dir, "documents").select("doc_id", "text"), with_output=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_co_training": op1_quality_co_training,
    "op2_mix_sources": op2_mix_sources,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_warc_salvage": op6_warc_salvage,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_html_main_text": op8_html_main_text,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_pivot_top_k": op10_pivot_top_k,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_source_divergence": op12_source_divergence,
    "op13_fill_in_middle": op13_fill_in_middle,
}
