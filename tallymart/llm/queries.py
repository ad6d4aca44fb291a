"""Registered queries of the text operators, on whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import codes, decontaminate, factors, fingerprints, htmldiff, langid, merkle, neardup, oracle, packing, pii, sharding, toxicity, warc
from tallymart.llm.storage import landed, prepared, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> Column:
    """Rows that nothing is learnt from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out()).select("doc_id", "toxic")
    found = toxicity.score(documents, toxicity.train(documents, labels))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = langid.identify(documents.select("doc_id", "text"), langid.train(documents))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def packed(documents: DataFrame) -> DataFrame:
    """Placed pieces of documents with the checksum of their ids; the ids themselves are not moved."""
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.with_checksum(packing.pieces(documents, path, capacity=4096, end_id=1))
    return packing.pack(landed(rows, "pieces"), capacity=4096)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    pages = warc.with_revisits(table(spark, sf_dir, "pages"))
    names = landed(warc.write_monolithic(pages, f"{folder}/monolithic"), "names")
    index = landed(warc.normalise(spark, names, f"{folder}/monolithic", f"{folder}/members"), "index")
    return warc.read(index, f"{folder}/members").drop("payload")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(pii.personal_data(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), count=16)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmldiff.main_text(table(spark, sf_dir, "pages"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    labels = table(spark, sf_dir, "labels").filter(~held).select("doc_id", "quality")
    found = factors.score(documents, factors.train(documents, labels))
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")


def op12_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
