"""A text corpus from raw documents: five stages, each on all that its predecessor kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written and read again as the
next stage's ``docs``.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import decontaminate, langid, neardup, pii
from tallymart.llm.queries import packed, table
from tallymart.llm.storage import landed, prepared

#: Bits by which the best language's code must exceed plain bytes of 8 bits to speak against every language.
EXCESS_BITS = 200.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, with ``lang`` as predicted.

    Rejected are texts without a letter, and those whose code in every language is ``EXCESS_BITS`` longer than
    their plain bytes.
    """
    prepared(spark)
    found = langid.identify(docs, langid.train(docs))
    excess = (F.col("bits_per_byte") - 8) * F.octet_length("text")
    kept = found.filter((F.col("lang_pred") != langid.UNKNOWN) & (excess < EXCESS_BITS))
    return kept.withColumn("lang", F.col("lang_pred")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest ``doc_id``, then hash of the text.

    Of rows of that id and text one stays, the first in the order of its other columns.  Unlike texts that
    share an id are in groups of their own; rows without an id or a word are in no group and all stay.
    """
    found = neardup.classes(docs).filter("component is not null").groupBy("component", "doc_id", "t").agg(F.count("*").alias("n"))
    found = landed(found, "copies")
    one = F.min(F.struct("doc_id", "t", "n")).alias("one")
    first = landed(found.groupBy("component").agg(one).select("one.*"), "first")
    key = ["__dedup_id", "__dedup_hash"]
    names = [F.col("doc_id").alias("__dedup_id"), F.col("t").alias("__dedup_hash")]
    aside = found.select(*names).join(first.select(*names), key, "left_anti")
    again = first.filter("n > 1").select(*names)
    aside, again = (decontaminate.if_small(landed(df, name)) for df, name in ((aside, "aside"), (again, "again")))
    rows = docs.select("*", F.col("doc_id").cast("long").alias("__dedup_id"), F.xxhash64("text").alias("__dedup_hash"))
    rest = F.struct("doc_id", "text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    single = rows.join(aside, key, "left_anti").join(again, key, "left_anti").select(docs.columns)
    repeated = rows.join(again, key, "left_semi").groupBy(*key).agg(F.min(rest).alias("rest")).select("rest.*")
    return single.unionByName(repeated.select(docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark occurs."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked, and ``n_chars`` counted anew."""
    hidden = pii.masked(docs)
    return hidden.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, placed: the pipeline's result."""
    return packed(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("packing", packing),
]

#: Stages learn a model, follow chains of links and tokenise, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name)
    return docs
