"""Corpus pipeline: documents to a training mix, in five stages.

Each stage is one operator of ``tessera.llm`` and works on everything its predecessor kept. All but the
last return the columns of ``documents``; ``n_chars`` follows the text where a stage changes it.

Edge cases: null and empty texts and texts without a letter go in the first stage; texts of any length pass whole; rows that are repeated or share an id are
judged row by row until near-dedup keeps one of each group; an empty table passes every stage empty; extra columns are carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Documents whose main language holds less than this share of their letters are rejected, as are those without a letter and those whose
#: letters are far less probable than the language's own texts (gibberish).
MIN_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tessera.llm.language_id import UNDETERMINED, identify, label_languages

    labelled = label_languages(docs, identify(docs))
    kept = labelled.where((F.col("lang_pred") != UNDETERMINED) & (F.col("lang_score") >= MIN_LANGUAGE_SCORE) & F.col("like_language"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tessera.llm.line_dedup import dedup_lines

    kept = dedup_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tessera.llm.simhash import one_of_each

    return one_of_each(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tessera.llm.common import table
    from tessera.llm.decontaminate import clean_documents

    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row for each piece of a document in a slot of an output shard."""
    from tessera.llm.mixing import mix

    pieces = mix(docs, weights=(3, 1, 2), share=1.5, max_repeat=2).where("n > 0")
    return pieces.select("shard", "slot", "block", "source", F.col("id").alias("doc_id"), F.col("first").alias("first_word"), F.col("n").alias("n_words"), "text")


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
]

#: The first and third stage are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.common import stash, table

    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
