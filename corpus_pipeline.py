"""A training corpus from raw documents: five stages, each one operator of ``geomedallion.llm``.

Every stage takes the documents that its predecessor kept, reread from Parquet. The first four return the
columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geomedallion.llm import best_fit_packing, decontamination, line_dedup, minhash_dedup, toxicity
from geomedallion.llm.common import added_tokens, scratch_folder, table, tokenizer
from geomedallion.llm.queries import toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores under 0.5.

    Null and empty texts get a score like any other; repeated rows are judged alike and stay or go together; columns
    stay as they are; an empty table gives no rows. With no labels in ``labels`` nothing is toxic.
    """
    return toxicity.drop_toxic(docs, toxicity_model(spark, sf_dir, docs))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source; ``n_chars``, if there is such a column, follows the text.

    Null and empty texts stay; documents without a source form a host of their own; copies of a text count once,
    repeated rows all lose the same lines; an empty table gives no rows.
    """
    cut = line_dedup.drop_boilerplate_lines(docs, host="source")
    if "n_chars" not in docs.columns:
        return cut
    n_chars = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of least ``doc_id``.

    Null and empty texts are no duplicates of anything and stay; of repeated rows one stays; an empty table gives no rows.
    """
    return minhash_dedup.keep_one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item.

    Null and empty texts and items match nothing; repeated rows stay or go together; an empty table gives no rows,
    and an empty benchmark drops none.
    """
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences.

    A null or empty text is one piece, its end token; repeated rows are packed once each; an empty table gives no rows.
    """
    return best_fit_packing.pack_documents(docs, "doc_id", "text", *tokenizer("byte_bpe_50k.tiktoken"), added_tokens("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack),
]

ORACLE_SQL = None  # models, MinHash and packing cannot be said in SQL; tests hold run() against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written to shared storage and reread.

    What happens to nulls, ties, repeated rows and empty tables is what the stages say, in their order.
    """
    docs = table(spark, sf_dir, "documents")
    folder = scratch_folder(spark, "corpus-pipeline")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    return docs
