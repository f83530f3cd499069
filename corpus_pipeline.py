"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input.

1. quality classifier: documents that it rejects go; 2. exact dedup: one of each group of equal texts stays;
3. n-gram Jaccard join: one of each group of near copies stays; 4. benchmark decontamination: contaminated
documents go; 5. BPE encoding and decoding: the token ids of each document that is left, and the text that they give.

All stages but the last return the columns of their input, whatever these are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from econ_lake.llm import bpe, decontaminate, exact_dedup, jaccard_join, quality
from econ_lake.llm.queries import tokenizer_path
from econ_lake.llm.shared import release, stored, table, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, n_tokens, ids and the text decoded from the ids."""
    return bpe.encode(docs, tokenizer_path(spark, "word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", good_documents),
    ("exact_dedup", distinct_texts),
    ("jaccard_join", one_of_near_copies),
    ("decontamination", uncontaminated),
    ("bpe", token_ids),
]

#: A trained classifier and a tokenizer can't be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage gives for ``documents``."""
    docs, first = table(spark, sf_dir, "documents"), written()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        release(spark, first)  # what the stage wrote on its way, and its input
    return docs


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
