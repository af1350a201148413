"""A training-corpus pipeline over ``documents``: each stage calls one operator
of ``quire.llm`` on everything that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import kneser_ney, mixing, packing, pii, simhash
from quire.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model of trusted text rejects go."""
    return kneser_ney.keep_good(spark, docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id."""
    return simhash.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; all rows stay."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The production mix; a document is repeated once per epoch that takes it."""
    return mixing.mix(docs)[0].select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids and their places in sequences."""
    return packing.pack(docs, *packing.vocabulary())


#: (name, function): each function's result is written as Parquet and read again as the next one's documents.
STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing", source_mix),
    ("packing", sequences),
]

#: The pipeline has models and iterations that SQL can't express; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after another, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
