"""A training corpus from raw documents: known languages, good quality, one of each group of near
copies, packed into sequences.

Each stage takes the rows that its predecessor kept, written as Parquet and read again, and learns
from them alone; all but the last give back whole rows of ``documents``.

All stages read null texts as empty and whole texts however long, keep a row's other columns
whatever their names, and turn an empty table into an empty one. Null keys are kept like any other
until near copies go; there, rows that repeat key and text count as copies. Rows without a label
teach nothing; with no labels at all the quality stage keeps every document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.durable import free, settle
from tidemark.llm import langid, packing, quality, simhash
from tidemark.llm.common import learns
from tidemark.sources.tables import read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language. Languages are learned from the rows not held out for its query."""
    return langid.keep_identified(docs, langid.fit(docs.where(learns("doc_id", 4, 2))))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that look like those labelled good, by the labelled rows not held out."""
    teach = learns("doc_id", 3, 1)
    model = quality.fit(docs.where(teach), read_table(spark, sf_dir, "labels").where(teach))
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id. Copies are what the
    operator's own query links: fingerprints of three-word shingles two bits or fewer apart."""
    return simhash.keep_one_of_each(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("quality_classifier", classify_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, settle(stage(spark, docs, sf_dir), name)
        free(before)
    return docs


ORACLE_SQL = None
