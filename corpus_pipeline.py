"""A training corpus from the documents: one stage after the other, each a stored table.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs``, and returns the rows
that stay with the columns of documents; the last returns the encoded corpus. ``docs`` must
be a stored table, as the stages number its rows by their place.

Defined cases are those of the operators. Of rows that are equal in doc_id and text one
stays. An empty table goes through all stages and ends empty. Extra columns of documents
are kept up to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from borderlake.llm.common import ROW, read_table, stored
from borderlake.llm.decontaminate import drop_contaminated
from borderlake.llm.exact_dedup import drop_copies
from borderlake.llm.language_id import keep_language
from borderlake.llm.sentencepiece_lattice import encode
from borderlake.llm.simhash import drop_near_copies


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or like none of the learned languages, go."""
    return keep_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of those with equal text stays."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces: doc_id, ids, score, and the next best segmentations."""
    return encode(docs).drop(ROW)


STAGES = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: The stages learn, search a graph and search a lattice, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage's result is stored and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
