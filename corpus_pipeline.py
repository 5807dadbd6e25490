"""A training corpus from raw documents: five stages, each one of the numbered operators.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns a DataFrame; all but the last return the columns of ``documents``. ``run``
writes every stage's result as Parquet in the shared folder and rereads it for the
next one, so a lost executor costs a re-read of that table.

Edge cases follow the operators: NULL and letterless texts are rejected by language
ID; a document whose lines all repeat earlier ones goes on with an empty text; rows
without an id pass the near-duplicate stage; of rows that repeat id and text one passes
it, and of documents that tie for a group's smallest id the one whose text has the
smaller hash; very long texts go through whole, in bounded pieces; extra columns, also
of names that the operators use inside, are kept as they are until packing; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortium.deploy import ship_package
from cohortium.llm import bestfit_packing, kn_langid, line_alignment, simhash_wildcards, winnowing
from cohortium.llm.common import stored, table
from cohortium.llm.entries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models recognise; ``lang`` stays as it came.

    The models learn from the stage's own documents that have a ``lang``; rejected
    documents (no letters, or too far from every language) go.
    """
    ship_package(spark)
    return kn_langid.keep_recognised(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that repeat an earlier document are cut from ``text``; ``n_chars`` follows."""
    ship_package(spark)
    return line_alignment.cut_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest id."""
    ship_package(spark)
    return simhash_wildcards.keep_one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    ship_package(spark)
    return winnowing.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of at most 1024 tokens."""
    ship_package(spark)
    return bestfit_packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", packing),
]

#: fingerprints, character models and packing are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
