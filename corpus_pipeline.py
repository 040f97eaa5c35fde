"""A corpus pipeline: language ID, exact dedup, near-dedup, benchmark decontamination, packing.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the docs of
the next one.  Every stage but the last returns the columns of its documents.
All stages accept nulls in any column, empty tables and further columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.common import table
from starloom.llm.decontam import drop_contaminated
from starloom.llm.exact_dedup import drop_exact_duplicates
from starloom.llm.language_id import identify
from starloom.llm.packing import pack
from starloom.llm.simhash import drop_near_duplicates
from starloom.session import clear_scratch, materialize, scratch_mark

# The stages are iterative or use numpy, so no SQL statement gives these rows; see tests/llm.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts that are null or have no letter go."""
    return identify(docs).where("lang_pred <> 'und'").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints (four words, at most four bits apart) connect it, the one with the smallest id."""
    return drop_near_duplicates(docs, shingle=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row per piece of a document."""
    return pack(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("simhash_dedup", near),
    ("decontamination", decontaminate),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed documents of ``sf_dir``; each stage's result is a table in the shared folder, what it wrote on the way goes when it ends."""
    docs, mark = table(spark, sf_dir, "documents"), scratch_mark()
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
        clear_scratch(spark, mark, keep_last=1)
    return docs
