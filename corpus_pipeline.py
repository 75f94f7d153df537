"""A corpus pipeline of five stages, each calling one operator of ``cohortlens.llm``.

Each function takes (spark, docs, sf_dir) and returns the documents that go on
(the last one: the pieces of the packed sequences); the result of each stage is
written as Parquet and read again as the next one's ``docs``.

Empty tables pass through; NULLs, ties, repeated rows and further columns are
treated as the operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm.common import stored, table
from cohortlens.llm.exact_dedup import distinct_documents
from cohortlens.llm.mixing import mixed_documents
from cohortlens.llm.packing import pack, tokenizer_path
from cohortlens.llm.quality import quality_documents
from cohortlens.llm.simhash import near_distinct_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_documents(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return distinct_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id stays."""
    return near_distinct_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in the packed sequences."""
    return pack(docs, tokenizer_path(), with_ids=False)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL: random rounding, tokenization and fingerprints; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
