"""Documents to packed training sequences: rules, exact copies, near copies, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import exact_dedup, mixing, packing, quality_rules, simhash
from lodestone.llm.common import documents, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rule 6: rejected documents go, lines over the limit leave the kept texts.  Null texts go; an empty table stays empty."""
    return quality_rules.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest id stays; repeats of that row are one."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints the document with the smallest id stays; a null id is the largest."""
    return simhash.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: rows repeated or cut to each source's target.  Texts without words and sources without any go."""
    return mixing.mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts with their places; a null or empty text is one piece of one id."""
    return packing.pack(docs, packing.word_bpe()).select(*packing.COLUMNS)


STAGES = [("quality_rules", quality), ("exact_dedup", exact_copies), ("simhash_dedup", near_copies), ("mixing", mixture), ("packing", sequences)]

#: Tokenizing and fingerprints have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
