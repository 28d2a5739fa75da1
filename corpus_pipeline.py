"""The corpus pipeline: five stages over ``documents``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``.  All stages but the last return the columns of ``documents``;
where a stage changes a text, ``n_chars`` is that of the new text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.llm.common import saved
from cartlens.llm.packing import pack_documents
from cartlens.llm.secrets import redacted
from cartlens.llm.simhash import one_of_each
from cartlens.llm.substring import without_repeats
from cartlens.llm.toxicity import non_toxic


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` brought up to date (a null text keeps its value)."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon learned from ``labels`` scores as toxic go."""
    return non_toxic(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (linked SimHash fingerprints) the document
    with the smallest id stays."""
    return one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words and more that a document with a smaller id has go."""
    return counted(without_repeats(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by the name of their kind."""
    return counted(redacted(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences: one row per piece."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup),
          ("substring_dedup", substring_dedup), ("secrets", secrets), ("packing", packing)]

#: SQL can express neither the fingerprints nor the token ids; the tests hold
#: the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
