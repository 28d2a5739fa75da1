"""The registered queries of this package: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartlens.llm.decontaminate import op13_decontaminate
from cartlens.llm.hamming_index import op7_neighbours
from cartlens.llm.packing import op4_packing
from cartlens.llm.periodic import op12_runs
from cartlens.llm.piece_bpe import op8_pieces
from cartlens.llm.quality import op5_quality
from cartlens.llm.secrets import op9_secrets
from cartlens.llm.simhash import op6_simhash
from cartlens.llm.spelling import op11_spelling
from cartlens.llm.substring import op10_substring
from cartlens.llm.token_counts import op3_token_counts
from cartlens.llm.token_files import op1_token_files
from cartlens.llm.toxicity import op2_toxicity


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def over(table: str, operator: Callable[[DataFrame], DataFrame]
         ) -> Callable[[SparkSession, str], DataFrame]:
    """A query that applies ``operator`` to a whole table."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(read(spark, sf_dir, table))
    return query


QUERIES = {
    "op1_token_files": over("documents", op1_token_files),
    "op2_toxicity": lambda spark, sf_dir: op2_toxicity(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")),
    "op3_token_counts": over("documents", op3_token_counts),
    "op4_packing": over("documents", op4_packing),
    "op5_quality": over("documents", op5_quality),
    "op6_simhash": over("documents", op6_simhash),
    "op7_neighbours": over("embeddings", op7_neighbours),
    "op8_pieces": over("documents", op8_pieces),
    "op9_secrets": over("documents", op9_secrets),
    "op10_substring": over("documents", op10_substring),
    "op11_spelling": over("documents", op11_spelling),
    "op12_runs": over("documents", op12_runs),
    "op13_decontaminate": lambda spark, sf_dir: op13_decontaminate(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")),
}
