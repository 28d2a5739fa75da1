"""Serving table over JDBC: write rules, read them back, read them for display.

Array columns have no JDBC type, so rules are flattened to comma-joined text
first.  The writer creates the table, so it always matches what we write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from cartlens.functions.codec import ids_to_text

SERVING_COLUMNS = ["antecedent", "antecedent_product_names", "consequent",
                   "consequent_product_names", "confidence", "lift", "support"]


def serving_frame(named_rules: DataFrame, with_timestamp: bool = True) -> DataFrame:
    """Rules normalised for loading: ids as text, metrics as double, names as
    text (empty when absent) and the load time in ``created_at``."""
    cols = []
    for name in ("antecedent", "consequent"):
        is_array = isinstance(named_rules.schema[name].dataType, ArrayType)
        value = ids_to_text(name) if is_array else F.col(name).cast("string")
        cols.append(value.alias(name))
        cols.append(F.coalesce(F.col(f"{name}_product_names").cast("string"), F.lit(""))
                    .alias(f"{name}_product_names"))
    for m in ("confidence", "lift", "support"):
        # six-column enriched rules carry no support: loaded as null
        metric = F.col(m) if m in named_rules.columns else F.lit(None)
        cols.append(metric.cast("double").alias(m))
    out = named_rules.select(*cols).select(*SERVING_COLUMNS)
    if with_timestamp:
        out = out.withColumn("created_at", F.current_timestamp())
    return out


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
               mode: str = "overwrite", column_types: str | None = None) -> None:
    """Text columns get the database's unbounded text type unless
    ``column_types`` declares others."""
    writer = df.write.mode(mode)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.jdbc(url, table, properties=properties)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
              partitioning: dict[str, object] | None = None) -> DataFrame:
    """The relation; ``partitioning`` (``column``, ``lowerBound``, ``upperBound``,
    ``numPartitions``) splits the read over tasks, else one task reads it."""
    return spark.read.jdbc(url, table, properties=properties, **(partitioning or {}))


def ordered_serving_rules(table: DataFrame) -> DataFrame:
    """The dashboard's read of the serving table: rule columns ordered by
    lift, highest first (ties by rule key)."""
    cols = [*SERVING_COLUMNS, *(["created_at"] if "created_at" in table.columns else [])]
    return table.select(*cols).orderBy(F.desc("lift"), "antecedent", "consequent")


def serving_rules(spark: SparkSession, url: str, table: str, properties: dict[str, str],
                  partitioning: dict[str, object] | None = None) -> DataFrame:
    """``ordered_serving_rules`` over the JDBC relation.  Written against the
    DataFrame API so column pruning and filters reach the database."""
    return ordered_serving_rules(read_jdbc(spark, url, table, properties, partitioning))


def load_rules(named_rules: DataFrame, url: str, table: str,
               properties: dict[str, str]) -> dict[str, int]:
    """Overwrite the serving table and verify by reading it back (counts of
    what was meant to be written vs. what the table now holds)."""
    frame = serving_frame(named_rules)
    expected = frame.count()
    write_jdbc(frame, url, table, properties)
    loaded = read_jdbc(named_rules.sparkSession, url, table, properties).count()
    if loaded != expected:
        raise RuntimeError(f"serving table {table}: wrote {expected} rows, found {loaded}")
    return {"expected": expected, "loaded": loaded}
