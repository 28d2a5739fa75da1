"""Adapters from the star-schema test tables to the basket roles.

role            table      columns
orders          orders     o_orderkey -> order_id
order lines     lineitem   l_orderkey -> order_id, item -> product_id
products        part       item id -> product_id, name -> product_name

Two item levels exist.  ``brand``: the item is the brand number
(``Brand#13`` -> 13) and the name is the brand text; frequent enough to
mine.  ``part``: the item is ``p_partkey`` and the name ``p_name`` (names
repeat across parts, which exercises the labelling semantics).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEVELS = ("brand", "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def brand_number(brand: Column) -> Column:
    """``Brand#13`` -> 13; anything else -> null."""
    return F.regexp_extract(brand, "^Brand#([0-9]+)$", 1).try_cast("bigint")


def orders_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"))


def order_lines(spark: SparkSession, sf_dir: str, level: str = "brand") -> DataFrame:
    """``order_id bigint, product_id bigint`` -- one row per order line."""
    lines = table(spark, sf_dir, "lineitem")
    if level == "part":
        return lines.select(F.col("l_orderkey").alias("order_id"),
                            F.col("l_partkey").cast("bigint").alias("product_id"))
    if level != "brand":
        raise ValueError(f"level must be one of {LEVELS}")
    # Line -> part -> brand.  The planner sizes the part side: broadcast while
    # it is small, a shuffled join (skew-split by AQE) once it is not.
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), brand_number(F.col("p_brand")).alias("product_id"))
    return (lines.select(F.col("l_orderkey").alias("order_id"), "l_partkey")
            .join(parts, "l_partkey", "left")
            .select("order_id", "product_id"))


def products_table(spark: SparkSession, sf_dir: str, level: str = "brand") -> DataFrame:
    """``product_id bigint, product_name string``."""
    part = table(spark, sf_dir, "part")
    if level == "part":
        return part.select(F.col("p_partkey").cast("bigint").alias("product_id"),
                           F.col("p_name").alias("product_name"))
    if level != "brand":
        raise ValueError(f"level must be one of {LEVELS}")
    return (part.select(brand_number(F.col("p_brand")).alias("product_id"),
                        F.col("p_brand").alias("product_name"))
            .distinct())
