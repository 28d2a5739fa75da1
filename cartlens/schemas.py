"""Declared schemas: no inference pass on CSV or JSON anywhere."""

from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

ITEM_TYPE = LongType()   # ids of large tables exceed 32 bits

ORDER = StructType([StructField("order_id", LongType())])

ORDER_LINE = StructType([
    StructField("order_id", LongType()),
    StructField("product_id", ITEM_TYPE),
])

# Product dimension as it arrives in text files: the id is read as text and
# converted with try_cast, so a bad id becomes null instead of failing (ANSI).
PRODUCT_TEXT = StructType([
    StructField("product_id", StringType()),
    StructField("product_name", StringType()),
])

PRODUCT = StructType([
    StructField("product_id", ITEM_TYPE),
    StructField("product_name", StringType()),
])

BASKET = StructType([
    StructField("order_id", LongType()),
    StructField("items", ArrayType(ITEM_TYPE)),
])

RULE = StructType([
    StructField("antecedent", ArrayType(ITEM_TYPE)),
    StructField("consequent", ArrayType(ITEM_TYPE)),
    StructField("confidence", DoubleType()),
    StructField("lift", DoubleType()),
    StructField("support", DoubleType()),
])

# Flat (comma-joined) forms used for CSV export.
FLAT_ITEMSET = StructType([
    StructField("items", StringType()),
    StructField("freq", LongType()),
    StructField("item_count", IntegerType()),
])

FLAT_RULE = StructType([
    StructField("antecedent", StringType()),
    StructField("consequent", StringType()),
    StructField("confidence", DoubleType()),
    StructField("lift", DoubleType()),
    StructField("support", DoubleType()),
])

# Flat rule with metrics still as text (a serving table filled by hand, CSV
# written by other tools): cleaned with try_cast before use.
FLAT_RULE_TEXT = StructType([
    StructField("antecedent", StringType()),
    StructField("antecedent_product_names", StringType()),
    StructField("consequent", StringType()),
    StructField("consequent_product_names", StringType()),
    StructField("confidence", StringType()),
    StructField("lift", StringType()),
    StructField("support", StringType()),
])

NAMED_RULE = StructType([
    StructField("antecedent", StringType()),
    StructField("antecedent_product_names", StringType()),
    StructField("consequent", StringType()),
    StructField("consequent_product_names", StringType()),
    StructField("confidence", DoubleType()),
    StructField("lift", DoubleType()),
    StructField("support", DoubleType()),
])

# JSON basket message on the wire: {"order_id": n, "items": [n, ...]}.
STREAM_MESSAGE = StructType([
    StructField("order_id", LongType()),
    StructField("items", ArrayType(ITEM_TYPE)),
])
