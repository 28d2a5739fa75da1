"""Flat export (arrays -> text) and enrichment of flat rules with names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from cartlens.functions.codec import ids_to_text, text_to_ids
from cartlens.operators.labels import label_arrays

RULE_METRICS = ("confidence", "lift", "support")


def flatten_itemsets(itemsets: DataFrame) -> DataFrame:
    """``items`` as ``"3,17"``; ``freq`` and ``item_count`` unchanged."""
    return itemsets.select(ids_to_text("items").alias("items"), "freq", "item_count")


def flatten_rules(rules: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Antecedent / consequent arrays as comma-joined text.  ``columns`` picks
    the output columns explicitly (default: the five rule columns, and the
    name columns when present)."""
    if columns is None:
        columns = ["antecedent", "consequent", *RULE_METRICS]
        if "antecedent_product_names" in rules.columns:
            columns = ["antecedent", "antecedent_product_names", "consequent",
                       "consequent_product_names", *RULE_METRICS]
    out = []
    for c in columns:
        if c in ("antecedent", "consequent") and isinstance(rules.schema[c].dataType,
                                                             ArrayType):
            out.append(ids_to_text(c).alias(c))
        else:
            out.append(F.col(c))
    return rules.select(*out)


def split_rule_ids(flat_rules: DataFrame, element_type: str = "bigint") -> DataFrame:
    """Flat rules with ``antecedent_ids`` / ``consequent_ids`` arrays added."""
    return flat_rules.select(
        "*",
        text_to_ids("antecedent", element_type=element_type).alias("antecedent_ids"),
        text_to_ids("consequent", element_type=element_type).alias("consequent_ids"))


def enrich_flat_rules(flat_rules: DataFrame, products: DataFrame, keep_support: bool = True,
                      unknown: str = "drop") -> DataFrame:
    """Flat rules (text ids) -> rules with product names.  Every row keeps its
    own metrics: repeated rules stay repeated."""
    metrics = [m for m in RULE_METRICS if m in flat_rules.columns
               and (keep_support or m != "support")]
    with_ids = split_rule_ids(flat_rules.select("antecedent", "consequent", *metrics))
    named = label_arrays(with_ids, {"antecedent_ids": "antecedent_product_names",
                                    "consequent_ids": "consequent_product_names"},
                         products, unknown=unknown)
    return named.select("antecedent", "antecedent_product_names", "consequent",
                        "consequent_product_names", *metrics)
