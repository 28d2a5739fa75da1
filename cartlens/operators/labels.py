"""Attach product names to id arrays (rules, itemsets, baskets, flat rules).

One operator covers the three labelling variants:

* names in item position order, unknown ids dropped (``unknown="drop"``);
* the same with set semantics, first occurrence kept (``distinct=True``);
* unknown ids shown as the id itself (``unknown="id"``; an id whose name is
  null is shown the same way).

Plan: the distinct arrays of all labelled columns are exploded with their
positions; the product dimension is first cut down to the ids that occur (a
semi join against the distinct ids, which are few for rules and itemsets) and
to one name per id, so a large dimension is neither shuffled nor broadcast
blindly; the names found are regrouped per array, ordered by position and
joined to text.  That lookup is joined back on the array, so each row of the
input stays one row, whatever its other columns and however often it repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.defaults import NAME_SEPARATOR

UNKNOWN_MODES = ("drop", "id")


def product_names(products: DataFrame, id_col: str = "product_id",
                  name_col: str = "product_name") -> DataFrame:
    """One name per id: of several the first in order; a null name is none."""
    return (products.select(F.col(id_col).alias("_id"), F.col(name_col).alias("_name"))
            .groupBy("_id").agg(F.min("_name").alias("_name")))


def label_arrays(df: DataFrame, columns: dict[str, str], products: DataFrame,
                 id_col: str = "product_id", name_col: str = "product_name",
                 unknown: str = "drop", distinct: bool = False, sep: str = NAME_SEPARATOR,
                 reduce_dimension: bool = True) -> DataFrame:
    """Add one text column per entry of ``columns`` (array column -> output
    column) holding the names of the ids in array order.

    Rows out are rows in.  Null or empty arrays give ``""``.
    ``reduce_dimension`` first cuts the dimension to the ids that occur, which
    is right for small inputs (rules, itemsets) against a large dimension; turn
    it off to label a large fact table.
    """
    if unknown not in UNKNOWN_MODES:
        raise ValueError(f"unknown must be one of {UNKNOWN_MODES}")
    id_type = products.schema[id_col].dataType
    # One lookup for all columns; their arrays are compared as the first one's.
    kind = df.schema[next(iter(columns))].dataType
    arrays = df.select(F.explode(F.array(*[F.col(c).cast(kind) for c in columns])).alias("_ids"))
    exploded = (arrays.where(F.size("_ids") > 0).distinct()
                .select("_ids", F.posexplode("_ids").alias("_pos", "_id"))
                .select("_ids", "_pos", F.col("_id").cast(id_type).alias("_id"))
                .where(F.col("_id").isNotNull()))
    names = products
    if reduce_dimension:
        wanted = exploded.select("_id").distinct()
        names = names.join(wanted, names[id_col] == wanted["_id"], "left_semi")
    looked_up = exploded.join(product_names(names, id_col, name_col), "_id", "left")
    label = F.col("_name")
    if unknown == "id":
        label = F.coalesce(label, F.col("_id").cast("string"))
    entries = F.array_sort(F.collect_list(F.when(label.isNotNull(),
                                                 F.struct("_pos", label.alias("n")))))
    found = F.transform(entries, lambda s: s["n"])
    texts = looked_up.groupBy("_ids").agg(
        F.concat_ws(sep, F.array_distinct(found) if distinct else found).alias("_text"))
    out = df
    for column, name in columns.items():
        side = texts.select(F.col("_ids").alias(f"_{name}_ids"), F.col("_text").alias(f"_{name}"))
        out = out.join(side, out[column].cast(kind) == side[f"_{name}_ids"], "left")
    return out.select(*[df[c] for c in df.columns],
                      *[F.coalesce(F.col(f"_{n}"), F.lit("")).alias(n) for n in columns.values()])


def label_rules(rules: DataFrame, products: DataFrame, unknown: str = "drop",
                distinct: bool = False, **kw) -> DataFrame:
    """Rules with ``antecedent_product_names`` / ``consequent_product_names``
    in the column order of the named-rule table."""
    named = label_arrays(rules, {"antecedent": "antecedent_product_names",
                                 "consequent": "consequent_product_names"},
                         products, unknown=unknown, distinct=distinct, **kw)
    rest = [c for c in rules.columns if c not in ("antecedent", "consequent")]
    return named.select("antecedent", "antecedent_product_names", "consequent",
                        "consequent_product_names", *rest)


def label_itemsets(itemsets: DataFrame, products: DataFrame, unknown: str = "id",
                   out_col: str = "products", **kw) -> DataFrame:
    """Itemsets with their names; by default an unknown id is shown as itself."""
    return label_arrays(itemsets, {"items": out_col}, products, unknown=unknown, **kw)
