"""Frequent itemsets and association rules.

Itemsets come from MLlib's parallel FP-Growth (``pyspark.ml.fpm.FPGrowth``):
frequent single items are counted with a combining ``reduceByKey`` and
collected (at most ``total items / minCount`` of them), then every basket is
cut into group-dependent prefixes and one FP-tree per item group is built
with a map-side-combining ``aggregateByKey``; tree size is bounded by
distinct prefixes, not by rows.

MLlib's itemset DataFrame is lazy: every action on it, and on
``associationRules``, re-runs the whole tree mining.  ``mine`` therefore
writes the itemsets once to a table below the checkpoint root (one job, and
the lineage is cut so a lost executor does not re-mine) and derives the
rules from that table with DataFrame joins, computing confidence, lift and
support in the same order of floating point operations as MLlib.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens import defaults
from cartlens.plans.materialize import materialize

DEFAULT_MIN_SUPPORT = defaults.MIN_SUPPORT
DEFAULT_MIN_CONFIDENCE = defaults.MIN_CONFIDENCE


@dataclass
class MiningResult:
    itemsets: DataFrame   # items array<bigint> (sorted), freq bigint, item_count int
    rules: DataFrame      # antecedent, consequent array<bigint>, confidence, lift, support
    n_baskets: int
    min_support: float
    min_confidence: float


def fit_fpgrowth(baskets: DataFrame, items_col: str = "items",
                 min_support: float = DEFAULT_MIN_SUPPORT,
                 min_confidence: float = DEFAULT_MIN_CONFIDENCE,
                 num_partitions: int | None = None) -> FPGrowthModel:
    """Plain FP-Growth fit.  Baskets must hold distinct items (see
    ``clean_baskets``); null baskets are ignored and are not counted in N."""
    fp = FPGrowth(itemsCol=items_col, minSupport=min_support, minConfidence=min_confidence)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    return fp.fit(baskets)


def canonical_itemsets(freq_itemsets: DataFrame, items_col: str = "items") -> DataFrame:
    """``items`` in ascending order plus ``item_count``."""
    return freq_itemsets.select(F.array_sort(items_col).alias("items"),
                                F.col("freq").cast("long").alias("freq"),
                                F.size(items_col).alias("item_count"))


def derive_rules(itemsets: DataFrame, n_baskets: int,
                 min_confidence: float = DEFAULT_MIN_CONFIDENCE) -> DataFrame:
    """Association rules X -> {y} from a complete table of frequent itemsets.

    For each itemset Z with |Z| >= 2 and each y in Z: X = Z - {y},
    confidence = f(Z)/f(X), lift = confidence / (f(y)/N), support = f(Z)/N.
    ``itemsets.items`` must be sorted (``canonical_itemsets``) so X matches
    the stored antecedent itemset exactly.  The planner sizes both joins from
    the written table.
    """
    multi = itemsets.where(F.size("items") >= 2)
    candidates = (multi.select(F.col("items").alias("_union"), F.col("freq").alias("_f_union"),
                               F.explode("items").alias("_cons"))
                  .select(F.array_remove("_union", F.col("_cons")).alias("antecedent"),
                          "_cons", "_f_union"))
    antecedents = itemsets.select(F.col("items").alias("antecedent"),
                                  F.col("freq").alias("_f_ante"))
    singles = itemsets.where(F.size("items") == 1).select(
        F.col("items")[0].alias("_cons"), F.col("freq").alias("_f_cons"))
    n = F.lit(float(n_baskets))
    confidence = F.col("_f_union") / F.col("_f_ante")
    return (candidates.join(antecedents, "antecedent")
            .join(singles, "_cons")
            .select("antecedent",
                    F.array("_cons").alias("consequent"),
                    confidence.alias("confidence"),
                    (confidence / (F.col("_f_cons") / n)).alias("lift"),
                    (F.col("_f_union") / n).alias("support"))
            .where(F.col("confidence") >= F.lit(float(min_confidence))))


def mine(baskets: DataFrame, items_col: str = "items",
         min_support: float = DEFAULT_MIN_SUPPORT,
         min_confidence: float = DEFAULT_MIN_CONFIDENCE,
         num_partitions: int | None = None, name: str = "mined",
         materialize_input: bool = False) -> MiningResult:
    """Fit FP-Growth once, write itemsets and rules below the checkpoint root,
    and return DataFrames over the written tables.

    The baskets are cached (memory and disk) for the passes of the fit; with
    ``materialize_input=True`` they are first written below the checkpoint
    root, so a lost executor re-reads files instead of re-running the basket
    build."""
    spark = baskets.sparkSession
    if materialize_input:
        baskets = materialize(baskets.select(items_col), f"{name}-baskets")
    data = (baskets.select(F.col(items_col).alias("items"))
            .where(F.col("items").isNotNull())
            .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        n_baskets = data.count()
        if n_baskets == 0:
            empty_sets = spark.createDataFrame([], "items array<bigint>, freq bigint, item_count int")
            return MiningResult(empty_sets, derive_rules(empty_sets, 1, min_confidence), 0,
                                min_support, min_confidence)
        model = fit_fpgrowth(data, "items", min_support, min_confidence, num_partitions)
        itemsets = materialize(canonical_itemsets(model.freqItemsets), f"{name}-itemsets")
    finally:
        data.unpersist()
    rules = materialize(derive_rules(itemsets, n_baskets, min_confidence), f"{name}-rules")
    return MiningResult(itemsets, rules, n_baskets, min_support, min_confidence)
