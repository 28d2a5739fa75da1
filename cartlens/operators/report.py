"""Rule reports: top-k by a metric, threshold filters, counts.

Every ordering ends with the rule key, so a limit picks the same rows on
every run; ``orderBy(...).limit(n)`` plans as a TakeOrderedAndProject (a
per-partition top-n, then a merge of n rows per partition), never a full
sort of the rule table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens import defaults as D

RULE_VIEW = ["antecedent_product_names", "consequent_product_names", "confidence", "lift"]


def rule_key(df: DataFrame) -> list[str]:
    """Columns that make an ordering of rules total."""
    for key in (["antecedent", "consequent"], ["items"],
                ["antecedent_product_names", "consequent_product_names"]):
        if all(c in df.columns for c in key):
            return key
    return []


def ranked(df: DataFrame, order: Sequence[Column], n: int | None = None,
           columns: Sequence[str] | None = None) -> DataFrame:
    """Sort by ``order`` then the rule key; keep the first ``n``; project."""
    out = df.orderBy(*order, *[F.asc_nulls_last(c) for c in rule_key(df)])
    if n is not None:
        out = out.limit(n)
    return out.select(*columns) if columns else out


def top_by_confidence(rules: DataFrame, n: int = D.REPORT_TOP,
                      columns: Sequence[str] | None = RULE_VIEW) -> DataFrame:
    return ranked(rules, [F.desc("confidence")], n, columns)


def top_by_lift(rules: DataFrame, n: int = D.REPORT_TOP,
                columns: Sequence[str] | None = RULE_VIEW) -> DataFrame:
    return ranked(rules, [F.desc("lift")], n, columns)


def strong_rules(rules: DataFrame, min_lift: float = D.STRONG_LIFT,
                 n: int | None = D.REPORT_ROWS,
                 columns: Sequence[str] | None = RULE_VIEW) -> DataFrame:
    """Rules with lift strictly above ``min_lift``, highest lift first."""
    return ranked(rules.where(F.col("lift") > F.lit(float(min_lift))), [F.desc("lift")], n,
                  columns)


def high_confidence_rules(rules: DataFrame, min_confidence: float = D.HIGH_CONFIDENCE,
                          n: int | None = D.REPORT_ROWS,
                          columns: Sequence[str] | None = RULE_VIEW) -> DataFrame:
    """Rules with confidence strictly above ``min_confidence``."""
    return ranked(rules.where(F.col("confidence") > F.lit(float(min_confidence))),
                  [F.desc("confidence")], n, columns)


def consequent_frequency(rules: DataFrame, n: int | None = D.RECOMMENDATION_ROWS,
                         col: str = "consequent_product_names") -> DataFrame:
    """How often each consequent is recommended, most frequent first."""
    counts = rules.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    out = counts.orderBy(F.desc("count"), F.asc_nulls_last(col))
    return out.limit(n) if n is not None else out


def rule_summary(rules: DataFrame, min_lift: float = D.STRONG_LIFT,
                 min_confidence: float = D.HIGH_CONFIDENCE) -> DataFrame:
    """Total, strong (lift > t) and high-confidence (confidence > t) counts in
    one pass."""
    return rules.agg(
        F.count(F.lit(1)).alias("total_rules"),
        F.count_if(F.col("lift") > F.lit(float(min_lift))).alias("strong_rules"),
        F.count_if(F.col("confidence") > F.lit(float(min_confidence)))
        .alias("high_confidence_rules"))


def top_rules_rounded(rules: DataFrame, n: int = D.TOP_RULES,
                      digits: int = D.TOP_RULES_DIGITS) -> DataFrame:
    """Top rules by lift then confidence, metrics rounded for display."""
    top = ranked(rules, [F.desc("lift"), F.desc("confidence")], n)
    return top.select("antecedent_product_names", "consequent_product_names",
                      *[F.round(m, digits).alias(m) for m in ("confidence", "lift", "support")])


def rule_report(rules: DataFrame, min_lift: float = D.STRONG_LIFT,
                min_confidence: float = D.HIGH_CONFIDENCE, top_n: int = D.REPORT_TOP,
                filtered_n: int = D.REPORT_ROWS,
                groups_n: int = D.RECOMMENDATION_ROWS) -> dict[str, DataFrame]:
    """All report sections, each a lazy DataFrame."""
    return {
        "top_confidence": top_by_confidence(rules, top_n),
        "top_lift": top_by_lift(rules, top_n),
        "strong_rules": strong_rules(rules, min_lift, filtered_n),
        "high_confidence": high_confidence_rules(rules, min_confidence, filtered_n),
        "top_recommendations": consequent_frequency(rules, groups_n),
        "summary": rule_summary(rules, min_lift, min_confidence),
    }
