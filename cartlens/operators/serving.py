"""Dashboard datasets as Spark plans: cleaning, slider filters, KPIs, search,
top-k tables, chart data and the full rule table.  Only the final (small)
result of each view would ever be collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens import defaults as D
from cartlens.functions.display import (percent_text, rule_label, thousands_text,
                                        two_decimal_text)
from cartlens.operators.numbering import numbered
from cartlens.operators.report import ranked, rule_key

RULE_METRICS = ("confidence", "lift")


def clean_metrics(rules: DataFrame, metrics: Sequence[str] = RULE_METRICS) -> DataFrame:
    """Metrics converted to double (text that is not a number -> null), then
    rows with a null or NaN metric dropped."""
    out = rules.withColumns({m: F.col(m).try_cast("double") for m in metrics})
    return out.na.drop(subset=list(metrics))


def cleaned_view(rules: DataFrame, min_confidence: float = 0.0, min_lift: float = 0.0,
                 text: str | None = None) -> dict[str, DataFrame]:
    """The dashboard over a table as it was loaded: metrics are cleaned first,
    then come the KPIs, the slider filter and what is shown of the filtered
    rules (``text`` narrows the search view).  A NaN metric would otherwise
    pass every filter, since Spark orders it above all numbers."""
    clean = clean_metrics(rules, [m for m in ("confidence", "lift", "support")
                                  if m in rules.columns])
    shown = filter_rules(clean, min_confidence, min_lift)
    return {"rules": clean, "kpis": rule_kpis(clean, min_confidence, min_lift), "filtered": shown,
            "top": top_filtered(shown), "chart_lift": chart_data(shown, "lift"),
            "chart_confidence": chart_data(shown, "confidence"), "scatter": scatter_data(shown),
            "search": search_rules(clean, text) if text else clean}


def filter_rules(rules: DataFrame, min_confidence: float = 0.0,
                 min_lift: float = 0.0) -> DataFrame:
    """Slider filter: both bounds inclusive."""
    return rules.where((F.col("confidence") >= F.lit(float(min_confidence)))
                       & (F.col("lift") >= F.lit(float(min_lift))))


def rule_kpis(rules: DataFrame, min_confidence: float = 0.0, min_lift: float = 0.0,
              lift_floor: float = D.LIFT_SLIDER_FLOOR) -> DataFrame:
    """One row: totals, filtered count, means (rounded to 9 digits) and the
    upper bound of the lift slider (at least ``lift_floor``), plus the KPI
    texts (thousands, mean confidence in percent, mean lift with two
    decimals)."""
    passes = ((F.col("confidence") >= F.lit(float(min_confidence)))
              & (F.col("lift") >= F.lit(float(min_lift))))
    row = rules.agg(F.count(F.lit(1)).alias("total_rules"),
                    F.count_if(passes).alias("filtered_rules"),
                    F.avg("confidence").alias("avg_confidence"),
                    F.avg("lift").alias("avg_lift"),
                    F.max("lift").alias("_max_lift"))
    rounded = row.select(
        "total_rules", "filtered_rules",
        F.round("avg_confidence", 9).alias("avg_confidence"),
        F.round("avg_lift", 9).alias("avg_lift"),
        F.greatest(F.lit(float(lift_floor)), F.col("_max_lift")).alias("max_lift_bound"))
    return rounded.select(
        "*",
        thousands_text("total_rules").alias("total_rules_text"),
        thousands_text("filtered_rules").alias("filtered_rules_text"),
        percent_text("avg_confidence").alias("avg_confidence_text"),
        two_decimal_text("avg_lift").alias("avg_lift_text"))


def itemset_kpis(itemsets: DataFrame, rules: DataFrame, n_baskets: int) -> DataFrame:
    """Basket, itemset and rule counts plus mean confidence / lift / support
    rounded to 3 digits (second dashboard)."""
    n_itemsets = itemsets.select(F.count(F.lit(1))).scalar()
    return rules.agg(F.count(F.lit(1)).alias("rules"),
                     F.round(F.avg("confidence"), D.KPI_DIGITS).alias("avg_confidence"),
                     F.round(F.avg("lift"), D.KPI_DIGITS).alias("avg_lift"),
                     F.round(F.avg("support"), D.KPI_DIGITS).alias("avg_support")).select(
        F.lit(int(n_baskets)).cast("long").alias("transactions"), n_itemsets.alias("itemsets"), "*")


def search_rules(rules: DataFrame, text: str, regex: bool = True,
                 col: str = "antecedent_product_names") -> DataFrame:
    """Rules whose antecedent names contain ``text``, case-insensitively;
    a null name never matches.  ``regex=True`` treats ``text`` as a regular
    expression (the dashboard default), otherwise as a literal."""
    return ranked(rules.where(name_matches(col, text, regex)),
                  [F.desc("lift"), F.desc("confidence")])


def name_matches(col: str, text: str, regex: bool = True) -> Column:
    if regex:
        hit = F.col(col).rlike(f"(?iu){text}")
    else:
        hit = F.lower(F.col(col)).contains(text.lower())
    return F.coalesce(hit, F.lit(False))


def display_rules(rules: DataFrame,
                  labels: Sequence[str] = ("product_purchased", "recommended_product",
                                           "confidence", "lift"),
                  keep: Sequence[str] = ()) -> DataFrame:
    """Relabelled columns with confidence as percent text and lift with two
    decimals (rows keep their order); ``keep`` columns are passed through first."""
    a, b, c, l = labels
    return rules.select(*keep, F.col("antecedent_product_names").alias(a),
                        F.col("consequent_product_names").alias(b),
                        percent_text("confidence").alias(c),
                        two_decimal_text("lift").alias(l))


def top_filtered(rules: DataFrame, n: int = D.DASHBOARD_TOP, by: str = "lift") -> DataFrame:
    return ranked(rules, [F.desc(by)], n)


def chart_data(rules: DataFrame, by: str = "lift", n: int = D.CHART_TOP) -> DataFrame:
    """Top ``n`` by ``by`` with the rule label of the bar chart."""
    top = ranked(rules, [F.desc(by)], n)
    return top.select(rule_label("antecedent_product_names", "consequent_product_names")
                      .alias("rule"), "confidence", "lift")


def scatter_data(rules: DataFrame, arrow: str = D.ARROW,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Every rule with its label and the three metrics (scatter plots);
    ``keep`` columns are passed through first."""
    cols = [*keep, rule_label("antecedent_product_names", "consequent_product_names", arrow)
            .alias("rule"), "confidence", "lift"]
    if "support" in rules.columns:
        cols.append("support")
    return rules.select(*cols)


def all_rules_table(rules: DataFrame,
                    labels: Sequence[str] = ("product_a", "product_b")) -> DataFrame:
    return rules.select(F.col("antecedent_product_names").alias(labels[0]),
                        F.col("consequent_product_names").alias(labels[1]),
                        "confidence", "lift")


def rules_by_lift(named_rules: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """All rules, highest lift first, five display columns; ``keep`` columns
    are passed through first."""
    return ranked(named_rules, [F.desc("lift")]).select(
        *keep,
        F.col("antecedent_product_names").alias("antecedent_names"),
        F.col("consequent_product_names").alias("consequent_names"),
        "confidence", "lift", "support")


def top_itemsets(named_itemsets: DataFrame, n: int | None = D.ITEMSET_TOP,
                 columns: Sequence[str] = ("products", "freq")) -> DataFrame:
    """Itemsets with their product names, the most frequent first; all of them
    with ``n=None``."""
    return ranked(named_itemsets, [F.desc("freq")], n, columns)


def positioned(rules: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``position`` (from 1) of each row in the order given, then by rule key."""
    return numbered(rules, [*order, *[F.asc_nulls_last(c) for c in rule_key(rules)]])
