import math

from pyspark.sql import functions as F

from cartlens.operators import report, serving

NAMED = ("antecedent string, antecedent_product_names string, consequent string, "
         "consequent_product_names string, confidence double, lift double, support double")
ROWS = [
    ("1", "ochre", "2", "flint", 0.30, 2.0, 0.01),     # lift equal to bound
    ("3", "jute", "2", "flint", 0.25, 2.5, 0.02),     # confidence equal to bound
    ("4", "cedar, split", "2", "flint", 0.40, 2.5, 0.03),   # tie on lift with the row above
    ("5", None, "1", "ochre", 0.10, 0.9, 0.04),
    ("6", "a.b", "1", "ochre", 0.50, 1.5, 0.05),
]


def frame(spark):
    return spark.createDataFrame(ROWS, NAMED)


def test_strict_thresholds_and_ties(spark):
    rules = frame(spark)
    strong = report.strong_rules(rules, 2.0, 50).collect()
    assert [r.antecedent_product_names for r in strong] == ["jute", "cedar, split"]
    high = report.high_confidence_rules(rules, 0.25, 50).collect()
    assert [r.antecedent_product_names for r in high] == ["a.b", "cedar, split", "ochre"]
    top = report.top_by_lift(rules, 2).collect()   # tie on 2.5 broken by antecedent key
    assert [r.antecedent_product_names for r in top] == ["jute", "cedar, split"]
    s = report.rule_summary(rules, 2.0, 0.25).first()
    assert (s.total_rules, s.strong_rules, s.high_confidence_rules) == (5, 2, 3)
    freq = report.consequent_frequency(rules).collect()
    assert [(r.consequent_product_names, r["count"]) for r in freq] == [("flint", 3), ("ochre", 2)]


def test_top_rules_plan_is_take_ordered(spark):
    plan = report.top_by_confidence(frame(spark), 10)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_inclusive_slider_filter_and_kpis(spark):
    rules = frame(spark)
    kept = serving.filter_rules(rules, 0.25, 2.0).collect()
    assert sorted(r.antecedent for r in kept) == ["1", "3", "4"]
    k = serving.rule_kpis(rules, 0.25, 2.0).first()
    assert (k.total_rules, k.filtered_rules, k.max_lift_bound) == (5, 3, 5.0)
    assert k.avg_confidence == round(sum(r[4] for r in ROWS) / 5, 9)
    assert k.total_rules_text == "5"


def test_clean_metrics(spark):
    df = spark.createDataFrame([("a", "0.5", "2"), ("b", None, "1"), ("c", "NaN", "1"),
                                ("d", "abc", "1"), ("e", "0.1", "1.5")],
                               "antecedent string, confidence string, lift string")
    out = serving.clean_metrics(df).collect()
    assert [(r.antecedent, r.confidence, r.lift) for r in out] == [("a", 0.5, 2.0),
                                                                  ("e", 0.1, 1.5)]
    assert not math.isnan(out[0].confidence)


def test_search(spark):
    rules = frame(spark)
    assert [r.antecedent for r in serving.search_rules(rules, "CEDAR, sp").collect()] == ["4"]
    # regex mode: '.' matches anything; literal mode matches the dot only
    assert len(serving.search_rules(rules, "a.b").collect()) == 1
    assert [r.antecedent for r in serving.search_rules(rules, "a.", regex=False).collect()] == \
        ["6"]
    assert serving.search_rules(rules, "(?:x)?hre").count() == 1   # null name never matches


def test_display_and_charts(spark):
    rules = frame(spark)
    shown = serving.display_rules(rules).where(F.col("product_purchased") == "ochre").first()
    assert (shown.confidence, shown.lift) == ("30.00%", "2.00")
    chart = serving.chart_data(rules, "lift", 2).collect()
    assert [c.rule for c in chart] == ["jute → flint", "cedar, split → flint"]
    scatter = serving.scatter_data(rules).where(F.col("rule").isNull()).count()
    assert scatter == 1


def test_itemset_kpis_no_cross_join(spark):
    its = spark.createDataFrame([([1], 5, 1), ([2], 4, 1)], "items array<int>, freq bigint, "
                                                            "item_count int")
    k = serving.itemset_kpis(its, frame(spark), 10).first()
    assert (k.transactions, k.itemsets, k.rules) == (10, 2, 5)
    plan = serving.itemset_kpis(its, frame(spark), 10)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_cleaned_view_drops_bad_metrics_before_all_else(spark):
    """A NaN passes every filter and spoils every mean unless it goes first."""
    raw = spark.createDataFrame(
        [("1", "a", "2", "b", "0.5", "1.5", "0.1"), ("1", "a", "3", "c", "NaN", "9", "0.1"),
         ("2", "b", "3", "c", "0.9", "NaN", "0.1"), ("3", "c", "1", "a", "n/a", "2", "0.1"),
         ("3", "c", "2", "b", "0.2", "1.1", None)],
        "antecedent string, antecedent_product_names string, consequent string, "
        "consequent_product_names string, confidence string, lift string, support string")
    view = serving.cleaned_view(raw, 0.1, 1.0, text="A")
    assert [view[k].count() for k in ("rules", "filtered", "top", "scatter", "search")] == [1] * 5
    kpis = view["kpis"].first()
    assert (kpis.total_rules, kpis.avg_confidence_text, kpis.avg_lift_text, kpis.max_lift_bound) \
        == (1, "50.00%", "1.50", 5.0)


def test_kpis_of_no_rules_have_no_text(spark):
    row = serving.rule_kpis(frame(spark).limit(0)).first()
    assert (row.total_rules, row.avg_confidence_text, row.avg_lift_text) == (0, None, None)
