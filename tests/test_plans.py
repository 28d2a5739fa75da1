"""Physical plan properties that matter at scale (checked with the broadcast
threshold off, as when every table is large)."""

import pytest

from cartlens.operators.baskets import build_baskets
from cartlens.operators.labels import label_rules
from cartlens.schemas import ORDER, ORDER_LINE, PRODUCT
from cartlens.sources.tables import order_lines, orders_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.conf.set("spark.sql.adaptive.enabled", aqe)


def test_baskets_one_shuffle_of_lines(spark, no_broadcast):
    orders = spark.createDataFrame([(1,), (2,)], ORDER)
    lines = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], ORDER_LINE)
    p = plan(build_baskets(orders, lines))
    # partial set per order before the shuffle; the semi join reuses the
    # aggregate's partitioning, so there are exactly two exchanges: the
    # combined line sets and the one-column order keys.
    assert p.count("Exchange hashpartitioning") == 2
    assert p.index("partial_collect_set") > p.index("Exchange hashpartitioning(order_id")
    assert "LeftSemi" in p


def test_scans_read_only_used_columns(spark, sf001, no_broadcast):
    p = plan(build_baskets(orders_table(spark, sf001), order_lines(spark, sf001)))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p
    assert "ReadSchema: struct<o_orderkey:bigint>" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string>" in p


def test_label_filters_dimension_before_lookup(spark, no_broadcast):
    products = spark.createDataFrame([(i, f"p{i}") for i in range(10)], PRODUCT)
    rules = spark.createDataFrame([([1, 2], [3], 0.5, 1.0, 0.1)],
                                  "antecedent array<int>, consequent array<int>, "
                                  "confidence double, lift double, support double")
    p = plan(label_rules(rules, products))
    assert "LeftSemi" in p and "BroadcastExchange" not in p   # no blind broadcast


def test_hot_order_and_hot_item(spark):
    """One order holds a third of all lines; one item is in every basket."""
    hot = [(1, i % 5) for i in range(3000)]
    rest = [(o, i) for o in range(2, 1502) for i in (99, o % 7 + 10, o % 3 + 20)]
    orders = spark.createDataFrame([(o,) for o in range(1, 1502)], ORDER)
    lines = spark.createDataFrame(hot + rest, ORDER_LINE)
    baskets = build_baskets(orders, lines)
    got = {r.order_id: r["items"] for r in baskets.collect()}
    assert got[1] == [0, 1, 2, 3, 4] and len(got) == 1501
    from cartlens.operators.mining import mine
    res = mine(baskets, min_support=0.2, min_confidence=0.5)
    freq = {tuple(r["items"]): r.freq for r in res.itemsets.collect()}
    assert freq[(99,)] == 1500


def test_salted_baskets_equal_and_spread_hot_order(spark, sf001):
    from cartlens.sources.tables import order_lines, orders_table
    plain = build_baskets(orders_table(spark, sf001), order_lines(spark, sf001))
    salted = build_baskets(orders_table(spark, sf001), order_lines(spark, sf001),
                           salt_buckets=8)
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0
    p = plan(salted)
    # first exchange on (order, salt), then the regroup on order alone
    assert "Exchange hashpartitioning(order_id#" in p
    assert p.count("Exchange hashpartitioning(order_id") == 2
    assert "partial_collect_set" in p and "partial_collect_list" in p
    # a hot order: its items land in several salt groups before the final merge
    hot = spark.createDataFrame([(1, i) for i in range(200)] + [(2, 1), (2, 2)], ORDER_LINE)
    orders = spark.createDataFrame([(1,), (2,)], ORDER)
    got = {r.order_id: r["items"] for r in
           build_baskets(orders, hot, salt_buckets=4).collect()}
    assert got[1] == list(range(200)) and got[2] == [1, 2]
