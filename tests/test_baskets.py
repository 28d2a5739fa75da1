from pyspark.sql import functions as F

from cartlens.operators.baskets import build_baskets, clean_baskets, explode_items
from cartlens.schemas import BASKET, ORDER, ORDER_LINE


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_build_baskets_edge_rows(spark):
    orders = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,), (6,)], ORDER)
    lines = spark.createDataFrame([
        (1, 10), (1, 11), (1, 10),          # repeated item -> set
        (2, 10),                            # one item -> dropped
        (3, 12), (3, None), (3, 13),        # null item skipped
        (4, None), (4, None),               # only nulls -> empty -> dropped
        (9, 10), (9, 11),                   # line without an order -> dropped
        (6, 13), (6, 12), (6, 11),
    ], ORDER_LINE)                          # order 5 has no lines -> no basket
    out = build_baskets(orders, lines)
    assert rows(out, "order_id", "items") == [(1, [10, 11]), (3, [12, 13]), (6, [11, 12, 13])]


def test_build_baskets_min_size_and_observation(spark):
    from pyspark.sql import Observation
    orders = spark.createDataFrame([(1,), (2,)], ORDER)
    lines = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], ORDER_LINE)
    obs = Observation("baskets")
    out = build_baskets(orders, lines, min_size=1, observation=obs)
    assert out.count() == 2
    assert obs.get["baskets"] == 2 and obs.get["basket_items"] == 3


def test_join_then_group_equals_group_then_join(spark, sf001):
    """Our plan aggregates before the order join; the reference order of
    operations (join, then group) gives the same baskets."""
    from cartlens.sources.tables import order_lines, orders_table
    orders, lines = orders_table(spark, sf001), order_lines(spark, sf001)
    ours = build_baskets(orders, lines)
    theirs = (orders.join(lines, "order_id").groupBy("order_id")
              .agg(F.array_sort(F.collect_set("product_id")).alias("items"))
              .where(F.size("items") >= 2))
    assert ours.exceptAll(theirs).count() == 0 and theirs.exceptAll(ours).count() == 0


def test_clean_baskets(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [5]), (4, [5, 5]), (5, [5, None, 6]),
                                (6, [7, 8, 7])], BASKET)
    out = clean_baskets(df)
    assert rows(out, "order_id", "items") == [(5, [5, 6]), (6, [7, 8])]


def test_explode_items_semantics(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [1, None])], BASKET)
    got = [(r.order_id, r.product_id) for r in explode_items(df).collect()]
    assert sorted(got, key=lambda t: (t[0], t[1] is None, t[1] or 0)) == [(3, 1), (3, None)]
