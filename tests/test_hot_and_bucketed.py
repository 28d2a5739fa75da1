"""Hot orders, bucketed tables and one-line CSV files."""

import random

from pyspark.sql import functions as F

from cartlens.operators.baskets import build_baskets, hot_orders
from cartlens.plans.queries import QUERIES
from cartlens.schemas import ORDER, ORDER_LINE, PRODUCT_TEXT
from cartlens.session import scratch_path
from cartlens.sources.bucketed import read_bucketed, write_bucketed
from cartlens.sources.readers import read_csv_columns, read_products_csv
from cartlens.sources.writers import write_csv


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def lines(spark):
    rng = random.Random(2)
    rows = [(7, rng.randrange(3000)) for _ in range(10_000)]          # a third
    rows += [(9, k % 50) for k in range(300)]                        # one in a hundred
    rows += [(rng.randrange(100, 9000), rng.randrange(40)) for _ in range(19_700)]
    rows += [(None, 1)] * 50
    return spark.createDataFrame(rows, ORDER_LINE).repartition(6)


def test_the_sketch_finds_the_hot_orders(spark):
    df = lines(spark)
    assert hot_orders(df, 0.05) == [7]
    found = hot_orders(df, 0.005)
    assert {7, 9} <= set(found) and len(found) <= 400
    assert hot_orders(df.limit(0), 0.01) == []


def test_baskets_with_hot_orders_equal_the_plain_ones(spark):
    df = lines(spark)
    orders = spark.createDataFrame([(o,) for o in [*range(9000), None]], ORDER)
    want = build_baskets(orders, df)
    for hot in ([7, 9], [7], []):
        got = build_baskets(orders, df, hot=hot)
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_only_hot_orders_take_two_phases(spark):
    orders = spark.createDataFrame([(1,)], ORDER)
    text = plan(build_baskets(orders, lines(spark), hot=[7]))
    # The branch of the other orders groups once, on the order alone.
    assert text.count("partial_collect_list") == 1
    cold, hot = text.split("Union")[1].split("partial_collect_list")
    assert "pmod(hash(" in hot and "pmod(hash(" not in cold
    assert "pmod(hash(" not in plan(build_baskets(orders, lines(spark), hot=[]))


def test_bucketed_tables_join_and_group_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = lines(spark).where("order_id IS NOT NULL")
        orders = spark.createDataFrame([(o,) for o in range(9000)], ORDER)
        a = read_bucketed(spark, write_bucketed(orders, ["order_id"], 5, "t_orders"))
        b = read_bucketed(spark, write_bucketed(df, ["order_id"], 5, "t_lines"))
        joined, baskets = a.join(b, "order_id"), build_baskets(a, b)
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        assert "Exchange" not in plan(baskets)
        want = orders.join(df, "order_id")
        assert joined.exceptAll(want).count() == 0 == want.exceptAll(joined).count()
        assert baskets.exceptAll(build_baskets(orders, df)).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_registered_key_over_buckets_has_no_exchange_above_its_scans(spark, sf001):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(QUERIES["order_lines_bucketed"](spark, sf001))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


ODD = ["plain", "", None, "\\N", "\\", "\\\\", "a\nb", "a\r\nb\\", "\\n", "\\\\n", "\\\n", " pad ",
       '"', 'a "b", c', '\\"', "x\\\\\\\ny", "\n", "\r", ",", "é\n字"]


def test_one_line_files_give_back_every_text(spark):
    df = spark.createDataFrame([(str(k), t) for k, t in enumerate(ODD)], PRODUCT_TEXT)
    path = write_csv(df, scratch_path(spark, "t-lines"), one_line=True)
    back = {r["product_id"]: r["product_name"]
            for r in read_csv_columns(spark, path, PRODUCT_TEXT, one_line=True).collect()}
    assert back == {str(k): t for k, t in enumerate(ODD)}
    lines_of = spark.read.text(path).count()
    files = spark.read.format("binaryFile").load(path).count()
    assert lines_of == len(ODD) + files                    # one line per row and header


def test_a_large_one_line_file_is_read_by_several_tasks(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("product_id"),
                                    F.concat(F.lit("name\nof "), "id").alias("product_name"))
    path = write_csv(df, scratch_path(spark, "t-big"), single_file=True, one_line=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        split = read_products_csv(spark, path, one_line=True)
        assert split.rdd.getNumPartitions() > 4
        assert split.where("product_name = concat('name\\nof ', product_id)").count() == 20_000
        whole = write_csv(df, scratch_path(spark, "t-whole"), single_file=True)
        assert read_products_csv(spark, whole).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
