from pyspark.sql import functions as F

from cartlens.operators.numbering import numbered
from cartlens.plans.catalog import MiningConfig, named_rules
from cartlens.operators.flat import flatten_rules
from cartlens.operators.serving import positioned


def test_numbers_follow_the_order_over_many_ranges(spark):
    rows = [(k * 7919 % 5000, "x" if k % 3 else None, k) for k in range(5000)]
    df = spark.createDataFrame(rows, "v int, _at string, _part long").repartition(13)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = numbered(df, [F.desc("v")]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert out[0].asDict().keys() == {"v", "_at", "_part", "position"}
    assert {r["v"]: r["position"] for r in out} == {v: 5000 - v for v in range(5000)}
    assert {(r["v"], r["_at"], r["_part"]) for r in out} == set(rows)


def test_ties_and_empty_tables(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(None,)] * 3, "v int")
    out = numbered(df, [F.asc_nulls_last("v")], "no").collect()
    assert sorted(r["no"] for r in out) == list(range(1, 54))
    assert {r["no"] for r in out if r["v"] is None} == {51, 52, 53}
    assert numbered(df.limit(0), [F.col("v")]).collect() == []


def test_no_task_gets_all_rows(spark, sf001):
    rules = flatten_rules(named_rules(spark, sf001, MiningConfig()))
    out = positioned(rules, [F.desc("lift")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
