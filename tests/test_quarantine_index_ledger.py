"""Bad input with reasons, the name index, and chains that go on."""

import random

import pytest
from pyspark.sql import functions as F

from cartlens.operators.flat import flatten_rules
from cartlens.operators.name_index import (build_index, matching_names, required_runs,
                                           search_indexed)
from cartlens.operators.quarantine import check_messages, check_metrics
from cartlens.operators.serving import search_rules
from cartlens.plans import chain
from cartlens.plans.chain import ChainConfig, run_chain
from cartlens.session import scratch_path
from cartlens.sources.tables import order_lines, orders_table, products_table
from cartlens.sources.writers import write_parquet

MESSAGES = [
    ('{"order_id":1,"items":[2,3]}', None), ('{"items":[],"order_id":2,"more":{"x":1}}', None),
    ('{"order_id":3,"items":[null]}', None), (None, "no message"), ("", "empty message"),
    (" \t", "not a JSON object"), ("   ", "empty message"), ("not json", "not a JSON object"),
    ('{"order_id":1,"items":[2', "not a JSON object"), ("[1,2]", "not a JSON object"),
    ('{"items":[1]}', "no order id"), ('{"order_id":null,"items":[1]}', "no order id"),
    ('{"order_id":"a","items":[1]}', "order id is not a number"),
    ('{"order_id":99999999999999999999,"items":[1]}', "order id is not a number"),
    ('{"order_id":5}', "no items"), ('{"order_id":5,"items":7}', "items are not a list of numbers"),
    ('{"order_id":5,"items":["x"]}', "items are not a list of numbers"),
]


def test_messages_are_kept_with_their_reason(spark):
    df = spark.createDataFrame([(k, m, 1) for k, (m, _) in enumerate(MESSAGES)],
                               "k int, value string, items int")
    checked = check_messages(df)
    bad = {r["k"]: (r["value"], r["reason"]) for r in checked.bad.collect()}
    assert bad == {k: (m, r) for k, (m, r) in enumerate(MESSAGES) if r}
    good = {r["k"]: (r["order_id"], r["items"]) for r in checked.good.collect()}
    assert good == {0: (1, [2, 3]), 1: (2, []), 2: (3, [None])}
    assert sum(r["n"] for r in checked.counts().collect()) == len(MESSAGES)
    assert check_messages(df.limit(0)).counts().collect() == []


def test_good_messages_are_those_that_the_stream_keeps(spark):
    from cartlens.streaming.baskets import parse_baskets
    df = spark.createDataFrame([(m,) for m, _ in MESSAGES], "value string")
    parsed = parse_baskets(df).where("order_id IS NOT NULL AND items IS NOT NULL")
    good = check_messages(df).good
    assert good.exceptAll(parsed).count() == 0 == parsed.exceptAll(good).count()


def test_bad_metrics(spark):
    df = spark.createDataFrame([("a", "0.5", "1.5", "0.1"), ("b", "x", "NaN", None),
                                ("c", "0.5", None, "0.1"), ("d", "0.5", "2", "nan"),
                                ("e", " 1 ", "2", " ")],
                               "antecedent string, confidence string, lift string, support string")
    checked = check_metrics(df)
    assert {r["antecedent"]: r["reason"] for r in checked.bad.collect()} == {
        "b": "confidence is not a number", "c": "lift is missing", "d": "support is NaN",
        "e": "support is missing"}
    assert [tuple(r) for r in checked.good.collect()] == [("a", 0.5, 1.5, 0.1)]


def test_runs_that_a_pattern_requires():
    assert required_runs("a.b", regex=False) == ["a.b"]
    assert required_runs("abc") == ["abc"]
    assert required_runs("abc|def") == required_runs("(?i)abc") == required_runs(r"\Qab") == []
    assert [r for r in required_runs(r"bran?d\.x+y[0-9]z{2}q\d.end") if r] == [
        "bra", "d.x", "xy", "q"]
    assert [r for r in required_runs("^ab.*cd$") if r] == ["ab", "cd"]


NAMES = ["Brand#12", "BRAND#1, Brand#21", "ﬁne ſilk", "ΟΔΟΣ ς", "İstanbul", "straße", "Kelvin K",
         "a.b+c", "x", "", "ab", "Brandy", "bran d#1", None]
PATTERNS = ["brand#1", "BRAND", "b.and", r"a\.b", "silk", "ſilk", "fine", "ﬁne", "οδος", "ΟΔΟΣ",
            "istanbul", "İst", "strasse", "straße", "kelvin k", "ab", "x|brand", "[bc]rand#2?1",
            "brandy?", "ran+d", "$", "", "no such name", r"\w+#\d", "b{1}rand", "(br)and"]


def test_the_index_finds_what_a_scan_finds(spark):
    rng = random.Random(6)
    names = [*NAMES, *["".join(rng.choices("abAB#1 ", k=9)) for _ in range(200)]]
    rules = spark.createDataFrame(
        [(str(k), n, "c", "n", 0.1 * (k % 7), 1.0 + k % 5) for k, n in enumerate(names)],
        "antecedent string, antecedent_product_names string, consequent string, "
        "consequent_product_names string, confidence double, lift double").coalesce(2).cache()
    index = build_index(rules)
    for pattern in PATTERNS:
        want = [r["antecedent"] for r in search_rules(rules, pattern).collect()]
        got = [r["antecedent"] for r in search_indexed(rules, index, pattern).collect()]
        assert got == want, pattern
    for text in ("a.b+", "brand", "ßE", ""):
        want = [r["antecedent"] for r in search_rules(rules, text, regex=False).collect()]
        got = [r["antecedent"] for r in search_indexed(rules, index, text, regex=False).collect()]
        assert got == want, text


def test_a_search_reads_its_own_postings_only(spark):
    rules = spark.createDataFrame([(f"name {k}",) for k in range(50)],
                                  "antecedent_product_names string")
    found = matching_names(spark, build_index(rules), "name 7")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [folder#" in text and "In(gram" in text.replace(" ", "")


@pytest.fixture()
def inputs(spark, sf001):
    path = scratch_path(spark, "t-chain-in")
    write_parquet(orders_table(spark, sf001), f"{path}/orders")
    write_parquet(order_lines(spark, sf001), f"{path}/lines")
    write_parquet(products_table(spark, sf001), f"{path}/products")
    return path


def test_a_killed_chain_goes_on_after_its_last_stage(spark, inputs, monkeypatch):
    tables = lambda: [spark.read.parquet(f"{inputs}/{t}")
                      for t in ("orders", "lines", "products")]
    cfg = ChainConfig(output_dir=scratch_path(spark, "t-chain-out"), min_confidence=0.2)
    done = []
    first, second = chain.preprocess, chain.mine_stage
    monkeypatch.setattr(chain, "preprocess", lambda *a: done.append("preprocess") or first(*a))

    def killed(*a):
        done.append("mine")
        raise KeyboardInterrupt

    monkeypatch.setattr(chain, "mine_stage", killed)
    with pytest.raises(KeyboardInterrupt):
        run_chain(spark, *tables(), cfg, resume=True)
    assert done == ["preprocess", "mine"]
    monkeypatch.setattr(chain, "mine_stage", lambda *a: done.append("mine") or second(*a))
    out = run_chain(spark, *tables(), cfg, resume=True)
    assert done == ["preprocess", "mine", "mine"]
    again = run_chain(spark, *tables(), cfg, resume=True)
    assert done == ["preprocess", "mine", "mine"] and again == out
    whole = run_chain(spark, *tables(), ChainConfig(
        output_dir=scratch_path(spark, "t-chain-whole"), min_confidence=0.2))
    a, b = (flatten_rules(spark.read.parquet(x["rules_path"])) for x in (out, whole))
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count() and a.count() > 0
    # Other parameters mine again; a changed table starts anew.
    done.clear()
    run_chain(spark, *tables(), ChainConfig(output_dir=cfg.output_dir, min_confidence=0.5), resume=True)
    assert done == ["mine"]
    spark.createDataFrame([(1, 1)], "order_id long, product_id long").write.mode("append").parquet(
        f"{inputs}/lines")
    run_chain(spark, *tables(), cfg, resume=True)
    assert done == ["mine", "preprocess", "mine"]
    # The same files, read otherwise.
    done.clear()
    orders, lines, products = tables()
    run_chain(spark, orders, lines.where(F.col("product_id") < 20), products, cfg, resume=True)
    assert done == ["preprocess", "mine"]
