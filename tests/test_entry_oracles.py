"""Driver contract and oracle agreement on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

ALL_KEYS = sorted(entry.oracle_sql())


def _rows(rows):
    def k(r):
        return tuple((v is None, str(type(v)), v if v is not None else 0) for v in r)
    return sorted((tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in r)
                   for r in rows), key=k)


def test_contract(spark, sf001):
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 40
    df = entry.entry(spark)
    assert df.columns == ["antecedent", "antecedent_product_names", "consequent",
                          "consequent_product_names", "confidence", "lift", "support"]
    assert df.count() == 1747


@pytest.mark.parametrize("name", ALL_KEYS)
def test_query_matches_oracle(spark, sf001, name):
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf001}/{t}.parquet')")
    df = entry.queries()[name](spark, sf001)
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    orows = cur.fetchall()
    idx = [ocols.index(c) for c in df.columns]
    assert _rows(df.collect()) == _rows([tuple(r[i] for i in idx) for r in orows])
    assert os.path.exists(sf001)


def test_oracle_cte_exact_with_four_item_sets(spark, sf001):
    """At a lower support 4-item sets are frequent; the oracle's itemsets and
    named rules still equal what Spark mines."""
    from cartlens.operators.flat import flatten_itemsets, flatten_rules
    from cartlens.operators.labels import label_rules
    from cartlens.operators.mining import mine
    from cartlens.plans import catalog
    from cartlens.plans.oracle import mining_cte
    res = mine(catalog.baskets(spark, sf001), min_support=0.004, min_confidence=0.3)
    assert max(r.item_count for r in res.itemsets.collect()) == 4
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf001}/{t}.parquet')")
    cte = mining_cte(0.004, 0.3)
    want_sets = con.execute(f"WITH {cte} SELECT items, freq, item_count FROM itemsets").fetchall()
    want_rules = con.execute(f"""WITH {cte} SELECT antecedent, antecedent_product_names,
        consequent, consequent_product_names, confidence, lift, support FROM named""").fetchall()
    got_sets = [tuple(r) for r in flatten_itemsets(res.itemsets).collect()]
    got_rules = [tuple(r) for r in flatten_rules(
        label_rules(res.rules, catalog.products(spark, sf001))).collect()]
    assert sorted(got_sets) == sorted(want_sets) and len(got_sets) == 1101
    assert sorted(got_rules) == sorted(want_rules) and len(got_rules) == 227
