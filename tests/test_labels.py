import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartlens.operators.flat import enrich_flat_rules
from cartlens.operators.labels import label_arrays, label_itemsets, label_rules
from cartlens.schemas import PRODUCT

BIG = 3_000_000_000      # beyond 32 bits
PRODUCTS = [(40, "rope"), (BIG, "lamp oil"), (7, "Zinc, 'fine'"), (8, "rope"), (9, None),
            (7, "Aged zinc"), (40, "rope")]       # two ids stand twice, one under two names
METRICS = "confidence double, lift double, support double"


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(PRODUCTS, PRODUCT)


@pytest.mark.parametrize("ids, names", [
    ([BIG, 40], "lamp oil, rope"),               # in the array's order, not sorted
    ([40, 8], "rope, rope"),                     # two ids of one name
    ([7], "Aged zinc"),                          # of two names the first in order
    ([9, BIG], "lamp oil"),                      # a null name is none
    ([555, 40, None], "rope"), ([555], ""), ([], ""), (None, ""),
])
def test_names_of_an_array(spark, products, ids, names):
    rules = spark.createDataFrame([(ids, [8], 0.5, 1.25, 0.1)],
                                  f"antecedent array<bigint>, consequent array<bigint>, {METRICS}")
    out = label_rules(rules, products)
    assert out.columns == ["antecedent", "antecedent_product_names", "consequent",
                           "consequent_product_names", "confidence", "lift", "support"]
    assert out.collect() == [(ids, names, [8], "rope", 0.5, 1.25, 0.1)]


def test_set_semantics_and_ids_in_place_of_names(spark, products):
    df = spark.createDataFrame([([40, 8, BIG],), ([555, 9, 40],)], "items array<bigint>")
    named = {tuple(r["items"]): r.names for r in
             label_arrays(df, {"items": "names"}, products, distinct=True).collect()}
    assert named == {(40, 8, BIG): "rope, lamp oil", (555, 9, 40): "rope"}
    shown = {tuple(r["items"]): r.products for r in label_itemsets(df, products).collect()}
    assert shown == {(40, 8, BIG): "rope, rope, lamp oil", (555, 9, 40): "555, 9, rope"}


def test_ids_read_as_text(spark):
    products = spark.createDataFrame([("12", "tar"), ("13", "pitch"), ("x", "no id")],
                                     "product_id string, product_name string")
    df = spark.createDataFrame([([13, 12],)], "items array<bigint>")
    assert label_arrays(df, {"items": "n"}, products).first().n == "pitch, tar"


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.lists(st.sampled_from([1, 2, 3, BIG]), max_size=3),
                          st.lists(st.sampled_from([1, 2]), min_size=1, max_size=2),
                          st.floats(0, 1)), min_size=1, max_size=8),
       st.lists(st.tuples(st.sampled_from([1, 2, 3, BIG]), st.sampled_from(["p", "q", None])),
                max_size=6), st.booleans())
def test_rows_out_are_rows_in(spark, rules, products, reduce):
    """Rules and products repeat as they like: each row keeps its own metric and
    gets one name per id."""
    names = {}
    for i, n in products:
        names[i] = min(names.get(i) or "z", n or "z")
    text = lambda ids: ", ".join(names[i] for i in ids if names.get(i, "z") != "z")
    df = spark.createDataFrame(rules, "antecedent array<bigint>, consequent array<bigint>, "
                                      "confidence double")
    dim = spark.createDataFrame(products, PRODUCT)
    got = label_rules(df, dim, reduce_dimension=reduce).collect()
    assert sorted(map(tuple, got)) == sorted((a, text(a), c, text(c), m) for a, c, m in rules)


def test_repeated_flat_rules_stay_repeated(spark, products):
    flat = spark.createDataFrame([("40,8", "7", 0.5, 2.0), ("40,8", "7", 0.25, 1.0),
                                  ("40,8", "7", 0.25, 1.0), (str(BIG), "oops", 0.1, 1.5)],
                                 "antecedent string, consequent string, confidence double, "
                                 "lift double")
    rows = sorted(map(tuple, enrich_flat_rules(flat, products).collect()))
    assert rows == [(str(BIG), "lamp oil", "oops", "", 0.1, 1.5),
                    ("40,8", "rope, rope", "7", "Aged zinc", 0.25, 1.0),
                    ("40,8", "rope, rope", "7", "Aged zinc", 0.25, 1.0),
                    ("40,8", "rope, rope", "7", "Aged zinc", 0.5, 2.0)]
