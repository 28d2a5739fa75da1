"""Randomised checks against plain-Python reference implementations."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartlens.operators.baskets import build_baskets
from cartlens.schemas import ORDER, ORDER_LINE

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))

lines_st = st.lists(st.tuples(st.integers(1, 8), st.one_of(st.none(), st.integers(1, 6))),
                    max_size=40)
orders_st = st.sets(st.integers(1, 10), max_size=10)


@SETTINGS
@given(lines=lines_st, orders=orders_st, min_size=st.sampled_from([1, 2, 3]),
       salt=st.sampled_from([None, 3]))
def test_baskets_match_python(spark, lines, orders, min_size, salt):
    want = {}
    for o, i in lines:
        if o in orders and i is not None:
            want.setdefault(o, set()).add(i)
    want = {o: sorted(s) for o, s in want.items() if len(s) >= min_size}
    got = build_baskets(spark.createDataFrame([(o,) for o in orders], ORDER),
                        spark.createDataFrame(lines, ORDER_LINE), min_size=min_size,
                        salt_buckets=salt)
    assert {r.order_id: r["items"] for r in got.collect()} == want


texts_st = st.lists(st.tuples(*[st.one_of(st.none(), st.text(
    alphabet=["a", " ", '"', "\\", "N", "\n", ",", "é", "'", "#"], max_size=6))] * 2),
    min_size=1, max_size=12)


@SETTINGS
@given(rows=texts_st, single=st.booleans())
def test_csv_keeps_texts(spark, rows, single):
    """Padding, quotes, backslashes, line breaks, empty and null texts and the
    null mark itself come back as they were."""
    from cartlens.schemas import PRODUCT_TEXT
    from cartlens.session import scratch_path
    from cartlens.sources.readers import read_csv, read_csv_columns
    from cartlens.sources.writers import write_csv
    path = write_csv(spark.createDataFrame(rows, PRODUCT_TEXT), scratch_path(spark, "t-texts"),
                     single_file=single)
    order = lambda r: tuple((x is not None, x or "") for x in r)
    for back in (read_csv(spark, path, PRODUCT_TEXT, multi_line=True),
                 read_csv_columns(spark, path, PRODUCT_TEXT, multi_line=True)):
        assert sorted(map(tuple, back.collect()), key=order) == sorted(rows, key=order)
