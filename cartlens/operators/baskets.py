"""Baskets: order lines -> one distinct item set per order.

Plan (one shuffle of the line data):

    lines --partial collect_set per order (map side)--> Exchange(order_id)
          --final collect_set, array_sort, size filter--> semi join orders

Grouping before the order join is equal to the join-then-group form (the
join only tests that the order exists, and a set ignores duplicates), and it
lets the partial aggregate shrink each map task's rows for an order to at
most the number of distinct items before anything is shuffled: an order
holding a third of all lines costs one small set per map task, not a third
of the data in one task.  The semi join then reuses the hash partitioning
on ``order_id`` the aggregate produced, so only the (pruned, one-column)
orders side moves.

Orders that hold very many lines are found by a heavy-hitter sketch
(``hot_orders``); only their lines are aggregated in two phases.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: An order with this share of all lines is hot.
HOT_SHARE = 0.001
#: Sets that a hot order is first cut into.
SALT_BUCKETS = 32


def hot_orders(lines: DataFrame, share: float = HOT_SHARE,
               order_col: str = "order_id") -> list:
    """Order ids that may hold at least ``share`` of all lines: all that do, and
    none with clearly fewer.  A frequent-items sketch of the whole table, merged
    map side; at most ``2 / share`` ids, however large the table."""
    wanted = max(1, math.ceil(2 / share))
    tracked = 1 << max(6, math.ceil(math.log2(4 / share)))
    row = (lines.where(F.col(order_col).isNotNull())
           .agg(F.expr(f"approx_top_k(`{order_col}`, {wanted}, {tracked})").alias("top"),
                F.count(F.lit(1)).alias("n")).first())
    return sorted(r["item"] for r in row["top"] or [] if r["count"] >= share * row["n"])


def build_baskets(orders: DataFrame, lines: DataFrame, order_col: str = "order_id",
                  item_col: str = "product_id", min_size: int = 2,
                  observation: Observation | None = None,
                  salt_buckets: int | None = None, hot: Sequence | None = None) -> DataFrame:
    """``order_id, items`` with ``items`` the sorted distinct non-null items of
    the order; orders without lines, unknown orders and baskets smaller than
    ``min_size`` are dropped.

    ``salt_buckets=S`` aggregates in two phases for extreme orders: sets are
    first built per (order, hash(item) mod S), so one order's merge is spread
    over S tasks, and the S disjoint sets are then concatenated per order.
    Without ``hot`` that costs every order a second (smaller) shuffle; with the
    ids of ``hot_orders`` only their lines take two phases."""
    pairs = lines.select(order_col, item_col)
    if hot is not None:
        is_hot = F.col(order_col).isin(list(hot))
        sets = _sets(pairs.where(F.col(order_col).isNotNull() & ~is_hot), order_col, item_col)
        if hot:
            sets = sets.unionByName(_salted_sets(pairs.where(is_hot), order_col, item_col,
                                                 salt_buckets or SALT_BUCKETS))
    elif salt_buckets and salt_buckets > 1:
        sets = _salted_sets(pairs, order_col, item_col, salt_buckets)
    else:
        sets = _sets(pairs, order_col, item_col)
    if min_size:
        sets = sets.where(F.size("items") >= min_size)
    baskets = sets.join(orders.select(order_col), order_col, "left_semi")
    if observation is not None:
        baskets = baskets.observe(observation, F.count(F.lit(1)).alias("baskets"),
                                  F.sum(F.size("items")).alias("basket_items"))
    return baskets


def _sets(pairs: DataFrame, order_col: str, item_col: str) -> DataFrame:
    return pairs.groupBy(order_col).agg(F.array_sort(F.collect_set(item_col)).alias("items"))


def _salted_sets(pairs: DataFrame, order_col: str, item_col: str, buckets: int) -> DataFrame:
    salt = F.pmod(F.hash(item_col), F.lit(int(buckets)))
    return (pairs.groupBy(order_col, salt.alias("_salt")).agg(F.collect_set(item_col).alias("_part"))
            .groupBy(order_col)
            .agg(F.array_sort(F.flatten(F.collect_list("_part"))).alias("items")))


def clean_baskets(baskets: DataFrame, items_col: str = "items", min_size: int = 2,
                  drop_null_items: bool = True, distinct: bool = True) -> DataFrame:
    """Make baskets from any source safe to mine: no null basket, no null
    item, no repeated item, at least ``min_size`` items."""
    items = F.col(items_col)
    if drop_null_items:
        items = F.filter(items, lambda x: x.isNotNull())
    if distinct:
        items = F.array_distinct(items)
    out = baskets.withColumn(items_col, items)
    return out.where(F.col(items_col).isNotNull() & (F.size(items_col) >= min_size))


def explode_items(baskets: DataFrame, order_col: str = "order_id", items_col: str = "items",
                  item_alias: str = "product_id") -> DataFrame:
    """One row per (order, item); null or empty baskets produce no rows, a null
    element produces a row with a null item."""
    return baskets.select(order_col, F.explode(items_col).alias(item_alias))
