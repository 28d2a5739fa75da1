"""Results shared by the registered queries of one session.

Mining is the expensive step and its outputs are small, so a session mines
each (tables, level, thresholds) combination once: itemsets and rules are
written below the checkpoint root and every report, export and dashboard
view reads the written tables, the way the batch chain hands results from
one job to the next through files.  What is kept is keyed by the tables' file
listings, so changed files are mined anew.
"""

from __future__ import annotations

import threading
from collections import OrderedDict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.operators.baskets import build_baskets
from cartlens.operators.labels import label_itemsets, label_rules
from cartlens.operators.mining import MiningResult, mine
from cartlens.plans.materialize import materialize
from cartlens.session import session_id
from cartlens.sources.listing import fingerprint
from cartlens.sources.tables import order_lines, orders_table, products_table
from cartlens.sources.writers import basket_messages


@dataclass(frozen=True)
class MiningConfig:
    level: str = "brand"
    min_support: float = 0.005
    min_confidence: float = 0.15


#: Results kept; the one not asked for longest goes first.
MEMO_ENTRIES = 16
_MEMO: OrderedDict[tuple, object] = OrderedDict()
_LOCK = threading.RLock()   # queries run from several threads mine only once
TABLES = ("orders", "lineitem", "part")


def _contents(spark: SparkSession, sf_dir: str) -> str:
    """What the tables' files are now.  Only their listing is read."""
    return fingerprint(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TABLES])


def remembered(spark: SparkSession, sf_dir: str, cfg: MiningConfig, what: str, make):
    """``make()``, or what it gave before over the same files."""
    key = (session_id(spark), sf_dir.rstrip("/"), _contents(spark, sf_dir), cfg, what)
    with _LOCK:
        if key not in _MEMO:
            _MEMO[key] = make()
            while len(_MEMO) > MEMO_ENTRIES:
                _MEMO.popitem(last=False)
        _MEMO.move_to_end(key)
        return _MEMO[key]


def baskets(spark: SparkSession, sf_dir: str, cfg: MiningConfig = MiningConfig()) -> DataFrame:
    """Lazy basket plan over the given tables (``order_id, items``)."""
    return build_baskets(orders_table(spark, sf_dir), order_lines(spark, sf_dir, cfg.level))


def products(spark: SparkSession, sf_dir: str, cfg: MiningConfig = MiningConfig()) -> DataFrame:
    return products_table(spark, sf_dir, cfg.level)


def mined(spark: SparkSession, sf_dir: str, cfg: MiningConfig = MiningConfig()) -> MiningResult:
    return remembered(spark, sf_dir, cfg, "mined", lambda: mine(
        baskets(spark, sf_dir, cfg), min_support=cfg.min_support,
        min_confidence=cfg.min_confidence))


def named_rules(spark: SparkSession, sf_dir: str, cfg: MiningConfig = MiningConfig()) -> DataFrame:
    """Rules with product names (array ids), written once per session."""
    return remembered(spark, sf_dir, cfg, "named_rules", lambda: materialize(
        label_rules(mined(spark, sf_dir, cfg).rules, products(spark, sf_dir, cfg)),
        "named-rules"))


def known_products(spark: SparkSession, sf_dir: str,
                   cfg: MiningConfig = MiningConfig()) -> DataFrame:
    """The dimension without every fourth id, as when products are delisted:
    lookups meet ids they do not know."""
    return products(spark, sf_dir, cfg).where("product_id % 4 <> 0")


def named_itemsets(spark: SparkSession, sf_dir: str,
                   cfg: MiningConfig = MiningConfig()) -> DataFrame:
    """Itemsets with names from ``known_products``, unknown ids as themselves."""
    return remembered(spark, sf_dir, cfg, "named_itemsets", lambda: materialize(
        label_itemsets(mined(spark, sf_dir, cfg).itemsets, known_products(spark, sf_dir, cfg)),
        "named-itemsets"))


def messages(spark: SparkSession, sf_dir: str, cfg: MiningConfig = MiningConfig()) -> DataFrame:
    """``order_id, value``: the baskets' JSON messages, written once per session.
    Of every 11 orders one message is cut off, of every 13 one has no items."""
    def make() -> DataFrame:
        sent = basket_messages(baskets(spark, sf_dir, cfg)).select(
            F.col("key").cast("long").alias("order_id"), "value")
        value = (F.when(F.col("order_id") % 11 == 0, F.substring("value", 1, 12))
                 .when(F.col("order_id") % 13 == 0,
                       F.format_string('{"order_id":%d}', F.col("order_id")))
                 .otherwise(F.col("value")))
        return materialize(sent.select("order_id", value.alias("value")), "messages")
    return remembered(spark, sf_dir, cfg, "messages", make)


def clear() -> None:
    with _LOCK:
        _MEMO.clear()
