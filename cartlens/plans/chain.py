"""The batch chain: preprocess -> mine -> label -> publish (-> serving table).

Each stage writes its result and the next reads it back, so a failed stage
restarts from files instead of from the raw tables, and nothing is recomputed
because an action ran twice.  With ``resume`` a ledger below the output folder
says which stages are done for the same input files and parameters; those are
not run again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartlens.operators.baskets import build_baskets, clean_baskets
from cartlens.operators.labels import label_rules
from cartlens.operators.mining import DEFAULT_MIN_CONFIDENCE, DEFAULT_MIN_SUPPORT, mine
from cartlens.plans.ledger import StageLedger, stage_key
from cartlens.sources.jdbc import load_rules
from cartlens.sources.writers import write_parquet


@dataclass
class ChainConfig:
    output_dir: str
    min_support: float = DEFAULT_MIN_SUPPORT
    min_confidence: float = DEFAULT_MIN_CONFIDENCE
    min_basket_size: int = 2
    salt_buckets: int | None = None
    num_partitions: int | None = None
    jdbc_url: str | None = None
    jdbc_table: str = "association_rules"
    jdbc_properties: dict[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.output_dir.rstrip('/')}/{name}"


def preprocess(orders: DataFrame, lines: DataFrame, cfg: ChainConfig,
               observation: Observation | None = None) -> str:
    """Stage 1: baskets written as Parquet (counts observed during the write,
    no extra pass)."""
    return write_parquet(build_baskets(orders, lines, min_size=cfg.min_basket_size,
                                       observation=observation,
                                       salt_buckets=cfg.salt_buckets),
                         cfg.path("transactions"))


def mine_stage(spark: SparkSession, baskets_path: str, products: DataFrame,
               cfg: ChainConfig) -> dict[str, object]:
    """Stage 2: read baskets, clean, mine (itemsets and rules are written once
    each), label the written rules, write the tables."""
    stored = spark.read.parquet(baskets_path)
    # A basket table of few files would leave most cores idle through the fit.
    wanted = cfg.num_partitions or spark.sparkContext.defaultParallelism
    if stored.rdd.getNumPartitions() < wanted:
        stored = stored.repartition(wanted)
    res = mine(clean_baskets(stored, min_size=cfg.min_basket_size), min_support=cfg.min_support,
               min_confidence=cfg.min_confidence, num_partitions=cfg.num_partitions)
    itemsets_path = write_parquet(res.itemsets, cfg.path("frequent_itemsets"))
    observed = Observation("rules")
    rules = label_rules(res.rules, products).observe(observed, F.count(F.lit(1)).alias("n"))
    rules_path = write_parquet(rules, cfg.path("association_rules"))
    return {"baskets": res.n_baskets, "itemsets_path": itemsets_path, "rules_path": rules_path,
            "rules": observed.get["n"]}


def run_chain(spark: SparkSession, orders: DataFrame, lines: DataFrame,
                 products: DataFrame, cfg: ChainConfig, resume: bool = False) -> dict[str, object]:
    """preprocess >> mine >> load; the load runs only when a JDBC URL is set.

    With ``resume`` every run of a stage writes to a folder of its own, and a
    stage that the ledger has for the same inputs (tables read from files) and
    parameters is left out."""
    def first(cfg: ChainConfig) -> dict[str, object]:
        observed = Observation("preprocess")
        path = preprocess(orders, lines, cfg, observed)
        return {"baskets_path": path, "preprocess": dict(observed.get)}

    if not resume:
        result = first(cfg)
        result.update(mine_stage(spark, result["baskets_path"], products, cfg))
    else:
        ledger = StageLedger(spark, cfg.path("ledger"))
        anew = lambda: replace(cfg, output_dir=cfg.path(f"run-{uuid.uuid4().hex[:12]}"))
        key = stage_key(spark, [orders, lines], {
            "min_basket_size": cfg.min_basket_size, "rows": _plan(orders, lines)})
        result = ledger.run("preprocess", key, lambda: first(anew()))
        key = stage_key(spark, [products, result["baskets_path"]], {
            "min_basket_size": cfg.min_basket_size, "min_support": cfg.min_support,
            "min_confidence": cfg.min_confidence, "rows": _plan(products)})
        result |= ledger.run("mine", key, lambda: mine_stage(spark, result["baskets_path"],
                                                             products, anew()))
    if cfg.jdbc_url:
        result["load"] = load_rules(spark.read.parquet(result["rules_path"]), cfg.jdbc_url,
                                    cfg.jdbc_table, cfg.jdbc_properties)
    return result


def _plan(*tables: DataFrame) -> list[str]:
    """What is done to the files: two inputs over the same files may differ.  The
    canonical form has no numbers that change from session to session."""
    return [t._jdf.queryExecution().optimizedPlan().canonicalized().toString() for t in tables]
