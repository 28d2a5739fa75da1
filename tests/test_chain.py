from cartlens.plans.catalog import MiningConfig, products
from cartlens.plans.chain import ChainConfig, run_chain
from cartlens.session import scratch_path
from cartlens.sources.tables import order_lines, orders_table


def test_batch_chain(spark, sf001):
    cfg = ChainConfig(output_dir=scratch_path(spark, "t-chain"), min_confidence=0.15)
    out = run_chain(spark, orders_table(spark, sf001), order_lines(spark, sf001),
                    products(spark, sf001, MiningConfig()), cfg)
    assert out["preprocess"]["baskets"] == 1351 == out["baskets"]
    assert out["rules"] == 1747
    assert spark.read.parquet(out["itemsets_path"]).count() == 867
    rules = spark.read.parquet(out["rules_path"])
    assert rules.where("antecedent_product_names = ''").count() == 0


def test_catalog_mines_once_across_threads(spark, sf001):
    from concurrent.futures import ThreadPoolExecutor

    from cartlens.plans import catalog
    cfg = MiningConfig(min_confidence=0.3)    # a configuration no other test mines
    with ThreadPoolExecutor(3) as pool:
        results = list(pool.map(lambda _: catalog.mined(spark, sf001, cfg), range(3)))
    assert results[0] is results[1] is results[2]
    assert results[0].n_baskets == 1351
