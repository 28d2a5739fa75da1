"""The command-line stages chained over CSV inputs written from the test tables."""

from cartlens.cli import main
from cartlens.session import scratch_path
from cartlens.sources.tables import order_lines, orders_table, products_table
from cartlens.sources.writers import write_csv


def test_cli_chain(spark, sf001, capsys):
    root = scratch_path(spark, "t-cli")
    write_csv(orders_table(spark, sf001), f"{root}/orders.csv")
    write_csv(order_lines(spark, sf001), f"{root}/order_products.csv")
    write_csv(products_table(spark, sf001), f"{root}/products.csv")
    main(["preprocess", "--orders", f"{root}/orders.csv", "--order-lines",
          f"{root}/order_products.csv", "--out", f"{root}/baskets"], spark)
    out = main(["mine", "--baskets", f"{root}/baskets", "--products", f"{root}/products.csv",
                "--out", f"{root}/results", "--min-confidence", "0.15"], spark)
    assert out["baskets"] == 1351
    main(["export", "--results", f"{root}/results", "--out", f"{root}/csv", "--single-file"],
         spark)
    main(["enrich", "--rules-csv", f"{root}/csv/association_rules_csv", "--products",
          f"{root}/products.csv", "--out", f"{root}/named"], spark)
    sections = main(["analyze", "--rules-csv", f"{root}/named", "--min-lift", "1.1"], spark)
    assert "summary" in sections["sections"]
    assert spark.read.parquet(f"{root}/results/association_rules").count() == 1747
    assert "== top_lift" in capsys.readouterr().out
    main(["stream", "--source", "text", "--path", f"{root}/csv/frequent_itemsets_csv",
          "--parse-only", "--sink", "parquet", "--sink-path", f"{root}/stream-out",
          "--checkpoint", f"{root}/stream-ckpt", "--available-now"], spark)
    # itemset CSV lines are not basket JSON: every parsed row is all-null
    parsed = spark.read.parquet(f"{root}/stream-out")
    assert parsed.where("order_id is not null").count() == 0


def test_cli_with_hot_orders_one_line_files_and_a_ledger(spark, sf001):
    from cartlens.operators.baskets import build_baskets
    from cartlens.streaming import parse_baskets
    from cartlens.streaming.ledger import committed
    root = scratch_path(spark, "t-cli2")
    for name, df in (("orders", orders_table(spark, sf001)), ("lines", order_lines(spark, sf001)),
                     ("products", products_table(spark, sf001))):
        write_csv(df, f"{root}/{name}.csv")
    main(["preprocess", "--orders", f"{root}/orders.csv", "--order-lines", f"{root}/lines.csv",
          "--out", f"{root}/baskets", "--hot-share", "0.0005"], spark)
    got = spark.read.parquet(f"{root}/baskets")
    want = build_baskets(orders_table(spark, sf001), order_lines(spark, sf001))
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    main(["mine", "--baskets", f"{root}/baskets", "--products", f"{root}/products.csv",
          "--out", f"{root}/results", "--min-confidence", "0.3"], spark)
    main(["export", "--results", f"{root}/results", "--out", f"{root}/csv", "--one-line"], spark)
    main(["enrich", "--rules-csv", f"{root}/csv/association_rules_csv", "--products",
          f"{root}/products.csv", "--out", f"{root}/named", "--one-line"], spark)
    sections = main(["analyze", "--rules-csv", f"{root}/named", "--one-line"], spark)
    assert "top_lift" in sections["sections"]
    spark.createDataFrame([('{"order_id":1,"items":[2]}',)], "value string").write.text(
        f"{root}/messages")
    main(["stream", "--source", "text", "--path", f"{root}/messages", "--parse-only", "--sink",
          "ledger", "--sink-path", f"{root}/out", "--checkpoint", f"{root}/cp", "--available-now"],
         spark)
    like = parse_baskets(spark.createDataFrame([], "value string"))
    assert [tuple(r) for r in committed(spark, f"{root}/out", like).collect()] == [(1, [2])]
