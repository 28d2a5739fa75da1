"""Command-line stages of the batch chain and the stream, for spark-submit.

    spark-submit -m cartlens preprocess --orders o.csv --order-lines op.csv --out baskets
    spark-submit -m cartlens mine --baskets baskets --products products.csv --out results
    spark-submit -m cartlens export --results results --out csv
    spark-submit -m cartlens enrich --rules-csv csv/association_rules --products products.csv --out named
    spark-submit -m cartlens analyze --rules-csv named
    spark-submit -m cartlens load --results results --url jdbc:... --table association_rules
    spark-submit -m cartlens stream --bootstrap kafka:9092 --topic t --checkpoint ckpt
    spark-submit -m cartlens publish --baskets baskets --bootstrap kafka:9092 --topic t

Every stage reads its inputs, runs the library operators and writes its
output; all paths and thresholds are arguments.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cartlens import defaults as D
from cartlens.operators import report
from cartlens.operators.baskets import build_baskets, hot_orders
from cartlens.operators.flat import enrich_flat_rules, flatten_itemsets, flatten_rules
from cartlens.plans import chain
from cartlens.schemas import FLAT_RULE, ORDER, ORDER_LINE
from cartlens.session import build_session
from cartlens.sources.jdbc import load_rules
from cartlens.sources.readers import (products_from_text, read_csv_columns,
                                      read_named_rules_csv, read_products_csv)
from cartlens.sources.writers import basket_messages, write_csv, write_kafka, write_parquet
from cartlens.streaming import parse_baskets, read_messages, run_to_completion, start_sink
from cartlens.streaming.baskets import valid_items
from cartlens.streaming.ledger import start_ledger_sink
from cartlens.streaming.start import read_latest


def _table(spark: SparkSession, path: str, columns) -> DataFrame:
    """The named columns of a CSV file with header (when the path ends in
    .csv) or of a Parquet table."""
    if path.endswith(".csv"):
        return read_csv_columns(spark, path, columns)
    return spark.read.parquet(path).select(*columns.fieldNames())


def _products(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".csv"):
        return read_products_csv(spark, path)
    return products_from_text(spark.read.parquet(path))


def preprocess(spark, a) -> dict:
    orders = _table(spark, a.orders, ORDER)
    lines = _table(spark, a.order_lines, ORDER_LINE)
    hot = None if a.hot_share is None else hot_orders(lines, a.hot_share)
    baskets = build_baskets(orders, lines, min_size=a.min_size, salt_buckets=a.salt_buckets,
                            hot=hot)
    return {"baskets": write_parquet(baskets, a.out)}


def mine_stage(spark, a) -> dict:
    out = a.out.rstrip("/")
    cfg = chain.ChainConfig(output_dir=out, min_support=a.min_support,
                            min_confidence=a.min_confidence, min_basket_size=a.min_size,
                            num_partitions=a.num_partitions)
    res = chain.mine_stage(spark, a.baskets, _products(spark, a.products), cfg)
    report.top_rules_rounded(spark.read.parquet(res["rules_path"])).show(
        D.TOP_RULES, truncate=False)
    return {"baskets": res["baskets"], "out": out}


def export(spark, a) -> dict:
    res, out = a.results.rstrip("/"), a.out.rstrip("/")
    write_csv(flatten_itemsets(spark.read.parquet(f"{res}/frequent_itemsets")),
              f"{out}/frequent_itemsets_csv", single_file=a.single_file, one_line=a.one_line)
    write_csv(flatten_rules(spark.read.parquet(f"{res}/association_rules")),
              f"{out}/association_rules_csv", single_file=a.single_file, one_line=a.one_line)
    return {"out": out}


def enrich(spark, a) -> dict:
    flat = read_csv_columns(spark, a.rules_csv, FLAT_RULE, allow_missing=True, multi_line=True,
                            one_line=a.one_line)
    products = _products(spark, a.products).selectExpr(
        "CAST(product_id AS STRING) AS product_id", "product_name")
    write_csv(enrich_flat_rules(flat, products), a.out, single_file=a.single_file,
              one_line=a.one_line)
    return {"out": a.out}


def analyze(spark, a) -> dict:
    rules = read_named_rules_csv(spark, a.rules_csv, one_line=a.one_line)
    sections = report.rule_report(rules, a.min_lift, a.min_confidence)
    for name, df in sections.items():
        print(f"== {name}")
        df.show(D.REPORT_ROWS, truncate=False)
    return {"sections": list(sections)}


def load(spark, a) -> dict:
    props = {"user": a.user or "", "password": a.password or ""}
    if a.driver:
        props["driver"] = a.driver
    rules = spark.read.parquet(f"{a.results.rstrip('/')}/association_rules")
    return load_rules(rules, a.url, a.table, props)


def stream(spark, a) -> dict:
    if a.source == "text" and a.starting_offsets == "latest":
        messages = read_latest(spark, a.path, a.checkpoint, a.max_per_trigger)
    else:
        messages = read_messages(spark, a.source, path=a.path, bootstrap_servers=a.bootstrap,
                                 topic=a.topic, starting_offsets=a.starting_offsets,
                                 max_per_trigger=a.max_per_trigger)
    rows = (parse_baskets(messages) if a.parse_only
            else valid_items(parse_baskets(messages), observe_as="basket_stream"))
    if a.sink == "ledger":
        query = start_ledger_sink(rows, a.sink_path, a.checkpoint, a.available_now)
    else:
        query = start_sink(rows, a.sink, checkpoint=a.checkpoint, path=a.sink_path,
                           available_now=a.available_now, processing_time=a.processing_time)
    if a.available_now:
        run_to_completion(query)
    else:
        query.awaitTermination()
    return {"query": query.name or str(query.id)}


def publish(spark, a) -> dict:
    write_kafka(basket_messages(spark.read.parquet(a.baskets)), a.bootstrap, a.topic)
    return {"topic": a.topic}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cartlens")
    sub = p.add_subparsers(dest="stage", required=True)

    s = sub.add_parser("preprocess")
    s.add_argument("--orders", required=True)
    s.add_argument("--order-lines", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--min-size", type=int, default=D.MIN_BASKET_SIZE)
    s.add_argument("--salt-buckets", type=int, default=None,
                   help="two-phase aggregation for extremely large orders")
    s.add_argument("--hot-share", type=float, default=None,
                   help="find orders with this share of all lines; only they take two phases")
    s.set_defaults(run=preprocess)

    s = sub.add_parser("mine")
    s.add_argument("--baskets", required=True)
    s.add_argument("--products", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--min-size", type=int, default=D.MIN_BASKET_SIZE)
    s.add_argument("--min-support", type=float, default=D.MIN_SUPPORT)
    s.add_argument("--min-confidence", type=float, default=D.MIN_CONFIDENCE)
    s.add_argument("--num-partitions", type=int, default=None)
    s.set_defaults(run=mine_stage)

    s = sub.add_parser("export")
    s.add_argument("--results", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--single-file", action="store_true")
    s.add_argument("--one-line", action="store_true", help="CSV with one row per line")
    s.set_defaults(run=export)

    s = sub.add_parser("enrich")
    s.add_argument("--rules-csv", required=True)
    s.add_argument("--products", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--single-file", action="store_true")
    s.add_argument("--one-line", action="store_true", help="CSV with one row per line")
    s.set_defaults(run=enrich)

    s = sub.add_parser("analyze")
    s.add_argument("--rules-csv", required=True)
    s.add_argument("--one-line", action="store_true", help="CSV with one row per line")
    s.add_argument("--min-lift", type=float, default=D.STRONG_LIFT)
    s.add_argument("--min-confidence", type=float, default=D.HIGH_CONFIDENCE)
    s.set_defaults(run=analyze)

    s = sub.add_parser("load")
    s.add_argument("--results", required=True)
    s.add_argument("--url", required=True)
    s.add_argument("--table", default="association_rules")
    s.add_argument("--user")
    s.add_argument("--password")
    s.add_argument("--driver")
    s.set_defaults(run=load)

    s = sub.add_parser("stream")
    s.add_argument("--source", choices=["kafka", "text"], default="kafka")
    s.add_argument("--bootstrap")
    s.add_argument("--topic")
    s.add_argument("--path")
    s.add_argument("--starting-offsets", default="earliest")
    s.add_argument("--max-per-trigger", type=int, default=D.MAX_OFFSETS_PER_TRIGGER)
    s.add_argument("--parse-only", action="store_true")
    s.add_argument("--sink", default="console",
                   help="a streaming format, or ledger: files with a ledger of batches")
    s.add_argument("--sink-path")
    s.add_argument("--checkpoint")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--processing-time", default=None,
                   help='micro-batch interval, e.g. "10 seconds" (default: as fast as possible)')
    s.set_defaults(run=stream)

    s = sub.add_parser("publish")
    s.add_argument("--baskets", required=True)
    s.add_argument("--bootstrap", required=True)
    s.add_argument("--topic", required=True)
    s.set_defaults(run=publish)
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    spark = spark or build_session(app_name=f"cartlens-{args.stage}")
    return args.run(spark, args)


def run() -> int:
    """Console-script entry: run a stage, print its summary, exit 0."""
    print(main())
    return 0


if __name__ == "__main__":
    run()
