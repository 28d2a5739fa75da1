"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key of
the operator inventory.  Every query reads the given tables (or tables Spark
derived from them in this session) in full.

Conventions shared with the SQL oracles: id arrays are returned as sorted,
comma-joined text; averages are rounded to 9 digits; every limit follows a
total order (metric, then the rule/itemset key as text).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.functions.codec import ids_to_text
from cartlens.operators import report, serving
from cartlens.operators.baskets import (build_baskets, clean_baskets, explode_items,
                                        hot_orders)
from cartlens.operators.flat import (enrich_flat_rules, flatten_itemsets, flatten_rules,
                                     split_rule_ids)
from cartlens.operators.labels import label_arrays
from cartlens.operators.name_index import build_index, search_indexed
from cartlens.operators.quarantine import check_messages, check_metrics
from cartlens.plans import catalog
from cartlens.plans.catalog import MiningConfig
from cartlens.plans.chain import ChainConfig, run_chain
from cartlens.schemas import FLAT_ITEMSET, FLAT_RULE, FLAT_RULE_TEXT, ORDER, ORDER_LINE
from cartlens.session import scratch_path
from cartlens.sources.bucketed import read_bucketed, write_bucketed
from cartlens.sources.kafka import peek_messages
from cartlens.sources.readers import (read_csv, read_csv_columns, read_named_rules_csv,
                                      read_products_csv)
from cartlens.sources.tables import (brand_number, order_lines, orders_table, products_table,
                                     table)
from cartlens.sources.writers import (basket_messages, preview, write_csv, write_messages,
                                      write_parquet)
from cartlens.streaming.baskets import (parse_baskets, read_messages, run_to_completion,
                                        start_sink, valid_items)
from cartlens.streaming.ledger import committed, start_ledger_sink
from cartlens.streaming.progress import keep_progress, progress_table
from cartlens.streaming.start import read_latest

# Parameters of the registered queries (brand-level items).
CFG = MiningConfig(level="brand", min_support=0.005, min_confidence=0.15)
STRONG_LIFT = 1.1          # strict lift threshold of the strong-rule report
HIGH_CONFIDENCE = 0.20     # strict confidence threshold of the report
SLIDER_CONFIDENCE = 0.18   # inclusive dashboard filter
SLIDER_LIFT = 1.05
SEARCH_TEXT = "brand#1"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


# ---------------------------------------------------------------- helpers

def _flat_baskets(baskets: DataFrame) -> DataFrame:
    return baskets.select(F.col("order_id").cast("long").alias("order_id"),
                          ids_to_text("items").alias("items"),
                          F.size("items").alias("item_count"))


def _flat_named(spark: SparkSession, d: str) -> DataFrame:
    return flatten_rules(catalog.named_rules(spark, d, CFG))


def _flat_named_itemsets(spark: SparkSession, d: str) -> DataFrame:
    named = catalog.named_itemsets(spark, d, CFG)
    return named.select(ids_to_text("items").alias("items"), "products", "freq", "item_count")


def _dirty_rules(spark: SparkSession, d: str) -> DataFrame:
    """Named rules as a table filled by hand: metrics are text, some are no
    number, some NaN, some missing."""
    named = _flat_named(spark, d)
    con = F.col("consequent").cast("long")
    bad = {"confidence": F.when(con % 5 == 0, F.lit("n/a")),
           "lift": F.when(con % 7 == 0, F.lit("NaN")),
           "support": F.when(con % 9 == 0, F.lit(""))}
    return named.select(*[F.coalesce(bad[c], F.col(c).cast("string")).alias(c) if c in bad
                          else F.col(c) for c in named.columns])


# ---------------------------------------------------------------- baskets

@query("baskets")
def q_baskets(spark, d):
    return _flat_baskets(catalog.baskets(spark, d, CFG))


@query("order_lines")
def q_order_lines(spark, d):
    return (orders_table(spark, d).join(order_lines(spark, d, CFG.level), "order_id", "inner")
            .select("order_id", "product_id"))


def _bucketed(spark, d) -> tuple[DataFrame, DataFrame]:
    """Orders and lines, each written once in buckets of the order id."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (read_bucketed(spark, write_bucketed(orders_table(spark, d), ["order_id"], n, "orders")),
            read_bucketed(spark, write_bucketed(order_lines(spark, d, CFG.level), ["order_id"], n,
                                                "order_lines")))


@query("order_lines_bucketed")
def q_order_lines_bucketed(spark, d):
    orders, lines = _bucketed(spark, d)
    return orders.join(lines, "order_id", "inner").select("order_id", "product_id")


@query("baskets_bucketed")
def q_baskets_bucketed(spark, d):
    return _flat_baskets(build_baskets(*_bucketed(spark, d)))


@query("baskets_hot_order")
def q_baskets_hot_order(spark, d):
    """Order lines of which one order holds a third: the lines of every third
    order are booked on the first one that has lines."""
    lines = order_lines(spark, d, CFG.level)
    first = lines.select(F.min("order_id")).scalar()
    lines = lines.withColumn("order_id", F.when(F.col("order_id") % 3 == 0, first)
                             .otherwise(F.col("order_id")))
    hot = hot_orders(lines)
    return _flat_baskets(build_baskets(orders_table(spark, d), lines, hot=hot))


@query("clean_baskets")
def q_clean_baskets(spark, d):
    """Baskets as another tool might write them: items repeat, and those of
    every seventh part are missing."""
    lines = order_lines(spark, d, "part").alias("l")
    brand = table(spark, d, "part").select(F.col("p_partkey").alias("product_id"),
                                           brand_number(F.col("p_brand")).alias("brand"))
    item = F.when(F.col("product_id") % 7 != 0, F.col("brand"))
    raw = (lines.join(brand, "product_id", "left").groupBy("order_id")
           .agg(F.collect_list(F.struct(item.alias("i"))).alias("s"))
           .select("order_id", F.transform("s", lambda x: x["i"]).alias("items"))
           .join(orders_table(spark, d), "order_id", "left_semi"))
    clean = clean_baskets(raw, min_size=2)
    return _flat_baskets(clean.withColumn("items", F.array_sort("items")))


@query("exploded_items")
def q_exploded_items(spark, d):
    return explode_items(catalog.baskets(spark, d, CFG))


@query("csv_roundtrip")
def q_csv_roundtrip(spark, d):
    root = scratch_path(spark, "csv-input")
    write_csv(orders_table(spark, d), f"{root}/orders")
    write_csv(order_lines(spark, d, CFG.level), f"{root}/order_products")
    orders = read_csv_columns(spark, f"{root}/orders", ORDER)
    lines = read_csv_columns(spark, f"{root}/order_products", ORDER_LINE)
    return _flat_baskets(build_baskets(orders, lines))


@query("product_dim")
def q_product_dim(spark, d):
    """Ids and names by way of text files.  Some names are padded, quoted,
    broken over lines, empty or missing; some ids are no number, and one in
    four is beyond 32 bits."""
    path = write_csv(_odd_products(spark, d), scratch_path(spark, "products-csv"))
    return read_products_csv(spark, path)


@query("product_dim_one_line")
def q_product_dim_one_line(spark, d):
    """The same by way of files with one row per line, which tasks can split."""
    path = write_csv(_odd_products(spark, d), scratch_path(spark, "products-lines"), one_line=True)
    return read_products_csv(spark, path, one_line=True)


def _odd_products(spark, d) -> DataFrame:
    k, name = F.col("product_id"), F.col("product_name")
    key = (F.when(k % 17 == 0, F.concat(F.lit("no"), k))
           .when(k % 4 == 0, (k + 3_000_000_000).cast("string")).otherwise(k.cast("string")))
    odd = (F.when(k % 6 == 0, F.concat(F.lit("  "), name, F.lit(" ")))
           .when(k % 6 == 1, F.concat(F.lit('"'), name, F.lit('", \\')))
           .when(k % 6 == 2, F.concat(name, F.lit("\n"), name))
           .when(k % 6 == 3, F.lit("")).when(k % 6 == 4, F.lit(None)).otherwise(name))
    return products_table(spark, d, "part").select(key.alias("product_id"),
                                                   odd.alias("product_name"))


# ---------------------------------------------------------------- mining

@query("freq_itemsets")
def q_freq_itemsets(spark, d):
    return flatten_itemsets(catalog.mined(spark, d, CFG).itemsets)


@query("rules")
def q_rules(spark, d):
    return flatten_rules(catalog.mined(spark, d, CFG).rules)


@query("rules_named")
def q_rules_named(spark, d):
    return _flat_named(spark, d)


@query("names_by_array")
def q_names_by_array(spark, d):
    rules = catalog.mined(spark, d, CFG).rules
    arrays = (rules.select(F.lit("antecedent").alias("side"), F.col("antecedent").alias("ids"))
              .unionByName(rules.select(F.lit("consequent").alias("side"),
                                        F.col("consequent").alias("ids")))
              .distinct())
    named = label_arrays(arrays, {"ids": "names"}, catalog.products(spark, d, CFG), distinct=True)
    return named.select("side", ids_to_text("ids").alias("ids"), "names")


@query("itemsets_named")
def q_itemsets_named(spark, d):
    return _flat_named_itemsets(spark, d).select("items", "products", "freq")


@query("stage_counts")
def q_stage_counts(spark, d):
    res = catalog.mined(spark, d, CFG)

    def count(df, stage):
        return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(stage).alias("stage"),
                                                              "rows")
    parts = [count(orders_table(spark, d), "orders"),
             count(table(spark, d, "lineitem"), "order_lines"),
             spark.range(1).select(F.lit("baskets").alias("stage"),
                                   F.lit(res.n_baskets).cast("long").alias("rows")),
             count(res.itemsets, "itemsets"),
             count(res.rules, "rules")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- export / enrichment

@query("itemsets_flat")
def q_itemsets_flat(spark, d):
    path = write_csv(flatten_itemsets(catalog.mined(spark, d, CFG).itemsets),
                     scratch_path(spark, "itemsets-csv"))
    return read_csv_columns(spark, path, FLAT_ITEMSET)


def _rules_csv(spark, d) -> str:
    return write_csv(flatten_rules(catalog.mined(spark, d, CFG).rules),
                     scratch_path(spark, "rules-csv"))


@query("rules_flat")
def q_rules_flat(spark, d):
    return read_csv_columns(spark, _rules_csv(spark, d), FLAT_RULE)


@query("split_ids")
def q_split_ids(spark, d):
    flat = read_csv_columns(spark, _rules_csv(spark, d), FLAT_RULE)
    ids = split_rule_ids(flat)
    return ids.select("antecedent", "consequent",
                      F.size("antecedent_ids").alias("n_antecedent"),
                      F.col("antecedent_ids")[0].alias("first_antecedent"),
                      F.element_at("antecedent_ids", -1).alias("last_antecedent"),
                      F.col("consequent_ids")[0].alias("consequent_id"))


@query("rules_enriched")
def q_rules_enriched(spark, d):
    """Flat rules, each in the file twice, named from the dimension, in which
    some ids stand twice: rows stay as many, names do not double."""
    flat = read_csv_columns(spark, _rules_csv(spark, d), FLAT_RULE)
    flat = flat.unionByName(flat)
    # Products keyed by their id as text, as when both sides come from text files.
    products = catalog.products(spark, d, CFG).select(
        F.col("product_id").cast("string").alias("product_id"), "product_name")
    again = products.where("CAST(product_id AS BIGINT) % 3 = 0").select(
        "product_id", F.concat("product_name", F.lit(" (old)")).alias("product_name"))
    return enrich_flat_rules(flat, products.unionByName(again))


@query("part_names")
def q_part_names(spark, d):
    """Part-level baskets with names, which repeat over parts."""
    baskets = build_baskets(orders_table(spark, d), order_lines(spark, d, "part"))
    products = products_table(spark, d, "part")
    named = label_arrays(baskets, {"items": "names"}, products, reduce_dimension=False)
    return named.select("order_id", ids_to_text("items").alias("items"), "names")


@query("rules_named_csv")
def q_rules_named_csv(spark, d):
    path = write_csv(_flat_named(spark, d), scratch_path(spark, "named-rules-csv"))
    return read_named_rules_csv(spark, path)


@query("rules_named_one_line")
def q_rules_named_one_line(spark, d):
    path = write_csv(_flat_named(spark, d), scratch_path(spark, "named-rules-lines"), one_line=True)
    return read_named_rules_csv(spark, path, one_line=True)


@query("parquet_roundtrip")
def q_parquet_roundtrip(spark, d):
    root = scratch_path(spark, "parquet")
    path = write_parquet(catalog.named_rules(spark, d, CFG), f"{root}/association_rules")
    return flatten_rules(spark.read.parquet(path))


@query("parquet_baskets")
def q_parquet_baskets(spark, d):
    path = write_parquet(catalog.baskets(spark, d, CFG), scratch_path(spark, "transactions"))
    return _flat_baskets(spark.read.parquet(path))


@query("parquet_itemsets")
def q_parquet_itemsets(spark, d):
    path = write_parquet(catalog.mined(spark, d, CFG).itemsets,
                         scratch_path(spark, "frequent-itemsets"))
    return flatten_itemsets(spark.read.parquet(path))


@query("rules_for_load")
def q_rules_for_load(spark, d):
    from cartlens.sources.jdbc import SERVING_COLUMNS, serving_frame
    frame = serving_frame(catalog.named_rules(spark, d, CFG))
    return frame.where(F.col("created_at").isNotNull()).select(*SERVING_COLUMNS)


@query("serving_table")
def q_serving_table(spark, d):
    """Load frame written as the serving table (Parquet stands in for the
    JDBC relation), read back in the dashboard's order."""
    from cartlens.sources.jdbc import ordered_serving_rules, serving_frame
    path = write_parquet(serving_frame(catalog.named_rules(spark, d, CFG)),
                         scratch_path(spark, "serving-table"))
    rows = ordered_serving_rules(spark.read.parquet(path).drop("created_at"))
    return serving.positioned(rows, [F.desc("lift")])


@query("batch_chain")
def q_batch_chain(spark, d):
    cfg = ChainConfig(output_dir=scratch_path(spark, "chain"),
                         min_support=CFG.min_support, min_confidence=CFG.min_confidence)
    out = run_chain(spark, orders_table(spark, d), order_lines(spark, d, CFG.level),
                       catalog.products(spark, d, CFG), cfg)
    return flatten_rules(spark.read.parquet(out["rules_path"]))


@query("batch_chain_resumed")
def q_batch_chain_resumed(spark, d):
    """The chain twice: a higher confidence first, then the wanted one, which
    finds the baskets done, and mines."""
    out = scratch_path(spark, "chain-resumed")
    for confidence in (2 * CFG.min_confidence, CFG.min_confidence):
        cfg = ChainConfig(output_dir=out, min_support=CFG.min_support, min_confidence=confidence)
        result = run_chain(spark, orders_table(spark, d), order_lines(spark, d, CFG.level),
                           catalog.products(spark, d, CFG), cfg, resume=True)
    return flatten_rules(spark.read.parquet(result["rules_path"]))


# ---------------------------------------------------------------- JSON / streaming

@query("basket_json")
def q_basket_json(spark, d):
    return basket_messages(catalog.baskets(spark, d, CFG)).select(
        F.col("key").cast("long").alias("order_id"), "value")


@query("json_parse")
def q_json_parse(spark, d):
    return _flat_baskets(parse_baskets(catalog.messages(spark, d, CFG)))


def _run_stream(spark, d, transform, name: str, max_per_trigger: int | None = None) -> DataFrame:
    """Half of the messages arrive before the first run, half between it and
    the second, which goes on from the checkpoint."""
    messages = catalog.messages(spark, d, CFG)
    source = scratch_path(spark, f"{name}-in")
    out = scratch_path(spark, f"{name}-out")
    checkpoint = scratch_path(spark, f"{name}-checkpoint")
    for half in (0, 1):
        write_messages(messages.where(F.col("order_id") % 2 == half), source, mode="append")
        stream = transform(read_messages(spark, "text", path=source,
                                         max_per_trigger=max_per_trigger))
        run_to_completion(start_sink(stream, "parquet", checkpoint=checkpoint, path=out,
                                     available_now=True))
    return spark.read.schema(stream.schema).parquet(out)


@query("stream_parse")
def q_stream_parse(spark, d):
    return _flat_baskets(_run_stream(spark, d, parse_baskets, "stream-parse"))


@query("stream_items")
def q_stream_items(spark, d):
    return _run_stream(spark, d,
                       lambda m: valid_items(parse_baskets(m), observe_as="basket_stream"),
                       "stream-items")


#: Files that the registered runs cut their messages into, and files per batch.
STREAM_FILES, FILES_PER_BATCH = 12, 3


@query("stream_batches")
def q_stream_batches(spark, d):
    """Admission control at work: messages in files, a few files a batch.  One row
    per batch: rows read, and messages and valid ones as observed in it."""
    messages = catalog.messages(spark, d, CFG)
    source = write_messages(messages, scratch_path(spark, "batches-in"), files=STREAM_FILES)
    keep_progress(spark)
    stream = valid_items(parse_baskets(read_messages(spark, "text", path=source,
                                                     max_per_trigger=FILES_PER_BATCH)),
                         observe_as="basket_stream")
    sink = start_sink(stream, "parquet", checkpoint=scratch_path(spark, "batches-checkpoint"),
                      path=scratch_path(spark, "batches-out"), available_now=True)
    run_to_completion(sink)
    seen = F.col("observed")["basket_stream"]
    return progress_table(sink).agg(
        F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.sum(seen["messages"]).alias("messages"),
        F.sum(seen["valid_messages"]).alias("valid_messages"))


class _Crash(Exception):
    pass


@query("stream_replayed")
def q_stream_replayed(spark, d):
    """The run dies once between a batch's write and the ledger.  The restarted
    stream hands the batch over again; every row is in the target once."""
    messages = catalog.messages(spark, d, CFG)
    source = write_messages(messages, scratch_path(spark, "replayed-in"), files=STREAM_FILES)
    target, checkpoint = (scratch_path(spark, f"replayed-{x}") for x in ("out", "checkpoint"))
    stream = valid_items(parse_baskets(read_messages(spark, "text", path=source,
                                                     max_per_trigger=FILES_PER_BATCH)))

    def crash(batch_id: int) -> None:
        if batch_id == 1:
            raise _Crash("before the ledger")

    try:
        run_to_completion(start_ledger_sink(stream, target, checkpoint, available_now=True,
                                            before_ledger=crash))
    except Exception as error:  # noqa: BLE001 - Spark wraps what a batch raises
        if "before the ledger" not in str(error):
            raise
    run_to_completion(start_ledger_sink(stream, target, checkpoint, available_now=True))
    return committed(spark, target, stream)


@query("stream_latest")
def q_stream_latest(spark, d):
    """A stream that starts at ``latest``: messages of even orders are there
    before, those of odd orders come after; a restart keeps the position."""
    messages = catalog.messages(spark, d, CFG)
    source, checkpoint, out = (scratch_path(spark, f"latest-{x}")
                               for x in ("in", "checkpoint", "out"))
    write_messages(messages.where("order_id % 2 = 0"), source)
    for part in ("order_id % 2 = 1 AND order_id % 3 = 0", "order_id % 2 = 1 AND order_id % 3 <> 0"):
        stream = valid_items(parse_baskets(read_latest(spark, source, checkpoint)))
        write_messages(messages.where(part), source, mode="append")
        run_to_completion(start_sink(stream, "parquet", checkpoint=checkpoint, path=out,
                                     available_now=True))
    return spark.read.schema(stream.schema).parquet(out)


def _odd_messages(spark, d) -> DataFrame:
    """The messages, and bad ones of more kinds."""
    o = F.col("order_id")
    value = (F.when(o % 17 == 0, F.lit(None)).when(o % 19 == 0, F.lit("  "))
             .when(o % 23 == 0, F.lit('{"items":[1,2]}'))
             .when(o % 29 == 0, F.lit('{"order_id":"x7","items":[1,2]}'))
             .when(o % 31 == 0, F.format_string('{"order_id":%d,"items":5}', o))
             .otherwise(F.col("value")))
    return catalog.messages(spark, d, CFG).select(o.alias("sent"), value.alias("value"))


@query("messages_checked")
def q_messages_checked(spark, d):
    """Good messages' items and bad messages' texts with the reason, side by side."""
    checked = check_messages(_odd_messages(spark, d))
    good = checked.good.select("sent", F.lit(None).cast("string").alias("reason"),
                               F.lit(None).cast("string").alias("value"),
                               ids_to_text("items").alias("items"))
    return good.unionByName(checked.bad.select("sent", "reason", "value",
                                               F.lit(None).cast("string").alias("items")))


@query("messages_rejected")
def q_messages_rejected(spark, d):
    return check_messages(_odd_messages(spark, d)).counts()


@query("topic_peek")
def q_topic_peek(spark, d):
    messages = catalog.messages(spark, d, CFG).withColumnRenamed("order_id", "position")
    return _flat_baskets(peek_messages(messages, 10, order_by=["position"]))


# ---------------------------------------------------------------- reports

@query("top_rules")
def q_top_rules(spark, d):
    return report.top_rules_rounded(_flat_named(spark, d), 30, 4)


@query("top_confidence")
def q_top_confidence(spark, d):
    return report.top_by_confidence(_flat_named(spark, d), 10)


@query("top_lift")
def q_top_lift(spark, d):
    return report.top_by_lift(_flat_named(spark, d), 10)


@query("strong_rules")
def q_strong_rules(spark, d):
    return report.strong_rules(_flat_named(spark, d), STRONG_LIFT, 50)


@query("high_confidence")
def q_high_confidence(spark, d):
    return report.high_confidence_rules(_flat_named(spark, d), HIGH_CONFIDENCE, 50)


@query("top_recommendations")
def q_top_recommendations(spark, d):
    return report.consequent_frequency(_flat_named(spark, d), 20)


@query("rule_summary")
def q_rule_summary(spark, d):
    return report.rule_summary(_flat_named(spark, d), STRONG_LIFT, HIGH_CONFIDENCE)


@query("preview")
def q_preview(spark, d):
    return preview(flatten_itemsets(catalog.mined(spark, d, CFG).itemsets), 20,
                   [F.desc("freq"), "items"])


@query("preview_rules")
def q_preview_rules(spark, d):
    return preview(flatten_rules(catalog.mined(spark, d, CFG).rules), 20,
                   [F.desc("lift"), "antecedent", "consequent"])


# ---------------------------------------------------------------- dashboards

@query("rules_clean")
def q_rules_clean(spark, d):
    path = write_csv(_dirty_rules(spark, d), scratch_path(spark, "serving-text"))
    raw = read_csv(spark, path, FLAT_RULE_TEXT, multi_line=True)
    return serving.clean_metrics(raw, ("confidence", "lift", "support"))


@query("rules_rejected")
def q_rules_rejected(spark, d):
    """Rules with a bad metric, why, and the metrics' texts that are no number."""
    bad = check_metrics(_dirty_rules(spark, d)).bad
    return bad.select("antecedent", "consequent", "reason", *[
        F.when(F.col(m).try_cast("double").isNull() | F.isnan(F.col(m).try_cast("double")),
               F.col(m)).alias(m)
        for m in ("confidence", "lift", "support")])


@query("dashboard_clean_kpis")
def q_dashboard_clean_kpis(spark, d):
    return serving.cleaned_view(_dirty_rules(spark, d), SLIDER_CONFIDENCE, SLIDER_LIFT)["kpis"]


@query("dashboard_clean_top")
def q_dashboard_clean_top(spark, d):
    view = serving.cleaned_view(_dirty_rules(spark, d), SLIDER_CONFIDENCE, SLIDER_LIFT)["top"]
    return serving.all_rules_table(view)


@query("kpis_of_no_rules")
def q_kpis_of_no_rules(spark, d):
    """The KPI row when no rule is left: counts 0, means and their texts null."""
    return serving.rule_kpis(serving.filter_rules(_flat_named(spark, d), 2.0), 0.0, 0.0)


@query("rule_kpis")
def q_rule_kpis(spark, d):
    return serving.rule_kpis(_flat_named(spark, d), SLIDER_CONFIDENCE, SLIDER_LIFT)


@query("dashboard_kpis")
def q_dashboard_kpis(spark, d):
    res = catalog.mined(spark, d, CFG)
    return serving.itemset_kpis(res.itemsets, res.rules, res.n_baskets)


def _filtered(spark, d) -> DataFrame:
    return serving.filter_rules(_flat_named(spark, d), SLIDER_CONFIDENCE, SLIDER_LIFT)


@query("rules_filtered")
def q_rules_filtered(spark, d):
    return _filtered(spark, d)


@query("top_rules_filtered")
def q_top_rules_filtered(spark, d):
    return serving.all_rules_table(serving.top_filtered(_filtered(spark, d), 20))


@query("chart_lift")
def q_chart_lift(spark, d):
    return serving.chart_data(_filtered(spark, d), "lift", 15)


@query("chart_confidence")
def q_chart_confidence(spark, d):
    return serving.chart_data(_filtered(spark, d), "confidence", 15)


@query("chart_scatter")
def q_chart_scatter(spark, d):
    return serving.scatter_data(_filtered(spark, d))


@query("dashboard_rules")
def q_dashboard_rules(spark, d):
    """Second dashboard: rules named by lookup with the id as fallback, the
    "A ➜ B" label and the three metrics of its support/confidence scatter."""
    from cartlens.defaults import HEAVY_ARROW
    from cartlens.operators.labels import label_rules
    res = catalog.mined(spark, d, CFG)
    named = flatten_rules(label_rules(res.rules, catalog.known_products(spark, d, CFG),
                                      unknown="id"))
    return serving.scatter_data(named, HEAVY_ARROW, keep=("antecedent", "consequent"))


@query("rule_search")
def q_rule_search(spark, d):
    hits = serving.search_rules(_flat_named(spark, d), SEARCH_TEXT)
    hits = serving.positioned(hits, [F.desc("lift"), F.desc("confidence")])
    return hits.select("position", F.col("antecedent_product_names").alias("product_purchased"),
                       F.col("consequent_product_names").alias("recommended_product"),
                       "confidence", "lift")


@query("rule_search_indexed")
def q_rule_search_indexed(spark, d):
    """The search by way of a written index of the names."""
    rules = _flat_named(spark, d)
    hits = search_indexed(rules, build_index(rules), SEARCH_TEXT)
    return hits.select(F.col("antecedent_product_names").alias("product_purchased"),
                       F.col("consequent_product_names").alias("recommended_product"),
                       "confidence", "lift")


@query("rule_display")
def q_rule_display(spark, d):
    return serving.display_rules(_flat_named(spark, d),
                                 ("product_purchased", "recommended_product",
                                  "confidence_text", "lift_text"),
                                 keep=("antecedent", "consequent"))


@query("all_rules")
def q_all_rules(spark, d):
    return serving.all_rules_table(_filtered(spark, d))


@query("rules_by_lift")
def q_rules_by_lift(spark, d):
    named = serving.positioned(_flat_named(spark, d), [F.desc("lift")])
    return serving.rules_by_lift(named, keep=("position",))


@query("top_itemsets")
def q_top_itemsets(spark, d):
    return serving.top_itemsets(_flat_named_itemsets(spark, d), 20, ["items", "products", "freq"])


@query("itemsets_by_freq")
def q_itemsets_by_freq(spark, d):
    """Every itemset, the most frequent first."""
    named = serving.positioned(_flat_named_itemsets(spark, d), [F.desc("freq")])
    return serving.top_itemsets(named, None, ["position", "items", "products", "freq"])
