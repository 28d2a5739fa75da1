import os


from cartlens.operators.flat import flatten_rules
from cartlens.schemas import BASKET, NAMED_RULE
from cartlens.session import scratch_path
from cartlens.sources.jdbc import SERVING_COLUMNS, serving_frame
from cartlens.sources.kafka import kafka_source_options, peek_messages
from cartlens.sources.readers import (literal_table, read_csv, read_named_rules_csv,
                                      read_products_csv)
from cartlens.sources.writers import (basket_messages, kafka_producer_options, write_csv,
                                      write_messages)
from cartlens.streaming import (parse_baskets, read_messages, run_to_completion, start_sink,
                                valid_items)

BASKETS = [(1, [1, 2]), (2, [3]), (3, [4, 5, 6]), (4, []), (5, [7, None])]


def _source(spark):
    df = spark.createDataFrame(BASKETS, BASKET)
    path = write_messages(basket_messages(df), scratch_path(spark, "t-msgs"), files=3)
    # junk that must be filtered out by the validation step
    spark.createDataFrame([("not json",), ('{"items": [1]}',), ('{"order_id": 9}',)],
                          "value string").write.mode("append").text(path)
    return path


def test_stream_items_available_now_and_restart(spark):
    src = _source(spark)
    out, ckpt = scratch_path(spark, "t-out"), scratch_path(spark, "t-ckpt")

    def run():
        stream = valid_items(parse_baskets(read_messages(spark, "text", path=src,
                                                         max_per_trigger=1)))
        q = start_sink(stream, "parquet", checkpoint=ckpt, path=out, available_now=True)
        run_to_completion(q, 120)
        return q

    q = run()
    local = src.removeprefix("file:")
    files = [f for f in os.listdir(local)
             if f.endswith(".txt") and os.path.getsize(os.path.join(local, f)) > 0]
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == len(files) >= 2     # admission control: one file per batch
    first = sorted((r.order_id, r.product_id) for r in spark.read.parquet(out).collect()
                   if r.product_id is not None)
    assert first == [(1, 1), (1, 2), (2, 3), (3, 4), (3, 5), (3, 6), (5, 7)]
    assert spark.read.parquet(out).where("product_id is null").count() == 1
    run()   # restart from the checkpoint: nothing new, nothing repeated
    assert spark.read.parquet(out).count() == 8


def test_batch_equals_stream(spark):
    src = _source(spark)
    batch = valid_items(parse_baskets(spark.read.text(src)))
    out, ckpt = scratch_path(spark, "t-out2"), scratch_path(spark, "t-ckpt2")
    stream = valid_items(parse_baskets(read_messages(spark, "text", path=src)))
    run_to_completion(start_sink(stream, "parquet", checkpoint=ckpt, path=out,
                                 available_now=True), 120)
    assert spark.read.parquet(out).exceptAll(batch).count() == 0
    assert batch.exceptAll(spark.read.parquet(out)).count() == 0


def test_peek_first_messages(spark):
    msgs = spark.read.text(_source(spark))
    got = peek_messages(msgs.where("value like '{\"order_id\":_,%'"), 2,
                        order_by=["value"]).collect()
    assert [(r.order_id, r["items"]) for r in got] == [(1, [1, 2]), (2, [3])]


def test_option_builders():
    opts = kafka_source_options("k:9092", "orders", "earliest", 10000)
    assert opts["maxOffsetsPerTrigger"] == "10000" and opts["subscribe"] == "orders"
    latest = kafka_source_options("k:9092", "orders", "latest")
    assert latest["startingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in latest
    prod = kafka_producer_options("k:9092", "orders")
    assert (prod["kafka.acks"], prod["kafka.retries"], prod["kafka.linger.ms"],
            prod["kafka.batch.size"]) == ("all", "5", "10", "16384")


def test_csv_round_trips(spark):
    rules = spark.createDataFrame(
        [([1, 2], "A, \"x\"", [3], "", 0.1, 1.2, 0.01)],
        "antecedent array<int>, antecedent_product_names string, consequent array<int>, "
        "consequent_product_names string, confidence double, lift double, support double")
    flat = flatten_rules(rules)
    path = write_csv(flat, scratch_path(spark, "t-csv"), single_file=True)
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".csv")]
    assert len(files) == 1
    assert read_csv(spark, path, NAMED_RULE).first().consequent_product_names == ""
    back = read_named_rules_csv(spark, path).first()
    assert (back.antecedent, back.antecedent_product_names, back.consequent,
            back.consequent_product_names, back.lift) == ("1,2", 'A, "x"', "3", "", 1.2)


def test_products_csv_try_cast(spark):
    from pyspark.sql import Observation
    df = spark.createDataFrame([("3000000000", "resin"), ("12b", "no number"), (None, "none"),
                                ("77", None)], "product_id string, product_name string")
    path = write_csv(df, scratch_path(spark, "t-products"))
    seen = Observation()
    got = sorted(read_products_csv(spark, path, observation=seen).collect(),
                 key=lambda r: r.product_name or "")
    assert [(r.product_id, r.product_name) for r in got] == [
        (77, None), (None, "no number"), (None, "none"), (3000000000, "resin")]
    assert seen.get["rejected_ids"] == 1


def test_literal_table_smoke(spark):
    from cartlens.schemas import PRODUCT
    df = literal_table(spark, [(90, "slate"), (91, None)], PRODUCT)
    assert [tuple(r) for r in df.collect()] == [(90, "slate"), (91, None)]


def test_serving_frame(spark):
    rules = spark.createDataFrame(
        [([1, 2], "A, B", [3], None, 0.1, 1.2, 0.01)],
        "antecedent array<int>, antecedent_product_names string, consequent array<int>, "
        "consequent_product_names string, confidence double, lift double, support double")
    frame = serving_frame(rules)
    assert frame.columns == SERVING_COLUMNS + ["created_at"]
    row = frame.first()
    assert (row.antecedent, row.consequent, row.consequent_product_names) == ("1,2", "3", "")
    assert row.created_at is not None
    assert dict(frame.dtypes)["antecedent"] == "string"


def test_basket_message_format(spark):
    df = spark.createDataFrame([(7, [1, 2])], BASKET)
    assert basket_messages(df).first().value == '{"order_id":7,"items":[1,2]}'
    assert basket_messages(df).first().key == "7"


def test_console_sink_and_preview(spark):
    from cartlens.sources.writers import preview
    src = _source(spark)
    parsed = parse_baskets(read_messages(spark, "text", path=src))
    q = start_sink(parsed, "console", checkpoint=scratch_path(spark, "t-console"),
                   available_now=True, num_rows=3)
    run_to_completion(q, 120)
    assert sum(p["numInputRows"] for p in q.recentProgress) == len(BASKETS) + 3
    df = spark.createDataFrame(BASKETS, BASKET)
    assert [r.order_id for r in preview(df, 2, ["order_id"]).collect()] == [1, 2]


def test_serving_frame_without_support(spark):
    flat = spark.createDataFrame([("1", "A", "2", "B", 0.5, 1.5)],
                                 "antecedent string, antecedent_product_names string, "
                                 "consequent string, consequent_product_names string, "
                                 "confidence double, lift double")
    row = serving_frame(flat).first()
    assert (row.antecedent, row.support, row.lift) == ("1", None, 1.5)


def test_csv_columns_by_header_name(spark):
    from cartlens.schemas import ORDER_LINE
    from cartlens.sources.readers import read_csv_columns
    df = spark.createDataFrame([(3, 7, 1, "x"), (4, None, 2, "y")],
                               "add_to_cart_order int, product_id int, order_id int, r string")
    path = write_csv(df, scratch_path(spark, "t-cols"))
    got = sorted(read_csv_columns(spark, path, ORDER_LINE).collect())
    assert [(r.order_id, r.product_id) for r in got] == [(1, 7), (2, None)]
    assert read_csv_columns(spark, path, ORDER_LINE).dtypes == [("order_id", "bigint"),
                                                                ("product_id", "bigint")]


def test_six_column_named_rules_csv(spark):
    df = spark.createDataFrame([("1", "A", "2", "", 0.5, 1.5)],
                               "antecedent string, antecedent_product_names string, "
                               "consequent string, consequent_product_names string, "
                               "confidence double, lift double")
    path = write_csv(df, scratch_path(spark, "t-six"))
    row = read_named_rules_csv(spark, path).first()
    assert (row.antecedent, row.consequent_product_names, row.lift, row.support) == \
        ("1", "", 1.5, None)


def test_kafka_record_layout(spark):
    """Rows shaped like the Kafka source (binary key/value, partition, offset):
    peek follows topic position; parse and validation read the binary value."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    msgs = basket_messages(spark.createDataFrame(BASKETS, BASKET))
    records = (msgs.select(F.col("key").cast("binary").alias("key"),
                           F.col("value").cast("binary").alias("value"),
                           F.lit("orders").alias("topic"),
                           (F.abs(F.hash("key")) % 2).cast("int").alias("partition"))
               .withColumn("offset", F.row_number().over(
                   Window.partitionBy("partition").orderBy("key")).cast("long") - 1))
    peeked = peek_messages(records, 3).collect()
    positions = [(r.partition, r.offset) for r in peeked]
    assert positions == sorted(positions) and positions[0][1] == 0
    assert {r.order_id for r in peeked} <= {o for o, _ in BASKETS}
    items = valid_items(parse_baskets(records)).collect()
    assert sorted((r.order_id, r.product_id) for r in items if r.product_id is not None) == \
        [(1, 1), (1, 2), (2, 3), (3, 4), (3, 5), (3, 6), (5, 7)]


def test_load_rules_read_back_verification(spark, monkeypatch):
    """The load path with the JDBC relation replaced by Parquet (no database may
    be started here): the written table is read back and counted."""
    import pytest

    from cartlens.sources import jdbc
    tables = {}

    def fake_write(df, url, table, properties, mode="overwrite", column_types=None):
        assert column_types is None      # unbounded text, whatever the database calls it
        path = scratch_path(spark, f"t-jdbc-{table}")
        df.write.mode(mode).parquet(path)
        tables[table] = path

    def fake_read(session, url, table, properties):
        return session.read.parquet(tables[table])

    monkeypatch.setattr(jdbc, "write_jdbc", fake_write)
    monkeypatch.setattr(jdbc, "read_jdbc", fake_read)
    rules = spark.createDataFrame(
        [([1], "A", [2], "B", 0.5, 1.5, 0.1), ([2], "B", [1], "A", 0.4, 1.5, 0.1)],
        "antecedent array<int>, antecedent_product_names string, consequent array<int>, "
        "consequent_product_names string, confidence double, lift double, support double")
    assert jdbc.load_rules(rules, "jdbc:x", "association_rules", {}) == \
        {"expected": 2, "loaded": 2}
    ordered = jdbc.ordered_serving_rules(fake_read(spark, "", "association_rules", {}))
    assert [r.antecedent for r in ordered.collect()] == ["1", "2"]
    assert "created_at" in ordered.columns

    def short_read(session, url, table, properties):
        return session.read.parquet(tables[table]).limit(1)

    monkeypatch.setattr(jdbc, "read_jdbc", short_read)
    with pytest.raises(RuntimeError):
        jdbc.load_rules(rules, "jdbc:x", "association_rules", {})


def test_kafka_reader_reaches_the_connector(spark):
    """Building the Kafka stream opens no connection: without the connector
    jar Spark reports the missing source; with it, a streaming frame with a
    value column comes back."""
    try:
        df = read_messages(spark, "kafka", bootstrap_servers="localhost:9", topic="orders",
                           max_per_trigger=10000)
    except Exception as exc:  # noqa: BLE001
        assert "kafka" in str(exc).lower()
    else:
        assert df.isStreaming and "value" in df.columns


def test_stream_observed_counts(spark):
    src = _source(spark)
    stream = valid_items(parse_baskets(read_messages(spark, "text", path=src)),
                         observe_as="basket_stream")
    q = start_sink(stream, "parquet", checkpoint=scratch_path(spark, "t-obs-ckpt"),
                   path=scratch_path(spark, "t-obs-out"), available_now=True)
    run_to_completion(q, 120)
    metrics = [p["observedMetrics"]["basket_stream"] for p in q.recentProgress
               if "basket_stream" in p.get("observedMetrics", {})]
    assert sum(m["messages"] for m in metrics) == len(BASKETS) + 3
    assert sum(m["valid_messages"] for m in metrics) == len(BASKETS)


def test_big_ids_reach_every_item(spark):
    """Ids beyond 32 bits stay, in baskets and in messages."""
    from cartlens.operators.baskets import build_baskets
    from cartlens.schemas import ORDER, ORDER_LINE
    big = 3_000_000_000
    baskets = build_baskets(spark.createDataFrame([(1,)], ORDER),
                            spark.createDataFrame([(1, big), (1, 2), (1, 5)], ORDER_LINE))
    assert baskets.first()["items"] == [2, 5, big]
    assert parse_baskets(basket_messages(baskets)).first()["items"] == [2, 5, big]


def test_brand_numbers_are_strict(spark):
    from cartlens.sources.tables import brand_number
    df = spark.createDataFrame([("Brand#12",), ("Label#12",), ("Brand#12x",), ("",), (None,)],
                               "b string")
    assert [r[0] for r in df.select(brand_number(df.b)).collect()] == [12, None, None, None, None]


def test_streams_wait_without_a_limit():
    import inspect
    assert inspect.signature(run_to_completion).parameters["timeout_s"].default is None


def test_peek_options_bound_each_partition():
    from cartlens.sources.kafka import bounded_offsets
    assert bounded_offsets("t", {1: 40, 0: 7}, 10) == {
        "startingOffsets": '{"t": {"0": 7, "1": 40}}', "endingOffsets": '{"t": {"0": 17, "1": 50}}'}


def test_no_shared_folder_is_an_error_on_a_cluster(monkeypatch):
    import pytest

    from cartlens import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_changed_files_are_mined_anew(spark, sf001, tmp_path):
    """What the catalog keeps is keyed by the tables' files."""
    import shutil

    import pyarrow.parquet as pq

    from cartlens.plans import catalog
    for t in catalog.TABLES:
        shutil.copyfile(f"{sf001}/{t}.parquet", tmp_path / f"{t}.parquet")
    first = catalog.mined(spark, str(tmp_path))
    assert catalog.mined(spark, str(tmp_path)) is first
    orders = pq.read_table(f"{sf001}/orders.parquet")
    pq.write_table(orders.slice(0, 700), f"{tmp_path}/orders.parquet")
    again = catalog.mined(spark, str(tmp_path))
    assert again is not first and again.n_baskets < first.n_baskets
