"""Streams: progress per batch, batches applied once, a start at the latest file."""

import pytest
from pyspark.sql import functions as F

from cartlens.schemas import BASKET
from cartlens.session import scratch_path
from cartlens.sources.writers import basket_messages, write_messages
from cartlens.streaming import parse_baskets, read_messages, run_to_completion, start_sink
from cartlens.streaming.baskets import valid_items
from cartlens.streaming.ledger import apply_batch, committed, prepare, start_ledger_sink
from cartlens.streaming.progress import keep_progress, progress_table
from cartlens.streaming.start import read_latest


def baskets(spark, orders):
    return basket_messages(spark.createDataFrame([(o, [o, o + 1]) for o in orders], BASKET))


def test_progress_has_every_batch(spark):
    path = scratch_path(spark, "t-progress")
    for k in range(7):
        write_messages(baskets(spark, range(10 * k, 10 * k + k + 1)), path, files=1, mode="append")
    keep_progress(spark)
    stream = valid_items(parse_baskets(read_messages(spark, "text", path=path, max_per_trigger=2)),
                         observe_as="seen")
    query = start_sink(stream, "parquet", checkpoint=scratch_path(spark, "t-progress-cp"),
                       path=scratch_path(spark, "t-progress-out"), available_now=True)
    run_to_completion(query, 120)
    rows = progress_table(query).orderBy("batch_id").collect()
    assert len(rows) == 4 and [r["batch_id"] for r in rows] == list(range(4))
    assert sum(r["input_rows"] for r in rows) == 28
    assert [r["observed"]["seen"]["messages"] for r in rows] == [r["input_rows"] for r in rows]
    assert all(r["at"] is not None and r["durations"] for r in rows)


def test_a_batch_is_applied_once(spark):
    target = scratch_path(spark, "t-ledger")
    batch = spark.createDataFrame([(1, 2), (3, 4)], "order_id long, product_id long")
    prepare(spark, target)
    assert committed(spark, target, batch).count() == 0

    def crash(batch_id):
        raise RuntimeError("crash")

    with pytest.raises(RuntimeError):
        apply_batch(batch, 0, target, crash)
    assert committed(spark, target, batch).count() == 0     # written, but not in the ledger
    assert apply_batch(batch, 0, target) and not apply_batch(batch, 0, target)
    assert apply_batch(batch, 1, target)
    assert committed(spark, target, batch).count() == 4
    assert committed(spark, target, batch).columns == ["order_id", "product_id"]


def test_a_stream_that_crashed_before_the_ledger(spark):
    path, target, checkpoint = (scratch_path(spark, f"t-replay-{x}") for x in ("in", "out", "cp"))
    write_messages(baskets(spark, range(30)), path, files=5)
    stream = valid_items(parse_baskets(read_messages(spark, "text", path=path, max_per_trigger=1)))

    def crash(batch_id):
        if batch_id == 2:
            raise RuntimeError("crash")

    query = start_ledger_sink(stream, target, checkpoint, available_now=True, before_ledger=crash)
    with pytest.raises(Exception, match="crash"):
        run_to_completion(query, 120)
    before = committed(spark, target, stream).count()
    assert 0 < before < 60
    run_to_completion(start_ledger_sink(stream, target, checkpoint, available_now=True), 120)
    got = committed(spark, target, stream)
    assert got.count() == got.distinct().count() == 60
    data = spark.read.parquet(f"{target}/data")
    assert data.count() > 60                                 # the lost attempt is still there


def test_a_start_at_the_latest_file(spark):
    path, checkpoint, out = (scratch_path(spark, f"t-latest-{x}") for x in ("in", "cp", "out"))
    write_messages(baskets(spark, range(5)), path, files=2)

    def run():
        stream = parse_baskets(read_latest(spark, path, checkpoint))
        run_to_completion(start_sink(stream, "parquet", checkpoint=checkpoint, path=out,
                                     available_now=True), 120)
        return sorted(r["order_id"] for r in spark.read.schema(stream.schema).parquet(out).collect())

    assert run() == []
    write_messages(baskets(spark, range(100, 103)), path, files=2, mode="append")
    assert run() == [100, 101, 102]
    write_messages(baskets(spark, [200]), path, mode="append")
    assert run() == [100, 101, 102, 200]


def test_a_latest_start_over_no_files_reads_all(spark):
    path, checkpoint, out = (scratch_path(spark, f"t-none-{x}") for x in ("in", "cp", "out"))
    write_messages(baskets(spark, []), path)
    stream = parse_baskets(read_latest(spark, path, checkpoint))
    write_messages(baskets(spark, [1, 2]), path, mode="append")
    run_to_completion(start_sink(stream, "parquet", checkpoint=checkpoint, path=out,
                                 available_now=True), 120)
    assert spark.read.parquet(out).agg(F.count("order_id")).first()[0] == 2
