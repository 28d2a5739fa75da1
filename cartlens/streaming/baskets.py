"""Streaming baskets.

    source (Kafka topic, or JSON-lines files offline)
      -> from_json(declared schema) over the value as text -> its fields
      -> keep rows with order id and items -> explode -> sink

The transformations are stateless (append mode, no state store), so each
micro-batch is planned as an ordinary batch plan and scales with the number
of source partitions.  Admission control bounds a batch
(``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``) and the checkpoint
location makes a restarted query continue where it stopped.
The same functions apply unchanged to batch DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cartlens.defaults import CONSOLE_ROWS
from cartlens.functions.messages import parse_message
from cartlens.schemas import STREAM_MESSAGE
from cartlens.sources.kafka import kafka_source_options


def read_messages(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                  bootstrap_servers: str | None = None, topic: str | None = None,
                  starting_offsets: str = "earliest", max_per_trigger: int | None = None
                  ) -> DataFrame:
    """Streaming DataFrame with a ``value`` column.

    ``fmt="kafka"``: subscribe to ``topic`` from ``starting_offsets``
    (earliest / latest), at most ``max_per_trigger`` offsets per batch.
    ``fmt="text"``: JSON lines under ``path``, at most ``max_per_trigger``
    files per batch.
    """
    if fmt == "kafka":
        opts = kafka_source_options(bootstrap_servers, topic, starting_offsets,
                                    max_offsets_per_trigger=max_per_trigger)
        return spark.readStream.format("kafka").options(**opts).load()
    if fmt == "text":
        reader = spark.readStream.format("text")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_per_trigger))
        return reader.load(path)
    raise ValueError("fmt must be 'kafka' or 'text'")


def parse_baskets(messages: DataFrame, schema: StructType = STREAM_MESSAGE) -> DataFrame:
    """``value`` (bytes or text) -> the declared columns (``order_id, items``)."""
    return messages.select(parse_message("value", schema).alias("message")).select("message.*")


def valid_items(parsed: DataFrame, order_col: str = "order_id", items_col: str = "items",
                item_alias: str = "product_id", observe_as: str | None = None) -> DataFrame:
    """Rows with an order id and an item list, one output row per item
    (an empty list yields no row; a null element is kept).

    ``observe_as`` names per-batch counts (messages, valid messages) that a
    streaming query reports in ``lastProgress["observedMetrics"]`` without
    an extra pass over the data."""
    valid = F.col(order_col).isNotNull() & F.col(items_col).isNotNull()
    if observe_as:
        parsed = parsed.observe(observe_as, F.count(F.lit(1)).alias("messages"),
                                F.count_if(valid).alias("valid_messages"))
    return parsed.where(valid).select(order_col, F.explode(items_col).alias(item_alias))


def start_sink(df: DataFrame, fmt: str = "console", checkpoint: str | None = None,
               path: str | None = None, output_mode: str = "append",
               available_now: bool = False, processing_time: str | None = None,
               query_name: str | None = None, num_rows: int = CONSOLE_ROWS,
               truncate: bool = False) -> StreamingQuery:
    """Start a streaming write.  ``console`` prints ``num_rows`` rows per batch
    untruncated; ``parquet`` / ``json`` write files under ``path``; the
    checkpoint (offsets, commits) lives at ``checkpoint``."""
    writer = df.writeStream.format(fmt).outputMode(output_mode)
    if fmt == "console":
        writer = writer.option("truncate", truncate).option("numRows", num_rows)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if path:
        writer = writer.option("path", path)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_to_completion(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait until an ``availableNow`` query has drained its input, however long
    that takes, and fail if it ended with an error.  With ``timeout_s`` (for
    tests) a query that still runs then is stopped and fails."""
    if timeout_s is None:
        query.awaitTermination()
        finished = True
    else:
        finished = query.awaitTermination(timeout_s)
    if not finished:
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} still running "
                           f"after {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
