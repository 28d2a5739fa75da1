"""Sinks: Parquet, CSV, JSON message files and the Kafka writer.

Every writer is a distributed write from the executors; nothing is looped
over on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cartlens import defaults as D
from cartlens.defaults import CSV_NULL, LINE_ESCAPES
from cartlens.functions.messages import basket_message


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def escape_breaks(text: Column) -> Column:
    """The text on one line: backslash, line feed and carriage return become
    ``\\\\``, ``\\n`` and ``\\r``."""
    for raw, mark in LINE_ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(mark))
    return text


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              single_file: bool = False, one_line: bool = False) -> str:
    """CSV with header.  Texts come back from ``read_csv*`` as they were:
    padding is kept, null is ``CSV_NULL`` and a text that looks like it gets a
    further backslash.  ``one_line=True`` escapes line breaks (``escape_breaks``),
    so that every row is one line and a reader with ``one_line=True`` may split
    the files.  ``single_file=True`` gathers the rows in one task that only
    writes (sensible for small results such as rule tables)."""
    if one_line:
        return _write_one_line(df, path, mode, header, single_file)
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    df = df.select(*[F.when(F.col(f"`{c}`").rlike(r"^\\+N$"), F.concat(F.lit("\\"), f"`{c}`"))
                     .otherwise(F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`")
                     for c in df.columns])
    if single_file:
        df = df.repartition(1)
    (df.write.mode(mode).option("header", header).option("nullValue", CSV_NULL)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def _write_one_line(df: DataFrame, path: str, mode: str, header: bool, single_file: bool) -> str:
    """All backslashes are doubled, so no text looks like ``CSV_NULL``.  A quote
    in a text is written twice, as other CSV tools do: the backslash means
    nothing to the CSV layer."""
    df = df.select(*[escape_breaks(F.col(f"`{f.name}`")).alias(f.name)
                     if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
                     for f in df.schema.fields])
    if single_file:
        df = df.repartition(1)
    (df.write.mode(mode).option("header", header).option("nullValue", CSV_NULL)
     .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def basket_messages(baskets: DataFrame, order_col: str = "order_id",
                    items_col: str = "items") -> DataFrame:
    """One JSON text per basket in ``value`` (the Kafka value layout), keyed by
    the order id so a topic keeps one order on one partition."""
    return baskets.select(basket_message(order_col, items_col).alias("value"),
                          baskets[order_col].cast("string").alias("key"))


def write_messages(messages: DataFrame, path: str, files: int | None = None,
                   mode: str = "overwrite") -> str:
    """JSON lines, one message per line: the file-source stand-in for a topic.
    ``files`` fixes the number of files (micro-batch granularity)."""
    if files:
        messages = messages.repartition(files)
    messages.select("value").write.mode(mode).text(path)
    return path


def kafka_producer_options(bootstrap_servers: str, topic: str, acks: str = D.PRODUCER_ACKS,
                           retries: int = D.PRODUCER_RETRIES,
                           linger_ms: int = D.PRODUCER_LINGER_MS,
                           batch_size: int = D.PRODUCER_BATCH_SIZE) -> dict[str, str]:
    """Writer options equal to a producer with acks/retries/linger/batch set."""
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "topic": topic,
        "kafka.acks": str(acks),
        "kafka.retries": str(retries),
        "kafka.linger.ms": str(linger_ms),
        "kafka.batch.size": str(batch_size),
    }


def write_kafka(messages: DataFrame, bootstrap_servers: str, topic: str, **producer) -> None:
    """Publish ``key``/``value`` rows to a topic from every executor in parallel
    (needs the spark-sql-kafka package on the classpath)."""
    writer = messages.select("key", "value").write.format("kafka")
    for key, value in kafka_producer_options(bootstrap_servers, topic, **producer).items():
        writer = writer.option(key, value)
    writer.save()


def preview(df: DataFrame, n: int = 20, order_by: Sequence = (),
            print_schema: bool = False) -> DataFrame:
    """The first ``n`` rows (by ``order_by`` when given, so the sample is
    stable), optionally printing the schema: the inspection sink."""
    if print_schema:
        df.printSchema()
    return (df.orderBy(*order_by) if order_by else df).limit(n)
