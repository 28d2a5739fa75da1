"""Kafka topic options and a bounded peek at a topic.

The Kafka connector jar is not bundled with pyspark; these functions build
the options and plans, and tests drive the same plans with file sources.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cartlens.defaults import PEEK_MESSAGES
from cartlens.functions.messages import parse_message


def kafka_source_options(bootstrap_servers: str, topic: str,
                         starting_offsets: str = "earliest",
                         max_offsets_per_trigger: int | None = None,
                         ending_offsets: str | None = None,
                         group_id: str | None = None) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if ending_offsets:
        opts["endingOffsets"] = ending_offsets
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def bounded_offsets(topic: str, starts: dict[int, int], n: int) -> dict[str, str]:
    """Options that read at most ``n`` messages of each partition, from the
    given first offsets: what a peek of n messages can need at most."""
    def text(extra: int) -> str:
        return json.dumps({topic: {str(p): o + extra for p, o in sorted(starts.items())}})
    return {"startingOffsets": text(0), "endingOffsets": text(n)}


def peek_topic(spark: SparkSession, bootstrap_servers: str, topic: str, starts: dict[int, int],
               n: int = PEEK_MESSAGES) -> DataFrame:
    """The first ``n`` messages of a topic; only the first ``n`` offsets of each
    partition are read."""
    opts = kafka_source_options(bootstrap_servers, topic) | bounded_offsets(topic, starts, n)
    return peek_messages(spark.read.format("kafka").options(**opts).load(), n)


def peek_messages(messages: DataFrame, n: int = PEEK_MESSAGES,
                  order_by: Sequence[str] = ("partition", "offset")) -> DataFrame:
    """The first ``n`` messages by topic position (or any other total order of
    their columns), parsed into ``order_id, items`` behind the other columns.  The limit comes before
    the parse, so only ``n`` messages are parsed."""
    carried = [c for c in messages.columns if c != "value"]
    first = messages.orderBy(*order_by).limit(n)
    return first.select(*carried, parse_message("value").alias("m")).select(*carried, "m.*")
