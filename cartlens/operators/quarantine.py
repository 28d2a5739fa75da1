"""Bad input kept with its raw text and the reason, beside the good rows.

Both sides come from one read: the rows are checked once and written to one
table, partitioned by whether they are good, and each side reads its own part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from cartlens.functions.messages import parse_message, rejection
from cartlens.session import scratch_path


@dataclass
class Checked:
    """``good`` rows, and ``bad`` ones with ``reason``, of the table at ``path``."""

    good: DataFrame
    bad: DataFrame
    path: str

    def counts(self) -> DataFrame:
        """``reason, n`` for every reason that occurs, and null for good rows."""
        return (self.good.select(F.lit(None).cast("string").alias("reason"))
                .unionByName(self.bad.select("reason")).groupBy("reason")
                .agg(F.count(F.lit(1)).alias("n")))


def _written(checked: DataFrame, path: str, good: Sequence[str], bad: Sequence[str]) -> Checked:
    checked.withColumn("_good", F.col("reason").isNull()).write.partitionBy("_good").parquet(path)
    schema = StructType([*checked.schema.fields, StructField("_good", BooleanType())])
    rows = checked.sparkSession.read.schema(schema).parquet(path)
    return Checked(rows.where("_good").select(*good), rows.where("NOT _good").select(*bad), path)


def check_messages(messages: DataFrame, path: str | None = None,
                   value_col: str = "value") -> Checked:
    """JSON basket messages: good ones parsed (``order_id, items``), bad ones with
    their text (``value, reason``).  Other columns are kept on both sides."""
    path = path or scratch_path(messages.sparkSession, "checked-messages")
    kept = [c for c in messages.columns if c not in (value_col, "order_id", "items", "reason")]
    checked = messages.select(
        *[F.col(f"`{c}`") for c in kept], F.col(value_col).cast("string").alias("value"),
        rejection(value_col).alias("reason"), parse_message(value_col).alias("m")).select(
        *[F.col(f"`{c}`") for c in kept], "value", "reason", "m.order_id", "m.items")
    return _written(checked, path, [*kept, "order_id", "items"], [*kept, "value", "reason"])


def check_metrics(rules: DataFrame, metrics: Sequence[str] = ("confidence", "lift", "support"),
                  path: str | None = None) -> Checked:
    """Rules whose metrics are text: good rows with numbers; bad ones as they came,
    with a reason that names the first metric that is missing, not a number or
    NaN."""
    path = path or scratch_path(rules.sparkSession, "checked-rules")
    reason = F.lit(None).cast("string")
    for m in reversed(list(metrics)):
        raw, number = F.col(m).cast("string"), F.col(m).try_cast("double")
        reason = (F.when(raw.isNull() | (F.trim(raw) == ""), F.lit(f"{m} is missing"))
                  .when(number.isNull(), F.lit(f"{m} is not a number"))
                  .when(F.isnan(number), F.lit(f"{m} is NaN")).otherwise(reason))
    checked = _written(rules.withColumn("reason", reason), path, rules.columns,
                       [*rules.columns, "reason"])
    checked.good = checked.good.withColumns({m: F.col(m).try_cast("double") for m in metrics})
    return checked
