"""JSON basket messages: struct -> JSON text and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartlens.functions.codec import _col
from cartlens.schemas import STREAM_MESSAGE


def basket_message(order_col: str = "order_id", items_col: str = "items") -> Column:
    """``{"order_id":1,"items":[3,5]}`` for one basket row."""
    return F.to_json(F.struct(F.col(order_col).alias("order_id"),
                              F.col(items_col).alias("items")))


def parse_message(value: str | Column, schema: StructType = STREAM_MESSAGE) -> Column:
    """Permissive JSON parse against a declared schema.

    Accepts text or bytes (Kafka ``value``).  Malformed text gives a struct of
    nulls, null/empty text gives null, a field of the wrong type gives null
    for that field only.
    """
    return F.from_json(_col(value).cast("string"), schema, {"mode": "PERMISSIVE"})


#: Why a message gives no basket, in the order of the tests.
REASONS = ("no message", "empty message", "not a JSON object", "no order id",
           "order id is not a number", "no items", "items are not a list of numbers")


def rejection(value: str | Column) -> Column:
    """The reason why a message of ``{"order_id": n, "items": [n, ...]}`` form is
    rejected; null for a good one.  A field of the wrong type is told apart from
    a missing one by a second parse that takes every field as text."""
    text = _col(value).cast("string")
    typed = parse_message(text)
    loose = F.from_json(text, "order_id string, items string, _bad string",
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    tests = (text.isNull(), F.trim(text) == "", loose.isNull() | loose["_bad"].isNotNull(),
             loose["order_id"].isNull(), typed["order_id"].isNull(),
             loose["items"].isNull(), typed["items"].isNull())
    out = F.lit(None).cast("string")
    for reason, test in reversed(list(zip(REASONS, tests, strict=True))):
        out = F.when(test, F.lit(reason)).otherwise(out)
    return out
