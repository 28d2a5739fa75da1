"""Row numbers over a whole ordered table, without one task for all rows.

The rows are dealt by ranges of the order, sorted in each range and written with
their place in it.  The number of rows in each range, a table of one row per
range, gives every range's first number, and is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.plans.materialize import materialize

#: ``monotonically_increasing_id`` has the partition above this many bits.
_PLACE_BITS = 33


def numbered(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` and ``name`` (bigint, from 1): each row's place in ``order``, which
    should be total (rows that tie get neighbouring numbers in any order).  The
    rows are written once, since both the counts and the result read them."""
    taken = {c.lower() for c in df.columns}
    at, part = (_free(c, taken) for c in ("_at", "_part"))
    placed = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn(at, F.monotonically_increasing_id()), "ordered-rows")
    placed = placed.withColumn(part, F.shiftright(at, _PLACE_BITS))
    # One row per range: as many as the shuffle has partitions.
    counts = placed.groupBy(part).count().collect()
    starts, total = [], 0
    for row in sorted(counts, key=lambda r: r[part]):
        starts.append((row[part], total))
        total += row["count"]
    first = _free("_first", taken)
    offsets = df.sparkSession.createDataFrame(starts, f"{part} long, {first} long")
    mask = F.lit((1 << _PLACE_BITS) - 1)
    return (placed.join(offsets, part)
            .withColumn(name, F.col(first) + F.col(at).bitwiseAND(mask) + 1)
            .select(*[F.col(f"`{c}`") for c in df.columns], name))


def _free(name: str, taken: set[str]) -> str:
    while name in taken:
        name = f"_{name}"
    return name
