"""Flat codec: id arrays <-> comma-joined text (for CSV columns)."""

from __future__ import annotations

import re

from cartlens.defaults import ID_SEPARATOR

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ids_to_text(c: str | Column, sep: str = ID_SEPARATOR) -> Column:
    """``[5, 7]`` -> ``"5,7"``; nulls inside the array are skipped, ``[]`` -> ``""``,
    a null array -> ``""`` (``concat_ws`` semantics)."""
    return F.concat_ws(sep, _col(c).cast("array<string>"))


def text_to_ids(c: str | Column, sep: str = ID_SEPARATOR, element_type: str = "bigint") -> Column:
    """``"5,7"`` -> ``[5, 7]``; an element that is not a number becomes null
    (``try_cast``, so ANSI mode never raises); a null text stays null."""
    parts = F.split(_col(c), re.escape(sep))
    return F.transform(parts, lambda x: F.trim(x).try_cast(element_type))
