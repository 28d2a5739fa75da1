"""Display text for dashboards: percent, two decimals, thousands, rule labels.

Formatting runs in the JVM (``format_string`` / ``format_number``), so
half-way cases follow Java rounding of the shortest decimal form of the
double (2.675 -> "2.68"), not Python's binary rounding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartlens.defaults import ARROW, HEAVY_ARROW  # noqa: F401
from cartlens.functions.codec import _col


def _unless_null(c: str | Column, text: Column) -> Column:
    """``format_string`` would spell a null out."""
    return F.when(_col(c).isNotNull(), text)


def percent_text(c: str | Column, digits: int = 2) -> Column:
    """0.1234 -> "12.34%"."""
    return _unless_null(c, F.format_string(f"%.{digits}f%%", _col(c) * F.lit(100.0)))


def two_decimal_text(c: str | Column, digits: int = 2) -> Column:
    """1.2345 -> "1.23"."""
    return _unless_null(c, F.format_string(f"%.{digits}f", _col(c)))


def thousands_text(c: str | Column) -> Column:
    """3058126 -> "3,058,126"."""
    return F.format_number(_col(c), 0)


def rule_label(antecedent: str | Column, consequent: str | Column,
               arrow: str = ARROW) -> Column:
    """"A → B"; null when either side is null (string concatenation semantics)."""
    return F.concat(_col(antecedent), F.lit(arrow), _col(consequent))
