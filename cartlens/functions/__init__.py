"""Column-level helpers: all native Spark expressions, no Python UDFs."""

from cartlens.functions.codec import ids_to_text, text_to_ids
from cartlens.functions.display import (percent_text, rule_label, thousands_text,
                                        two_decimal_text)
from cartlens.functions.messages import basket_message, parse_message

__all__ = ["ids_to_text", "text_to_ids", "percent_text", "two_decimal_text",
           "thousands_text", "rule_label", "basket_message", "parse_message"]
