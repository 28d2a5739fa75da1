"""Structured Streaming path: JSON baskets -> validated (order, product) rows."""

from cartlens.streaming.baskets import (parse_baskets, read_messages, run_to_completion,
                                        start_sink, valid_items)

__all__ = ["read_messages", "parse_baskets", "valid_items", "start_sink", "run_to_completion"]
