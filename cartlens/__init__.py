"""cartlens: market-basket analytics as composable Spark DataFrame operators.

Orders and order lines become baskets, baskets become frequent itemsets and
association rules (MLlib FP-Growth), rules get product names, and the results
are published, searched, ranked and summarised -- on batch tables and on
Structured Streaming input alike.
"""

from cartlens.session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
