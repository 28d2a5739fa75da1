"""Library defaults.

Fixed values: parameters, bounds and text formats that must equal the
reference's so that the same inputs give the same results.
"""

# Mining.
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.20
MIN_BASKET_SIZE = 2

# Rule report.
TOP_RULES = 30              # top rules by lift, then confidence
TOP_RULES_DIGITS = 4        # rounding of their metrics
REPORT_TOP = 10             # top rules by confidence / by lift
STRONG_LIFT = 2.0           # strict: lift > 2
HIGH_CONFIDENCE = 0.25      # strict: confidence > 0.25
REPORT_ROWS = 50            # rows shown of the two filtered lists
RECOMMENDATION_ROWS = 20    # most frequent consequents

# Dashboards.
DASHBOARD_TOP = 20          # top filtered rules
CHART_TOP = 15              # bars per chart
LIFT_SLIDER_FLOOR = 5.0     # the lift slider reaches at least 5.0
KPI_DIGITS = 3              # rounding of the second dashboard's means
ITEMSET_TOP = 20            # most frequent itemsets

# Text formats.
ID_SEPARATOR = ","
NAME_SEPARATOR = ", "
ARROW = " → "
HEAVY_ARROW = " ➜ "

# What stands for null in our own CSV files (an empty text is written as "").
CSV_NULL = "\\N"
# One-line texts in them, in the order of replacement.
LINE_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))

# Streaming and publishing.
MAX_OFFSETS_PER_TRIGGER = 10000
CONSOLE_ROWS = 20
PEEK_MESSAGES = 10
PRODUCER_ACKS = "all"
PRODUCER_RETRIES = 5
PRODUCER_LINGER_MS = 10
PRODUCER_BATCH_SIZE = 16384
