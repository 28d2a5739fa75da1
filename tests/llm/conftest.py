import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.fixture(scope="session")
def documents(spark):
    """Null ids and texts, empty and blank texts, repeated rows, one id with two
    texts, other white space, and columns named like the operators' own."""
    passage = " ".join(f"w{k}" for k in range(20))
    long = " ".join(f"t{k % 997}" for k in range(30_000))
    rows = [
        (1, f"Alpha beta\n{passage}\tgamma  delta"), (2, f"other words {passage} end"),
        (2, f"other words {passage} end"), (2, "a second text of the same id"),
        (3, None), (4, ""), (5, " \n\t "), (None, f"{passage} without an id"), (None, None),
        (6, long), (7, f"{long} more"), (8, "token = 'abcdefghijklmnop' <|endoftext|> ünï ▁x"),
        (9, "a a a a a"), (-3, passage),
    ]
    return spark.createDataFrame(
        [(i, t, None if k % 3 else "en", k, k, "x", 1.5) for k, (i, t) in enumerate(rows)],
        "doc_id long, text string, lang string, k int, th int, spans string, score double")


@pytest.fixture(scope="session")
def empty(documents):
    return documents.limit(0)
