"""op12: runs against a brute-force version."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from cartlens.llm import periodic
from cartlens.llm.periodic import analysed, collapsed, first_periods, op12_runs, runs_of


def brute(words, least=12):
    """(start, length, period) of every run, from the definition."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(least, 2 * q):
                out.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def echo(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = echo(doc_id, (text or "").encode().split())
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(((-n, s, q) for s, n, q in runs), default=None)
    first = (None,) * 4 if top is None else (top[1], -top[0], top[2], 1000 * -top[0] // top[2])
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *first, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def texts(rng, count):
    out = []
    for _ in range(count):
        kind, n = rng.randrange(5), rng.choice((0, 1, 5, 12, 13, 30, 90))
        words = [rng.choice("ab") if kind == 0 else rng.choice("abcdefgh") for _ in range(n)]
        if kind >= 2:                       # a power, perhaps with a word changed
            part = words[:rng.randrange(1, 9)]
            words = words[:7] + part * rng.randrange(1, 14) + words[3:]
            if kind == 4 and words:
                words[rng.randrange(len(words))] = "z"
        out.append(words)
    out += [["a"] * 40, list("ab") * 30, list("aab") * 9 + list("aab")[:2],
            [f"w{k}" for k in range(50)] * 3]
    fib = ["a", "ab"]
    while len(fib[-1]) < 200:
        fib.append(fib[-1] + fib[-2])
    thue = "".join("ab"[bin(k).count("1") % 2] for k in range(256))
    return [[w.encode() for w in x] for x in (*out, list(fib[-1]), list(thue))]


def test_runs_equal_brute_force(monkeypatch):
    some = texts(random.Random(3), 300)
    got = [[(s, e - s, q) for s, e, q in rows.tolist()] for rows in analysed(some)]
    assert got == [brute(x) for x in some]
    monkeypatch.setattr(periodic, "TESTS", 7)
    assert [[(s, e - s, q) for s, e, q in rows.tolist()] for rows in analysed(some, 2)] == \
        [brute(x, 2) for x in some]


def test_a_long_run_and_a_long_text_of_one_word():
    words = np.r_[np.arange(1000, 3000), np.tile(np.arange(777), 60)[:45_000], np.arange(5000, 5100)]
    assert runs_of(np.r_[words, 9999]).tolist() == [[2000, 47_000, 777]]
    assert runs_of(np.r_[np.zeros(1_000_000, np.int64), 1]).tolist() == [[0, 1_000_000, 1]]
    assert runs_of(np.r_[np.tile(np.arange(3), 100_000), 9]).tolist() == [[0, 300_000, 3]]
    assert runs_of(np.array([5])).tolist() == []


def test_of_overlapping_runs_only_first_periods_stay():
    words = (b"a b " * 6 + b"c").split()
    (rows,) = analysed([words])
    assert first_periods(words, rows) == [b"a", b"b", b"c"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    made = [(k, " ".join(w.decode() for w in words)) for k, words in enumerate(texts(rng, 60))]
    return [*made, (None, "x " * 30), (None, None), (7, None), (7, "\t \n"), (7, "é ü\n" * 9),
            (7, "é ü\n" * 9), *[(k, " ".join(f"w{i % 61}" for i in range(200 + k)))
                                for k in range(100, 160)]]


def test_query(spark, rows, documents, empty):
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, t in rows if t and i is not None)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows],
                               "doc_id long, text string, runs int, top int")

    def ordered(found):
        return sorted(map(tuple, found), key=str)

    assert ordered(op12_runs(df).collect()) == ordered(expected(*r) for r in rows)
    small = documents.where("length(coalesce(text, '')) < 5000")
    assert ordered(op12_runs(small).collect()) == ordered(
        expected(r["doc_id"], r["text"]) for r in small.collect())
    assert op12_runs(documents).count() == documents.count()
    assert op12_runs(empty).count() == 0


def test_collapsed_texts(spark):
    docs = spark.createDataFrame(
        [(1, "go \n on  please", "r"), (2, "head " + "x y z\t" * 20 + "tail", None), (3, None, "s")],
        "doc_id long, text string, rest string")
    assert {r["doc_id"]: (r["text"], r["rest"]) for r in collapsed(docs).collect()} == {
        1: ("go \n on  please", "r"), 2: ("head x y z tail", None), 3: (None, "s")}
