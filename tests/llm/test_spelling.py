"""op11: near words, forms and roots against a brute-force version."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from cartlens.llm import spelling
from cartlens.llm.spelling import letters_of, near_pairs, op11_spelling, variants, word_counts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def less_one(word):
    return {word[:i] + word[i + 1:] for i in range(len(word))}


def brute(counts):
    """word -> (form, root, n, n_near, form_n), by comparing what is left of every
    word without any one letter."""
    by = defaultdict(set)
    for w in counts:
        by[w].add(w)
        for i in range(len(w)):
            by[(i, w[:i], w[i + 1:])].add(w)
    near = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            near[w] |= by[(i, w[:i], w[i + 1:])] - {w}
        for x in less_one(w) & counts.keys():
            near[w].add(x)
            near[x].add(w)
    form = {w: min(near[w], key=lambda x: (-counts[x], x), default=None) for w in counts}
    form = {w: f if f is not None and counts[f] >= 2 * counts[w] else None
            for w, f in form.items()}
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def brute_counts(docs, noise=97):
    total = Counter()
    for doc_id, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % noise == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def table(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r)[1:] for r in rows}


def test_letters():
    assert letters_of("Déjà-VU × ÷ aŁb €uro ÿes 日本 É1x \U0001F600z".encode()) == [
        w.translate(LOWER).encode() for w in
        ["Déjà", "VU", "×", "÷", "a", "b", "uro", "ÿes", "É", "x", "z"]]


@pytest.fixture(scope="module")
def counts():
    rng = random.Random(11)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(5, 9))) for _ in range(400)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "ababababab", "babababab", "ÿÿÿÿÿÿ", "zzzzz"}
    base = "".join(rng.choice("abcd") for _ in range(40))
    for n in (5, 6, 31, 32, 33, 34, 40):        # across the bound of the tries
        w = base[:n]
        words |= {w, w[1:], w[:-1], w[:3] + "x" + w[4:], w[:n // 2] + w[n // 2 + 1:], "q" + w}
    return {w: rng.choice((1, 2, 3, 4, 9, 20, 70)) for w in sorted(words) if len(w) >= 5}


@pytest.mark.parametrize(("trie_letters", "few"), [(32, 1), (6, 3)])
def test_variants_equal_brute_force(spark, counts, monkeypatch, trie_letters, few):
    monkeypatch.setattr(spelling, "FEW", few)
    df = spark.createDataFrame([(w, n, "x") for w, n in counts.items()],
                               "word string, n int, form string")
    assert table(variants(df, trie_letters=trie_letters)) == brute(counts)


def test_long_words(spark):
    w = "".join(random.Random(1).choices("abc", k=3000))
    words = [w, w[1:], w[:1500] + w[1501:], w[:2000] + "q" + w[2001:], w + "a", w[::-1]]
    got = {(r[0], r[1]) for r in near_pairs(
        spark.createDataFrame([(x,) for x in words], "word string")).collect()}
    assert got == {(w, x) for x in words[1:5]} | {(x, w) for x in words[1:5]}


def test_query(spark, documents, empty):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeè") for _ in range(rng.randrange(4, 9))) for _ in range(60)]
    docs = [(k, " ".join(rng.choices(words, k=120)).title()) for k in range(150)]
    docs += [(None, "Other other OTHER others others others"), (None, None), (3, ""), (3, "x" * 900),
             (3, "x" * 900), (4, "x" * 900)]
    df = spark.createDataFrame([(i, t, "r", 0) for i, t in docs],
                               "doc_id long, text string, root string, n int")
    want = brute_counts(docs)
    assert any(len(w) == 900 for w in want) and len(want) > 60
    assert {r[0]: r[1] for r in word_counts(df, noise=97).collect()} == want
    got = table(op11_spelling(df))
    assert got == brute(want) and any(f for f, *_ in got.values())
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert table(op11_spelling(documents)) == brute(brute_counts(rows))
    assert op11_spelling(empty).count() == 0


def test_hot_node(spark):
    """A third of all words begin alike."""
    rng = random.Random(4)
    counts = {"unthinkable" + "".join(rng.choices("abcdefgh", k=4)): 3 for _ in range(1500)}
    counts |= {"".join(rng.choices("abcdefgh", k=8)): 4 for _ in range(3000)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert table(variants(df)) == brute(counts)
