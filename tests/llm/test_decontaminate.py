"""op13 against a brute-force version, over several blocks, and its limits."""

import hashlib
import random

import pytest

from cartlens.llm.decontaminate import (Automaton, automata, decontaminated, leaks,
                                        op13_decontaminate, words_of)


def brute(docs, items, window=10):
    """Per document: (n_words, hit positions, item ids)."""
    out = []
    for _, text in docs:
        words, hit, ids = words_of((text or "").encode()), set(), set()
        for item, item_text in items:
            part = words_of((item_text or "").encode())
            k = min(window, len(part))
            wins = {tuple(part[i:i + k]) for i in range(len(part) - k + 1)} if part else set()
            for i in range(len(words) - k + 1):
                if k and tuple(words[i:i + k]) in wins:
                    hit.update(range(i, i + k))
                    if item is not None:
                        ids.add(str(item))
        out.append((len(words), len(hit), sorted(ids)))
    return out


def digest(ids):
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)

    def some(n, letters):
        return " ".join(rng.choice(letters) for _ in range(n))

    items = [(k, some(rng.choice((0, 1, 3, 9, 10, 11, 40)), "abc")) for k in range(25)]
    items += [(30, None), (31, " .,; "), (32, "É-Über 9"), (None, some(12, "ab")),
              (items[5][0], items[5][1]), (33, items[6][1]), (34, some(9_000, "pqrstuvw"))]
    docs = [(k, some(rng.choice((0, 5, 30, 200)), "abcx")) for k in range(60)]
    docs += [(70, None), (70, "é-über 9"), (71, "É...Über, 9! x"), (None, items[7][1]),
             (72, items[-1][1][8_000:8_300].upper()), (72, items[-1][1][8_000:8_300].upper()),
             (73, some(50_000, "xyz"))]
    return (docs, items,
            spark.createDataFrame([(i, t, "leak", 1) for i, t in docs],
                                  "doc_id long, text string, leak string, rest int"),
            spark.createDataFrame([(i, t, "x") for i, t in items],
                                  "item_id long, text string, block string"))


@pytest.mark.parametrize("block_words", [100_000, 2_000])
def test_equals_brute_force_in_one_and_several_blocks(tables, block_words):
    docs, items, docs_df, items_df = tables
    if block_words < 100_000:
        assert automata(items_df, block_words=block_words).count() > 2
    got = leaks(docs_df, items_df, keep=("doc_id",), block_words=block_words).collect()
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["leak"]["n_words"],
                    r["leak"]["n_hit"], r["leak"]["items"]) for r in got)
    want = sorted((d is None, d or 0, *w)
                  for (d, _), w in zip(docs, brute(docs, items), strict=True))
    assert found == want


def test_query(tables):
    docs, items, docs_df, items_df = tables
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"],
                  r["items_sha256"], r["contaminated"])
                 for r in op13_decontaminate(docs_df, items_df).collect())
    want = sorted((d is None, d or 0, n, hit, len(ids), digest(ids), hit > 0)
                  for (d, _), (n, hit, ids) in zip(docs, brute(docs, items), strict=True))
    assert got == want


def test_empty_tables(tables):
    _, _, docs_df, items_df = tables
    assert op13_decontaminate(docs_df.limit(0), items_df).count() == 0
    clean = op13_decontaminate(docs_df, items_df.limit(0))
    assert clean.count() == docs_df.count() and clean.where("contaminated").count() == 0


def test_longest_run_is_tracked_through_suffix_links():
    held = Automaton([("1", True, words_of(b"a b c d e f g h i j k l")),
                      ("2", True, words_of(b"z c d e f g h i j k l m n"))])
    spans, sets, longest = held.read(words_of(b"q b c d e f g h i j k l m n o"))
    assert (spans, longest) == ([1, 14], 12)
    assert sorted(x for k in sets for x in held.items[k]) == ["1", "2", "2"] or \
        {x for k in sets for x in held.items[k]} == {"1", "2"}


def test_spans_and_documents_beyond_the_limits_go(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame(
        [(1, f"Before it, all else stays as it was; quite  so! {item.upper()}: and after it\n\nmore of "
             "it follows here in full", "x"),
         (2, f"so {item}", "y"), (3, "clean", None), (4, None, None)],
        "doc_id long, text string, leak string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    left = {r["doc_id"]: (r["text"], r["leak"]) for r in decontaminated(docs, items).collect()}
    assert left == {1: ("Before it, all else stays as it was; quite  so! : and after it\n\nmore of "
                        "it follows here in full", "x"), 3: ("clean", None), 4: (None, None)}
    assert decontaminated(docs, items, min_length=12).count() == 3   # the whole item is a window
    assert decontaminated(docs, items, max_coverage=1.0).count() == 4
