import hashlib
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from cartlens.llm import components, simhash, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    runs = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, bits=2):
    """A group number for each print."""
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def near_prints(seed, n_bases=5, n=60):
    rng, out = random.Random(seed), set()
    for _ in range(n_bases):
        base = x = rng.getrandbits(64)
        for _ in range(n):
            for _ in range(rng.choice([1, 1, 2, 3])):
                x ^= 1 << rng.randrange(64)
            out.add(x)
            x = rng.choice([x, base])
    return sorted(out)


def test_prints_and_components_equal_brute_force(documents):
    rows = documents.select("doc_id", "text").collect()
    prints = [slow_print(r.text) for r in rows]
    groups = slow_groups(prints)
    least = {}
    for r, g in zip(rows, groups, strict=True):
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), f"{p:016x}", least.get(g)) for r, p, g in
                  zip(rows, prints, groups, strict=True))
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id)
                 for r in simhash.op6_simhash(documents).collect())
    assert got == want


def test_links_in_open_and_crowded_cells(spark):
    prints = near_prints(3)
    nodes = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    groups = slow_groups(prints)
    for cell in (256, 3, 0):
        found = simhash.near_pairs(nodes, 2, cell)
        for r in found.collect():
            assert ((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= 2
        root = {r.node: r.root for r in components.components(found).collect()}
        pairs = {(g, root.get(signed(x), signed(x))) for g, x in zip(groups, prints, strict=True)}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_every_pair_of_an_open_cell_is_found(spark):
    prints = near_prints(4, 3, 40)
    nodes = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    want = {tuple(sorted((signed(a), signed(b)))) for a in prints for b in prints
            if a < b and (a ^ b).bit_count() <= 2}
    assert {tuple(sorted(r)) for r in simhash.near_pairs(nodes).collect()} == want


def test_components_of_chains_and_repeats(spark):
    links = [(k, k + 1) for k in range(1, 60)] + [(100, 90), (90, 100), (7, 7), (200, 100)]
    found = {r.node: r.root for r in components.components(
        spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {k: 1 for k in range(1, 61)} | {90: 90, 100: 90, 200: 90}
    none = spark.createDataFrame([], "u long, v long")
    assert components.components(none).collect() == []


def test_one_row_of_each_component_stays(documents):
    kept = simhash.one_of_each(documents)
    assert kept.columns == documents.columns
    rows = documents.select("doc_id", "text").collect()
    least = {}
    for r, g in zip(rows, slow_groups([slow_print(r.text) for r in rows]), strict=True):
        least[g] = min(least.get(g, (True, 0)), (r.doc_id is None, r.doc_id or 0))
    ids = [(r.doc_id is None, r.doc_id or 0) for r in kept.collect()]
    assert sorted(ids) == sorted(least.values())
    assert simhash.one_of_each(documents.limit(0)).collect() == []
    assert simhash.op6_simhash(documents.limit(0)).collect() == []


def slow_kept(rows):
    """The words left of each (id, text)."""
    least = {}
    words = [WORD.findall(t or "") for _, t in rows]
    for (i, _), w in zip(rows, words, strict=True):
        for k in range(len(w) - 12 if i is not None else 0):
            key = tuple(w[k:k + 13])
            least[key] = min(least.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - 12 if i is not None else 0):
            if least[tuple(w[k:k + 13])] < i:
                gone[k:k + 13] = [True] * 13
        out.append([x for x, g in zip(w, gone, strict=True) if not g])
    return out


def removed_rows(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256)
                  for r in substring.op10_substring(df).collect())


def want_rows(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    return sorted((str(i), len(WORD.findall(t or "")), len(WORD.findall(t or "")) - len(k),
                   hashlib.sha256(" ".join(k).encode()).hexdigest())
                  for (i, t), k in zip(rows, slow_kept(rows), strict=True))


def test_removals_equal_brute_force(documents):
    assert removed_rows(documents) == want_rows(documents)


def test_passages_cut_anyhow(spark):
    rng = random.Random(11)
    passages = [[f"p{n}w{k}" for k in range(rng.randrange(10, 40))] for n in range(6)]
    rows = []
    for i in range(80):
        words = []
        for _ in range(rng.randrange(1, 6)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) - 8)
            words += [f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(9))]
            words += p[a:rng.randrange(a + 1, len(p) + 1)]
        rows.append((i * 7 % 80, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert removed_rows(df) == want_rows(df)


def test_runs_settle_what_they_can():
    h = np.array([5, 5, 5, 9, 9, 4], np.int64)
    doc = np.array([2, 1, 1, 3, 3, 8], np.int64)
    pos = np.array([0, 1, 2, 3, 4, 5], np.int32)
    out = substring.settle_anchors([h, doc, doc, pos]).to_pydict()
    assert sorted(zip(out["doc_id"], out["pos"], strict=True)) == [(1, -2), (2, -1), (3, 3), (8, 5)]
    assert out["h"].count(5) == 1 and {9, 4} <= set(out["h"])
    out = substring.settle_windows([h, pos * 0, doc, doc, pos]).to_pydict()
    assert sorted(zip(out["doc_id"], out["pos"], strict=True)) == [(1, 1), (2, -1), (3, 3), (8, 5)]
    assert out["h1"].count(5) == 1


def test_one_id_in_a_third_of_the_rows(spark):
    """Its texts are dealt out by their rows, equal ones too, and texts move once."""
    rng = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(30))
    rows = [(7, " ".join(rng.choices("abcdefgh", k=25)) + (f" {passage}" if k % 3 else ""))
            for k in range(60)]
    rows += [(7, f"{passage} all the same text again and again, word for word, so it is")] * 40
    rows += [(k, f"own{k} words {passage} and more{k}") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert removed_rows(df) == want_rows(df)
    dealt = substring.dealt(df, "doc_id", "text")
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.5 * len(rows) and dealt.select("row").distinct().count() == len(rows)
    at = dealt.select("row").limit(9).withColumn("at", F.array(F.lit(0)))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = dealt.join(at, "row")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    texts = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(texts) <= 2 and "text#" not in "".join(texts) and "bucket" in plan.lower()


def test_a_document_of_one_word_over_and_over(spark):
    rows = [(3, "la " * 4000), (1, "la " * 40 + "end"), (2, "x " + "la " * 12), (9, "la " * 13),
            (4, "a b " * 500), (5, "b a " * 300 + "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert removed_rows(df) == want_rows(df)


def test_texts_without_repeats(documents):
    left = substring.without_repeats(documents)
    assert left.columns == documents.columns and left.dtypes == documents.dtypes
    got = [(str(r.doc_id), r.text) for r in left.collect()]
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = sorted(((str(i), " ".join(k) if len(k) < len(WORD.findall(t or "")) else t)
                   for (i, t), k in zip(rows, slow_kept(rows), strict=True)),
                  key=lambda x: (x[0], x[1] is not None, x[1] or ""))
    assert sorted(got, key=lambda x: (x[0], x[1] is not None, x[1] or "")) == want
    none = documents.limit(0)
    assert substring.without_repeats(none).collect() == []
    assert substring.op10_substring(none).collect() == []


def test_whole_table(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    assert removed_rows(docs) == want_rows(docs)
    rows = docs.collect()
    groups = slow_groups([slow_print(r.text) for r in rows])
    least = {}
    for r, g in zip(rows, groups, strict=True):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    got = {r.doc_id: r.component_id for r in simhash.op6_simhash(docs).select(
        "doc_id", F.col("component_id")).collect()}
    assert got == {r.doc_id: least[g] for r, g in zip(rows, groups, strict=True)}
