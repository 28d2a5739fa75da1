import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from cartlens.llm import hamming_index, piece_bpe


# ---- neighbours

def slow_nearest(ids, x, q, k=20):
    at = {i: n for n, i in enumerate(ids)}
    out = {}
    for i in q:
        score = (x * x[at[i]]).sum(axis=1)
        order = np.lexsort((ids, -score))
        out[i] = [ids[n] for n in order if ids[n] != i][:k]
    return out


def read(df):
    rows = {}
    for r in hamming_index.op7_neighbours(df).orderBy("query_id", "rank").collect():
        rows.setdefault(r.query_id, []).append(r)
    return rows


def test_recall_on_the_table(spark, sf001):
    df = spark.read.parquet(sf001.replace("0.001", "0.1") + "/embeddings.parquet")
    t = df.toPandas().sort_values("vec_id")
    x, ids = np.stack(t.embedding.to_list()).astype(float), t.vec_id.to_numpy()
    want = slow_nearest(ids, x, ids[ids % 20 == 0])
    got = read(df)
    assert got.keys() == want.keys()
    hits = [len(set(w) & {r.vec_id for r in got[i]}) / len(w) for i, w in want.items()]
    assert np.mean(hits) >= 0.95
    at = {i: n for n, i in enumerate(ids)}
    for i, rows in got.items():
        assert [r.rank for r in rows] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        for r in rows:
            assert r.score == pytest.approx(float(x[at[i]] @ x[at[r.vec_id]]), abs=1e-12)


def test_rows_of_other_lengths_scales_and_ties(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * rng.uniform(0.2, 5, size=(300, 1))
    x[100:200] = x[100]                                      # a third are one vector
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got, ids = read(df), np.arange(300)
    want = slow_nearest(ids, x, ids[::20])
    hits = [len(set(w) & {r.vec_id for r in got[i]}) / 20 for i, w in want.items()]
    assert np.mean(hits) >= 0.9 and all(len(r) == 20 for r in got.values())
    tied = [r.vec_id for r in got[120] if r.score == got[120][0].score]
    assert len(tied) < 2 or tied == sorted(tied)


def test_vectors_that_take_no_part(spark):
    df = spark.createDataFrame(
        [(0, [1.0, 0.0]), (20, [2.0, 0.0]), (20, [1.0, 5.0]), (3, None), (4, [0.0, 0.0]),
         (5, [1.0, None]), (6, [float("nan"), 1.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]),
         (8, [3.0, 4.0]), (9, [float("inf"), 1.0]), (10, [])],
        "vec_id long, embedding array<float>")
    got = {i: [(r.vec_id, r.score) for r in rows] for i, rows in read(df).items()}
    assert got == {0: [(8, 3.0), (20, 1.0)], 20: [(8, 23.0), (0, 1.0)]}
    assert hamming_index.op7_neighbours(df.limit(0)).collect() == []
    assert hamming_index.op7_neighbours(df.where("vec_id = 0")).collect() == []


def test_the_most_frequent_length_counts(spark):
    rows = [(0, [1.0]), *[(k, [1.0, float(k)]) for k in range(1, 41)]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = read(df)
    assert got.keys() == {20, 40} and all(len(r) == 20 for r in got.values())
    even = spark.createDataFrame(rows[:2], df.schema)
    assert [len(r.vec) for r in hamming_index.valid_vectors(even).collect()] == [2]


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 32, size=(400, 4), dtype=np.uint64).astype("<u4")
    asked = codes[:30] ^ (rng.random((30, 4)) < 0.5) * np.uint32(1 << 7 | 1)
    index = hamming_index.BlockIndex(codes)
    far = np.bitwise_count(asked[:, None] ^ codes[None]).sum(axis=2)
    for radius in (0, 1, 2, 5, 30, 47, 50, 61, 128):
        assert set(zip(*index.within(asked, radius), strict=True)) == set(
            zip(*np.nonzero(far <= radius), strict=True))


def test_probing_leaves_codes_out(sf001):
    """At 64 components; the bits are shared out evenly among the substrings."""
    at = sf001.replace("0.001", "0.1") + "/embeddings.parquet"
    x = np.stack(pq.read_table(at).column("embedding").to_pylist()).astype(float)
    assert x.shape[1] == 64
    book = hamming_index.learn_codebook(x, float(np.linalg.norm(x, axis=1).max()), 20)
    codes, asked = book.codes(x), book.codes(x[::20], queries=True)
    used = np.bitwise_count(np.bitwise_or.reduce(codes, axis=0))
    assert used.sum() == 260 and used.max() - used.min() <= 1
    share = hamming_index.BlockIndex(codes).probed(asked, book.radius).mean()
    assert share < 0.5


# ---- pieces

@pytest.fixture(scope="module")
def bpe():
    return piece_bpe.PieceBpe(piece_bpe.model_path(None))


def test_ids_are_the_librarys(bpe):
    rng = random.Random(2)
    parts = ["a", "th", "e", "in", " ", "  ", "▁", "\n", "字", "😀", "ﬁ", "Ａ", ".", "1", "23", "é",
             "\x00", "   ", "t", "he", " the", "ing", "aa", "<s>", "<0x0A>", "ñ", "ción", "x", "er"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(4000)]
    texts += [" " * k for k in range(40)] + ["a" + " " * k + "b" for k in range(40)]
    texts += ["a" * 500, "ab" * 300, "the" * 200, "!" * 5000, "x," * 3000]
    for text, ids in zip(texts, bpe.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == bpe.library.encode(text)


def test_neighbouring_tokens(bpe):
    one = lambda p: bpe.ids[p]
    assert bpe.together(one("▁the"), one("▁")) and not bpe.together(one("t"), one("he"))


def test_digests(documents, bpe):
    want = []
    for r in documents.collect():
        ids = bpe.library.encode(r.text or "")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((str(r.doc_id), len(ids), sha(",".join(map(str, ids))),
                     sha(bpe.library.decode(ids) if ids else "")))
    got = [(str(r[0]), *r[1:]) for r in piece_bpe.op8_pieces(documents).collect()]
    assert sorted(got) == sorted(want)
    assert piece_bpe.op8_pieces(documents.limit(0)).collect() == []
    listed = piece_bpe.encoded(documents).where("doc_id = 9").first().ids
    assert listed == bpe.library.encode("a a a a a")
