import re

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from cartlens.llm import tokens, toxicity
from cartlens.llm.secrets import MORE
from tests.llm.test_dedup import WORD, slow_groups, slow_kept, slow_print
from tests.llm.test_scores import slow_spans
from tests.llm.test_tokens import check_pieces, crc


def slow_redacted(text):
    """Spans of the base kinds and of the further ones, the first of overlapping
    ones named."""
    if text is None:
        return None
    names = ["assign", "access", "hex", *[r.kind for r in MORE]]
    spans = [(a, n, b) for a, n, b in slow_spans(text)]
    for n, r in enumerate(MORE, 3):
        spans += [(m.start(), n, m.end()) for m in re.finditer(r.pattern, text, re.A)]
    out, at = [], 0
    for a, n, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{names[n]}]"]
        at = max(at, b)
    return "".join([*out, text[at:]]) if spans else text


@pytest.fixture(scope="module")
def whole(spark, sf001):
    return spark.read.parquet(f"{sf001}/documents.parquet")


def test_stages_keep_the_columns_and_equal_brute_force(spark, sf001, whole):
    columns, docs = whole.dtypes, whole
    rows = {r.doc_id: r.text for r in whole.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "substring_dedup", "secrets", "packing"]

    def step(name):
        out = corpus_pipeline.saved(stages[name](spark, docs, sf001), name)
        assert out.dtypes == columns
        found = {r.doc_id: r.text for r in out.collect()}
        assert out.where("n_chars <> length(text)").count() == 0
        return out, found

    docs, got = step("toxicity")
    lexicon = toxicity.learn(whole, spark.read.parquet(f"{sf001}/labels.parquet")
                             .where(~toxicity.held_out()))
    m = lexicon.matcher()
    rows = {i: t for i, t in rows.items() if m.score(t or "") < 0.5}
    assert got == rows

    docs, got = step("near_dedup")
    ids = sorted(rows)
    first = {}
    for i, g in zip(ids, slow_groups([slow_print(rows[i]) for i in ids]), strict=True):
        first.setdefault(g, i)
    rows = {i: rows[i] for i in first.values()}
    assert got == rows

    docs, got = step("substring_dedup")
    ids = list(rows)
    for i, kept in zip(ids, slow_kept([(i, rows[i]) for i in ids]), strict=True):
        if len(kept) < len(WORD.findall(rows[i] or "")):
            rows[i] = " ".join(kept)
    assert got == rows

    docs, got = step("secrets")
    rows = {i: slow_redacted(t) for i, t in rows.items()}
    assert got == rows

    t = Tokenizer.from_file(tokens.tokenizer_path(None))
    pieces = check_pieces(stages["packing"](spark, docs, sf001).collect(), (1024,))
    assert pieces.keys() == rows.keys()
    for i, held in pieces.items():
        ids, at = [*t.encode(rows[i] or "", add_special_tokens=False).ids, 0], 0
        for p in sorted(held, key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == crc(ids[at:at + p.length])
            at += p.length
        assert at == len(ids)

    ran = corpus_pipeline.run(spark, sf001)
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    by_doc = lambda df: df.groupBy("doc_id").sum("length").orderBy("doc_id").collect()
    assert set(cols) <= set(ran.columns)
    assert by_doc(ran) == by_doc(stages["packing"](spark, docs, sf001))


def test_stages_on_odd_rows(spark, sf001, documents):
    docs = documents.withColumn("n_chars", documents.k.cast("long"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.saved(stage(spark, docs, sf001), "odd")
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), sf001).collect() == []
        docs = out
    assert corpus_pipeline.packing(spark, docs, sf001).count() > 0


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert [q for q in names if q.startswith(f"op{n}_")]
