"""Nulls, empty tables, repeated rows, long texts and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from propensa.llm import bm25, fingerprint, jaccard_join, lang_id, line_dedup, packing, sp_encode, token_counts, toxicity, warc
from propensa.llm.queries import tokenizer_path
from tests.conftest import SF_SMALL

MODEL, WORDS = tokenizer_path("piece_bpe_32k.model"), tokenizer_path("word_bpe_49k.json")
LONG = "very long text " * 20_000
ROWS = [(1, "some words here\nand there", "en"), (1, "some words here\nand there", "en"), (None, "null id", None), (2, None, "en"), (3, "", None),
        (4, " \n ", "en"), (5, LONG, "de"), (6, "12 34 !!", "de"), (7, "\U0001f600 ▁ é", None)]


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with nulls and repeats, and columns named like those the operators add."""
    names = ["ids", "decoded", "n_tokens", "n_lines", "score", "key", "row", "sig", "place", "gone", "lang_pred"]
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    return df.select("*", *[F.lit("x").alias(n) for n in names])


def both(frame, run):
    """The operator on the rows, and on none."""
    assert run(frame.limit(0)).count() == 0
    return run(frame).collect()


def test_encode_and_counts(odd):
    got = both(odd, lambda d: sp_encode.decode(sp_encode.encode(d, MODEL), MODEL))
    assert len(got) == len(ROWS)
    for r in got:
        assert (r.ids is None) == (r.text is None) and r.decoded == (None if r.text is None else r.text.replace("▁", " "))
    counts = {(r.doc_id, r.text): r.n_tokens for r in both(odd, lambda d: token_counts.token_counts(d, MODEL))}
    assert counts[(2, None)] is None and counts[(3, "")] == 0 and counts[(5, LONG)] > 50_000


def test_search(odd):
    asked = odd.select(F.col("doc_id").alias("query_id"), "text")
    got = bm25.top_k(odd, asked, 3).collect()
    mine = [r.doc_id for r in got if r.query_id == 1]
    assert mine[:2] == [1, 1] and not [r for r in got if r.query_id in (2, 3, 4)]
    assert [r.doc_id for r in got if r.query_id is None][0] is None
    assert bm25.top_k(odd.limit(0), asked, 3).count() == 0 and bm25.top_k(odd, asked.limit(0), 3).count() == 0


def test_jaccard(odd):
    got = both(odd, lambda d: jaccard_join.jaccard_classes(d))
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in got if r.doc_id != 5) == sorted(
        [(1, 2, 1), (1, 2, 1), (-1, 1, None), (2, 0, 2), (3, 0, 3), (4, 0, 4), (6, 1, 6), (7, 1, 7)], key=lambda x: (x[0], x[1]))
    kept = both(odd, lambda d: jaccard_join.one_of_each(d, 5, 80))
    assert len(kept) == len(ROWS) - 1 and kept[0].asDict().keys() == set(odd.columns)


def test_language(odd, spark):
    learned = lang_id.learn(odd)
    assert {m[0] for m in learned} == {"en", "de"}
    got = {(r.doc_id, r.text): r for r in both(odd, lambda d: lang_id.predict(d, learned, keep=("doc_id", "text")))}
    assert got[(2, None)].lang_pred == got[(3, "")].lang_pred == got[(6, "12 34 !!")].lang_pred == "und"
    assert got[(5, LONG)].lang_pred == "de" and all(0 <= r.score <= 1 for r in got.values())
    assert lang_id.learn(odd.limit(0)) == []
    assert {r.lang_pred for r in lang_id.predict(odd, []).collect()} == {"und"}


def test_line_dedup(odd):
    got = both(odd, line_dedup.line_dedup)
    assert len(got) == len(ROWS)
    by = {r.doc_id: r for r in got}
    assert by[2].text is None and by[3].text == "" and by[5].text == LONG and by[2].n_lines == 0


def test_line_dedup_with_clashing_columns(spark):
    rows = [(1, "a b\nc d\ne f"), (2, "x y\na b\nc d\ne f"), (3, None)]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    clash = plain.withColumns({n: F.lit("x") for n in ("_gone", "_gone_id", "_gone_key", "_gone_row", "_row", "_doc_key", "_lines", "gone")})
    for run in (line_dedup.line_dedup, line_dedup.passage_dedup):
        got, want = run(clash), run(plain)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        assert got.where("_gone = 'x' and _gone_id = 'x' and _row = 'x'").count() == 3


def test_packing(odd):
    got = both(odd, lambda d: packing.pack(d, WORDS))
    assert packing.check_packing(packing.pack(odd.where("doc_id > 1"), WORDS)).count() == 0
    for i in (2, 3, 4):
        assert [(r.start, r.length, r.doc_tokens) for r in got if r.doc_id == i] == [(0, 1, 1)]
    assert max(r.length for r in got) == 4096
    with pytest.raises(ValueError):
        packing.pack(odd, WORDS, max_len=100)


def test_toxicity(odd, spark):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (9, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    got = both(odd, lambda d: toxicity.score(d, model))
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    none = toxicity.train(odd, labels.limit(0))
    assert {r.score for r in toxicity.score(odd, none).collect()} == {0.5}
    only = toxicity.train(odd, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))
    assert {round(r.score, 6) for r in toxicity.score(odd, only).collect()} == {round(2.5 / 3, 6)}


def test_fingerprints(odd):
    got = both(odd, fingerprint.fingerprints)
    assert len(got) == len(ROWS) and {r.n_chars for r in got if r.doc_id in (2, 3)} == {0}
    assert len({r.fingerprint for r in got if r.doc_id in (1, 2, 3)}) == 2
    one = fingerprint.fingerprints(odd.where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_warc_extra_columns(spark):
    pages = spark.createDataFrame([(1, "u", "x" * 2000, "a"), (1, "u", "x" * 2000, "b")], "page_id long, url string, html string, digest string")
    got = warc.read_archives(warc.write_archives(pages)).collect()
    assert [(r.record_type, r.refers_to) for r in got] == [("response", None)] * 2


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), SF_SMALL)
        assert empty.count() == 0
        out = stage(spark, docs, SF_SMALL)
        if name != "packing":
            assert out.columns == names
            out = out.cache()
            seen.append(out.count())
        docs = out
    assert seen == sorted(seen, reverse=True) and seen[0] >= 0.95 * 200
    whole = corpus_pipeline.run(spark, SF_SMALL)
    assert whole.select("doc_id").distinct().count() == seen[-1]
    assert packing.check_packing(whole).count() == 0


def test_filter_stages_with_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    clash = docs.withColumns({n: F.lit("x") for n in ("lang_pred", "score", "fit")})
    for _, stage in corpus_pipeline.STAGES[:2]:
        out = stage(spark, clash, SF_SMALL)
        assert out.columns == clash.columns
        assert out.where("score = 'x' and fit = 'x'").count() == stage(spark, docs, SF_SMALL).count() > 0
