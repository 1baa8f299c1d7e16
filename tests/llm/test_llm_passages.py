"""Repeated passages of a few lines in differing contexts, against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from propensa.llm import line_dedup
from tests.conftest import SF_SMALL


def line(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def brute(texts, min_lines=2, min_words=50):
    """(text, lines removed, runs of removed lines) of each text, in the order of the ids."""
    seen, out = set(), []
    for t in texts:
        lines = t.split("\n") if t else []
        gone = set()
        for i in range(len(lines)):
            for n in [min_lines] * (i + min_lines <= len(lines)) + [1] * (lines[i].count(" ") + 1 >= min_words):
                if (span := tuple(lines[i:i + n])) in seen:
                    gone |= set(range(i, i + n))
                seen.add(span)
        out.append(("\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone), sum(i - 1 not in gone for i in gone)))
    return out


@pytest.mark.parametrize("size", [3, 4, 5, 6])
def test_short_passages_go_in_every_context(spark, size):
    rng = random.Random(size)
    passages = [[line(rng, 20) for _ in range(size)] for _ in range(10)]
    texts, own = [], []
    for _ in range(3):
        for p in passages:
            before, after = ([line(rng, 9) for _ in range(rng.randrange(1, 4))] for _ in range(2))
            texts.append("\n".join(before + p + after))
            own.append("\n".join(before + after))
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.dedup_lines(spark, docs, SF_SMALL).collect()}
    assert [got[i].text for i in range(30)] == texts[:10] + own[10:]
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_passages_equal_brute_force(spark):
    rng = random.Random(11)
    pool = ["", "a", "b", "a b", line(rng, 49), line(rng, 50), line(rng, 60), *[line(rng, 5) for _ in range(30)]]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(12))) for _ in range(120)] + ["x\nx\nx\nx", "single", "single", "é\n你", "é\n你\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = {r.doc_id: (r.text, r.n_lines_removed, r.n_chunks_removed) for r in line_dedup.passage_dedup(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)
    have = {x for t, _, _ in got.values() for x in t.split("\n")}
    assert all(set(t.split("\n")) <= have for t in texts)


def test_passages_of_odd_rows(spark):
    rows = [(1, "two\nlines"), (1, "two\nlines"), (None, "two\nlines\nmore"), (2, None), (3, ""), (4, "two\nlines")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in ("_row", "_lines", "start", "h1", "n_lines")])
    got = line_dedup.passage_dedup(docs)
    assert got.columns == ["doc_id", "text", "_row", "_lines", "start", "h1", "n_lines", "n_lines_removed", "n_chunks_removed"]
    assert sorted(((r.doc_id or 0, r.text) for r in got.collect()), key=str) == sorted(
        [(0, "two\nlines\nmore"), (1, ""), (1, ""), (2, None), (3, ""), (4, "")], key=str)
    assert line_dedup.passage_dedup(docs.limit(0)).count() == 0


def brute_chunks(texts, divisor=4, min_lines=2, min_words=50):
    """The texts without the chunks of lines that occurred before, by the rolling hash of two lines."""
    seen, out = set(), []
    for t in texts:
        lines, kept, start = t.split("\n"), [], 0
        h = [0, *[int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]]
        long = [x.count(" ") + 1 >= min_words for x in lines] + [True]
        for i in range(len(lines)):
            value = (h[i + 1] % 2147483647 + h[i] % 2147483647 * 1000003) % 2147483647
            if value % divisor == 0 or long[i] or long[i + 1]:
                chunk = tuple(lines[start:i + 1])
                if not (len(chunk) >= min_lines or long[start]) or chunk not in seen:
                    kept += chunk
                seen.add(chunk)
                start = i + 1
        out.append("\n".join(kept))
    return out


def test_stage_removes_the_operators_chunks_of_what_passages_leave(spark):
    rng = random.Random(23)
    passage, texts = [line(rng, 12) for _ in range(3)], []
    for _ in range(40):  # lines that come together only when the passage between them is cut
        a, b, c = (line(rng, 6) for _ in range(3))
        texts += ["\n".join([a, *passage, b, c]), "\n".join([a, b])]
    after = [t for t, _, _ in brute(texts)]
    want = brute_chunks(after)
    assert want != after and "" in want
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long").repartition(5)
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.dedup_lines(spark, docs, SF_SMALL).collect()}
    assert got == {i: (t, len(t)) for i, t in enumerate(want) if t}
