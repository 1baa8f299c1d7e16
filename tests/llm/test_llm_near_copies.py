"""Fingerprints of near copies on two sides of a length, against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from propensa.llm import fingerprint
from propensa.llm.queries import REGISTRY


def fitted(rng, n_chars):
    """Words in one line of exactly ``n_chars`` characters."""
    text = " ".join(f"w{rng.randrange(10**4)}" for _ in range(n_chars))[:n_chars]
    return text if text[-1] != " " else text[:-1] + "x"


def near_next(spark, texts, tmp_path):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    return {r.doc_id: r.near_next for r in REGISTRY["op10_fingerprints"](spark, str(tmp_path)).collect()}


def test_near_copies_around_a_length(spark, tmp_path):
    rng = random.Random(3)
    texts = []
    for limit in (200, 1000):
        for _ in range(10):
            below = fitted(rng, limit - 5)
            texts += [below, f"{below} {fitted(rng, 9)}"]
            middle = below.index(" ", limit // 2)
            texts += [below, f"{below[:middle]} {fitted(rng, 9)}{below[middle:]}"]
    near = near_next(spark, texts, tmp_path)
    pairs = [near[i] for i in range(1, len(texts), 2)]
    short, long = pairs[:20], pairs[20:]
    assert min(short) > 0.2 and sum(short) / 20 > 0.5
    assert min(long) > 0.7 and sum(long) / 20 > 0.8


def test_paragraphs_equal_plain_python(spark, tmp_path):
    rng = random.Random(4)
    pool = [f"v{i}" for i in range(60)] + ["é", "你好", "\n", "\n", ""]
    texts = [" ".join(rng.choice(pool) for _ in range(n)) for n in (0, 1, 5, 30, 60, 200, 600)] + ["a  b \n\n c ", "word " * 100, "w\n" * 5]
    words = sorted({w for t in texts for w in re.split("[ \n]", t)})
    cuts = {r.w for r in spark.createDataFrame([(w,) for w in words], "w string").where(F.pmod(F.xxhash64("w"), F.lit(fingerprint.DIVISOR)) == 0).collect()}

    def paragraphs(text):
        found, run = set(), []
        for w in re.findall("[^ \n]+|\n| (?= )", text + "\n"):
            if w in " \n":
                found, run = found | ({" ".join(run)} if run else set()), []
            else:
                run.append(w)
                if w in cuts or len(run) == fingerprint.LONGEST:
                    found, run = found | {" ".join(run)}, []
        return found

    near = near_next(spark, texts, tmp_path)
    for i, t in enumerate(texts):
        a, b = paragraphs(t), paragraphs(texts[i - 1])
        assert near[i] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0), i
    sizes = spark.createDataFrame([(t,) for t in texts], "t string").select(F.size(fingerprint.cut_digests(F.col("t"))).alias("n")).collect()
    assert [r.n for r in sizes] == [len(paragraphs(t)) for t in texts]


def test_peeling_copies_and_scans_nothing(spark):
    """Bound values are not copied (as results of a transformation are), and no digest is looked for in a list."""
    rng = random.Random(5)
    sets = [([rng.randrange(-2**63, 2**63) for _ in range(n)], [rng.randrange(-2**63, 2**63) for _ in range(m)]) for n, m in ((0, 3), (5, 0), (20, 9), (40, 40))]
    rows = [(i, a + [7, 8], b + [8]) for i, (a, b) in enumerate(sets)]
    frame = spark.createDataFrame(rows, "pair int, a array<long>, b array<long>")
    bits = F.lit(6)
    cells = fingerprint.subtract(fingerprint.sketch(F.col("a"), bits), fingerprint.sketch(F.col("b"), bits))
    got = frame.select("pair", fingerprint.peel(cells, bits)["found"].alias("found"))
    assert {r.pair: r.found for r in got.collect()} == {i: len(set(a) ^ set(b)) for i, a, b in rows}
    assert "array_contains" not in got._jdf.queryExecution().analyzed().toString()
    bound = spark.range(1).select(fingerprint.let(F.col("id") + 2, lambda v: v * v).alias("n"))
    assert bound.first().n == 4 and "transform(" not in bound._jdf.queryExecution().analyzed().toString()
