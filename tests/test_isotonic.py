"""Isotonic regression in ranges against the min-max formula and Spark's own fit."""

import random
from fractions import Fraction

import pytest

from propensa.operators import isotonic


def min_max(points):
    """Value of each point: the largest over starts of the smallest mean over ends."""
    def mean(a, b):
        return Fraction(sum(p for _, p, _ in points[a:b + 1]), sum(n for _, _, n in points[a:b + 1]))
    return [max(min(mean(a, b) for b in range(i, len(points))) for a in range(i + 1)) for i in range(len(points))]


def random_points(rnd, n, kind):
    out = []
    for i in range(n):
        cnt = rnd.randint(1, 5)
        share = {"rise": i / n, "fall": 1 - i / n, "noise": 0.5, "steps": (i // 7 % 2) * 0.8 + 0.1}[kind]
        out.append((i / 3, sum(rnd.random() < share for _ in range(cnt)), cnt))
    return out


def values(blocks, points):
    blocks = sorted(blocks)
    assert all(a[2] * b[3] < b[2] * a[3] and a[1] < b[0] for a, b in zip(blocks, blocks[1:]))
    return [next(Fraction(b[2], b[3]) for b in blocks if b[0] <= s <= b[1]) for s, _, _ in points]


def test_pooling_equals_the_min_max_formula():
    rnd = random.Random(8)
    for kind in ("rise", "fall", "noise", "steps"):
        for n in (1, 2, 9, 40):
            points = random_points(rnd, n, kind)
            assert values(isotonic.pool([(s, s, p, c) for s, p, c in points]), points) == min_max(points)


@pytest.mark.parametrize("kind", ["rise", "fall", "steps"])
def test_ranges_do_not_change_the_blocks(spark, kind):
    points = random_points(random.Random(kind), 60, kind)
    df = spark.createDataFrame(points, "score double, pos long, cnt long").repartition(3)
    for size in (7, 1000):
        got = [tuple(r) for r in isotonic.isotonic_blocks(df, size).collect()]
        assert values(got, points) == min_max(points)


def test_no_points(spark):
    df = spark.createDataFrame([], "score double, pos long, cnt long")
    assert isotonic.isotonic_blocks(df).count() == 0
