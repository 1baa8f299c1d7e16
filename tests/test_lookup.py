"""Lookup by a rule table: the same rows as a literal, by broadcast and by shuffle."""

from contextlib import redirect_stdout
from io import StringIO

from propensa.operators.lookup import with_lookup


def plan(df):
    out = StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_three_plans_give_the_same_rows(spark):
    data = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz"), (5, "a"), (6, "A")], "id int, kind string")
    table = spark.createDataFrame([("a", 10), ("b", 20), ("b", 15), ("c", None), (None, 99)], "name string, value int")
    ways = {"literal": (10, 10), "broadcast": (0, 10), "shuffle": (0, 0)}
    got, plans = {}, {}
    for way, (literal, broadcast) in ways.items():
        df = with_lookup(data, "kind", "points", table, -1, literal_rows=literal, broadcast_rows=broadcast)
        got[way], plans[way] = sorted(map(tuple, df.collect())), plan(df)
    assert got["literal"] == got["broadcast"] == got["shuffle"] == [(1, "a", 10), (2, "b", 20), (3, None, -1), (4, "zz", -1), (5, "a", 10), (6, "A", -1)]
    assert "Join" not in plans["literal"] and "BroadcastHashJoin" in plans["broadcast"] and "SortMergeJoin" in plans["shuffle"]


def test_empty_table_and_replaced_column(spark):
    data = spark.createDataFrame([(1, "a", 5)], "id int, kind string, points int")
    none = spark.createDataFrame([], "name string, value int")
    for literal in (10, -1):
        assert with_lookup(data, "kind", "points", none, 7, literal_rows=literal).collect()[0].points == 7
