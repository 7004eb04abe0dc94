import random

import pytest

from chronolink.plans.sequence import number_rows, number_rows_checked


def sample(seed=1, keys=20, rows=400):
    rng = random.Random(seed)
    # One key holds a third of all rows, many with the same time.
    return [
        ("hot" if i % 3 == 0 else f"k{rng.randrange(keys)}", rng.randrange(30), i, rng.choice([None, "x", "y"]))
        for i in range(rows)
    ]


def expected(rows, key):
    groups = {}
    for row in rows:
        groups.setdefault(key(row), []).append(row)
    out = set()
    for group in groups.values():
        group.sort(key=lambda r: (r[1], r[2]))
        for at, row in enumerate(group):
            following = group[at + 1] if at + 1 < len(group) else (None,) * 4
            out.add((*row, at + 1, following[1], following[3]))
    return out


@pytest.mark.parametrize("hot_rows", [1, 30, 10_000])
def test_numbers_within_keys(spark, hot_rows):
    rows = sample()
    df = spark.createDataFrame(rows, "k string, t int, id int, v string").repartition(5)
    numbered, hot = number_rows_checked(
        df, ["k"], ["t", "id"], lead={"next_t": "t", "next_v": "v"}, hot_rows=hot_rows
    )
    assert hot == (hot_rows < 10_000)
    assert {tuple(r) for r in numbered.collect()} == expected(rows, lambda r: r[0])
    assert numbered.count() == len(rows)


def test_numbers_whole_table(spark):
    rows = sample(seed=2)
    df = spark.createDataFrame(rows, "k string, t int, id int, v string").repartition(5)
    numbered = number_rows(df, [], ["t", "id"], lead={"next_t": "t", "next_v": "v"})
    assert {tuple(r) for r in numbered.collect()} == expected(rows, lambda r: 0)


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, t int")
    assert number_rows(df, ["k"], ["t"]).collect() == []
    assert number_rows(df, [], ["t"]).collect() == []


def test_hot_key_is_spread_over_ranges(spark):
    df = spark.range(4000).selectExpr("'hot' as k", "id as t")
    numbered = number_rows(df, ["k"], ["t"], hot_rows=100)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan
    assert numbered.agg({"seq": "max"}).first()[0] == 4000
