"""As-of join against a plain loop: ties, nulls, hot keys and instants, empty sides."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join

LEFT = "k string, at long, id int, extra map<string,int>"
RIGHT = "k string, since long, v int, name string"


def plain(left, right):
    out = []
    for k, at, i, extra in left:
        best = None
        for rk, since, v, name in right:
            if None not in (k, at, rk, since) and rk == k and since <= at:
                if best is None or (since, v) > best[:2]:
                    best = (since, v, name)
        out.append((i, *(best or (None, None, None))))
    return sorted(out, key=str)


def result(spark, left, right):
    out = asof_join(spark.createDataFrame(left, LEFT).repartition(5),
                    spark.createDataFrame(right, RIGHT).repartition(3),
                    ["k"], "at", "since", ["since", "v", "name"], tie=["v"])
    assert out.columns == ["k", "at", "id", "extra", "since", "v", "name"]
    return sorted(map(tuple, out.select("id", "since", "v", "name").collect()), key=str)


@pytest.mark.parametrize("hot", [0.0, 0.9])
def test_matches_plain_version(spark, hot):
    rng = random.Random(3)

    def key():
        return "hot" if rng.random() < hot else rng.choice([None, "a", "b", "c", "never"])

    def time():
        return None if rng.random() < 0.05 else 50 if rng.random() < hot / 2 else rng.randint(0, 99)

    left = [(key(), time(), i, {"x": i}) for i in range(400)]
    right = [(k if (k := key()) != "never" else "z", time(), rng.randint(0, 5), f"n{i}")
             for i in range(60)]
    # moves of one key, time and tie value name one row
    right = list({(r[0], r[1], r[2]): r for r in right}.values())
    assert result(spark, left, right) == plain(left, right)


def test_empty_sides(spark):
    left = [("a", 1, 1, None)]
    assert result(spark, left, []) == [(1, None, None, None)]
    assert result(spark, [], [("a", 1, 1, "x")]) == []


def test_plan_has_no_product(spark):
    left = spark.createDataFrame([("a", 1, 1, None)], LEFT)
    right = spark.createDataFrame([("a", 1, 1, "x")], RIGHT)
    plan = asof_join(left, right, ["k"], "at", "since", ["v"])._jdf.queryExecution().executedPlan()
    assert "NestedLoop" not in plan.toString() and "Cartesian" not in plan.toString()


def test_clashing_names(spark):
    left = spark.createDataFrame([("a", 5, 1)], "k string, _t long, _right int")
    right = spark.createDataFrame([("a", 3, 9)], "k string, _t long, v int")
    row = asof_join(left, right, ["k"], "_t", "_t", ["v"]).first()
    assert (row["_t"], row["_right"], row["v"]) == (5, 1, 9)
    assert asof_join(left.filter(F.lit(False)), right, ["k"], "_t", "_t", ["v"]).count() == 0
