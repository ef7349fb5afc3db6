"""Places and ranks over groups that lie in many partitions, against plain versions."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import events as E
from tidemark.operators import ranks as R


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(3)
    made = [("hot" if r.random() < 0.6 else r.choice(["a", "b", None]), float(r.randrange(40)), i) for i in range(3000)]
    made += [("hot", 7.0, -1 - i) for i in range(500)] + [("one", 1.0, 9000), ("none", None, 9001), ("hot", None, 9002)]
    return made


def test_places(spark, rows):
    frame = spark.createDataFrame(rows, "k string, v double, i int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = R.placed(frame, ["k"], [F.col("v").desc_nulls_last(), F.col("i")]).collect()
        sums = R.running(frame.where("v is not null"), ["k"], [F.col("v"), F.col("i")], F.col("v").cast("long"), "s").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    groups, totals = defaultdict(list), {}
    for k, v, i in rows:
        groups[k].append((v is None, -(v or 0), i))
    want = {(k, x[2]): n for k, own in groups.items() for n, x in enumerate(sorted(own), 1)}
    assert {(r["k"], r["i"]): r["place"] for r in found} == want and len(found) == len(rows)
    for k in groups:
        total = 0
        for v, i in sorted((v, i) for g, v, i in rows if g == k and v is not None):
            totals[k, i] = total
            total += int(v)
    assert {(r["k"], r["i"]): r["s"] for r in sums} == totals


def test_percent_ranks(spark, rows):
    frame = spark.createDataFrame(rows, "k string, v double, i int").repartition(7)
    found = R.percent_ranked(frame, "v", ["k"], "pct")
    assert found.columns == ["k", "v", "i", "pct"]
    values = defaultdict(Counter)
    for k, v, _ in rows:
        if v is not None:
            values[k][v] += 1
    want = {}
    for k, own in values.items():
        less = 0
        for v, n in sorted(own.items()):
            want[k, v] = (less + 1 + (n - 1) / 2) / sum(own.values()) * 100
            less += n
    got = found.collect()
    assert len(got) == len(rows) and all(r["pct"] == want.get((r["k"], r["v"])) for r in got)
    assert R.percent_ranked(frame.limit(0), "v", ["k"], "pct").collect() == []


def test_specs_meet_series_by_an_entry(spark):
    series = [("s1", {"a": "1", "b": "2"}, "2020", 5), ("s2", {"a": "1"}, "2021", 4), ("s3", {"b": "2", "c": "3"}, "2021", 9), ("s4", {}, "2019", 1)]
    specs = [("x", {"a": "1"}, {}), ("y", {"a": "1", "b": "2"}, {}), ("z", {}, {"c": "3"}), ("none", {"a": "9"}, {})]
    found = E.containment_choice(spark.createDataFrame(specs, "spec string, required map<string,string>, preferred map<string,string>"), spark.createDataFrame(series, "key string, dims map<string,string>, last_period string, n int"))
    assert {r["spec"]: (r["key"], r["candidates"]) for r in found.collect()} == {"x": ("s2", 2), "y": ("s1", 1), "z": ("s3", 4)}
