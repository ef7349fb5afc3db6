"""Facts out of the driver's tables."""

import random

from pyspark.sql import functions as F

from tidemark.plans import facts


def test_means_follow_the_order_of_rows(spark, tmp_path):
    draw = random.Random(5)
    rows = [(i % 3, draw.choice([0.01, 0.03, 0.07, 0.1, None])) for i in range(600)]
    spark.createDataFrame(rows, "k int, v double").coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    placed = facts.placed(spark, str(tmp_path), "t").repartition(7, F.rand(1))
    found = {r["k"]: r["m"] for r in facts.ordered_means(placed, [F.col("k")], m=F.col("v")).collect()}
    for k in range(3):
        total, known = 0.0, [v for i, v in rows if i == k and v is not None]
        for v in known:
            total += v
        assert found[k] == total / len(known)
    none = facts.ordered_means(placed.where("v is null"), [F.col("k")], m=F.col("v")).collect()
    assert {r["m"] for r in none} == {None}
