"""Places and ranks within groups of any size.

A window over a group puts the whole group into one task, also where it holds a third of all rows. Here rows are sorted by
range over all tasks, so that a large group lies in several neighbouring partitions. A task counts within its part of a
group, and what the parts before it hold is added: a group goes on from one partition to the next at most once a
partition, so what is added has no more rows than there are partitions, and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.shared_files import written

_PART, _AT = "_part", "_at"


def running(rows: DataFrame, keys: list[str], order: list[Column], weight: Column, name: str) -> DataFrame:
    """``rows`` with the sum of ``weight`` over the rows of the same keys that come before, 0 for the first.

    Null keys are a group. Rows that are equal in ``order`` come in any order, the same for all that read the result.
    """
    sorting = [*(F.col(k) for k in keys), *order]
    placed = rows.withColumn("_weight", weight).repartitionByRange(*sorting).sortWithinPartitions(*sorting).withColumn(_AT, F.monotonically_increasing_id())
    placed = written(placed.withColumn(_PART, F.shiftright(_AT, 33)), "sorted")
    parts = placed.groupBy(*keys, _PART).agg(F.sum("_weight").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
    carried = parts.withColumn("_carried", before).where("_carried is not null").select(*(F.col(k).alias(f"_of_{k}") for k in keys), F.col(_PART).alias("_of_part"), "_carried")
    inside = F.sum("_weight").over(Window.partitionBy(*keys, _PART).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1))
    same = F.col(_PART) == F.col("_of_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    both = placed.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(F.broadcast(carried), same, "left")
    return both.select(*rows.columns, (F.col("_inside") + F.coalesce("_carried", F.lit(0))).cast("long").alias(name))


def placed(rows: DataFrame, keys: list[str], order: list[Column], name: str = "place") -> DataFrame:
    """``rows`` with their place from 1 among those of the same keys."""
    before = running(rows, keys, order, F.lit(1), "_before")
    return before.withColumn(name, F.col("_before") + 1).drop("_before")


def percent_ranked(rows: DataFrame, metric: str, keys: list[str], name: str) -> DataFrame:
    """``rows`` with the rank of their metric in per cent of the group, ties sharing their mean rank; null for a null metric, which is not counted.

    Values that repeat are counted before they are sorted.
    """
    values = rows.where(F.col(metric).isNotNull()).groupBy(*keys, metric).agg(F.count("*").alias("_n"))
    before = running(values, keys, [F.col(metric)], F.col("_n"), "_before")
    totals = values.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    named = lambda frame, columns: frame.select(*(F.col(c).alias(f"_r_{c}") for c in columns), *(c for c in frame.columns if c not in columns))
    alike = lambda columns: [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in columns]
    ranks = before.join(named(totals, keys), alike(keys)).select(*keys, metric, ((F.col("_before") + 1 + (F.col("_n") - 1) / 2) / F.col("_total") * 100).alias(name))
    both = rows.join(named(ranks, [*keys, metric]), alike([*keys, metric]), "left")
    return both.select(*rows.columns, name)
