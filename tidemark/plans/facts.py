"""The driver's tables as the facts that the series operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.shared_files import shared, written  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def placed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with ``place``, a number by which rows sort as they stand in its files, these by name."""
    rows = table(spark, sf_dir, name)
    file = F.array_position(F.lit(sorted(rows.inputFiles())), F.col("_metadata.file_path"))
    return rows.select("*", (F.shiftleft(file, 40) + F.col("_metadata.row_index")).alias("place"))


def ordered_means(rows: DataFrame, keys: list[Column], **values: Column) -> DataFrame:
    """(keys, means) of placed rows: doubles added one after another in the order of their places, however rows were dealt to tasks.

    For small groups, since it holds the values of each. Nulls are no values; a mean of none is null.
    """
    line = F.struct("place", *(v.alias(n) for n, v in values.items()))
    grouped = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(line)).alias("_lines"))

    def mean(name: str) -> Column:
        known = F.filter(F.col("_lines")[name], lambda x: x.isNotNull())
        return F.aggregate(known, F.lit(0.0), lambda total, x: total + x, lambda total: F.try_divide(total, F.size(known)))

    return grouped.select(*(c for c in grouped.columns if c != "_lines"), *(mean(n).alias(n) for n in values))


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier-months: nation as parent, line counts as flows, quantity as weight, rare deep discounts as adjustment."""
    lines, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    flows = lines.groupBy(F.col("l_suppkey").alias("entity"), F.to_date(F.date_trunc("month", "l_shipdate")).alias("period")).agg(
        F.count("*").alias("births"),
        F.count_if(F.col("l_returnflag") == "R").alias("deaths"),
        F.count_if(F.col("l_returnflag") == "A").alias("imm_internal"),
        F.count_if(F.col("l_returnflag") == "N").alias("emi_internal"),
        F.count_if(F.col("l_linestatus") == "O").alias("imm_foreign"),
        F.count_if(F.col("l_linestatus") == "F").alias("emi_foreign"),
        F.count_if((F.col("l_quantity") >= 50) & (F.col("l_discount") >= 0.095) & (F.col("l_tax") >= 0.075)).alias("adjustment"),
        F.sum("l_quantity").alias("weight"),
    )
    names = supplier.select(F.col("s_suppkey").alias("entity"), F.col("s_nationkey").alias("parent"), F.col("s_name").alias("name"))
    return flows.join(names, "entity")


#: The same as a DuckDB common table expression.
MONTHLY = """
lines AS (SELECT l_suppkey AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, count(*) AS births,
    count(*) FILTER (l_returnflag = 'R') AS deaths, count(*) FILTER (l_returnflag = 'A') AS imm_internal,
    count(*) FILTER (l_returnflag = 'N') AS emi_internal, count(*) FILTER (l_linestatus = 'O') AS imm_foreign,
    count(*) FILTER (l_linestatus = 'F') AS emi_foreign,
    count(*) FILTER (l_quantity >= 50 AND l_discount >= 0.095 AND l_tax >= 0.075) AS adjustment, sum(l_quantity) AS weight
  FROM lineitem GROUP BY 1, 2),
monthly AS (SELECT l.*, s_nationkey AS parent, s_name AS name FROM lines l JOIN supplier ON s_suppkey = entity)"""

ANNUAL = (
    MONTHLY
    + """,
annual AS (SELECT entity, parent, name, CAST(year(period) AS INTEGER) AS year, count(DISTINCT period) AS months, CAST(sum(births) AS BIGINT) AS births,
    CAST(sum(deaths) AS BIGINT) AS deaths, CAST(sum(imm_internal) AS BIGINT) AS imm_internal, CAST(sum(emi_internal) AS BIGINT) AS emi_internal,
    CAST(sum(imm_foreign) AS BIGINT) AS imm_foreign, CAST(sum(emi_foreign) AS BIGINT) AS emi_foreign,
    CAST(sum(abs(adjustment)) AS BIGINT) AS adjustment_abs, arg_min(weight, period) AS weight_start, arg_max(weight, period) AS weight_end
  FROM monthly GROUP BY 1, 2, 3, 4),
years AS (SELECT year, months FROM (SELECT CAST(year(period) AS INTEGER) AS year, count(DISTINCT month(period)) AS months FROM monthly GROUP BY 1)
  WHERE months = 12 ORDER BY year DESC LIMIT 6)"""
)

def last_month(spark: SparkSession, sf_dir: str):
    """The first day of the last month that the facts cover to its end."""
    last = F.date_add(F.max(F.to_date("l_shipdate")), 1)
    return table(spark, sf_dir, "lineitem").agg(F.add_months(F.trunc(last, "month"), -1)).first()[0]


CALENDAR = """,
calendar AS (SELECT date_diff('month', min(period), max(period)) + 1 AS n FROM monthly WHERE period <= (SELECT date_trunc('month', max(l_shipdate) + INTERVAL 1 DAY) - INTERVAL 1 MONTH FROM lineitem)),
dense AS (SELECT entity, list(CAST({flow} AS DOUBLE) ORDER BY period) AS v FROM monthly WHERE period <= (SELECT date_trunc('month', max(l_shipdate) + INTERVAL 1 DAY) - INTERVAL 1 MONTH FROM lineitem) GROUP BY entity
  HAVING count(*) = (SELECT n FROM calendar)),
rolled AS (SELECT entity, list_transform(range(12, len(v) + 1), lambda i: list_sum(v[i - 11:i])) AS r FROM dense WHERE len(v) >= 12)"""


# Expressions over DuckDB lists, in the terms of tidemark.functions.arrays.
def median(x: str) -> str:
    return f"list_transform([list_sort({x})], lambda z: (z[(len(z) + 1) // 2] + z[len(z) // 2 + 1]) / 2)[1]"


def diffs(x: str) -> str:
    return f"list_transform(range(2, len({x}) + 1), lambda q: ({x})[q] - ({x})[q - 1])"


def mad(x: str, scaled: bool = True) -> str:
    raw = median(f"list_transform({x}, lambda q: abs(q - {median(x)}))")
    return f"({raw} * 1.4826)" if scaled else raw


def sd(x: str) -> str:
    return f"list_aggregate({x}, 'stddev_pop')"


def robust_scale(x: str, eps: str = "1e-9", guard: bool = True) -> str:
    last = f"CASE WHEN {sd(x)} > {eps} THEN {sd(x)} ELSE 0 END" if guard else sd(x)
    return f"(CASE WHEN len({x}) < 3 THEN 0.0 WHEN {mad(x)} > {eps} THEN {mad(x)} ELSE {last} END)"


def theil_sen(x: str) -> str:
    return median(f"flatten(list_transform(range(1, len({x})), lambda i: list_transform(range(i + 1, len({x}) + 1), lambda j: (({x})[j] - ({x})[i]) / (j - i))))")


def resid(x: str, slope: str) -> str:
    return f"list_transform(range(1, len({x}) + 1), lambda i: ({x})[i] - {slope} * (i - 1))"


def ranks(x: str) -> str:
    return f"list_transform({x}, lambda p: len(list_filter({x}, lambda q: q < p)) + (len(list_filter({x}, lambda q: q = p)) + 1) / 2.0)"
