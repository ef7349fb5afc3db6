"""From facts to series: monthly and yearly roll-ups, quality gates, windows and arrays.

The facts have columns entity, parent, name, period (date of the month's first day), flow columns,
adjustment and weight, one row per entity and month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FLOWS = ["births", "deaths", "imm_internal", "emi_internal", "imm_foreign", "emi_foreign"]


def annual_rollup(monthly: DataFrame) -> DataFrame:
    """Distinct months, flow sums, absolute adjustments, weight of the first and the last month, by entity and year."""
    month = F.when(F.col("weight").isNotNull(), F.col("period"))
    return monthly.groupBy("entity", "parent", "name", F.year("period").alias("year")).agg(
        F.count_distinct("period").alias("months"),
        *(F.sum(c).alias(c) for c in FLOWS),
        F.sum(F.abs(F.coalesce("adjustment", F.lit(0)))).alias("adjustment_abs"),
        F.min_by("weight", month).alias("weight_start"),
        F.max_by("weight", month).alias("weight_end"),
    )


def complete_years(monthly: DataFrame, keep: int = 6) -> DataFrame:
    """The last ``keep`` years of which the facts hold all twelve months."""
    months = monthly.groupBy(F.year("period").alias("year")).agg(F.count_distinct(F.month("period")).alias("months"))
    return months.where("months = 12").orderBy(F.desc("year")).limit(keep)


def quality_passport(annual: DataFrame, years: DataFrame) -> DataFrame:
    """Per entity: how many complete years it covers, how fully, its adjustments and names; quality_a if all is in order."""
    wanted = F.broadcast(years.select("year"))
    needed = years.agg(F.count("*").alias("needed"))
    found = annual.join(wanted, "year").groupBy("entity").agg(
        F.count_distinct("year").alias("years"),
        F.min("months").alias("min_months"),
        F.sum("adjustment_abs").alias("adjustment_abs"),
        F.count_distinct("name").alias("names"),
        F.count_distinct("parent").alias("parents"),
    )
    good = (F.col("years") == F.col("needed")) & (F.col("min_months") == 12) & (F.col("adjustment_abs") == 0) & (F.col("names") == 1) & (F.col("parents") == 1)
    return found.join(F.broadcast(needed)).withColumn("quality_a", good).drop("needed")


def only_stable(rows: DataFrame, passport: DataFrame) -> DataFrame:
    return rows.join(passport.where("quality_a").select("entity"), "entity", "left_semi")


def latest_row(annual: DataFrame) -> DataFrame:
    """The last year's name, parent and closing weight of each entity."""
    return annual.groupBy("entity").agg(F.max_by(F.struct("year", "name", "parent", "weight_end"), "year").alias("r")).select("entity", "r.*")


def series_of(rows: DataFrame, value: Column, by: str = "period", key: str = "entity") -> DataFrame:
    """(key, periods, values): each series as arrays in order of period."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(by).alias("p"), value.cast("double").alias("v"))))
    grouped = rows.groupBy(key).agg(pairs.alias("s"))
    return grouped.select(key, F.col("s")["p"].alias("periods"), F.col("s")["v"].alias("values"))


def annual_series(annual: DataFrame, years: DataFrame, value: str) -> DataFrame:
    """Series over exactly the given years; entities that lack one are left out."""
    needed = F.broadcast(years.agg(F.count("*").alias("needed")))
    found = series_of(annual.join(F.broadcast(years.select("year")), "year").where(F.col(value).isNotNull()), F.col(value), "year")
    return found.join(needed).where(F.size("values") == F.col("needed")).drop("needed")


def dense_monthly(monthly: DataFrame, value: str, end=None) -> DataFrame:
    """Series over the whole calendar from the first to the last month; entities with a gap are left out."""
    rows = monthly if end is None else monthly.where(F.col("period") <= F.lit(end).cast("date"))
    calendar = rows.agg((F.months_between(F.max("period"), F.min("period")) + 1).cast("int").alias("calendar"))
    found = series_of(rows.where(F.col(value).isNotNull()), F.col(value))
    return found.join(F.broadcast(calendar)).where(F.size("values") == F.col("calendar")).drop("calendar")


def rolling_sums(values: Column, width: int = 12) -> Column:
    """Sums over each full window of an array, each from the one before."""
    n = F.size(values)
    first = F.aggregate(F.slice(values, 1, width), F.lit(0.0), lambda a, x: a + x)
    steps = F.zip_with(F.slice(values, width + 1, F.greatest(n - width, F.lit(0))), F.slice(values, 1, F.greatest(n - width, F.lit(0))), lambda b, a: b - a)
    sums = F.aggregate(steps, F.array(first), lambda done, d: F.concat(done, F.array(F.element_at(done, -1) + d)))
    return F.when(n >= width, sums).otherwise(F.array().cast("array<double>"))


def rolling_rows(monthly: DataFrame, value: str, width: int = 12) -> DataFrame:
    """Rolling sums as rows, full windows of rows only."""
    w = Window.partitionBy("entity").orderBy("period")
    frame = w.rowsBetween(1 - width, 0)
    return monthly.select("entity", "period", F.sum(value).over(frame).alias("rolling"), F.count("*").over(frame).alias("n")).where(F.col("n") == width).drop("n")


def rest_of_parent(annual: DataFrame, value: str) -> DataFrame:
    """Own rate per thousand and the rate of all other entities of the parent, by year."""
    parent = annual.groupBy("parent", "year").agg(F.sum(value).alias("parent_flow"), F.sum("weight_start").alias("parent_weight"))
    rows = annual.join(parent, ["parent", "year"])
    return rows.select(
        "entity",
        "parent",
        "year",
        F.col(value).alias("flow"),
        F.try_divide(F.col(value) * 1000.0, "weight_start").alias("rate"),
        F.try_divide((F.col("parent_flow") - F.col(value)) * 1000.0, F.col("parent_weight") - F.col("weight_start")).alias("rest_rate"),
    )


def keep_last(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the last in an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*(c.desc_nulls_last() for c in order))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def top_k(rows: DataFrame, keys: list[str], order: list[Column], k: int, overall: int | None = None) -> DataFrame:
    """The first k rows of each group, and of those the first ``overall``."""
    kept = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= k).drop("_n")
    return kept if overall is None else kept.orderBy(*order).limit(overall)


def registry(rows: DataFrame) -> DataFrame:
    """Distinct territories (region, area_type, area, municipality, municipality_code) with all names, in the order of a printed registry.

    Regions, areas and municipalities sort by their letters whatever their case, types as they are written; equal ones by code.
    """
    order = ["region", "area", "municipality", "municipality_code"]
    named = rows.where("trim(region) <> '' and trim(area) <> '' and trim(municipality) <> ''")
    return named.distinct().orderBy(F.lower("region"), "area_type", F.lower("area"), F.lower("municipality"), *order)

