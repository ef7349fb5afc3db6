"""From the files of three publishers to detections: municipal waste, air stations, and national goals.

Each gives series (entity, indicator, unit, periods, values), which one detector of short series reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import classes as C
from tidemark.functions.numbers import inferred_separators
from tidemark.operators import detectors as D
from tidemark.sources.yearly import Layout, well_covered

#: Values that a series needs.
LEAST = 6
# Headers of the publishers' files, as patterns where they changed over the years.
WASTE = Layout(
    {"region": "Regione", "population": "Popolazione", "sorted_t": r"Totale RD \(t\)", "waste_t": r"Totale RU \(t\)"},
    {"municipality": "Comune", "province": "Provincia", "code": r"Istat.*|Codice.*"},
)
AIR = Layout({"year_text": "yy", "mean": "media_yy"}, {"coverage": "copertura", "station": "station_eu_code|nome_stazione"})
NATION = "Italia"


def _series(rows: DataFrame, value: str, unit: str, indicator: str) -> DataFrame:
    """(entity, indicator, unit, periods, values) of rows (entity, year, value), series with LEAST known values."""
    pair = F.struct(F.col("year").alias("p"), F.col(value).cast("double").alias("v"))
    grouped = rows.where(F.col(value).isNotNull()).groupBy("entity").agg(F.array_sort(F.collect_list(pair)).alias("s"))
    found = grouped.select("entity", F.lit(indicator).alias("indicator"), F.lit(unit).alias("unit"), F.col("s")["p"].cast("array<string>").alias("periods"), F.col("s")["v"].alias("values"))
    return found.where(F.size("values") >= LEAST)


def waste_series(rows: DataFrame) -> DataFrame:
    """Municipal rows (year, region, population, sorted_t, waste_t as text) to the sorted share of the nation and each region, and the nation's waste a head.

    A municipality counts for the share where both amounts are numbers; its people always count. The three levels come
    from one rollup of partial sums.
    """
    n = {c: inferred_separators(F.col(c)) for c in ("population", "sorted_t", "waste_t")}
    typed = rows.select("year", F.trim("region").alias("region"), *(v.alias(c) for c, v in n.items())).where("region <> ''")
    both = F.col("sorted_t").isNotNull() & F.col("waste_t").isNotNull()
    sums = typed.rollup("year", "region").agg(
        F.grouping("region").alias("whole"),
        F.sum(F.when(both, F.col("sorted_t"))).alias("sorted"),
        F.sum(F.when(both, F.col("waste_t"))).alias("waste"),
        F.sum("population").alias("people"),
    )
    sums = sums.where("year is not null").withColumn("entity", F.when(F.col("whole") == 1, NATION).otherwise(F.col("region")))
    sums = sums.withColumns({"share": F.try_divide(F.col("sorted") * 100, "waste"), "head": F.try_divide(F.col("waste") * 1000, "people")})
    share = _series(sums, "share", "%", "Raccolta differenziata dei rifiuti urbani")
    return share.unionByName(_series(sums.where("whole = 1"), "head", "kg/ab", "Rifiuti urbani prodotti pro capite"))


def air_series(rows: DataFrame, pollutant: str, unit: str = "µg/m³") -> DataFrame:
    """Station rows (year_text, mean, coverage as text) to the yearly median over stations of enough coverage."""
    typed = rows.select(*(inferred_separators(F.col(c)).alias(c) for c in ("year_text", "mean", "coverage")))
    typed = typed.select(F.col("year_text").cast("int").alias("year"), "mean", "coverage").where("year between 1900 and 2100")
    good = well_covered(typed, F.col("coverage")).where("mean is not null")
    medians = good.groupBy("year").agg(F.median("mean").alias("value")).withColumn("entity", F.lit(NATION))
    return _series(medians, "value", unit, f"{pollutant} - mediana nazionale delle medie annue di stazione")


def goal_series(rows: DataFrame, years: list[int]) -> DataFrame:
    """Rows of measures (goal, level, dimension, name, code, unit, y<year> as text) to the national series of environmental goals.

    Measures that repeat, by their code or else their name, count once, the first by place. Missing years stay in their place.
    """
    kept = rows.where(C.is_national_goal(F.col("goal"), F.col("level"), F.col("dimension")) & (F.trim("name") != ""))
    kept = kept.withColumn("pillar", C.green_pillar(F.col("name"), C.goal_number(F.col("goal")))).where("pillar is not null")
    key = F.when(F.coalesce(F.trim("code"), F.lit("")) != "", F.trim("code")).otherwise(F.trim(F.regexp_replace(F.lower("name"), r"(?U)\W+", " ")))
    values = F.array(*(inferred_separators(F.col(f"y{y}")) for y in years))
    kept = kept.withColumns({"_key": key, "values": values}).where(C.enough_values(F.col("values"), LEAST))
    first = kept.withColumn("_n", F.row_number().over(Window.partitionBy("_key").orderBy("place"))).where("_n = 1")
    return first.select(F.col("_key").alias("entity"), F.trim("name").alias("indicator"), "unit", F.lit([str(y) for y in years]).alias("periods"), "values")


def detected(series: DataFrame, family: D.Short = D.GREEN) -> DataFrame:
    """Series with patterns and score of their known values, in order; those without a pattern have an empty array."""
    pairs = F.filter(F.arrays_zip("periods", "values"), lambda p: p["values"].isNotNull() & ~F.isnan(p["values"]))
    known = series.withColumn("_p", pairs).withColumns({"periods": F.col("_p")["periods"], "values": F.col("_p")["values"]}).drop("_p")
    found = D.short_series(known, family)
    return found.select("entity", "indicator", "unit", "periods", "values", F.element_at("periods", -1).alias("latest"), "patterns", "z", "z_level", "score")
