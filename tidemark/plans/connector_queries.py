"""Reports, fetch plans, drifting yearly files and grids, written from the driver's tables and read back."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tidemark.functions import reports as R
from tidemark.operators import connectors as C
from tidemark.operators import detectors as D
from tidemark.operators import fetch_plan as P
from tidemark.plans.detector_queries import short_sql
from tidemark.plans.facts import table, written
from tidemark.sources import grids as G
from tidemark.sources import yearly as Y

QUERIES, SQL = {}, {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def _text(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _italian(value: Column, digits: int = 1) -> Column:
    return F.translate(F.format_number(value, digits), ",.", ".,")


# --- reports -------------------------------------------------------------------------------------

_REPORT = [
    R.Row("power", "Totale", "MW", (1, 3, 5, 7), 8, 0, 9000),
    R.Row("output", "Produzione totale da FER", "GWh", (0, 2, 4, 6), 8),
    R.Row("share", "Produzione FER/Produzione complessiva", "%", (0, 1, 2, 3), 4, 0, 55),
    R.Row("losses", "Perdite di rete", "GWh", (0,), 1),
    R.Row("imports", "Importazioni nette", "GWh", (0,), 1),
]


@query(
    """WITH y AS (SELECT list(DISTINCT year(o_orderdate) ORDER BY year(o_orderdate))[-4:] AS l FROM orders),
v AS (SELECT c_nationkey AS nation, year(o_orderdate) AS year, round(sum(o_totalprice) / 1000, 1) AS p, round(sum(o_totalprice) FILTER (o_orderstatus = 'F') / 1000, 1) AS f, count(*) AS n, count(*) FILTER (o_orderstatus = 'O') * 100 // count(*) AS s
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
a AS (SELECT nation, list(p ORDER BY year) AS p, list(f ORDER BY year) AS f, list(CAST(s AS DOUBLE) ORDER BY year) AS s FROM v, y WHERE list_contains(l, year) GROUP BY nation HAVING count(*) = 4 AND count(f) = 4),
r AS (SELECT nation, 'power' AS name, 'MW' AS unit, p AS x, CASE WHEN p[4] > 9000 THEN 'out_of_range' END AS error FROM a
  UNION ALL SELECT nation, 'output', 'GWh', f, NULL FROM a UNION ALL SELECT nation, 'share', '%', s, CASE WHEN s[4] > 55 THEN 'out_of_range' END FROM a UNION ALL SELECT nation, 'losses', 'GWh', NULL, 'too_few_values' FROM a UNION ALL SELECT nation, 'imports', 'GWh', NULL, 'missing_row' FROM a)
SELECT nation, name, unit, CASE WHEN error IS NULL THEN x END AS x, error FROM r"""
)
def labelled_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series of reports, a text a nation: labelled rows of numbers whose last value must lie in a range."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    year = F.year("o_orderdate")
    years = sorted(r[0] for r in orders.select(year).distinct().collect())[-4:]
    rows = orders.where(year.isin(years)).join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey", year.alias("year")).agg(
        F.round(F.sum("o_totalprice") / 1000, 1).alias("p"),
        F.round(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))) / 1000, 1).alias("f"),
        F.count("*").alias("n"),
        F.floor(F.count_if(F.col("o_orderstatus") == "O") * 100 / F.count("*")).alias("s"),
    )
    by_year = rows.groupBy(F.col("c_nationkey").alias("nation")).agg(F.array_sort(F.collect_list(F.struct("year", "p", "f", "n", "s"))).alias("v"), F.count("f").alias("known"))
    by_year = by_year.where((F.size("v") == 4) & (F.col("known") == 4))
    joined = lambda cell: F.array_join(F.transform("v", cell), " ")
    text = _text(
        "Relazione 2030\nTabella di sintesi\n Totale\t", joined(lambda x: _text(x["n"], " ", _italian(x["p"]))), " -1,5% 2,0%\nProduzione totale da FER ",
        joined(lambda x: _text(_italian(x["f"]), "  ", _italian(x["f"] + 1))), " 3,1% 4%\nProduzione FER/Produzione complessiva ", joined(lambda x: _text(x["s"], "%")),
        " 0,4 0,5\nPerdite di rete nessuna\nFonte: registro",
    )
    found = R.read_reports(by_year.select("nation", text.alias("text")), _REPORT, [str(y) for y in years])
    return found.select("nation", "name", "unit", F.col("values").alias("x"), "error")


# --- fetch plans ---------------------------------------------------------------------------------

_FETCHED = """p AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders), l AS (SELECT year, max(month) AS latest FROM p GROUP BY 1),
m AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, c_nationkey AS province, arg_max(o_orderstatus, (o_orderdate, o_orderstatus)) AS last FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3),
w AS (SELECT l.year, CAST(mm AS INTEGER) AS month, n_nationkey AS province FROM l, nation, range(1, 13) r(mm) WHERE mm <= latest)"""


def _manifest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    year, month = F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    manifest = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        year, month, F.col("c_nationkey").alias("province"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise(F.col("o_orderstatus")).alias("status"), F.col("o_orderdate").alias("fetched_at")
    )
    # of the same time, the status that sorts last counts: as text "ok" follows "O" and "P", as "P" follows "F" in the orders
    manifest = manifest.withColumn("fetched_at", F.struct("fetched_at", F.when(F.col("status") == "ok", "F").otherwise(F.col("status")).alias("s")))
    return P.latest_months(orders.select(year, month)), table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("province")), manifest


@query(
    f"""WITH {_FETCHED}, z AS (SELECT max((year, latest)) AS z FROM l)
SELECT w.year, w.month, w.province, CASE WHEN last IS NULL THEN 'new' WHEN last <> 'F' THEN 'failed' ELSE 'provisional' END AS reason FROM w LEFT JOIN m ON m.year = w.year AND m.month = w.month AND m.province = w.province, z
WHERE last IS NULL OR last <> 'F' OR (w.year = z[1] AND w.month = z[2])"""
)
def fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of months and nations still to be fetched: never, failed last, or provisional."""
    return P.fetch_plan(*_manifest(spark, sf_dir))


@query(
    f"""WITH {_FETCHED}, g AS (SELECT DISTINCT year(o_orderdate) AS year, month(o_orderdate) AS month, c_nationkey AS province FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F')
SELECT w.year, w.month, w.province FROM w LEFT JOIN g ON g.year = w.year AND g.month = w.month AND g.province = w.province WHERE g.year IS NULL"""
)
def fetch_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices that no successful fetch covers."""
    return P.gaps(*_manifest(spark, sf_dir))


# --- yearly files --------------------------------------------------------------------------------


def _waste_files(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    """A file a year of suppliers as municipalities: headers change their case and place, and the newest lacks one that is needed."""
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "supplier", "nation", "region")}
    sums = t["lineitem"].groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        F.sum("l_quantity").alias("waste"), F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("sorted"), F.count("*").alias("people")
    )
    named = sums.join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    named = written(named.select("year", "s_name", "r_name", "people", "sorted", "waste"), "municipalities")
    years = sorted(r[0] for r in named.select("year").distinct().collect())
    files = {}
    for y in years:
        name = str.upper if y % 2 else str
        rd = F.coalesce(_italian(F.col("sorted"), 2), F.lit("n.d.")).alias(name("Totale RD (t)"))
        own = [F.col("r_name").alias(name("Regione")), F.col("s_name").alias("Comune"), F.col("people").alias("Popolazione"), _italian(F.col("waste"), 2).alias("Totale RU (t)")]
        own += [] if y == years[-1] else [rd]
        files[y] = named.where(F.col("year") == y).select(*(reversed(own) if y % 2 else own), *([F.lit("x").alias("Nota")] if y % 3 == 0 else []))
    return files


_WASTE_SERIES = f"""d0 AS (SELECT l_suppkey, year(l_shipdate) AS y, sum(l_quantity) AS u, sum(l_quantity) FILTER (l_returnflag = 'R') AS r, count(*) AS n FROM lineitem GROUP BY 1, 2),
e0 AS (SELECT r_name, y, u, r, n FROM d0 JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey WHERE y < (SELECT max(y) FROM d0)),
g0 AS (SELECT coalesce(r_name, 'Italia') AS entity, y, sum(r) * 100 / nullif(sum(u) FILTER (r IS NOT NULL), 0) AS v, sum(u) FILTER (r IS NOT NULL) * 1000 / sum(n) AS h FROM e0 GROUP BY GROUPING SETS ((r_name, y), (y))),
b0 AS (SELECT entity || '|share' AS entity, y, v FROM g0 WHERE v IS NOT NULL UNION ALL SELECT 'Italia|head', y, h FROM g0 WHERE entity = 'Italia' AND h IS NOT NULL),
s AS (SELECT entity, list(v ORDER BY y)[-{D.GREEN.points}:] AS x, CAST(NULL AS DOUBLE[]) AS wh FROM b0 GROUP BY entity HAVING count(*) >= 6)"""


@query(short_sql(D.GREEN, _WASTE_SERIES))
def waste_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly files of municipal waste with drifting headers, to shares of regions and the nation, to detections."""
    rows, _ = Y.aligned(_waste_files(spark, sf_dir), C.WASTE, C.LEAST)
    found = C.detected(C.waste_series(rows))
    entity = _text(F.col("entity"), "|", F.when(F.col("unit") == "%", "share").otherwise("head"))
    return _shown(found.withColumn("entity", entity))


def _shown(found: DataFrame) -> DataFrame:
    return found.select("entity", F.array_join("patterns", "|").alias("patterns"), *(F.round(c, 6).alias(c) for c in ("z", "z_level", "score")))


@query(
    """WITH y AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem), z AS (SELECT max(year) AS z FROM y)
SELECT year, CASE WHEN year = z THEN 'missing_columns' ELSE 'read' END AS status, CASE WHEN year = z THEN 'sorted_t' ELSE '' END AS missing, 'province,code' AS absent, CASE WHEN year % 3 = 0 THEN 'Nota' ELSE '' END AS unknown FROM y, z"""
)
def header_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the header of each yearly file lacked and had beyond the layout."""
    _, told = Y.aligned(_waste_files(spark, sf_dir), C.WASTE, C.LEAST)
    return told.select("year", "status", *(F.array_join(c, ",").alias(c) for c in ("missing", "absent", "unknown")))


_AIR_SERIES = f"""c0 AS (SELECT l_suppkey, year(l_shipdate) AS y, round(avg(l_tax), 4) AS v, CASE WHEN count(*) > 3 THEN round(avg(l_discount) * 18, 3) END AS cov FROM lineitem GROUP BY 1, 2),
t0 AS (SELECT CASE WHEN median(cov) <= 1.5 THEN 0.75 ELSE 75 END AS least FROM c0), k0 AS (SELECT y, median(v) AS v FROM c0, t0 WHERE cov IS NULL OR cov >= least GROUP BY y),
s AS (SELECT 'Italia' AS entity, list(v ORDER BY y)[-{D.GREEN.points}:] AS x, CAST(NULL AS DOUBLE[]) AS wh FROM k0 HAVING count(*) >= 6)"""


@query(short_sql(D.GREEN, _AIR_SERIES))
def air_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station file to the yearly median over stations of enough coverage, whose scale is told from it, to detections."""
    lines = table(spark, sf_dir, "lineitem")
    file = lines.groupBy(F.col("l_suppkey").alias("nome_stazione"), F.year("l_shipdate").alias("yy")).agg(
        F.format_string("%.4f", F.round(F.avg("l_tax"), 4)).alias("media_yy"), F.when(F.count("*") > 3, F.format_string("%.3f", F.round(F.avg("l_discount") * 18, 3))).alias("copertura")
    )
    rows, _ = Y.aligned({0: file}, C.AIR)
    return _shown(C.detected(C.air_series(rows, "PM10")))


_GOAL_SERIES = f"""m0 AS (SELECT p_size, CAST(year(l_shipdate) AS INTEGER) AS y, round(avg(l_discount), 4) AS v, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
s AS (SELECT 'M' || p_size AS entity, list(v ORDER BY y)[-{D.GREEN.points}:] AS x, CAST(NULL AS DOUBLE[]) AS wh FROM m0 WHERE n % 5 <> 0 GROUP BY p_size HAVING count(*) >= 6)"""


@query(short_sql(D.GREEN, _GOAL_SERIES))
def goal_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of national goals, a column a year, some years missing; repeated measures and other levels are left out."""
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    means = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_size", F.year("l_shipdate").alias("y")).agg(F.round(F.avg("l_discount"), 4).alias("v"), F.count("*").alias("n"))
    years = sorted(r[0] for r in means.select("y").distinct().collect())
    shown = F.when(F.col("n") % 5 == 0, "....").otherwise(F.format_string("%.4f", F.col("v")))
    wide = means.groupBy("p_size").agg(*(F.max(F.when(F.col("y") == y, shown)).alias(f"y{y}") for y in years))
    name = F.lit("Emissioni di gas serra")
    kinds = [("Goal 13 - clima", "Italia (NUTS 0)", "", "M", 0), ("Goal 13 - clima", "Italia (NUTS 0)", " Territorio ", "M", 1), ("Goal 13 - clima", "Nord (NUTS 1)", "", "N", 0), ("Goal 1 - altro", "Italia (NUTS 0)", "", "G", 0), ("Goal 13 - clima", "Italia (NUTS 0)", "sesso", "S", 0)]
    rows = None
    for goal, level, dimension, code, place in kinds:
        own = wide.select(
            F.lit(goal).alias("goal"), F.lit(level).alias("level"), F.lit(dimension).alias("dimension"), name.alias("name"), _text(code, F.col("p_size")).alias("code"), F.lit("%").alias("unit"),
            (F.col("p_size") * 10 + place).alias("place"), *(F.col(f"y{y}") for y in years),
        )
        rows = own if rows is None else rows.unionByName(own)
    return _shown(C.detected(C.goal_series(rows, years)))


# --- grids ---------------------------------------------------------------------------------------


@F.pandas_udf(BinaryType())
def _grid_file(temperature: pd.Series, rain: pd.Series) -> pd.Series:
    """A classic NetCDF file of two variables over one dimension; missing rain is its fill value."""
    name = lambda text: struct.pack(">i", len(text)) + text.encode().ljust(-(-len(text) // 4) * 4, b"\0")
    text = lambda key, value: name(key) + struct.pack(">i", 2) + name(value)

    def made(t, r) -> bytes:
        t, r = np.array(t, ">f8"), np.array([-9.0 if v is None else v for v in r], ">f8")
        rain_attributes = struct.pack(">ii", 12, 2) + text("units", "m") + name("_FillValue") + struct.pack(">iid", 6, 1, -9.0)
        head = b"CDF\1" + struct.pack(">iii", 0, 10, 1) + name("cell") + struct.pack(">iii", len(t), 0, 0) + struct.pack(">ii", 11, 2)
        one = name("t2m") + struct.pack(">ii", 1, 0) + struct.pack(">ii", 12, 1) + text("units", "K")
        two = name("tp_mean") + struct.pack(">ii", 1, 0) + rain_attributes
        size = len(head) + len(one) + len(two) + 24
        place = lambda begin: struct.pack(">iii", 6, 8 * len(t), begin)
        return head + one + place(size) + two + place(size + 8 * len(t)) + t.tobytes() + r.tobytes()

    return pd.Series([made(*x) for x in zip(temperature, rain)])


@query(
    """WITH c AS (SELECT c_nationkey AS nation, avg(c_acctbal) / 100 AS t, avg(c_acctbal) FILTER (c_acctbal >= 0) AS r, count(*) AS n, count(*) FILTER (c_acctbal >= 0) AS k FROM customer GROUP BY 1)
SELECT nation, 'temperature_c' AS quantity, round(t, 6) AS mean, n AS cells FROM c UNION ALL SELECT nation, 'precipitation_mm_day', round(r, 6), k FROM c"""
)
def grid_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means over gridded files, a file a nation, a cell a customer: Kelvin and metres, cells without rain missing."""
    pair = F.sort_array(F.collect_list(F.struct("c_custkey", "c_acctbal")))["c_acctbal"]
    cells = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(pair.alias("x"))
    rain = F.transform("x", lambda v: F.when(v >= 0, v / 1000))
    files = cells.select(_text("/in/", F.col("nation"), ".nc").alias("path"), _grid_file(F.transform("x", lambda v: v / 100 + 273.15), rain).alias("content"))
    found = G.spatial_means(G.grid_blocks(files))
    return found.select(F.regexp_extract("path", r"(\d+)\.nc", 1).cast("int").alias("nation"), "quantity", F.round("mean", 6).alias("mean"), "cells")
