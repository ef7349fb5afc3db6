"""Roll-ups, gates, windows and robust statistics, each over all entities, with the SQL that must agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import arrays as A
from tidemark.operators import series as S
from tidemark.operators.ranks import percent_ranked
from tidemark.plans.facts import ANNUAL, CALENDAR, MONTHLY, diffs, last_month, mad, median, monthly, ordered_means, placed, ranks, resid, robust_scale, sd, table, theil_sen

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def r6(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


@query(
    f"""WITH {MONTHLY}{CALENDAR.format(flow='births')},
x AS (SELECT entity, r[-1] AS current, list_max(r[:-2]) AS top, list_min(r[:-2]) AS bottom FROM rolled WHERE len(r) > 1)
SELECT entity, current, top AS previous_max, bottom AS previous_min, current > top AS is_max, current < bottom AS is_min,
  round(CASE WHEN current > top THEN current - top WHEN current < bottom THEN bottom - current ELSE 0 END, 6) AS margin FROM x"""
)
def record_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = S.dense_monthly(monthly(spark, sf_dir), "births", last_month(spark, sf_dir))
    r = dense.select("entity", S.rolling_sums(F.col("values")).alias("r")).where(F.size("r") > 1)
    prior = A.without_last(F.col("r"))
    x = r.select("entity", A.at(F.col("r"), -1).alias("current"), F.array_max(prior).alias("previous_max"), F.array_min(prior).alias("previous_min"))
    high, low = F.col("current") > F.col("previous_max"), F.col("current") < F.col("previous_min")
    margin = F.when(high, F.col("current") - F.col("previous_max")).when(low, F.col("previous_min") - F.col("current")).otherwise(0.0)
    return x.select("*", high.alias("is_max"), low.alias("is_min"), F.round(margin, 6).alias("margin"))


@query(f"WITH {ANNUAL} SELECT * FROM annual")
def annual_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.annual_rollup(monthly(spark, sf_dir))


@query(f"WITH {ANNUAL} SELECT year, months FROM years")
def complete_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.complete_years(monthly(spark, sf_dir))


PASSPORT = (
    ANNUAL
    + """,
passport AS (SELECT entity, count(DISTINCT a.year) AS years, min(a.months) AS min_months, CAST(sum(adjustment_abs) AS BIGINT) AS adjustment_abs,
  count(DISTINCT name) AS names, count(DISTINCT parent) AS parents,
  count(DISTINCT a.year) = (SELECT count(*) FROM years) AND min(a.months) = 12 AND sum(adjustment_abs) = 0 AND count(DISTINCT name) = 1
    AND count(DISTINCT parent) = 1 AS quality_a
  FROM annual a JOIN years USING (year) GROUP BY entity)"""
)


def _annual(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    m = monthly(spark, sf_dir)
    return S.annual_rollup(m), S.complete_years(m)


@query(f"WITH {PASSPORT} SELECT * FROM passport")
def quality_passport(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.quality_passport(*_annual(spark, sf_dir))


@query(f"WITH {PASSPORT} SELECT a.entity, a.year, a.births, a.deaths FROM annual a SEMI JOIN (SELECT entity FROM passport WHERE quality_a) p ON a.entity = p.entity")
def stable_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    annual, years = _annual(spark, sf_dir)
    return S.only_stable(annual, S.quality_passport(annual, years)).select("entity", "year", "births", "deaths")


@query(f"WITH {ANNUAL} SELECT entity, max(year) AS year, arg_max(name, year) AS name, arg_max(parent, year) AS parent, arg_max(weight_end, year) AS weight_end FROM annual GROUP BY entity")
def latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.latest_row(_annual(spark, sf_dir)[0])


REST = (
    ANNUAL
    + """,
p AS (SELECT parent, year, sum(births) AS f, sum(weight_start) AS w FROM annual GROUP BY 1, 2),
rest AS (SELECT a.entity, a.parent, a.year, a.births AS flow, a.births * 1000.0 / nullif(a.weight_start, 0) AS rate,
  (f - a.births) * 1000.0 / nullif(w - a.weight_start, 0) AS rest_rate FROM annual a JOIN p USING (parent, year))"""
)


@query(f"WITH {REST} SELECT entity, parent, year, flow, round(rate, 6) AS rate, round(rest_rate, 6) AS rest_rate FROM rest")
def rest_of_parent_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.rest_of_parent(_annual(spark, sf_dir)[0], "births")
    return rows.select("entity", "parent", "year", "flow", *r6("rate", "rest_rate"))


@query(
    f"""WITH {ANNUAL}, t AS (SELECT parent, year, CAST(sum(births) AS BIGINT) AS total FROM annual GROUP BY 1, 2)
SELECT a.entity, a.year, a.births, total, round(a.births * 100.0 / total, 6) AS share FROM annual a LEFT JOIN t USING (parent, year)"""
)
def parent_share_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.sum("births").over(Window.partitionBy("parent", "year"))
    return _annual(spark, sf_dir)[0].select("entity", "year", "births", total.alias("total"), F.round(F.col("births") * 100.0 / total, 6).alias("share"))


@query(
    f"""WITH {MONTHLY}, w AS (SELECT entity, period, CAST(sum(births) OVER x AS BIGINT) AS rolling, count(*) OVER x AS n FROM monthly
  WINDOW x AS (PARTITION BY entity ORDER BY period ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)) SELECT entity, period, rolling FROM w WHERE n = 12"""
)
def rolling12_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.rolling_rows(monthly(spark, sf_dir), "births")


@query(f"WITH {MONTHLY}{CALENDAR.format(flow='births')} SELECT entity, len(r) AS points, r[1] AS first_sum, r[-1] AS last_sum, list_sum(r) AS all_sums FROM rolled")
def rolling12_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = S.dense_monthly(monthly(spark, sf_dir), "births", last_month(spark, sf_dir)).select("entity", S.rolling_sums(F.col("values")).alias("r")).where(F.size("r") > 0)
    return r.select("entity", F.size("r").cast("long").alias("points"), A.at(F.col("r"), 0).alias("first_sum"), A.at(F.col("r"), -1).alias("last_sum"), A.total(F.col("r")).alias("all_sums"))


@query(
    f"""WITH {MONTHLY}, d AS (SELECT entity, period, births - lag(births) OVER w AS step, lag(births) OVER w AS before FROM monthly WINDOW w AS (PARTITION BY entity ORDER BY period))
SELECT entity, period, step, round(step / nullif(before, 0), 6) AS change FROM d WHERE step IS NOT NULL"""
)
def first_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = F.lag("births").over(Window.partitionBy("entity").orderBy("period"))
    rows = monthly(spark, sf_dir).select("entity", "period", (F.col("births") - before).alias("step"), before.alias("before")).where("step is not null")
    return rows.select("entity", "period", "step", F.round(F.try_divide("step", "before"), 6).alias("change"))


SIX = ANNUAL + """,
six AS (SELECT entity, list(CAST(births AS DOUBLE) ORDER BY a.year) AS v FROM annual a JOIN years USING (year) GROUP BY entity HAVING count(*) = (SELECT count(*) FROM years))"""


def _six(spark: SparkSession, sf_dir: str, flow: str = "births") -> DataFrame:
    return S.annual_series(*_annual(spark, sf_dir), flow)


@query(
    f"""WITH {SIX}, s AS (SELECT entity, v, {theil_sen('v')} AS slope FROM six)
SELECT entity, round(slope, 6) AS slope, round({median(resid('v', 'slope'))}, 6) AS intercept, round({median(resid('v', 'slope'))} + slope * len(v), 6) AS expected FROM s"""
)
def theil_sen_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("values")
    x = _six(spark, sf_dir).withColumn("slope", A.theil_sen(v)).withColumn("intercept", A.intercept(v, F.col("slope")))
    return x.select("entity", *r6("slope", "intercept"), F.round(F.col("intercept") + F.col("slope") * F.size(v), 6).alias("expected"))


@query(
    f"""WITH {SIX}, r AS (SELECT entity, {ranks('v')} AS k, len(v) AS n FROM six),
s AS (SELECT entity, list_sum(list_transform(range(1, n + 1), lambda i: (k[i] - (n + 1) / 2.0) * (i - 1 - (n - 1) / 2.0))) AS a,
  list_sum(list_transform(k, lambda q: pow(q - (n + 1) / 2.0, 2))) AS b, list_sum(list_transform(range(n), lambda i: pow(i - (n - 1) / 2.0, 2))) AS c FROM r)
SELECT entity, round(CASE WHEN b > 0 THEN a / (sqrt(b) * sqrt(c)) ELSE 0 END, 6) AS rho FROM s"""
)
def spearman_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _six(spark, sf_dir).select("entity", F.round(A.spearman_time(F.col("values")), 6).alias("rho"))


@query(
    f"""WITH {SIX} SELECT entity, round({median('v')}, 6) AS med, round({mad('v')}, 6) AS mad, round({sd('v')}, 6) AS sd,
  round({robust_scale('v')}, 6) AS scale, round({robust_scale('v[1:2]')}, 6) AS short_scale FROM six"""
)
def robust_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("values")
    x = _six(spark, sf_dir).withColumns({"med": A.median(v), "mad": A.mad(v), "sd": A.sd(v), "scale": A.robust_scale(v), "short_scale": A.robust_scale(F.slice(v, 1, 2))})
    return x.select("entity", *r6("med", "mad", "sd", "scale", "short_scale"))


@query(
    f"""WITH {SIX}, d AS (SELECT entity, {diffs('v')} AS d FROM six)
SELECT entity, CAST(sign({median('d')}) AS DOUBLE) AS sign, round(len(list_filter(d, lambda q: sign(q) = sign({median('d')}))) / CAST(len(d) AS DOUBLE), 6) AS dominance FROM d"""
)
def dominant_sign(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("values")
    return _six(spark, sf_dir).select("entity", F.signum(A.median(A.diffs(v))).alias("sign"), F.round(A.dominance(v), 6).alias("dominance"))


@query(
    f"""WITH {ANNUAL}, t AS (SELECT entity, CAST(sum(births) AS BIGINT) AS total, any_value(parent) AS parent FROM annual GROUP BY entity)
SELECT entity, total, round((rank() OVER (PARTITION BY parent ORDER BY total) + (count(*) OVER (PARTITION BY parent, total) - 1) / 2.0) / count(*) OVER (PARTITION BY parent) * 100, 6) AS pct FROM t"""
)
def percent_rank_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _annual(spark, sf_dir)[0].groupBy("entity", "parent").agg(F.sum("births").alias("total"))
    return percent_ranked(totals, "total", ["parent"], "pct").select("entity", "total", F.round("pct", 6).alias("pct"))


@query(
    """WITH c AS (SELECT c_custkey AS entity, c_nationkey AS parent FROM customer),
o AS (SELECT DISTINCT o_custkey AS entity, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
g AS (SELECT entity, y, y - row_number() OVER (PARTITION BY entity ORDER BY y) AS island FROM o),
m AS (SELECT entity, max(y) AS last_year, arg_max(island, y) AS island, count(*) AS n_years FROM g GROUP BY entity)
SELECT m.entity, last_year, n_years, (SELECT count(*) FROM g WHERE g.entity = m.entity AND g.island = m.island) AS run FROM m"""
)
def trailing_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("y"))
    x = years.groupBy("entity").agg(F.array_sort(F.collect_set("y")).alias("years"))
    return x.select("entity", F.array_max("years").alias("last_year"), F.size("years").cast("long").alias("n_years"), A.trailing_run(F.col("years")).cast("long").alias("run"))


@query(
    """WITH y AS (SELECT o_custkey AS entity, CAST(year(o_orderdate) AS INTEGER) AS y, sum(CASE WHEN o_orderpriority LIKE '1%' THEN o_totalprice END) AS urgent FROM orders GROUP BY 1, 2)
SELECT entity, max(y) FILTER (urgent IS NOT NULL) AS year, round(arg_max(urgent, y) FILTER (urgent IS NOT NULL), 4) AS urgent,
  list(y ORDER BY y)[-6:] = range(max(y) - 5, max(y) + 1) AS six_in_a_row FROM y GROUP BY entity"""
)
def latest_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    urgent = F.sum(F.when(F.col("o_orderpriority").startswith("1"), F.col("o_totalprice"))).alias("urgent")
    y = orders.groupBy(F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("y")).agg(urgent)
    year = F.when(F.col("urgent").isNotNull(), F.col("y"))
    x = y.groupBy("entity").agg(F.max(year).alias("year"), F.max_by("urgent", year).alias("u"), F.array_sort(F.collect_list("y")).alias("ys"))
    run = A.last_n(F.col("ys"), 6) == F.sequence(F.array_max("ys") - 5, F.array_max("ys"))
    return x.select("entity", "year", F.round("u", 4).alias("urgent"), run.alias("six_in_a_row"))


@query(
    """SELECT o_custkey, o_orderkey, o_orderpriority, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1"""
)
def keep_last_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = S.keep_last(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return kept.select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice")


@query(
    """WITH t AS (SELECT s_nationkey, s_suppkey, s_acctbal, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS n FROM supplier)
SELECT s_nationkey, s_suppkey, s_acctbal FROM t WHERE n <= 3 ORDER BY s_acctbal DESC, s_suppkey LIMIT 40"""
)
def topk_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal")
    return S.top_k(rows, ["s_nationkey"], [F.desc("s_acctbal"), F.asc("s_suppkey")], 3, 40)


@query(
    """WITH m AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, avg(l_extendedprice) AS station_mean, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT year, count(*) AS stations, round(median(station_mean), 4) AS median_of_means FROM m GROUP BY year"""
)
def median_of_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    means = lines.groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(F.avg("l_extendedprice").alias("station_mean"))
    return means.groupBy("year").agg(F.count("*").alias("stations"), F.round(F.median("station_mean"), 4).alias("median_of_means"))


@query(
    """WITH c AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, avg(l_discount) * 10 AS coverage, avg(l_tax) AS value FROM lineitem GROUP BY 1, 2),
t AS (SELECT CASE WHEN median(coverage) <= 1.5 THEN 0.5 ELSE 50 END AS threshold FROM c)
SELECT year, count(*) AS kept, round(median(value), 6) AS med FROM c, t WHERE coverage >= threshold GROUP BY year"""
)
def coverage_scaled_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [F.col("l_suppkey"), F.year("l_shipdate").alias("year")]
    c = ordered_means(placed(spark, sf_dir, "lineitem"), keys, coverage=F.col("l_discount"), value=F.col("l_tax")).withColumn("coverage", F.col("coverage") * 10)
    threshold = c.agg(F.when(F.median("coverage") <= 1.5, 0.5).otherwise(50.0).alias("threshold"))
    kept = c.join(F.broadcast(threshold), F.col("coverage") >= F.col("threshold"))
    return kept.groupBy("year").agg(F.count("*").alias("kept"), F.round(F.median("value"), 6).alias("med"))


@query(
    """SELECT r_name, n_name, grouping(n_name) AS level, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity), 6) AS share, CAST(sum(l_quantity) AS BIGINT) AS quantity
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ROLLUP (r_name, n_name)"""
)
def ratio_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "supplier", "nation", "region")}
    by_supplier = t["lineitem"].groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"), F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)).alias("part"))
    named = by_supplier.join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    rolled = named.rollup("r_name", "n_name").agg(F.grouping("n_name").cast("long").alias("level"), F.round(F.try_divide(F.sum("part"), F.sum("q")), 6).alias("share"), F.sum("q").cast("long").alias("quantity"))
    return rolled


@query(
    """SELECT l_shipmode_key AS sheet, round(sum(within) / sum(total), 6) AS compliance, CAST(sum(total) AS BIGINT) AS total FROM (
  SELECT l_linenumber AS l_shipmode_key, l_suppkey, sum(CASE WHEN l_discount <= 0.05 THEN l_quantity ELSE 0 END) AS within, sum(l_quantity) AS total FROM lineitem GROUP BY 1, 2) WHERE total > 0 GROUP BY 1"""
)
def weighted_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    sheets = lines.groupBy(F.col("l_linenumber").alias("sheet"), "l_suppkey").agg(F.sum(F.when(F.col("l_discount") <= 0.05, F.col("l_quantity")).otherwise(0)).alias("within"), F.sum("l_quantity").alias("total"))
    return sheets.where("total > 0").groupBy("sheet").agg(F.round(F.sum("within") / F.sum("total"), 6).alias("compliance"), F.sum("total").cast("long").alias("total"))


@query(
    """WITH p AS (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A' AND l_tax > 0.079) AS a, count(*) FILTER (l_returnflag = 'R' AND l_tax > 0.079) AS r, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_suppkey, CASE WHEN a = 0 AND r = 0 THEN NULL ELSE round((CASE WHEN a = 0 THEN 0 ELSE a END + CASE WHEN r = 0 THEN 0 ELSE r END) * 100.0 / n, 6) END AS share FROM p"""
)
def null_tolerant_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    part = lambda flag: F.nullif(F.count_if((F.col("l_returnflag") == flag) & (F.col("l_tax") > 0.079)), F.lit(0))
    p = lines.groupBy("l_suppkey").agg(part("A").alias("a"), part("R").alias("r"), F.count("*").alias("n"))
    both = F.when(F.col("a").isNotNull() | F.col("r").isNotNull(), F.coalesce("a", F.lit(0)) + F.coalesce("r", F.lit(0)))
    return p.select("l_suppkey", F.round(both * 100.0 / F.col("n"), 6).alias("share"))


_KNOWN = "list_transform(list_filter(range(1, len(x) + 1), lambda i: x[i] IS NOT NULL AND NOT isnan(x[i])), lambda i: x[i])"


@query(
    f"""WITH m AS (SELECT l_suppkey AS entity, date_trunc('month', l_shipdate) AS period, CASE WHEN count(*) FILTER (l_returnflag = 'R') = 0 THEN NULL WHEN count(*) FILTER (l_returnflag = 'A') = 0 THEN 'nan'::DOUBLE
  ELSE round(avg(l_discount) FILTER (l_returnflag = 'R'), 4) END AS x FROM lineitem GROUP BY 1, 2),
s AS (SELECT entity, list(x ORDER BY period) AS x FROM m GROUP BY entity),
k AS (SELECT entity, x, {_KNOWN} AS v, list_filter(range(1, len(x) + 1), lambda i: x[i] IS NOT NULL AND NOT isnan(x[i])) AS pl FROM s),
t AS (SELECT *, {median("flatten(list_transform(pl, lambda i: list_transform(list_filter(pl, lambda j: j > i), lambda j: (x[j] - x[i]) / (j - i))))")} AS slope FROM k),
e AS (SELECT *, list_transform(pl, lambda i: x[i] - slope * (i - 1)) AS rest FROM t)
SELECT entity, len(x) AS months, len(v) AS known, round({median('v')}, 6) AS med, round({mad('v')}, 6) AS mad, round({sd('v')}, 6) AS sd, round({robust_scale('v')}, 6) AS scale,
  CASE WHEN len(v) >= 2 THEN round(slope, 8) END AS slope, CASE WHEN len(v) >= 2 THEN round({median('rest')}, 6) END AS intercept FROM e"""
)
def gapped_robust_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Robust statistics of monthly series with months that are null and months that are NaN."""
    has = lambda flag: F.count_if(F.col("l_returnflag") == flag)
    x = F.when(has("R") == 0, None).when(has("A") == 0, float("nan")).otherwise(F.round(F.avg(F.when(F.col("l_returnflag") == "R", F.col("l_discount"))), 4))
    months = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("entity"), F.date_trunc("month", "l_shipdate").alias("period")).agg(x.alias("x"))
    v = F.col("values")
    s = S.series_of(months, F.col("x")).withColumn("slope", A.theil_sen(v))
    s = s.withColumns({"months": F.size(v).cast("long"), "known": F.size(A.known(v)).cast("long"), "med": A.median(v), "mad": A.mad(v), "sd": A.sd(v), "scale": A.robust_scale(v), "intercept": A.intercept(v, F.col("slope"))})
    return s.select("entity", "months", "known", *r6("med", "mad", "sd", "scale"), F.round("slope", 8).alias("slope"), *r6("intercept"))
