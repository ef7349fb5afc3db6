"""The detectors over every supplier: all metrics and the flag, flagged or not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import arrays as A
from tidemark.operators import detectors as D
from tidemark.operators import flow_events as X
from tidemark.operators import series as S
from tidemark.plans.facts import ANNUAL, CALENDAR, MONTHLY, diffs, last_month, mad, median, monthly, ranks, resid, robust_scale, sd, table, theil_sen, written

QUERIES, SQL = {}, {}
METRICS = ["metric", "strength", "persistence"]


def _weights(annual: DataFrame, last: DataFrame) -> DataFrame:
    return annual.join(F.broadcast(last), "year").select("entity", F.col("weight_end").alias("weight"))


def six_years(spark: SparkSession, sf_dir: str, flow: str) -> DataFrame:
    """(entity, values, weight) over the last six complete years."""
    m = monthly(spark, sf_dir)
    annual, years = S.annual_rollup(m), S.complete_years(m)
    return S.annual_series(annual, years, flow).join(_weights(annual, years.agg(F.max("year").alias("year"))), "entity")


def rates(spark: SparkSession, sf_dir: str, flow: str) -> DataFrame:
    """(entity, rates, rest_rates, counts, weight) over the last six complete years."""
    m = monthly(spark, sf_dir)
    annual, years = S.annual_rollup(m), S.complete_years(m)
    rows = S.rest_of_parent(annual, flow).join(F.broadcast(years.select("year")), "year").where("rate is not null and rest_rate is not null")
    grouped = rows.groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("year", "rate", "rest_rate", F.col("flow").cast("double").alias("flow")))).alias("s"))
    needed = years.agg(F.count("*").alias("needed"))
    grouped = grouped.join(F.broadcast(needed)).where(F.size("s") == F.col("needed"))
    found = grouped.select("entity", F.col("s")["rate"].alias("rates"), F.col("s")["rest_rate"].alias("rest_rates"), F.col("s")["flow"].alias("counts"))
    return found.join(_weights(annual, years.agg(F.max("year").alias("year"))), "entity")


def rolled(spark: SparkSession, sf_dir: str, flow: str, min_count: float, p: D.Flow) -> DataFrame:
    """(entity, rolling, scope, eligible): dense monthly series as rolling sums, with the yearly median as size."""
    dense = S.dense_monthly(monthly(spark, sf_dir), flow, last_month(spark, sf_dir)).select("entity", S.rolling_sums(F.col("values")).alias("rolling"))
    six = six_years(spark, sf_dir, flow).withColumn("med", A.median(F.slice("values", 1, 5)))
    rows = dense.join(six.select("entity", "med", "weight"), "entity")
    rows = rows.withColumn("scope", D.scope(F.col("med"), F.col("weight"), p))
    return rows.withColumn("eligible", (F.col("med") >= min_count) & (F.col("scope") != "LOCALE"))


def shown(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select("entity", "pattern", "flag", "scope", *(F.round(c, 8).alias(c) for c in (*METRICS, *extra)))


SIX = ANNUAL + """,
six AS (SELECT entity, list(CAST({flow} AS DOUBLE) ORDER BY a.year) AS v, arg_max(weight_end, a.year) AS weight FROM annual a JOIN years USING (year)
  GROUP BY entity HAVING count(*) = (SELECT count(*) FROM years))"""


def _scope(count: str, p: D.Flow) -> str:
    return (
        f"CASE WHEN {count} >= {p.general_count} OR weight >= {p.general_weight} THEN 'GENERAL' WHEN {count} >= {p.territorial_count} OR weight >= {p.territorial_weight} "
        "THEN 'TERRITORIALE' ELSE 'LOCALE' END"
    )


def _inversion_sql(flow: str, least: float, p: D.Flow = D.NATURAL) -> str:
    by = lambda g, t, l: f"CASE scope WHEN 'GENERAL' THEN {g} WHEN 'TERRITORIALE' THEN {t} ELSE {l} END"
    return f"""WITH {SIX.format(flow=flow)},
a AS (SELECT entity, weight, v[1:5] AS h, v[6] AS cur, v[5] AS prev FROM six),
b AS (SELECT *, {median('h')} AS med, {theil_sen('h')} AS slope, {ranks('h')} AS k, {diffs('h')} AS d FROM a),
c AS (SELECT *, {resid('h', 'slope')} AS e0, list_sum(list_transform(range(1, 6), lambda i: (k[i] - 3) * (i - 3))) AS kt, list_sum(list_transform(k, lambda q: pow(q - 3, 2))) AS kk,
  len(list_filter(d, lambda q: sign(q) = sign({median('d')}))) / 4.0 AS dominance FROM b),
d AS (SELECT *, {median('e0')} AS base, CASE WHEN kk > 0 THEN kt / (sqrt(kk) * sqrt(10)) ELSE 0 END AS rho, {_scope('med', p)} AS scope FROM c),
e AS (SELECT *, list_transform(e0, lambda q: q - base) AS e, base + slope * 5 AS expected, cur - prev AS delta FROM d),
f AS (SELECT *, abs(cur - expected) / greatest({mad('e')}, {mad('d')}, 1.0) AS gap, CASE WHEN abs(prev) > 1e-9 THEN delta / abs(prev) ELSE 0 END AS pct FROM e)
SELECT entity, 'INVERSIONE' AS pattern, med >= {least} AND dominance >= 0.75 AND abs(rho) >= 0.8 AND abs(slope) > 1e-9 AND sign(delta) <> sign(slope) AND gap >= 2
    AND abs(pct) >= {by(0.03, 0.05, 0.10)} AND abs(delta) >= greatest(5, ({by(0.01, 0.03, 0.10)}) * med) AS flag, scope, round(gap, 8) AS metric,
  round(0.65 * least(100, 50 + 20 * greatest(gap - 2, 0)) + 0.35 * least(100, abs(pct) * 500), 8) AS strength,
  round(least(100, 50 + 30 * dominance + 20 * abs(rho)), 8) AS persistence, round(slope, 8) AS slope, round(rho, 8) AS rho, round(expected, 8) AS expected, round(pct, 8) AS pct FROM f"""


def _divergence_sql(flow: str, least: float, p: D.Flow = D.NATURAL) -> str:
    return f"""WITH {ANNUAL}, p AS (SELECT parent, year, sum({flow}) AS f, sum(weight_start) AS w FROM annual GROUP BY 1, 2),
r AS (SELECT a.entity, a.year, CAST(a.{flow} AS DOUBLE) AS flow, a.{flow} * 1000.0 / nullif(a.weight_start, 0) AS rate, (f - a.{flow}) * 1000.0 / nullif(w - a.weight_start, 0) AS rest, weight_end
  FROM annual a JOIN p USING (parent, year) JOIN years USING (year)),
g AS (SELECT entity, list(rate ORDER BY year) AS l, list(rest ORDER BY year) AS b, list(flow ORDER BY year) AS n, arg_max(weight_end, year) AS weight FROM r
  WHERE rate IS NOT NULL AND rest IS NOT NULL GROUP BY entity HAVING count(*) = (SELECT count(*) FROM years)),
c AS (SELECT *, list_transform(range(2, 7), lambda i: (l[i] - l[i - 1]) / nullif(l[i - 1], 0)) AS lc, list_transform(range(2, 7), lambda i: (b[i] - b[i - 1]) / nullif(b[i - 1], 0)) AS bc,
  len(list_filter(l[1:5], lambda q: q > 0)) = 5 AND len(list_filter(b[1:5], lambda q: q > 0)) = 5 AS valid, {median('n[1:5]')} AS med FROM g),
d AS (SELECT *, list_transform(range(1, 8), lambda i: lc[i] - bc[i]) AS gaps, {_scope('med', p)} AS scope FROM c),
e AS (SELECT *, gaps[5] AS gap, gaps[1:4] AS past, sign(lc[5]) <> sign(bc[5]) AS opposite FROM d),
f AS (SELECT *, CASE WHEN valid THEN (gap - {median('past')}) / greatest({mad('past')}, 0.03) END AS dz FROM e)
SELECT entity, 'DIVERGENZA' AS pattern, coalesce(valid AND med >= {least} AND abs(dz) >= 2.5 AND abs(gap) >= CASE WHEN opposite THEN 0.05 ELSE 0.1 END AND scope <> 'LOCALE', false) AS flag, scope,
  round(abs(dz), 8) AS metric, round(0.6 * least(100, 50 + 20 * greatest(abs(dz) - 2.5, 0)) + 0.4 * least(100, abs(gap) * 500), 8) AS strength, 60.0::DOUBLE AS persistence, round(gap, 8) AS gap FROM f"""


def _rolled_sql(flow: str, least: float, p: D.Flow) -> str:
    return f"""WITH {SIX.format(flow=flow)}{CALENDAR.format(flow=flow)},
x AS (SELECT entity, r, {_scope(median('v[1:5]'), p)} AS scope, {median('v[1:5]')} >= {least} AS big FROM rolled JOIN six USING (entity)),
y AS (SELECT *, big AND scope <> 'LOCALE' AS eligible FROM x)"""


def _record_sql(flow: str, least: float, p: D.Flow) -> str:
    return f"""{_rolled_sql(flow, least, p)},
a AS (SELECT *, r[-1] AS cur, list_max(r[:-2]) AS top, list_min(r[:-2]) AS bottom FROM y),
b AS (SELECT *, CASE WHEN cur > top THEN cur - top WHEN cur < bottom THEN bottom - cur ELSE 0 END AS margin, CASE WHEN cur > top THEN top WHEN cur < bottom THEN bottom ELSE 1 END AS ref,
  CASE WHEN cur > top THEN 'RECORD_MAX' WHEN cur < bottom THEN 'RECORD_MIN' END AS pattern FROM a),
c AS (SELECT *, margin / greatest(abs(ref), 1) * 100 AS metric0 FROM b)
SELECT entity, pattern, eligible AND pattern IS NOT NULL AND margin >= greatest({p.record_abs}, {p.record_share} * greatest(ref, 1)) AS flag, scope, round(metric0, 8) AS metric,
  round(least(100, 55 + metric0 * {p.record_slope}), 8) AS strength, 70.0::DOUBLE AS persistence FROM c"""


def _trend_sql(flow: str, least: float, p: D.Flow, faster: bool) -> str:
    step = "new_abs - old_abs" if faster else "old_abs - new_abs"
    if faster:
        test = f"ratio >= {p.accel_ratio} AND score >= {p.accel_score} AND new_abs >= {p.min_slope} * level"
        strength = f"0.65 * least(100, 50 + {p.score_gain} * greatest(score - {p.accel_score}, 0)) + 0.35 * least(100, 50 + {p.accel_gain} * greatest(ratio - {p.accel_ratio}, 0))"
    else:
        test = f"ratio <= {p.slow_ratio} AND score >= {p.slow_score} AND old_abs >= {p.min_slope} * level"
        strength = f"0.65 * least(100, 50 + {p.score_gain} * greatest(score - {p.slow_score}, 0)) + 0.35 * least(100, 50 + {p.slow_gain} * greatest({p.slow_ratio} - ratio, 0))"
    return f"""{_rolled_sql(flow, least, p)},
a AS (SELECT *, r[-13:-7] AS o, r[-7:] AS n, r[-18:] AS w, r[-4:] AS q4 FROM y),
b AS (SELECT *, {theil_sen('o')} AS old_slope, {theil_sen('n')} AS new_slope, {diffs('w')} AS dw, {diffs('q4')} AS dq, greatest(abs({median('n')}), 1) AS level FROM a),
c AS (SELECT *, greatest({mad('dw')}, 1.0) AS vol, len(list_filter(dq, lambda q: sign(q) = sign(new_slope))) AS agreeing, abs(old_slope) AS old_abs, abs(new_slope) AS new_abs FROM b),
d AS (SELECT *, new_abs / (old_abs + 1e-9) AS ratio, ({step}) / vol AS score FROM c)
SELECT entity, '{"ACCELERAZIONE" if faster else "RALLENTAMENTO"}' AS pattern, eligible AND sign(old_slope) = sign(new_slope) AND old_abs > 1e-9 AND new_abs > 1e-9 AND agreeing >= 2 AND {step} > 0 AND {test} AS flag,
  scope, round(score, 8) AS metric, round({strength}, 8) AS strength, 75.0::DOUBLE AS persistence, round(old_slope, 8) AS old_slope, round(new_slope, 8) AS new_slope, round(volatility, 8) AS volatility
FROM (SELECT *, vol AS volatility FROM d)"""


def _anomaly_sql(flow: str, least: float, p: D.Flow) -> str:
    return f"""{_rolled_sql(flow, least, p)},
a AS (SELECT *, r[-25:-2] AS h, r[-1] AS cur FROM y),
b AS (SELECT *, {theil_sen('h')} AS slope FROM a), c AS (SELECT *, {resid('h', 'slope')} AS e0 FROM b), d AS (SELECT *, {median('e0')} AS base FROM c),
e AS (SELECT *, list_transform(e0, lambda q: q - base) AS e, base + slope * len(h) AS expected FROM d),
f AS (SELECT *, {median('e')} AS centre, {sd('e')} AS dev FROM e),
g AS (SELECT *, {median("list_transform(e, lambda q: abs(q - centre))")} AS raw FROM f),
z AS (SELECT *, 0.6745 * ((cur - expected) - centre) / CASE WHEN raw > 1e-9 THEN raw WHEN dev > 1e-9 THEN dev END AS z, (cur - expected) / greatest(abs(expected), 1) * 100 AS gap_pct FROM g)
SELECT entity, 'ANOMALIA' AS pattern, coalesce(eligible AND abs(z) >= {p.anomaly_z} AND abs(gap_pct) >= {p.anomaly_gap}, false) AS flag, scope, round(abs(z), 8) AS metric,
  round(0.65 * least(100, 50 + {p.anomaly_z_gain} * greatest(abs(z) - {p.anomaly_z}, 0)) + 0.35 * least(100, abs(gap_pct) * {p.anomaly_gap_gain}), 8) AS strength, 50.0::DOUBLE AS persistence,
  round(gap_pct, 8) AS gap_pct, round(expected, 8) AS expected FROM z"""


def _add(name: str, f, sql: str) -> None:
    f.__name__ = name
    QUERIES[name], SQL[name] = f, sql


for _name, _flow, _least in (("births", "births", 50), ("deaths", "deaths", 80)):
    _add(
        f"inversion_{_name}",
        lambda spark, sf_dir, flow=_flow, least=_least: shown(D.inversion(six_years(spark, sf_dir, flow), least), "slope", "rho", "expected", "pct"),
        _inversion_sql(_flow, _least),
    )
for _name, _flow, _least in (("births", "births", 75), ("deaths", "deaths", 100)):
    _add(f"divergence_{_name}", lambda spark, sf_dir, flow=_flow, least=_least: shown(D.divergence(rates(spark, sf_dir, flow), least), "gap"), _divergence_sql(_flow, _least))
#: Flow, smallest yearly median, thresholds: natural flows and the four of migration.
ROLLING = [
    ("births", 100, D.NATURAL), ("deaths", 150, D.NATURAL), ("imm_internal", 150, D.MIGRATION), ("emi_internal", 150, D.MIGRATION),
    ("imm_foreign", 75, D.MIGRATION), ("emi_foreign", 50, D.MIGRATION),
]
for _flow, _least, _p in ROLLING:
    _add(f"record_{_flow}", lambda spark, sf_dir, f=_flow, n=_least, p=_p: shown(D.record(rolled(spark, sf_dir, f, n, p), p)), _record_sql(_flow, _least, _p))
    _add(
        f"acceleration_{_flow}",
        lambda spark, sf_dir, f=_flow, n=_least, p=_p: shown(D.trend_change(rolled(spark, sf_dir, f, n, p), True, p), "old_slope", "new_slope", "volatility"),
        _trend_sql(_flow, _least, _p, True),
    )
    _add(
        f"slowdown_{_flow}",
        lambda spark, sf_dir, f=_flow, n=_least, p=_p: shown(D.trend_change(rolled(spark, sf_dir, f, n, p), False, p), "old_slope", "new_slope", "volatility"),
        _trend_sql(_flow, _least, _p, False),
    )
    _add(
        f"anomaly_{_flow}",
        lambda spark, sf_dir, f=_flow, n=_least, p=_p: shown(D.anomaly(rolled(spark, sf_dir, f, n, p), p), "gap_pct", "expected"),
        _anomaly_sql(_flow, _least, _p),
    )


def parts_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly mean prices of part sizes, with those of the whole: short series of every family's kind."""
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    priced = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_size").alias("entity"), F.to_date(F.date_trunc("month", "l_shipdate")).alias("period"), "l_extendedprice"
    )
    monthly_mean = priced.groupBy("entity", "period").agg(F.round(F.avg("l_extendedprice"), 4).alias("x"))
    whole = priced.groupBy("period").agg(F.round(F.avg("l_extendedprice"), 4).alias("whole"))
    rows = monthly_mean.join(F.broadcast(whole), "period")
    s = F.array_sort(F.collect_list(F.struct("period", "x", "whole")))
    return rows.groupBy("entity").agg(s.alias("s")).select("entity", F.col("s")["x"].alias("values"), F.col("s")["whole"].alias("whole"))


def short_sql(f: D.Short, series: str | None = None) -> str:
    """The detector of a family in SQL over ``series``, common table expressions that end in s (entity, x, wh); monthly prices of part sizes unless given."""
    series = series or f"""q AS (SELECT p_size AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, l_extendedprice AS e FROM lineitem JOIN part ON p_partkey = l_partkey),
m AS (SELECT entity, period, round(avg(e), 4) AS x FROM q GROUP BY 1, 2), w AS (SELECT period, round(avg(e), 4) AS whole FROM q GROUP BY 1),
s AS (SELECT entity, list(x ORDER BY period)[-{f.points}:] AS x, list(whole ORDER BY period)[-{f.points}:] AS wh FROM m JOIN w USING (period) GROUP BY entity)"""
    prior = "x[:-2]" if f.prior is None else f"x[:-2][-{f.prior}:]"
    guard = f.guard_sd
    bench = f.name in ("BES", "NOI")
    if f.name == "BES":
        apart_by = f"coalesce(abs(latest - other) / greatest({robust_scale('d', '1e-12')}, {robust_scale('dw', '1e-12')}, 1e-6), 0)"
        apart = f"coalesce({apart_by} >= 2.0 OR (latest * other < 0 AND abs(latest - other) >= greatest({robust_scale('d', '1e-12')}, {robust_scale('dw', '1e-12')}, 1e-6)), false)"
    else:
        apart_by, apart = "0.0", "coalesce(latest * other < 0 AND abs(latest) >= 0.35 * scale, false)" if bench else "false"
    eps2 = "1e-12" if f.name == "GREEN" else str(f.eps)
    odd = "z_level >= 2.5" + (" OR z >= 2.75" if f.anomaly_by_step else "")
    apart_bonus = "CASE WHEN apart THEN least(10, apart_by * 2.5) ELSE 0 END" if f.name == "BES" else f"CASE WHEN apart THEN {f.divergence_bonus} ELSE 0 END"
    shown_patterns = "CASE WHEN len(p) = 0 THEN ['ULTIMO_DATO'] ELSE p END" if f.latest_if_none else "p"
    return f"""WITH {series},
a AS (SELECT *, {diffs('x')} AS d, {prior} AS prior, {diffs('wh')} AS dw, wh[-1] - wh[-2] AS other FROM s WHERE len(x) >= {f.least}),
b AS (SELECT *, d[-1] AS latest, d[-2] AS step, {robust_scale('d[:-2]', str(f.eps), guard)} AS raw, {robust_scale('prior', str(f.eps), guard)} AS level_scale FROM a),
c AS (SELECT *, CASE WHEN raw > {f.eps} THEN raw ELSE greatest(abs({median('x')}) * {f.zero_share}, 1e-6) END AS scale FROM b),
e AS (SELECT *, abs(latest) / scale AS z, CASE WHEN level_scale > {f.eps} AND len(prior) >= {f.level_prior} THEN abs(x[-1] - {median('prior')}) / level_scale ELSE 0 END AS z_level FROM c),
f AS (SELECT *, len(prior) >= {f.record_prior} AND x[-1] > list_max(prior) AND z >= {f.record_z} AS high, len(prior) >= {f.record_prior} AND x[-1] < list_min(prior) AND z >= {f.record_z} AS low,
  latest * step < 0 AND z >= {f.inversion_z} AND abs(step) >= {f.inversion_step} * scale AS turned, latest * step > 0 AND abs(step) > {eps2} AS onward, abs(latest) / nullif(abs(step), 0) AS ratio,
  {odd} AS odd, {apart} AS apart, {apart_by} AS apart_by FROM e),
g AS (SELECT *, onward AND ratio >= {f.accel_ratio} AND z >= {f.accel_z} AS faster FROM f),
h AS (SELECT *, onward AND NOT faster AND ratio <= {f.slow_ratio} AND abs(step) >= {f.slow_step} * scale AS slower FROM g),
i AS (SELECT *, list_filter([CASE WHEN high THEN 'RECORD_MAX' END, CASE WHEN low THEN 'RECORD_MIN' END, CASE WHEN turned THEN 'INVERSIONE' END, CASE WHEN faster THEN 'ACCELERAZIONE' END,
  CASE WHEN slower THEN 'RALLENTAMENTO' END, CASE WHEN odd THEN 'ANOMALIA' END, CASE WHEN apart THEN 'DIVERGENZA' END], lambda q: q IS NOT NULL) AS p FROM h)
SELECT entity, array_to_string({shown_patterns}, '|') AS patterns, round(z, 6) AS z, round(z_level, 6) AS z_level, round(least(99, {f.base} + least({f.z_gain[1]}, z * {f.z_gain[0]}) + least({f.level_gain[1]}, z_level * {f.level_gain[0]})
  + CASE WHEN high OR low THEN {f.record_bonus} ELSE 0 END + CASE WHEN turned THEN {f.inversion_bonus} ELSE 0 END + CASE WHEN odd THEN {f.anomaly_bonus} ELSE 0 END
  + CASE WHEN faster OR slower THEN {f.trend_bonus} ELSE 0 END + {apart_bonus}), 6) AS score FROM i"""


def _short(family: D.Short):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = parts_series(spark, sf_dir)
        benchmark = A.last_n(F.col("whole"), family.points) if family.name in ("BES", "NOI") else None
        found = D.short_series(rows, family, benchmark)
        return found.select("entity", F.array_join("patterns", "|").alias("patterns"), *(F.round(c, 6).alias(c) for c in ("z", "z_level", "score")))

    return run


for _f in D.FAMILIES.values():
    _add(f"short_series_{_f.name.lower()}", _short(_f), short_sql(_f))


def latest_value_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parts_series(spark, sf_dir).select("entity", A.last_n(F.col("values"), 12).alias("x"))
    return rows.select("entity", F.round(D.latest_only_score(F.col("x"), 64, 46, 4, 15), 6).alias("score"))


_add(
    "latest_value_score",
    latest_value_score,
    f"""WITH m AS (SELECT p_size AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, round(avg(l_extendedprice), 4) AS v FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
s AS (SELECT entity, list(v ORDER BY period)[-12:] AS x FROM m GROUP BY entity), a AS (SELECT *, {diffs('x')} AS d FROM s),
b AS (SELECT *, CASE WHEN len(x) >= 4 THEN {robust_scale('d[:-2]')} ELSE 0 END AS raw FROM a)
SELECT entity, round(least(64, 46 + least(15, abs(d[-1]) / CASE WHEN raw > 1e-9 THEN raw ELSE greatest(abs({median('x')}) * 0.005, 0.05) END * 4)), 6) AS score FROM b""",
)


#: Suppliers have a tenth of the counts that the published thresholds were set for.
EVENT_SETTINGS = X.smaller(X.SETTINGS, 0.1)


def events_of_flows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, int, str]:
    """(events of all six flows, their series, last complete year, last month); both tables are written."""
    facts = written(monthly(spark, sf_dir), "monthly")
    years = sorted(r["year"] for r in S.complete_years(facts, 1000).collect())
    end = last_month(spark, sf_dir)
    series = written(X.flow_series(facts, list(EVENT_SETTINGS), years, end), "series")
    found = written(X.detections(series, years, EVENT_SETTINGS), "detections")
    return X.merged_events(found, EVENT_SETTINGS), series, years[-1], end.strftime("%Y-%m")


def event_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of the flagged detections of six flows, with its score, its status and whether it reaches the floor."""
    merged = events_of_flows(spark, sf_dir)[0]
    return merged.select("entity", "indicator", F.array_join("patterns", " + ").alias("patterns"), "scope", "status", "published", *(F.round(F.round(c, 8), 5).alias(c) for c in ("strength", "rarity", "persistence", "score")))


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published events with nested series, benchmarks and sentences."""
    merged, series, year, period = events_of_flows(spark, sf_dir)
    return X.payload(merged.where("published"), series, year, period)


def published_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as rows of text, in the columns of published tables."""
    merged, series, year, period = events_of_flows(spark, sf_dir)
    rows = X.as_published(X.payload(merged.where("published"), series, year, period), "Monthly flows", "https://example.org/flows")
    return rows.select("id", "municipality_code", "patterns", "score", "annual", "rolling12", "benchmark_local", "benchmark_rest", "analysis", "source_family")


def _flagged(flow: str, order: int, sql: str) -> str:
    return f"SELECT entity, '{flow}' AS indicator, {order} AS ord, pattern, scope, metric, strength, persistence FROM ({sql}) WHERE flag"


def _all_flagged() -> str:
    parts = []
    for flow, s in EVENT_SETTINGS.items():
        if s.inversion is not None:
            parts.append(_flagged(flow, 0, _inversion_sql(flow, s.inversion, s.flow)))
        if s.divergence is not None:
            parts.append(_flagged(flow, 1, _divergence_sql(flow, s.divergence, s.flow)))
        rolling = (_record_sql(flow, s.rolling, s.flow), _trend_sql(flow, s.rolling, s.flow, True), _trend_sql(flow, s.rolling, s.flow, False), _anomaly_sql(flow, s.rolling, s.flow))
        parts += [_flagged(flow, order, sql) for order, sql in enumerate(rolling, 2)]
    return " UNION ALL ".join(parts)


_NATURAL = ", ".join(f"'{k}'" for k, s in EVENT_SETTINGS.items() if s.context)
EVENTS = f"""found AS MATERIALIZED ({_all_flagged()}),
ranked AS (SELECT *, (rank() OVER (PARTITION BY indicator, pattern ORDER BY metric) + (count(*) OVER (PARTITION BY indicator, pattern, metric) - 1) / 2.0) / count(*) OVER (PARTITION BY indicator, pattern) * 100 AS rarity FROM found),
joined AS (SELECT entity, indicator, list(pattern ORDER BY ord) AS p, max(strength) AS strength, max(rarity) AS rarity, max(persistence) AS persistence, arg_min(scope, ord) AS scope FROM ranked GROUP BY 1, 2),
scored AS (SELECT *, 0.95 * (0.4 * strength + 0.2 * rarity + 0.15 * persistence + 0.1 * CASE WHEN len(p) < 2 THEN 30 WHEN indicator IN ({_NATURAL}) THEN 85 ELSE 80 END + 5
  + 0.05 * CASE WHEN list_contains(p, 'DIVERGENZA') AND indicator IN ({_NATURAL}) THEN 90 ELSE 60 END) AS score FROM joined),
events_ AS (SELECT *, CAST(printf('%.1f', score) AS DOUBLE) AS tenth FROM scored),
merged AS (SELECT *, tenth >= 65 AS published, CASE WHEN tenth >= 80 AND scope = 'GENERAL' THEN 'VALIDATO — FEED GENERALE' WHEN tenth >= 72 AND scope IN ('GENERAL', 'TERRITORIALE') THEN 'VALIDATO — FEED TERRITORIALE'
  WHEN tenth >= 65 THEN 'PROMETTENTE — RIVEDERE' ELSE 'ARCHIVIO / SCARTO' END AS status FROM events_)"""
_add(
    "event_merge",
    event_merge,
    f"""WITH {EVENTS} SELECT entity, indicator, array_to_string(p, ' + ') AS patterns, scope, status, published, round(strength, 5) AS strength, round(rarity, 5) AS rarity, round(persistence, 5) AS persistence,
  round(score, 5) AS score FROM merged""",
)


def _flow_columns(flow: str) -> str:
    return f"SELECT entity, parent, name, period, weight, '{flow}' AS indicator, {flow} AS v FROM monthly"


_LONG = f"""{MONTHLY}, last_ AS (SELECT date_trunc('month', max(l_shipdate) + INTERVAL 1 DAY) - INTERVAL 1 MONTH AS z FROM lineitem),
long_ AS (SELECT * FROM ({' UNION ALL '.join(map(_flow_columns, EVENT_SETTINGS))}) WHERE period <= (SELECT z FROM last_)),
full_ AS (SELECT year(period) AS y FROM monthly GROUP BY 1 HAVING count(DISTINCT month(period)) = 12),
yearly_ AS (SELECT entity, parent, name, indicator, year(period) AS y, sum(v) AS f, arg_min(weight, period) AS w FROM long_ WHERE year(period) IN (SELECT y FROM full_) GROUP BY 1, 2, 3, 4, 5),
parent_ AS (SELECT parent, indicator, y, sum(f) AS pf, sum(w) AS pw FROM yearly_ GROUP BY 1, 2, 3),
rated_ AS (SELECT yearly_.*, CAST(printf('%.3f', f * 1000.0 / nullif(w, 0)) AS DOUBLE) AS own, CAST(printf('%.3f', (pf - f) * 1000.0 / nullif(pw - w, 0)) AS DOUBLE) AS rest FROM yearly_ JOIN parent_ USING (parent, indicator, y)),
annual_ AS (SELECT entity, indicator, arg_max(name, y) AS name, arg_max(parent, y) AS parent, list(CAST(f AS BIGINT) ORDER BY y) AS a, list(own ORDER BY y) AS bl, list(rest ORDER BY y) AS br FROM rated_ GROUP BY 1, 2),
months_ AS (SELECT entity, indicator, list(CAST(v AS BIGINT) ORDER BY period) AS m FROM long_ GROUP BY 1, 2),
series_ AS (SELECT *, list_transform(range(12, len(m) + 1), lambda i: CAST(list_sum(m[i - 11:i]) AS BIGINT)) AS r FROM annual_ JOIN months_ USING (entity, indicator))"""
_PAYLOADS = f"""WITH {EVENTS}, {_LONG},
both_ AS (SELECT *, a[-2] AS before, a[-1] AS now, CASE WHEN a[-2] <> 0 THEN (a[-1] - a[-2]) / a[-2] * 100 ELSE 0 END AS pct, CASE WHEN bl[-2] <> 0 THEN (bl[-1] / bl[-2] - 1) * 100 END AS cl, CASE WHEN br[-2] <> 0 THEN (br[-1] / br[-2] - 1) * 100 END AS cr,
  strftime((SELECT z FROM last_), '%Y-%m') AS period, (SELECT max(y) FROM full_) AS year FROM merged JOIN series_ USING (entity, indicator) WHERE published),
said_ AS (SELECT *, list_filter([
  CASE WHEN list_contains(p, 'INVERSIONE') THEN 'Inversione: nel ' || year || ' la serie cambia direzione da ' || before || ' a ' || now || ' (' || printf('%+.1f', pct) || '%).' END,
  CASE WHEN list_contains(p, 'DIVERGENZA') THEN 'Divergenza territoriale: il tasso locale varia del ' || printf('%+.1f', cl) || '% contro ' || printf('%+.1f', cr) || '% nel resto della provincia.' END,
  CASE WHEN list_contains(p, 'RECORD_MAX') THEN 'Record: il rolling 12 mesi di ' || period || ' (' || r[-1] || ') supera il massimo precedente (' || list_max(r[:-2]) || ').' END,
  CASE WHEN list_contains(p, 'RECORD_MIN') THEN 'Record: il rolling 12 mesi di ' || period || ' (' || r[-1] || ') scende sotto il minimo precedente (' || list_min(r[:-2]) || ').' END,
  CASE WHEN list_contains(p, 'ACCELERAZIONE') THEN 'Accelerazione: il fenomeno prosegue nella stessa direzione ma la pendenza recente aumenta rispetto alla finestra precedente.' END,
  CASE WHEN list_contains(p, 'RALLENTAMENTO') THEN 'Rallentamento: il fenomeno prosegue nella stessa direzione ma la pendenza recente si riduce rispetto alla finestra precedente.' END,
  CASE WHEN list_contains(p, 'ANOMALIA') THEN 'Anomalia: l''ultimo valore rolling 12 mesi si discosta in modo robusto dal trend recente oltre la soglia tecnica.' END,
  'Punteggio: ' || printf('%.1f', tenth) || '/100. Stato: ' || status || '.'], lambda q: q IS NOT NULL) AS analysis,
  CASE WHEN list_contains(p, 'INVERSIONE') THEN name || ': ' || lower(indicator) || CASE WHEN now > before THEN ' tornano a crescere' ELSE ' tornano a diminuire' END || ' nel ' || year || ' (' || before || ' → ' || now || ', ' || printf('%+.1f', pct) || '%).'
      || CASE WHEN list_contains(p, 'DIVERGENZA') AND cr IS NOT NULL THEN ' Il movimento diverge dal resto della provincia (' || printf('%+.1f', cr) || '%).' ELSE '' END
    WHEN list_contains(p, 'RECORD_MAX') THEN name || ': ' || lower(indicator) || ' raggiunge un nuovo massimo dei 60 mesi precedenti su base mobile 12 mesi (' || r[-1] || ').'
    WHEN list_contains(p, 'RECORD_MIN') THEN name || ': ' || lower(indicator) || ' raggiunge un nuovo minimo dei 60 mesi precedenti su base mobile 12 mesi (' || r[-1] || ').'
    ELSE name || ': rilevato ' || lower(array_to_string(p, ' + ')) || ' su ' || lower(indicator) || '.' END AS summary,
  substr(sha1(entity || '|' || indicator || '|' || period || '|' || array_to_string(p, ' + ')), 1, 16) AS id FROM both_)"""
_add(
    "event_payloads",
    event_payloads,
    f"""{_PAYLOADS} SELECT id, entity, name, parent, indicator, p AS patterns, scope, tenth AS score, status AS validation_status, period, summary, a AS annual, r AS rolling12, bl AS benchmark_local, br AS benchmark_rest, analysis FROM said_""",
)
_add(
    "published_event_rows",
    published_event_rows,
    f"""{_PAYLOADS} SELECT id, CAST(entity AS VARCHAR) AS municipality_code, array_to_string(p, '|') AS patterns, tenth AS score, array_to_string(a, '|') AS annual, array_to_string(r, '|') AS rolling12,
  array_to_string(list_transform(bl, lambda q: coalesce(CAST(q AS VARCHAR), '')), '|') AS benchmark_local, array_to_string(list_transform(br, lambda q: coalesce(CAST(q AS VARCHAR), '')), '|') AS benchmark_rest,
  array_to_string(analysis, '¦') AS analysis, 'Monthly flows' AS source_family FROM said_""",
)
