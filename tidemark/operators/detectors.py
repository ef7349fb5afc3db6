"""Detectors of records, inversions, accelerations, slowdowns, anomalies and divergences.

All are expressions over the arrays of one entity. The families differ in thresholds only, which is
what the parameter classes hold.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import arrays as A

EPS = A.EPS


@dataclass(frozen=True)
class Flow:
    """Thresholds of the monthly flow detectors. Those that published feeds were made with."""

    general_count: float = 150
    territorial_count: float = 75
    general_weight: float = 25_000
    territorial_weight: float = 10_000
    record_abs: float = 5
    record_share: float = 0.01
    record_slope: float = 4
    accel_ratio: float = 1.5
    accel_score: float = 1.5
    slow_ratio: float = 0.75
    slow_score: float = 1.5
    min_slope: float = 0.0015
    score_gain: float = 20
    accel_gain: float = 30
    slow_gain: float = 40
    anomaly_z: float = 4.0
    anomaly_gap: float = 3.0
    anomaly_z_gain: float = 12.5
    anomaly_gap_gain: float = 5
    convergence: float = 85

    def smaller(self, share: float) -> Flow:
        """The same tests for entities of that share of the usual size: what counts heads is scaled, ratios and scores are not."""
        sized = ("general_count", "territorial_count", "general_weight", "territorial_weight", "record_abs")
        return replace(self, **{name: getattr(self, name) * share for name in sized})


NATURAL = Flow()
MIGRATION = Flow(
    general_count=250, territorial_count=100, record_abs=10, record_share=0.02, record_slope=3, accel_ratio=1.75, accel_score=1.75, slow_ratio=0.65,
    slow_score=1.75, min_slope=0.002, score_gain=18, accel_gain=25, slow_gain=35, anomaly_z=4.5, anomaly_gap=5.0, anomaly_z_gain=12, anomaly_gap_gain=4, convergence=80,
)


def scope(count: Column, weight: Column, p: Flow = NATURAL) -> Column:
    return (
        F.when((count >= p.general_count) | (weight >= p.general_weight), "GENERAL")
        .when((count >= p.territorial_count) | (weight >= p.territorial_weight), "TERRITORIALE")
        .otherwise("LOCALE")
    )


def _ramp(start: float, gain: float, over: Column) -> Column:
    """From ``start`` upwards with what exceeds a threshold, 100 at most."""
    return F.least(F.lit(100.0), start + gain * F.greatest(over, F.lit(0.0)))


def inversion(rows: DataFrame, min_count: float, p: Flow = NATURAL) -> DataFrame:
    """Rows (entity, values of six years, weight): the last year breaks the trend of the five before."""
    h = F.col("history")
    out = rows.withColumns({"history": F.slice("values", 1, 5), "current": A.at(F.col("values"), 5), "previous": A.at(F.col("values"), 4)})
    out = out.withColumns({"med": A.median(h), "slope": A.theil_sen(h), "rho": A.spearman_time(h), "dominance": A.dominance(h)})
    out = out.withColumns({"resid": A.residuals(h, F.col("slope"))})
    out = out.withColumns({"base": A.median(F.col("resid"))})
    out = out.withColumns({"expected": F.col("base") + F.col("slope") * 5, "resid": F.transform("resid", lambda x: x - F.col("base"))})
    spread = F.greatest(A.mad(F.col("resid")), A.mad(A.diffs(h)), F.lit(1.0))
    delta = F.col("current") - F.col("previous")
    out = out.withColumns(
        {
            "gap": F.abs(F.col("current") - F.col("expected")) / spread,
            "delta": delta,
            "pct": F.when(F.abs("previous") > EPS, delta / F.abs("previous")).otherwise(0.0),
            "scope": scope(F.col("med"), F.col("weight"), p),
        }
    )
    by_scope = lambda g, t, l: F.when(F.col("scope") == "GENERAL", g).when(F.col("scope") == "TERRITORIALE", t).otherwise(l)
    keep = (
        (F.col("med") >= min_count)
        & (F.col("dominance") >= 0.75)
        & (F.abs("rho") >= 0.80)
        & (F.abs("slope") > EPS)
        & (F.signum("delta") != F.signum("slope"))
        & (F.col("gap") >= 2.0)
        & (F.abs("pct") >= by_scope(0.03, 0.05, 0.10))
        & (F.abs("delta") >= F.greatest(F.lit(5.0), by_scope(0.01, 0.03, 0.10) * F.col("med")))
    )
    return out.withColumns(
        {
            "flag": keep,
            "pattern": F.lit("INVERSIONE"),
            "metric": F.col("gap"),
            "strength": 0.65 * _ramp(50, 20, F.col("gap") - 2) + 0.35 * F.least(F.lit(100.0), F.abs("pct") * 500),
            "persistence": F.least(F.lit(100.0), 50 + 30 * F.col("dominance") + 20 * F.abs("rho")),
        }
    )


def divergence(rows: DataFrame, min_count: float, p: Flow = NATURAL) -> DataFrame:
    """Rows (entity, rates, rest_rates, counts of six years, weight): the last change departs from that of the rest of the parent."""
    out = rows.withColumns({"own": A.changes(F.col("rates")), "rest": A.changes(F.col("rest_rates"))})
    gaps = F.zip_with("own", "rest", lambda a, b: a - b)
    positive = lambda c: F.forall(F.slice(c, 1, 5), lambda x: x > 0)
    out = out.withColumns({"valid": positive("rates") & positive("rest_rates"), "gaps": gaps, "med": A.median(F.slice("counts", 1, 5))})
    past = F.slice("gaps", 1, 4)
    out = out.withColumns(
        {
            "gap": A.at(F.col("gaps"), 4),
            "dz": F.when(F.col("valid"), (A.at(F.col("gaps"), 4) - A.median(past)) / F.greatest(A.mad(past), F.lit(0.03))),
            "opposite": F.signum(A.at(F.col("own"), 4)) != F.signum(A.at(F.col("rest"), 4)),
            "scope": scope(F.col("med"), F.col("weight"), p),
        }
    )
    material = F.when(F.col("opposite"), F.abs("gap") >= 0.05).otherwise(F.abs("gap") >= 0.10)
    keep = F.col("valid") & (F.col("med") >= min_count) & (F.abs("dz") >= 2.5) & material & (F.col("scope") != "LOCALE")
    return out.withColumns(
        {
            "flag": F.coalesce(keep, F.lit(False)),
            "pattern": F.lit("DIVERGENZA"),
            "metric": F.abs("dz"),
            "strength": 0.60 * _ramp(50, 20, F.abs("dz") - 2.5) + 0.40 * F.least(F.lit(100.0), F.abs("gap") * 500),
            "persistence": F.lit(60.0),
        }
    )


def record(rows: DataFrame, p: Flow = NATURAL) -> DataFrame:
    """Rows (entity, rolling, eligible): the last rolling sum lies beyond all earlier ones."""
    prior = A.without_last(F.col("rolling"))
    out = rows.withColumns({"current": A.at(F.col("rolling"), -1), "top": F.array_max(prior), "bottom": F.array_min(prior)})
    high, low = F.col("current") > F.col("top"), F.col("current") < F.col("bottom")
    out = out.withColumns(
        {
            "margin": F.when(high, F.col("current") - F.col("top")).when(low, F.col("bottom") - F.col("current")).otherwise(0.0),
            "reference": F.when(high, F.col("top")).when(low, F.col("bottom")).otherwise(1.0),
            "pattern": F.when(high, "RECORD_MAX").when(low, "RECORD_MIN"),
        }
    )
    metric = F.col("margin") / F.greatest(F.abs("reference"), F.lit(1.0)) * 100
    enough = F.col("margin") >= F.greatest(F.lit(float(p.record_abs)), p.record_share * F.greatest("reference", F.lit(1.0)))
    return out.withColumns(
        {
            "flag": F.coalesce(F.col("eligible") & F.col("pattern").isNotNull() & enough, F.lit(False)),
            "metric": metric,
            "strength": F.least(F.lit(100.0), 55 + metric * p.record_slope),
            "persistence": F.lit(70.0),
        }
    )


def trend_change(rows: DataFrame, faster: bool, p: Flow = NATURAL) -> DataFrame:
    """Rows (entity, rolling, eligible): the slope of the last seven points against that of the seven ended six earlier."""
    r = F.col("rolling")
    out = rows.withColumns({"old_slope": A.theil_sen(F.slice(A.last_n(r, 13), 1, 7)), "new_slope": A.theil_sen(A.last_n(r, 7))})
    out = out.withColumns(
        {
            "volatility": F.greatest(A.mad(A.diffs(A.last_n(r, 18))), F.lit(1.0)),
            "agreeing": F.size(F.filter(A.diffs(A.last_n(r, 4)), lambda d: F.signum(d) == F.signum(F.col("new_slope")))),
            "level": F.greatest(F.abs(A.median(A.last_n(r, 7))), F.lit(1.0)),
            "old_abs": F.abs("old_slope"),
            "new_abs": F.abs("new_slope"),
        }
    )
    step = F.col("new_abs") - F.col("old_abs") if faster else F.col("old_abs") - F.col("new_abs")
    out = out.withColumns({"ratio": F.col("new_abs") / (F.col("old_abs") + EPS), "score": step / F.col("volatility")})
    same = (F.signum("old_slope") == F.signum("new_slope")) & (F.col("old_abs") > EPS) & (F.col("new_abs") > EPS)
    base = F.col("eligible") & same & (F.col("agreeing") >= 2) & (step > 0)
    if faster:
        keep = base & (F.col("ratio") >= p.accel_ratio) & (F.col("score") >= p.accel_score) & (F.col("new_abs") >= p.min_slope * F.col("level"))
        strength = 0.65 * _ramp(50, p.score_gain, F.col("score") - p.accel_score) + 0.35 * _ramp(50, p.accel_gain, F.col("ratio") - p.accel_ratio)
    else:
        keep = base & (F.col("ratio") <= p.slow_ratio) & (F.col("score") >= p.slow_score) & (F.col("old_abs") >= p.min_slope * F.col("level"))
        strength = 0.65 * _ramp(50, p.score_gain, F.col("score") - p.slow_score) + 0.35 * _ramp(50, p.slow_gain, p.slow_ratio - F.col("ratio"))
    return out.withColumns(
        {
            "flag": F.coalesce(keep, F.lit(False)),
            "pattern": F.lit("ACCELERAZIONE" if faster else "RALLENTAMENTO"),
            "metric": F.col("score"),
            "strength": strength,
            "persistence": F.lit(75.0),
        }
    )


def anomaly(rows: DataFrame, p: Flow = NATURAL) -> DataFrame:
    """Rows (entity, rolling, eligible): the last point against the line through the 24 before."""
    out = rows.withColumns({"history": A.without_last(A.last_n(F.col("rolling"), 25)), "current": A.at(F.col("rolling"), -1)})
    out = out.withColumns({"slope": A.theil_sen(F.col("history"))})
    out = out.withColumns({"resid": A.residuals(F.col("history"), F.col("slope"))})
    out = out.withColumns({"base": A.median(F.col("resid"))})
    out = out.withColumns({"expected": F.col("base") + F.col("slope") * F.size("history"), "resid": F.transform("resid", lambda x: x - F.col("base"))})
    out = out.withColumns({"centre": A.median(F.col("resid"))})
    out = out.withColumns({"raw_mad": A.median(A.deviations(F.col("resid"), F.col("centre"))), "deviation": A.sd(F.col("resid"))})
    spread = F.when(F.col("raw_mad") > EPS, F.col("raw_mad")).when(F.col("deviation") > EPS, F.col("deviation"))
    miss = F.col("current") - F.col("expected")
    out = out.withColumns({"z": 0.6745 * (miss - F.col("centre")) / spread, "gap_pct": miss / F.greatest(F.abs("expected"), F.lit(1.0)) * 100})
    return out.withColumns(
        {
            "flag": F.coalesce(F.col("eligible") & (F.abs("z") >= p.anomaly_z) & (F.abs("gap_pct") >= p.anomaly_gap), F.lit(False)),
            "pattern": F.lit("ANOMALIA"),
            "metric": F.abs("z"),
            "strength": 0.65 * _ramp(50, p.anomaly_z_gain, F.abs("z") - p.anomaly_z) + 0.35 * F.least(F.lit(100.0), F.abs("gap_pct") * p.anomaly_gap_gain),
            "persistence": F.lit(50.0),
        }
    )


@dataclass(frozen=True)
class Short:
    """Thresholds of the short-series detectors of one family. Those that published feeds were made with."""

    name: str
    points: int = 8
    least: int = 6
    prior: int | None = None
    zero_share: float = 0.005
    eps: float = 1e-9
    guard_sd: bool = True
    record_z: float = 0.65
    record_prior: int = 1
    level_prior: int = 1
    inversion_z: float = 0.8
    inversion_step: float = 0.0
    accel_ratio: float = 1.7
    accel_z: float = 0.9
    slow_ratio: float = 0.5
    slow_step: float = 0.7
    anomaly_by_step: bool = True
    base: float = 48
    z_gain: tuple[float, float] = (4, 22)
    level_gain: tuple[float, float] = (2, 12)
    record_bonus: float = 8
    inversion_bonus: float = 7
    anomaly_bonus: float = 7
    trend_bonus: float = 4
    divergence_bonus: float = 7
    latest_if_none: bool = False


SDMX = Short("SDMX", points=30, prior=12, zero_share=0.002, record_z=0.5, record_prior=5, level_prior=5, z_gain=(4, 20), level_gain=(2, 10), record_bonus=10, inversion_bonus=8, anomaly_bonus=8, trend_bonus=5, latest_if_none=True)
BES = Short("BES", points=6, zero_share=0.01, eps=1e-12, record_z=0.75, inversion_z=0.9, inversion_step=0.25, accel_z=1.0, slow_step=0.75, anomaly_by_step=False, base=42, z_gain=(4.5, 18), level_gain=(2, 10), record_bonus=10, inversion_bonus=9, anomaly_bonus=8, trend_bonus=5)
AMC = Short("AMC")
NOI = Short("NOI", inversion_z=0.75, accel_ratio=1.65, accel_z=0.8, slow_ratio=0.55, slow_step=0.65)
GREEN = Short("GREEN", points=12, guard_sd=False, record_z=0.55, inversion_z=0.75, accel_z=0.8, slow_step=0.6, base=50, z_gain=(4, 20), level_gain=(2, 10), record_bonus=10, trend_bonus=0)
FAMILIES = {f.name: f for f in (SDMX, BES, AMC, NOI, GREEN)}


def short_series(rows: DataFrame, family: Short, benchmark: Column | None = None, in_region: Column | None = None) -> DataFrame:
    """Rows with ``values`` (oldest first): patterns and score of the last change and the last level.

    ``benchmark`` is the series to diverge from: of the region (BES) or the nation (NOI). A series that
    is too short has no patterns and a null score.
    """
    f = family
    eps = 1e-12 if f.name == "GREEN" else f.eps
    out = rows.withColumn("x", A.last_n(F.col("values"), f.points)).where(F.size("x") >= f.least)
    x = F.col("x")
    prior = A.without_last(x)
    out = out.withColumns({"d": A.diffs(x), "prior": prior if f.prior is None else A.last_n(prior, f.prior)})
    d, prior = F.col("d"), F.col("prior")
    out = out.withColumns({"latest": A.at(d, -1), "step": A.at(d, -2), "raw": A.robust_scale(A.without_last(d), f.eps, f.guard_sd), "level_scale": A.robust_scale(prior, f.eps, f.guard_sd)})
    floor = F.greatest(F.abs(A.median(x)) * f.zero_share, F.lit(1e-6))
    out = out.withColumn("scale", F.when(F.col("raw") > f.eps, F.col("raw")).otherwise(floor))
    level = F.when((F.col("level_scale") > f.eps) & (F.size(prior) >= f.level_prior), F.abs(A.at(x, -1) - A.median(prior)) / F.col("level_scale")).otherwise(0.0)
    out = out.withColumns({"z": F.abs("latest") / F.col("scale"), "z_level": level})
    z, latest, step, scale = F.col("z"), F.col("latest"), F.col("step"), F.col("scale")
    can = F.size(prior) >= f.record_prior
    high = can & (A.at(x, -1) > F.array_max(prior)) & (z >= f.record_z)
    low = can & (A.at(x, -1) < F.array_min(prior)) & (z >= f.record_z)
    turned = (latest * step < 0) & (z >= f.inversion_z) & (F.abs(step) >= f.inversion_step * scale)
    onward = ~turned & (latest * step > 0) & (F.abs(step) > eps)
    ratio = F.try_divide(F.abs(latest), F.abs(step))
    faster = onward & (ratio >= f.accel_ratio) & (z >= f.accel_z)
    slower = onward & ~faster & (ratio <= f.slow_ratio) & (F.abs(step) >= f.slow_step * scale)
    odd = F.col("z_level") >= 2.5
    odd = odd | (z >= 2.75) if f.anomaly_by_step else odd
    apart, apart_by = F.lit(False), F.lit(0.0)
    if benchmark is not None:
        other = A.at(benchmark, -1) - A.at(benchmark, -2)
        if f.name == "BES":
            common = F.greatest(A.robust_scale(d, f.eps), A.robust_scale(A.diffs(benchmark), f.eps), F.lit(1e-6))
            apart_by = F.coalesce(F.abs(latest - other) / common, F.lit(0.0))
            apart = (apart_by >= 2.0) | ((latest * other < 0) & (F.abs(latest - other) >= common))
        else:
            apart = (latest * other < 0) & (F.abs(latest) >= 0.35 * scale)
        apart = F.coalesce(apart, F.lit(False))
    flags = {"RECORD_MAX": high, "RECORD_MIN": low, "INVERSIONE": turned, "ACCELERAZIONE": faster, "RALLENTAMENTO": slower, "ANOMALIA": odd, "DIVERGENZA": apart}
    patterns = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in flags.items())))
    out = out.withColumns({"patterns": patterns, "apart_by": apart_by})
    has = lambda *names: F.arrays_overlap("patterns", F.array(*map(F.lit, names)))
    bonus = lambda points, *names: F.when(has(*names), float(points)).otherwise(0.0)
    apart_bonus = F.when(has("DIVERGENZA"), F.least(F.lit(10.0), F.col("apart_by") * 2.5)).otherwise(0.0) if f.name == "BES" else bonus(f.divergence_bonus, "DIVERGENZA")
    score = (
        f.base
        + F.least(F.lit(float(f.z_gain[1])), z * f.z_gain[0])
        + F.least(F.lit(float(f.level_gain[1])), F.col("z_level") * f.level_gain[0])
        + bonus(f.record_bonus, "RECORD_MAX", "RECORD_MIN")
        + bonus(f.inversion_bonus, "INVERSIONE")
        + bonus(f.anomaly_bonus, "ANOMALIA")
        + bonus(f.trend_bonus, "ACCELERAZIONE", "RALLENTAMENTO")
        + apart_bonus
        + (F.when(in_region, 4.0).otherwise(0.0) if in_region is not None else 0.0)
    )
    out = out.withColumn("score", F.least(F.lit(99.0), score))
    if f.latest_if_none:
        out = out.withColumn("patterns", F.when(F.size("patterns") == 0, F.array(F.lit("ULTIMO_DATO"))).otherwise(F.col("patterns")))
    return out


def latest_only_score(values: Column, cap: float, base: float, gain: float, most: float, floor: float = 0.05) -> Column:
    """Editorial score of a new value that shows no pattern: by its last change against the earlier ones."""
    d = A.diffs(values)
    raw = F.when(F.size(values) >= 4, A.robust_scale(A.without_last(d))).otherwise(0.0)
    scale = F.when(raw > EPS, raw).otherwise(F.greatest(F.abs(A.median(values)) * 0.005, F.lit(floor)))
    return F.least(F.lit(cap), base + F.least(F.lit(most), F.abs(A.at(d, -1)) / scale * gain))
