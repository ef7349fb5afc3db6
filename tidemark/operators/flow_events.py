"""From monthly facts to published events: one table of series for all detectors, then merging, then text.

Everything about an entity and indicator stands in one row of that table: sums of years, rates beside those of the rest
of the parent, and the dense months. Detectors read it, and the payload of an event is joined from it by
the same two keys, by which it is already grouped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import arrays as A
from tidemark.functions.numbers import exact_round
from tidemark.operators import detectors as D
from tidemark.operators import events as E
from tidemark.operators import series as S

METRICS = ["metric", "strength", "persistence"]
#: The score from which events are published.
FLOOR = 65.0


@dataclass(frozen=True)
class Setting:
    """What an indicator is tested with: thresholds, and the least yearly counts; None leaves a test out."""

    flow: D.Flow = D.NATURAL
    rolling: float = 100
    inversion: float | None = None
    divergence: float | None = None
    #: Whether divergence lends an event context.
    context: bool = True


# The counts that published feeds were made with.
SETTINGS = {
    "births": Setting(D.NATURAL, 100, 50, 75),
    "deaths": Setting(D.NATURAL, 150, 80, 100),
    "imm_internal": Setting(D.MIGRATION, 150, context=False),
    "emi_internal": Setting(D.MIGRATION, 150, context=False),
    "imm_foreign": Setting(D.MIGRATION, 75, context=False),
    "emi_foreign": Setting(D.MIGRATION, 50, context=False),
}


def smaller(settings: dict[str, Setting], share: float) -> dict[str, Setting]:
    """Settings for entities of that share of the usual size."""
    scaled = lambda n: None if n is None else n * share
    return {k: Setting(s.flow.smaller(share), s.rolling * share, scaled(s.inversion), scaled(s.divergence), s.context) for k, s in settings.items()}


def flow_series(monthly: DataFrame, flows: list[str], years: list[int], end) -> DataFrame:
    """(indicator, entity, parent, name, weight, years, annual, rates, rest_rates, months, rolling) of each entity and flow.

    Arrays of ``years`` hold the complete ``years`` that the entity has, ``months`` all its months up to ``end``, in order, and ``rolling``
    their sums over twelve. All flows are grouped at once, and only sums of years and whole series become rows of their own;
    ``dense`` tells whether none is missing from the first month of all facts. A rate is null where there is no weight.
    """
    rows = monthly.where(F.col("period") <= F.lit(end).cast("date"))
    months = rows.agg((F.months_between(F.max("period"), F.min("period")) + 1).cast("int")).first()[0]
    dated = F.when(F.col("weight").isNotNull(), F.col("period"))
    wide = rows.where(F.year("period").isin(years)).groupBy("entity", "parent", "name", F.year("period").alias("year")).agg(
        *(F.sum(c).alias(c) for c in flows), F.min_by("weight", dated).alias("weight_start"), F.max_by("weight", dated).alias("weight_end")
    )
    yearly = wide.unpivot(["entity", "parent", "name", "year", "weight_start", "weight_end"], flows, "indicator", "flow")
    parent = yearly.groupBy("indicator", "parent", "year").agg(F.sum("flow").alias("all_flow"), F.sum("weight_start").alias("all_weight"))
    rate = F.try_divide(F.col("flow") * 1000.0, "weight_start").alias("rate")
    rest = F.try_divide((F.col("all_flow") - F.col("flow")) * 1000.0, F.col("all_weight") - F.col("weight_start")).alias("rest_rate")
    yearly = yearly.join(parent, ["indicator", "parent", "year"])
    by_year = F.sort_array(F.collect_list(F.struct("year", F.col("flow").cast("double").alias("flow"), rate, rest)))
    newest = F.max(F.struct("year", "parent", "name", F.col("weight_end").alias("weight")))
    annual = yearly.groupBy("indicator", "entity").agg(by_year.alias("y"), newest.alias("n"))
    grouped = rows.groupBy("entity").agg(F.collect_list(F.struct("period", *(F.col(c).cast("double").alias(c) for c in flows))).alias("all"))

    def by_month(flow: str) -> Column:
        known = F.filter("all", lambda m: m[flow].isNotNull())
        return F.sort_array(F.transform(known, lambda m: F.struct(m["period"].alias("period"), m[flow].alias("value"))))

    each = F.array(*(F.struct(F.lit(c).alias("indicator"), by_month(c).alias("m")) for c in flows))
    monthly_rows = grouped.select("entity", F.inline_outer(each)).where(F.size("m") > 0)
    return annual.join(monthly_rows, ["indicator", "entity"]).select(
        "indicator",
        "entity",
        "n.parent",
        "n.name",
        "n.weight",
        F.col("y.year").alias("years"),
        F.col("y.flow").alias("annual"),
        F.col("y.rate").alias("rates"),
        F.col("y.rest_rate").alias("rest_rates"),
        F.col("m.value").alias("months"),
        S.rolling_sums(F.col("m.value")).alias("rolling"),
        (F.size("m") == months).alias("dense"),
    )


def _count(settings: dict[str, Setting], name: str) -> Column:
    pairs = [x for k, s in settings.items() for x in (F.lit(k), F.lit(float(getattr(s, name) or 0)))]
    return F.create_map(*pairs)[F.col("indicator")]


def detections(series: DataFrame, years: list[int], settings: dict[str, Setting]) -> DataFrame:
    """All tests of every entity and indicator, in the order of ``ord``, whether they flag or not.

    Tests of years need all the last six, tests of rolling sums every month; the others have no row.
    """
    last = years[-6:]
    six = lambda c: F.transform(F.filter(F.arrays_zip("years", c), lambda x: x["years"].isin(last)), lambda x: x[c])
    whole = series.withColumns({c: six(c) for c in ("annual", "rates", "rest_rates")}).where(F.size("annual") == 6)
    out = None
    for flow in dict.fromkeys(s.flow for s in settings.values()):
        own = {k: s for k, s in settings.items() if s.flow == flow}
        rows = whole.where(F.col("indicator").isin(list(own)))
        med = A.median(F.slice("annual", 1, 5))
        rolled = rows.where("dense").withColumn("scope", D.scope(med, F.col("weight"), flow))
        rolled = rolled.withColumn("eligible", (med >= _count(own, "rolling")) & (F.col("scope") != "LOCALE"))
        parts = {2: D.record(rolled, flow), 3: D.trend_change(rolled, True, flow), 4: D.trend_change(rolled, False, flow), 5: D.anomaly(rolled, flow)}
        if turning := [k for k, s in own.items() if s.inversion is not None]:
            values = rows.where(F.col("indicator").isin(turning)).withColumn("values", F.col("annual"))
            parts[0] = D.inversion(values, _count(own, "inversion"), flow)
        if parting := [k for k, s in own.items() if s.divergence is not None]:
            known = F.forall("rates", lambda r: r.isNotNull()) & F.forall("rest_rates", lambda r: r.isNotNull())
            values = rows.where(F.col("indicator").isin(parting) & known).withColumn("counts", F.col("annual"))
            parts[1] = D.divergence(values, _count(own, "divergence"), flow)
        for order, part in sorted(parts.items()):
            part = part.select("entity", "indicator", F.lit(order).alias("ord"), "pattern", "scope", "flag", *METRICS)
            out = part if out is None else out.unionByName(part)
    return out


def merged_events(found: DataFrame, settings: dict[str, Setting], floor: float = FLOOR) -> DataFrame:
    """Events of all flagged detections with score and status; ``published`` where the rounded score reaches the floor."""
    ranked, out = E.with_rarity(found), None
    for kind in dict.fromkeys((s.flow, s.context) for s in settings.values()):
        own = [k for k, s in settings.items() if (s.flow, s.context) == kind]
        part = E.merge_detections(ranked.where(F.col("indicator").isin(own)), *kind)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("published", exact_round(F.col("score"), 1) >= floor)


def _signed(value: Column) -> Column:
    """A percentage with its sign and one decimal."""
    return F.concat(F.format_string("%+.1f", exact_round(value, 1)), F.lit("%"))


def _says(*parts) -> Column:
    return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


def _whole(value: Column) -> Column:
    return value.cast("long").cast("string")


# The sentences of published events.
def payload(events: DataFrame, series: DataFrame, year: int, period: str) -> DataFrame:
    """Events with their series, benchmarks and sentences: nested arrays annual, rolling12, benchmark_local, benchmark_rest, analysis.

    ``events`` are those of merged_events, ``year`` the last complete year and ``period`` the last month of the facts.
    Sentences whose numbers are missing are left out.
    """
    rows = events.join(series, ["indicator", "entity"])
    rounded = lambda c: F.transform(c, lambda r: exact_round(r, 3))
    rows = rows.withColumns(
        {
            "annual": F.transform("annual", lambda v: v.cast("long")),
            "rolling12": F.transform("rolling", lambda v: F.rint(v).cast("long")),
            "benchmark_local": rounded("rates"),
            "benchmark_rest": rounded("rest_rates"),
            "label": F.lower("indicator"),
        }
    )
    at = lambda c, i: A.at(F.col(c), i)
    has = lambda p: F.array_contains("patterns", p)
    before, now = at("annual", -2), at("annual", -1)
    pct = F.when(before != 0, (now - before) / before * 100).otherwise(0.0)
    change = lambda c: F.when(at(c, -2) != 0, (at(c, -1) / at(c, -2) - 1) * 100)
    rolling, earlier = at("rolling12", -1), A.without_last(F.col("rolling12"))
    moved = _says(_whole(before), " a ", _whole(now))
    analysis = F.array(
        F.when(has("INVERSIONE"), _says(f"Inversione: nel {year} la serie cambia direzione da ", moved, " (", _signed(pct), ").")),
        F.when(
            has("DIVERGENZA"),
            _says("Divergenza territoriale: il tasso locale varia del ", _signed(change("benchmark_local")), " contro ", _signed(change("benchmark_rest")), " nel resto della provincia."),
        ),
        F.when(has("RECORD_MAX"), _says(f"Record: il rolling 12 mesi di {period} (", _whole(rolling), ") supera il massimo precedente (", _whole(F.array_max(earlier)), ").")),
        F.when(has("RECORD_MIN"), _says(f"Record: il rolling 12 mesi di {period} (", _whole(rolling), ") scende sotto il minimo precedente (", _whole(F.array_min(earlier)), ").")),
        F.when(has("ACCELERAZIONE"), F.lit("Accelerazione: il fenomeno prosegue nella stessa direzione ma la pendenza recente aumenta rispetto alla finestra precedente.")),
        F.when(has("RALLENTAMENTO"), F.lit("Rallentamento: il fenomeno prosegue nella stessa direzione ma la pendenza recente si riduce rispetto alla finestra precedente.")),
        F.when(has("ANOMALIA"), F.lit("Anomalia: l'ultimo valore rolling 12 mesi si discosta in modo robusto dal trend recente oltre la soglia tecnica.")),
        _says("Punteggio: ", F.format_string("%.1f", exact_round(F.col("score"), 1)), "/100. Stato: ", F.col("status"), "."),
    )
    subject = _says(F.col("name"), ": ", F.col("label"))
    verb = F.when(now > before, "tornano a crescere").otherwise("tornano a diminuire")
    apart = F.when(has("DIVERGENZA"), _says(" Il movimento diverge dal resto della provincia (", _signed(change("benchmark_rest")), ")."))
    turned = _says(subject, " ", verb, f" nel {year} (", _whole(before), " → ", _whole(now), ", ", _signed(pct), ").", F.coalesce(apart, F.lit("")))
    extreme = lambda which: _says(subject, f" raggiunge un nuovo {which} dei 60 mesi precedenti su base mobile 12 mesi (", _whole(rolling), ").")
    plain = _says(F.col("name"), ": rilevato ", F.lower(F.array_join("patterns", " + ")), " su ", F.col("label"), ".")
    summary = F.coalesce(F.when(has("INVERSIONE"), turned), F.when(has("RECORD_MAX"), extreme("massimo")), F.when(has("RECORD_MIN"), extreme("minimo")), plain)
    return rows.select(
        E.event_id(F.col("entity").cast("string"), F.col("indicator"), F.lit(period), F.array_join("patterns", " + "), sha1=True).alias("id"),
        "entity",
        "name",
        "parent",
        "indicator",
        "patterns",
        "scope",
        exact_round(F.col("score"), 1).alias("score"),
        F.col("status").alias("validation_status"),
        F.lit(period).alias("period"),
        summary.alias("summary"),
        "annual",
        "rolling12",
        "benchmark_local",
        "benchmark_rest",
        F.array_compact(analysis).alias("analysis"),
    )


def as_published(events: DataFrame, family: str, url: str) -> DataFrame:
    """Payloads as rows of text in the columns of published tables: numbers joined by ``|``, sentences by ``¦``."""
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), "|", "")
    text = {c: joined(c) for c in ("patterns", "annual", "rolling12", "benchmark_local", "benchmark_rest")}
    known = {
        **text,
        "municipality_code": F.col("entity").cast("string"),
        "municipality": F.col("name"),
        "province": F.col("parent").cast("string"),
        "region": F.lit(""),
        "analysis": F.array_join("analysis", "¦"),
        "source_family": F.lit(family),
        "source_url": F.lit(url),
    }
    return events.select(*(known.get(c, F.col(c)).alias(c) for c in E.EVENT_COLUMNS))
