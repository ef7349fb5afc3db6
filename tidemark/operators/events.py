"""Events: merging detections, scoring, identities, and the upkeep of published feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import exact_round
from tidemark.operators.detectors import NATURAL, Flow
from tidemark.operators.ranks import percent_ranked
from tidemark.operators.series import keep_last

# The columns of published tables, in their order.
EVENT_COLUMNS = [
    "id", "municipality_code", "municipality", "province", "region", "indicator", "patterns", "scope", "score", "validation_status", "period",
    "summary", "annual", "rolling12", "benchmark_local", "benchmark_rest", "analysis", "source_family", "source_url",
]
OBSERVATION_COLUMNS = ["area", "indicator", "territory", "period", "value", "unit", "source", "url", "note", "status"]
EVENT_SCHEMA = T.StructType([T.StructField(c, T.DoubleType() if c == "score" else T.StringType()) for c in EVENT_COLUMNS])
OBSERVATION_SCHEMA = T.StructType([T.StructField(c, T.DoubleType() if c == "value" else T.StringType()) for c in OBSERVATION_COLUMNS])
QUALITY, FRESHNESS = 0.95, 50.0


def with_rarity(detections: DataFrame) -> DataFrame:
    """Rarity of each kept detection: per cent rank of its metric, to eight decimals, among those of its indicator and pattern.

    The rows pass a generator before the filter, so that the optimizer does not copy the detectors'
    deep expressions into the condition, once for every use of every step.
    """
    made = detections.select(F.inline(F.array(F.struct(*detections.columns))))
    kept = made.where("flag").drop("flag").withColumn("metric", F.round("metric", 8))
    return percent_ranked(kept, "metric", ["indicator", "pattern"], "rarity")


def merge_detections(detections: DataFrame, p: Flow = NATURAL, divergence_counts: bool = True) -> DataFrame:
    """One event for each entity and indicator: distinct patterns in the order given by ``ord``, largest strengths, score and status."""
    merged = detections.groupBy("entity", "indicator").agg(
        F.array_distinct(F.array_sort(F.collect_list(F.struct("ord", "pattern")))["pattern"]).alias("patterns"),
        F.max("strength").alias("strength"),
        F.coalesce(F.max("rarity"), F.lit(50.0)).alias("rarity"),
        F.max("persistence").alias("persistence"),
        F.min_by("scope", "ord").alias("scope"),
    )
    convergence = F.when(F.size("patterns") >= 2, float(p.convergence)).otherwise(30.0)
    context = F.when(F.array_contains("patterns", "DIVERGENZA") & divergence_counts, 90.0).otherwise(60.0)
    score = QUALITY * (0.40 * F.col("strength") + 0.20 * F.col("rarity") + 0.15 * F.col("persistence") + 0.10 * convergence + 0.10 * FRESHNESS + 0.05 * context)
    return merged.withColumn("score", score).withColumn("status", status(exact_round(F.col("score"), 1), F.col("scope")))


def status(score: Column, scope: Column) -> Column:
    return (
        F.when((score >= 80) & (scope == "GENERAL"), "VALIDATO — FEED GENERALE")
        .when((score >= 72) & scope.isin("GENERAL", "TERRITORIALE"), "VALIDATO — FEED TERRITORIALE")
        .when(score >= 65, "PROMETTENTE — RIVEDERE")
        .otherwise("ARCHIVIO / SCARTO")
    )


def event_id(*parts: Column, sha1: bool = False) -> Column:
    """First sixteen hexadecimal digits of the digest of the parts, joined by bars."""
    seed = F.concat_ws("|", *parts)
    return F.substring(F.sha1(seed) if sha1 else F.sha2(seed, 256), 1, 16)


def period_key(period: Column) -> Column:
    """Sortable (year, month, is monthly) of "2024", "2024-Q2" and "2024-05"; a mixed maximum is then the latest."""
    year = F.regexp_extract(period, r"((?:19|20)\d{2})", 1).try_cast("int")
    quarter = F.regexp_extract(period, r"(?i)Q([1-4])", 1).try_cast("int")
    month = F.regexp_extract(period, r"-(\d{2})", 1).try_cast("int")
    return F.struct(
        F.coalesce(year, F.lit(0)).alias("year"),
        F.coalesce(F.when(quarter.isNotNull(), quarter * 3), month, F.lit(12)).alias("month"),
        F.when(quarter.isNull() & month.isNotNull(), 1).otherwise(0).alias("monthly"),
    )


def current_year_only(events: DataFrame, exempt_scope: str = "GREEN") -> DataFrame:
    """Events of the newest year there is, and those of the exempt scope; a headline that names another year goes."""
    year = F.regexp_extract("period", r"^(\d{4})", 1).try_cast("int")
    newest = F.broadcast(events.where(F.col("scope") != exempt_scope).agg(F.max(year).alias("_newest")))
    named = F.regexp_extract("summary", r"(?i)\bnel\s+(20\d{2})\b", 1).try_cast("int")
    fresh = (F.col("scope") == exempt_scope) | (year == F.col("_newest"))
    return events.crossJoin(newest).where(fresh & ((F.col("scope") == exempt_scope) | named.isNull() | (named == F.col("_newest")))).drop("_newest")


def merge_feeds(feeds: list[DataFrame]) -> DataFrame:
    """Feeds aligned by column, of the current year, the best row of each id."""
    union = feeds[0]
    for feed in feeds[1:]:
        union = union.unionByName(feed, allowMissingColumns=True)
    return keep_last(current_year_only(union), ["id"], [F.col("score"), F.col("period")])


def with_fallback(wanted: DataFrame, fresh: DataFrame, last_good: DataFrame, year: str) -> DataFrame:
    """For each wanted indicator the fresh row, else the last good one of that year; column ``recovered`` tells which."""
    old = last_good.where(F.col("period").startswith(year))
    keys = wanted.select("indicator").distinct()
    found = keys.join(fresh, "indicator", "left_semi")
    rows = fresh.join(keys, "indicator", "left_semi").withColumn("recovered", F.lit(False))
    missing = keys.join(found, "indicator", "left_anti")
    return rows.unionByName(old.join(missing, "indicator", "left_semi").withColumn("recovered", F.lit(True)))


def patch(feed: DataFrame, recovered: DataFrame) -> DataFrame:
    """Rows of the recovered indicators replace those of the feed."""
    return feed.join(recovered.select("indicator").distinct(), "indicator", "left_anti").unionByName(recovered.select(*feed.columns))


def totals_only(rows: DataFrame, keys: list[str], rank: Column) -> DataFrame:
    """Drops detailed modes where the same key has a total (rank 0 or 1)."""
    best = F.min("_rank").over(Window.partitionBy(*keys))
    ranked = rows.withColumn("_rank", rank).withColumn("_best", best)
    return ranked.where("_rank <= 1 or _best > 1").drop("_rank", "_best")


def upsert(catalog: DataFrame, rows: DataFrame, key: Column) -> DataFrame:
    """The catalogue with the rows' values, by a normalised key; what the rows leave null stays."""
    old = catalog.withColumn("_key", key)
    new = keep_last(rows.withColumn("_key", key), ["_key"], [F.struct(*rows.columns)])
    both = old.alias("o").join(new.alias("n"), "_key", "full_outer")
    return both.select(*(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in catalog.columns))


def containment_choice(specs: DataFrame, series: DataFrame) -> DataFrame:
    """For each spec the best series that has all its required dimensions: newest, most preferred values, longest.

    ``specs`` is (spec, required map, preferred map), ``series`` (key, dims map, last_period, n). They meet by one required
    entry of a spec, the first by name, and the others are tested then; only specs without any meet all series.
    """
    entries = F.array_sort(F.map_entries("required"))
    chosen = specs.withColumns({"_k": F.get(entries, F.lit(0))["key"], "_v": F.get(entries, F.lit(0))["value"]})
    by_entry = series.select("*", F.explode("dims").alias("_k", "_v"))
    fits = F.forall(F.map_entries("required"), lambda e: F.col("dims")[e["key"]] == e["value"])
    liked = F.size(F.filter(F.map_entries("preferred"), lambda e: F.col("dims")[e["key"]] == e["value"]))
    pairs = by_entry.join(chosen.where("_k is not null"), ["_k", "_v"]).drop("_k", "_v").where(fits)
    free = chosen.where("_k is null").drop("_k", "_v")
    if not free.isEmpty():
        pairs = pairs.unionByName(series.crossJoin(free))
    order = F.struct(F.col("last_period"), liked, F.col("n"), F.col("key"))
    return pairs.groupBy("spec").agg(F.max_by("key", order).alias("key"), F.count("*").alias("candidates"))


def guarded(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Fails before anything is published where a check, an aggregate condition, does not hold."""
    found = rows.agg(*(c.alias(n) for n, c in checks.items())).first().asDict()
    broken = [n for n, ok in found.items() if not ok]
    if broken:
        raise ValueError(f"not published, checks failed: {', '.join(broken)}")
    return rows


def provenance_violations(observations: DataFrame) -> DataFrame:
    """How many rows lack a source, a url, a status or a numeric value."""
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    return observations.agg(
        F.count_if(blank("source")).alias("no_source"),
        F.count_if(blank("url")).alias("no_url"),
        F.count_if(blank("status")).alias("no_status"),
        F.count_if(F.col("value").isNull()).alias("no_value"),
        F.count("*").alias("n_rows"),
    )


def content_hash(rows: DataFrame) -> Column:
    """Digest of a table's rows whatever their order."""
    return F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))


def manifest(feed: DataFrame) -> DataFrame:
    """Rows, latest period by time rather than by spelling, families and content digest."""
    return feed.agg(
        F.count("*").alias("n_rows"),
        F.max_by("period", period_key(F.col("period"))).alias("latest_period"),
        F.count_distinct("source_family").alias("families"),
        content_hash(feed).alias("content_hash"),
    )
