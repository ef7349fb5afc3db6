"""Stories of the news radar: quarantine, curated rules, replacement of older stories, and what may be published.

A story is a row (id, url, headline, published_at, …); its nested parts are plain columns here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions.classes import has_any
from tidemark.operators.ranks import placed

# Statuses and roles of published feeds, and the headlines that templates made in earlier versions.
VERIFIED = ["verified", "verified_primary_match"]
PRIMARY, MEDIA, STRONG = "primary_statistical_source", "journalistic_radar", "strong_primary_match"
TEMPLATED = r"^(?:Dati|Lavoro|Economia|Salute|Istruzione|Ambiente|Energia|Mobilit.|Casa|Demografia), nuovo dato per "
AGGREGATOR = "news.google.com"


def strong_match(score: Column, keywords: Column) -> Column:
    """Numbers alone are no match: a high score and two distinct keywords are."""
    return (F.coalesce(score, F.lit(0)) >= 80) & (F.size(F.array_distinct(F.coalesce(keywords, F.array().cast("array<string>")))) >= 2)


def quarantined(items: DataFrame, now: Column, days: int = 3) -> DataFrame:
    """Items (url, title, summary, published, numbers, score) that report figures, kept apart until a primary source is found.

    Fresh, with a number that is no year, a statistical term, a title of 24 characters and a web address. Adds
    claims, news_score, domain, role and the two statuses.
    """
    real = F.filter("numbers", lambda n: ~T.number_core(n).rlike(r"^20\d{2}$"))
    words = F.lower(F.concat_ws(" ", "title", "summary"))
    good = T.is_fresh(F.col("published"), now, days) & (F.size(real) > 0) & (F.col("score") >= 45) & (F.length("title") >= 24)
    web = F.startswith("url", F.lit("https://")) | F.startswith("url", F.lit("http://"))
    host = T.host(F.col("url"))
    return items.where(good & has_any(words, T.STAT_TERMS) & web).select(
        *items.columns,
        F.slice(real, 1, 6).alias("claims"),
        F.least(F.lit(75), F.greatest(F.lit(45), F.col("score"))).alias("news_score"),
        F.when(F.endswith(host, F.lit(AGGREGATOR)), F.coalesce(T.publisher(F.col("title")), host)).otherwise(host).alias("domain"),
        F.lit("journalistic_source").alias("role"),
        F.lit("needs_primary_source").alias("editorial_status"),
        F.lit("quarantined").alias("publication_status"),
    )


def curated(title: Column, rules: list[dict]) -> Column:
    """The first rule all of whose ``match`` tokens stand in the title, as a struct of its other values; null where none does."""
    low = F.lower(title)
    hit = lambda tokens: F.forall(F.array(*(F.lit(t.lower()) for t in tokens)), lambda t: F.contains(low, t))
    return F.coalesce(*(F.when(hit(r["match"]), F.struct(*(F.lit(v).alias(k) for k, v in r.items() if k != "match"))) for r in rules))


def with_curated(stories: DataFrame, rules: list[dict]) -> DataFrame:
    """Stories with the values of their rule in place of their own, verified and published."""
    rows = stories.withColumn("_rule", curated(F.col("headline"), rules))
    found = F.col("_rule").isNotNull()
    given = {k for r in rules for k in r if k != "match"}
    statuses = {"editorial_status": "verified", "publication_status": "published", "role": PRIMARY}
    own = lambda c: F.col(c) if c in stories.columns else F.lit(None)
    changed = {k: F.when(found, F.col("_rule")[k]).otherwise(own(k)) for k in given}
    changed |= {k: F.when(found, v).otherwise(own(k)) for k, v in statuses.items()}
    return rows.withColumns(changed).drop("_rule")


def replace_legacy(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old stories with templated headlines give way to new ones of the same address, which take the earliest of their dates.

    Both have (id, url, headline, published_at), ids being unique in each. A new story whose id is known keeps its known
    date. Only one row an address is joined, so that an address of very many stories stays cheap.
    """
    columns = ["id", "url", "headline", "published_at"]
    old = old.select(*columns, T.canonical_url(F.col("url")).alias("_link"), F.col("headline").rlike(TEMPLATED).alias("_legacy"))
    new = new.select(*columns, T.canonical_url(F.col("url")).alias("_link"))
    earliest = old.where("_legacy").groupBy("_link").agg(F.min("published_at").alias("_earliest"))
    known = old.select("id", F.col("published_at").alias("_known"), F.lit(True).alias("_found"))
    dated = new.join(known, "id", "left").join(earliest, "_link", "left")
    date = F.when(F.col("_found"), F.coalesce("_known", "published_at")).otherwise(F.coalesce("_earliest", "published_at"))
    ends = new.groupBy("_link").agg(F.min("id").alias("_low"), F.max("id").alias("_high"))
    kept = old.join(ends, "_link", "left").where("not _legacy or _low is null or (_low = id and _high = id)")
    kept = kept.join(new.select("id"), "id", "left_anti")
    return kept.select(*columns).unionByName(dated.select("id", "url", "headline", date.alias("published_at")))


def publishable(stories: DataFrame) -> DataFrame:
    """What may be seen: published, verified, from a primary source; found by the media only with a strong match."""
    return stories.where(
        (F.col("publication_status") == "published")
        & F.col("editorial_status").isin(VERIFIED)
        & (F.col("role") == PRIMARY)
        & ((F.coalesce("discovery_role", F.lit("")) != MEDIA) | F.coalesce(F.col("evidence_gate") == STRONG, F.lit(False)))
    )


def publication_order() -> list[Column]:
    """Newest day first, in a day what the media found first, then the newest."""
    return [F.to_date("published_at").desc(), (F.coalesce("discovery_role", F.lit("")) == MEDIA).desc(), F.col("published_at").desc(), F.col("id")]


def day_positions(stories: DataFrame) -> DataFrame:
    """Adds the place of each story in its day, in publication order."""
    dated = stories.withColumn("_day", F.to_date("published_at"))
    return placed(dated, ["_day"], publication_order()[1:], "position").drop("_day")


def visible(index: DataFrame, stories: DataFrame) -> DataFrame:
    """Stories that an index (section, ids) names, with their section; unknown ids are left out."""
    named = index.select("section", F.explode("ids").alias("id"))
    return named.join(stories, "id")


def overlaps(buckets: DataFrame) -> DataFrame:
    """Ids that stand in several sections (section, id); none where buckets are disjoint."""
    return buckets.groupBy("id").agg(F.min("section").alias("_low"), F.max("section").alias("_high")).where("_low <> _high").select("id")


def national_values(series: DataFrame, national: DataFrame) -> DataFrame:
    """Adds ``national``: the country's values of a series' last two years; null unless both years are there.

    Series are (domain, indicator, territory, periods, values); ``national`` has one row an indicator.
    """
    by_year = national.select("domain", "indicator", F.map_from_arrays("periods", "values").alias("_by_year"))
    at = lambda i: F.try_element_at(F.col("_by_year"), F.try_element_at("periods", F.lit(i)))
    pair = F.when(at(-1).isNotNull() & at(-2).isNotNull(), F.array(at(-2), at(-1)))
    return series.join(by_year, ["domain", "indicator"], "left").withColumn("national", pair).drop("_by_year")
