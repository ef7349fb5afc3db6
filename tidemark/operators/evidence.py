"""Evidence: same-row comparisons in tables, comparisons of adjacent years in dimensional series, and their gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.arrays import bound
from tidemark.functions.numbers import exact_round, strict_percent, year_token

# Phrases that tell of a break in a series, in lower case.
BREAKS = ["break", "rottura", "discontinu", "not comparable", "non confrontabil", "methodological break"]
#: Evidence rows of a table, and comparisons of a source, unless a caller sets others.
MOST_PER_TABLE, MOST_PER_SOURCE = 20, 30
DIMENSIONS = ["dataset", "indicator", "unit", "territory", "method_id"]


def table_evidence(tables: DataFrame, most: int | None = MOST_PER_TABLE) -> DataFrame:
    """Rows (source_url, location, unit_hint, cells array<array<string>>): percentages of two years in one row.

    A header is one of the first eight rows with at least two years, the last two at most five years
    apart; the first header that yields evidence counts. A row needs a label of 4 to 125 characters, a
    percentage unit in heading, hint or label, and two strict percentages. The first ``most`` of a table, None for all.
    """
    table = tables.select("source_url", "location", "unit_hint", F.posexplode("cells").alias("r", "row"), F.size("cells").alias("n_rows"))
    headers = table.where((F.col("r") < 8) & (F.col("r") < F.col("n_rows") - 1))
    years = F.filter(F.transform("row", lambda c, i: F.struct(year_token(c).alias("year"), i.alias("i"))), lambda y: y["year"].isNotNull())
    headers = headers.withColumn("years", F.array_sort(years)).where(F.size("years") >= 2)
    left, right = F.try_element_at("years", F.lit(-2)), F.try_element_at("years", F.lit(-1))
    heading = F.lower(F.concat_ws(" ", F.array_join("row", " "), F.coalesce("unit_hint", F.lit(""))))
    headers = headers.select(
        "source_url", "location", F.col("r").alias("h"), left.alias("left"), right.alias("right"), heading.rlike(r"%|percentual|percent\b").alias("in_heading")
    ).where((F.col("right.year") - F.col("left.year")).between(1, 5))
    rows = table.join(headers, ["source_url", "location"]).where("r > h")
    cell = lambda side: F.try_element_at("row", F.col(f"{side}.i") + 1)
    label = F.trim(F.try_element_at("row", F.lit(1)))
    found = rows.withColumns({"indicator": label, "v0": strict_percent(cell("left")), "v1": strict_percent(cell("right"))}).where(
        F.length(label).between(4, 125)
        & (F.col("in_heading") | F.contains(label, F.lit("%")) | F.contains(F.lower(label), F.lit("percent")))
        & F.col("v0").isNotNull()
        & F.col("v1").isNotNull()
    )
    of_table = Window.partitionBy("source_url", "location")
    found = found.withColumn("first_h", F.min("h").over(of_table)).where("h = first_h")
    if most is not None:
        found = found.withColumn("n", F.row_number().over(of_table.orderBy("r"))).where(F.col("n") <= most)
    return found.select(
        "source_url",
        F.concat("location", F.lit(":row:"), (F.col("r") + 1).cast("string")).alias("location"),
        "indicator",
        F.lit("%").alias("unit"),
        F.array(
            F.struct(F.col("left.year").alias("period"), F.col("v0").alias("value"), cell("left").alias("raw")),
            F.struct(F.col("right.year").alias("period"), F.col("v1").alias("value"), cell("right").alias("raw")),
        ).alias("observations"),
        exact_round(F.col("v1") - F.col("v0"), 3).alias("delta"),
        F.lit("punti percentuali").alias("comparison_unit"),
        F.lit(True).alias("verified"),
    )


def has_break(notes: Column) -> Column:
    low = F.lower(F.coalesce(notes, F.lit("")))
    return F.exists(F.array(*map(F.lit, BREAKS)), lambda b: F.contains(low, b))


def compare_series(observations: DataFrame, most: int | None = None) -> DataFrame:
    """Rows (source_url, five dimensions, notes, period, value): verdict on the last two years of each series.

    ``reason`` is the first that applies of source_url, missing_dimensions, methodological_break,
    insufficient_observations, non_adjacent_years, invalid_percentage; null where verified. ``most`` series of a source
    (MOST_PER_SOURCE is usual), in the order of their dimensions, verified ones first; None for all.
    """
    year = year_token(F.col("period").cast("string"))
    value = F.col("value").cast("string").try_cast("double")
    usable = F.when(year.isNotNull() & value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")), F.struct(year.alias("year"), value.alias("value")))
    series = observations.groupBy("source_url", *DIMENSIONS).agg(
        F.array_sort(F.collect_set(usable)).alias("rows"), F.concat_ws(" ", F.array_sort(F.collect_set("notes"))).alias("notes")
    )
    before, after = F.try_element_at("rows", F.lit(-2)), F.try_element_at("rows", F.lit(-1))
    missing = F.exists(F.array(*(F.coalesce(F.col(d), F.lit("")) for d in DIMENSIONS)), lambda d: d == "")
    percent = F.col("unit") == "%"
    reason = (
        F.when(~F.coalesce(F.startswith("source_url", F.lit("https://")), F.lit(False)), "source_url")
        .when(missing, "missing_dimensions")
        .when(has_break(F.col("notes")), "methodological_break")
        .when(F.size("rows") < 2, "insufficient_observations")
        .when(after["year"] - before["year"] != 1, "non_adjacent_years")
        .when(percent & ~(before["value"].between(0, 100) & after["value"].between(0, 100)), "invalid_percentage")
    )
    series = series.withColumn("reason", reason)
    if most is not None:
        of_source = Window.partitionBy("source_url").orderBy(F.col("reason").isNotNull(), *DIMENSIONS)
        series = series.withColumn("_n", F.row_number().over(of_source)).where(F.col("_n") <= most)
    ok = F.col("reason").isNull()
    return series.select(
        "source_url",
        *DIMENSIONS,
        F.when(ok, "verified").otherwise("rejected").alias("status"),
        "reason",
        F.when(ok, before["year"]).alias("year_before"),
        F.when(ok, after["year"]).alias("year_after"),
        F.when(ok, exact_round(after["value"] - before["value"], 6)).alias("delta"),
        F.when(ok, F.when(percent, "punti percentuali").otherwise(F.col("unit"))).alias("comparison_unit"),
    )


REVISION_KEYS = ["revision", "revisions", "methodology", "methodological_notes", "break_in_series", "notes", "comment", "OBS_STATUS"]


def revision_status(content: Column) -> Column:
    """What a companion bulletin (JSON text) says: unreadable, unsupported, a break, or merely read."""
    parsed = F.try_parse_json(content)
    kind = F.schema_of_variant(parsed)
    notes = F.concat_ws(" ", *(F.try_variant_get(parsed, f"$.{k}", "string") for k in REVISION_KEYS))
    return (
        F.when(parsed.isNull(), "unreadable_revision_metadata")
        .when(~F.startswith(kind, F.lit("OBJECT")), "unsupported_revision_metadata")
        .when(has_break(notes), "methodological_break")
        .otherwise("metadata_read")
    )


def verify_claims(claims: DataFrame, documents: DataFrame) -> DataFrame:
    """Claims (claim, doc, numbers, keywords, trusted) against document texts: numbers found in any spelling, score, verdict.

    40 for any number that is no year, 8 a keyword up to 40, 15 for a trusted domain; verified from 55 with a number.
    """
    from tidemark.functions.text import number_variants

    text = F.lower(F.col("text"))
    found = bound(text, lambda t: F.filter("numbers", lambda n: ~n.rlike(r"^20\d{2}$") & F.exists(number_variants(n), lambda v: F.contains(t, v))))
    words = bound(text, lambda t: F.filter("keywords", lambda w: F.contains(t, w)))

    def told(m: Column) -> Column:
        score = F.when(F.size(m["n"]) > 0, 40).otherwise(0) + F.least(F.lit(40), 8 * F.size(m["k"])) + F.when(F.col("trusted"), 15).otherwise(0)
        return F.struct(m["n"].alias("matched_numbers"), m["k"].alias("matched_keywords"), score.alias("verification_score"), ((score >= 55) & (F.size(m["n"]) > 0)).alias("verified"))

    matched = F.struct(found.alias("n"), F.array_distinct(words).alias("k"))
    return claims.join(documents, "doc").select("claim", "doc", bound(matched, told).alias("_told")).select("claim", "doc", "_told.*")
