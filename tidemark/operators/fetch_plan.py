"""What is still to be fetched: slices of months and provinces, less what the manifest holds, and what came back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import keep_last

SLICE = ["year", "month", "province"]


class GapError(ValueError):
    """A slice of the plan is missing or failed."""


def latest_months(published: DataFrame) -> DataFrame:
    """(year, latest) from published rows (year, month): the last month from 1 to 12; years without one are left out."""
    month = F.col("month").try_cast("int")
    return published.where(month.between(1, 12)).groupBy("year").agg(F.max(month).alias("latest"))


def wanted_slices(latest: DataFrame, provinces: DataFrame) -> DataFrame:
    """Every month up to the latest of each year, for each province of a small dimension (province)."""
    months = latest.select("year", F.explode(F.sequence(F.lit(1), F.col("latest"))).alias("month"))
    return months.crossJoin(F.broadcast(provinces.select("province").where("province is not null").distinct()))


def fetch_plan(latest: DataFrame, provinces: DataFrame, manifest: DataFrame, restate: int = 1) -> DataFrame:
    """(year, month, province, reason) of the slices to fetch.

    ``manifest`` has (year, month, province, status, fetched_at), any number of rows a slice, of which the newest
    counts. A slice is fetched where it was never (``new``), where its newest fetch failed (``failed``), and the last
    ``restate`` months of the newest year once more, since they are provisional (``provisional``).
    """
    newest = keep_last(manifest, SLICE, [F.col("fetched_at"), F.col("status")]).select(*SLICE, F.col("status").alias("_status"))
    last = latest.agg(F.max(F.struct("year", "latest")).alias("_l")).select("_l.*")
    last = F.broadcast(last.select(F.col("year").alias("_year"), F.col("latest").alias("_latest")))
    rows = wanted_slices(latest, provinces).join(newest, SLICE, "left").crossJoin(last)
    reason = (
        F.when(F.col("_status").isNull(), "new")
        .when(F.col("_status") != "ok", "failed")
        .when((F.col("year") == F.col("_year")) & (F.col("month") > F.col("_latest") - restate), "provisional")
    )
    return rows.withColumn("reason", reason).where("reason is not null").select(*SLICE, "reason")


def gaps(latest: DataFrame, provinces: DataFrame, manifest: DataFrame) -> DataFrame:
    """The slices that no successful fetch covers."""
    good = manifest.where("status = 'ok'").select(*SLICE).distinct()
    return wanted_slices(latest, provinces).join(good, SLICE, "left_anti")


def complete(rows: DataFrame, latest: DataFrame, provinces: DataFrame, manifest: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The fetched rows, the last of each key; fails where a slice of the plan is missing, naming the first, or where there are none."""
    missing = gaps(latest, provinces, manifest).orderBy(*SLICE).limit(1).first()
    if missing:
        raise GapError(f"{missing['year']}-{missing['month']:02d}, province {missing['province']}: not fetched")
    if rows.isEmpty():
        raise GapError("no rows were fetched")
    return keep_last(rows, keys, order)
