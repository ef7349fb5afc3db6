"""Structured Streaming forms of the feed upkeep: windows with late data, permanent identities, last good values.

State is bounded everywhere: by watermarks, or by one row for each key of a bounded catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tumbling(events: DataFrame, time: str, keys: list[str], value: str, window: str = "1 day", late: str = "3 days") -> DataFrame:
    """Count and sum for each window and key; what comes later than ``late`` is left out."""
    return (
        events.withWatermark(time, late)
        .groupBy(F.window(time, window).alias("w"), *keys)
        .agg(F.count("*").alias("n"), F.sum(value).alias("total"))
        .select(F.col("w.start").alias("window_start"), *keys, "n", "total")
    )


def sliding(events: DataFrame, time: str, keys: list[str], value: str, window: str = "12 hours", slide: str = "4 hours", late: str = "3 days") -> DataFrame:
    """As ``tumbling``, over windows that overlap."""
    return (
        events.withWatermark(time, late)
        .groupBy(F.window(time, window, slide).alias("w"), *keys)
        .agg(F.count("*").alias("n"), F.sum(value).alias("total"))
        .select(F.col("w.start").alias("window_start"), *keys, "n", "total")
    )


def sessions(events: DataFrame, time: str, key: str, gap: str = "6 hours", late: str = "3 days") -> DataFrame:
    """Sessions of a key that a pause ends."""
    return (
        events.withWatermark(time, late)
        .groupBy(F.session_window(time, gap).alias("w"), key)
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, "n")
    )


def first_seen(events: DataFrame, time: str, keys: list[str], late: str = "3 days") -> DataFrame:
    """The first row of each identity within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def last_good(events: DataFrame) -> DataFrame:
    """Rows (key, ts, value): the newest value of each key that is not missing, carried over refreshes that fail."""
    good = F.when(F.col("value").isNotNull() & ~F.isnan("value"), F.struct(F.unix_micros("ts").alias("ts_micros"), "value"))
    newest = events.groupBy("key").agg(F.max(good).alias("_best"), F.count("*").alias("seen"))
    return newest.select("key", "_best.ts_micros", "_best.value", "seen")


def drained(spark: SparkSession, stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what there is, into a table, and reads the table.

    In append mode rows are written as they become final. Else every micro-batch overwrites the table, or
    with update mode adds its rows under a batch number.
    """
    writer = stream.writeStream.option("checkpointLocation", f"{path}/_state").trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", f"{path}/rows").start()
    elif mode == "complete":
        query = writer.outputMode("complete").foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(f"{path}/rows")).start()
    else:
        query = writer.outputMode("update").foreachBatch(lambda rows, n: rows.withColumn("batch", F.lit(n)).write.mode("append").parquet(f"{path}/rows")).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema if mode != "update" else stream.schema.add("batch", "long")).parquet(f"{path}/rows")
