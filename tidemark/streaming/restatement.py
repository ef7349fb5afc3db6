"""Streams that live over several refreshes: a bounded rate, late rows, restarts, and months that are restated.

A refresh drains what has come since the last one and ends; its checkpoint holds what was read, the watermark and
the state, so that the next refresh, in another process if need be, goes on there. Micro-batches may run again
after a failure. Writers here give the same table when they do: rows carry the version that they came with,
and merging them twice changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources import shared_files as files

Batch = Callable[[DataFrame, int], None]


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 64) -> DataFrame:
    """Parquet files that appear below ``path``, so many a micro-batch at most."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", "true").parquet(path)


def refresh(stream: DataFrame, path: str, batch: Batch, mode: str = "update") -> None:
    """Runs a stream over what has come since the last refresh, from the checkpoint below ``path`` on."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/_state")
    writer.trigger(availableNow=True).foreachBatch(batch).start().awaitTermination()


def numbered_batches(path: str) -> Batch:
    """Writes each micro-batch to a folder of its number: one that runs again overwrites its own rows."""
    return lambda rows, n: rows.withColumn("batch", F.lit(n).cast("long")).write.mode("overwrite").parquet(f"{path}/rows/n={n}")


def newest_of_batches(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """Of the rows that update mode gave for a key over all batches, the last."""
    rows = spark.read.schema(schema.add("batch", "long")).option("recursiveFileLookup", "true").parquet(f"{path}/rows")
    rest = [c for c in schema.names if c not in keys and c != "batch"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r"))
    return newest.select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest))


def restated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, value, version) to one a key: the newest value, the first one, and the versions that it came in.

    Also takes its own result, so that a table is merged with new rows by one aggregation whatever their order.
    """
    known = "versions" in rows.columns
    first = F.struct("first_version", "first_value") if known else F.struct(F.col("version").alias("first_version"), F.col("value").alias("first_value"))
    versions = F.col("versions") if known else F.array("version")
    # of one version that gives a key twice, the larger value
    return (
        rows.groupBy(*keys)
        .agg(F.max(F.struct("version", "value")).alias("_n"), F.min(first).alias("_f"), F.array_sort(F.array_distinct(F.flatten(F.collect_set(versions)))).alias("versions"))
        .select(*keys, "_n.version", "_n.value", "_f.first_version", "_f.first_value", "versions")
    )


def merge_into(path: str, keys: list[str], partition: str) -> Batch:
    """A batch writer that merges rows (keys, value, version) into the table below ``path``, partitioned by one of the keys.

    Only the partitions that a batch touches are read and replaced, each as a whole; they are written beside the table
    first, so that nothing reads what it overwrites. A batch that runs again finds its versions there already.
    """

    def merge(rows: DataFrame, _: int) -> None:
        spark = rows.sparkSession
        new, table = restated(rows, keys), f"{path}/table"
        draft = f"{path}/_drafts/{uuid.uuid4().hex[:12]}"
        if files.exists(spark, table):
            touched = [r[0] for r in rows.select(partition).distinct().collect()]  # the few months of one refresh
            old = spark.read.schema(new.schema).parquet(table).where(F.col(partition).isin(touched))
            new = restated(new.unionByName(old), keys)
        new.write.parquet(draft)
        back = spark.read.schema(new.schema).parquet(draft).repartition(partition)
        back.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(table)
        files.remove(spark, draft)

    return merge


def merged_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table that merge_into keeps, with columns of ``schema``."""
    return spark.read.schema(schema).parquet(f"{path}/table")


def provisional(month: Column, newest: Column) -> Column:
    """Whether a month is the newest there is in a year that is not complete."""
    return (month == newest) & (F.month(newest) != 12)
