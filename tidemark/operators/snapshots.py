"""Published tables as versions, of which a pointer names the current one.

A version is written to a folder of its own, read back and compared with what was to be written, by count and by a
digest that does not mind the order of rows. Only then does its manifest appear, and the pointer is renamed over
the old one last. A reader follows the pointer, so it never sees half a version; what a run that failed left
behind is never pointed at, and the last good version stays where it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.events import content_hash, guarded
from tidemark.sources import shared_files as files

CURRENT, MANIFEST = "CURRENT", "MANIFEST.json"


class SnapshotError(ValueError):
    """What was read is not what was published."""


def _measures(rows: DataFrame) -> dict[str, Column]:
    return {"n_rows": F.count("*"), "content_hash": F.coalesce(content_hash(rows).cast("string"), F.lit("0"))}


def _measured(rows: DataFrame) -> dict:
    return rows.agg(*(c.alias(n) for n, c in _measures(rows).items())).first().asDict()


def publish(
    rows: DataFrame,
    root: str,
    checks: dict[str, Column] | None = None,
    facts: dict | None = None,
    after_write: Callable[[str], None] | None = None,
) -> dict:
    """Writes ``rows`` as the next version below ``root`` and makes it the current one; gives its manifest.

    ``checks`` are aggregate conditions that must hold before anything is written; ``facts`` go into the manifest.
    Fails, leaving the current version as it was, where a check fails or the rows read back differ. ``after_write``
    gets the folder of the version before it is checked.
    """
    spark = rows.sparkSession
    if checks:
        guarded(rows, checks)
    before = current(spark, root)
    number = (before["version"] if before else 0) + 1
    folder = f"{root}/v{number:06d}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    written = rows.observe(seen, *(c.alias(n) for n, c in _measures(rows).items()))
    written.write.parquet(f"{folder}/rows")
    if after_write:
        after_write(folder)
    back = _measured(spark.read.schema(rows.schema).parquet(f"{folder}/rows"))
    meant = {n: seen.get[n] for n in back}
    if back != meant:
        raise SnapshotError(f"{folder}: wrote {meant}, read {back}")
    manifest = {"version": number, "folder": folder, "schema": rows.schema.jsonValue(), **back, "previous": before["version"] if before else None, **(facts or {})}
    files.write_json(spark, f"{folder}/{MANIFEST}", manifest)
    files.write_text(spark, f"{root}/{CURRENT}", folder)
    return manifest


def current(spark: SparkSession, root: str) -> dict | None:
    """The manifest of the current version; None before the first."""
    pointer = f"{root}/{CURRENT}"
    return files.read_json(spark, f"{files.read_text(spark, pointer)}/{MANIFEST}") if files.exists(spark, pointer) else None


def versions(spark: SparkSession, root: str) -> list[dict]:
    """The manifests of all versions that were published, oldest first."""
    folders = [f"{root}/{name}" for name in files.names(spark, root) if name.startswith("v")]
    return [files.read_json(spark, f"{f}/{MANIFEST}") for f in folders if files.exists(spark, f"{f}/{MANIFEST}")]


def last_good(spark: SparkSession, root: str, verify: bool = True) -> DataFrame:
    """The rows of the current version; ``verify`` compares count and digest with its manifest first."""
    from pyspark.sql.types import StructType

    manifest = current(spark, root)
    if manifest is None:
        raise SnapshotError(f"{root}: nothing published")
    rows = spark.read.schema(StructType.fromJson(manifest["schema"])).parquet(f"{manifest['folder']}/rows")
    if verify:
        found = _measured(rows)
        if any(found[n] != manifest[n] for n in found):
            raise SnapshotError(f"{manifest['folder']}: published {[manifest[n] for n in found]}, read {list(found.values())}")
    return rows


def refreshed(fresh: DataFrame, root: str, checks: dict[str, Column]) -> tuple[DataFrame, bool]:
    """Publishes ``fresh`` where the checks hold; else the last good version stands in. Tells whether it did."""
    try:
        publish(fresh, root, checks)
        recovered = False
    except ValueError:
        recovered = True
    return last_good(fresh.sparkSession, root), recovered
