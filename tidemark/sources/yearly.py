"""Yearly files whose headers drift: aligned by the columns that are needed and those that may be there, the differences told."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MISSING, DRIFT = "missing_columns", "year int, status string, missing array<string>, absent array<string>, unknown array<string>"


@dataclass(frozen=True)
class Layout:
    """The columns of a family of files: name in the result -> pattern of the header, matched whole, letters of either case alike."""

    required: dict[str, str]
    optional: dict[str, str] = field(default_factory=dict)


def matched(columns: list[str], layout: Layout) -> tuple[dict[str, str], list[str]]:
    """(result name -> header, headers that the layout does not know); of several headers that fit the first is taken."""
    found, used = {}, set()
    for name, pattern in {**layout.required, **layout.optional}.items():
        fits = (c for c in columns if c not in used and re.fullmatch(pattern, c.strip(), re.I))
        if header := next(fits, None):
            found[name] = header
            used.add(header)
    return found, [c for c in columns if c not in used]


def aligned(files: dict[int, DataFrame], layout: Layout, keep_years: int = 0) -> tuple[DataFrame, DataFrame]:
    """(rows of all files that have what is required, with ``year``, optional columns null where absent; what each header differed by).

    Values stay as they are read, as text. A file without a required column is left out and told as ``missing_columns``;
    fewer than ``keep_years`` files that remain are an error.
    """
    names, rows, told = [*layout.required, *layout.optional], None, []
    for year, frame in sorted(files.items()):
        found, unknown = matched(frame.columns, layout)
        missing = [n for n in layout.required if n not in found]
        told.append((year, MISSING if missing else "read", missing, [n for n in layout.optional if n not in found], unknown))
        if missing:
            continue
        value = lambda n: F.col(f"`{found[n]}`").cast("string") if n in found else F.lit(None).cast("string")  # noqa: B023, E731
        part = frame.select(F.lit(year).alias("year"), *(value(n).alias(n) for n in names))
        rows = part if rows is None else rows.unionByName(part)
    read = sum(t[1] == "read" for t in told)
    if read < max(1, keep_years):
        raise ValueError(f"{read} of {len(told)} files have the required columns, {max(1, keep_years)} are needed")
    return rows, rows.sparkSession.createDataFrame(told, DRIFT)


def header_difference(before: list[str], after: list[str]) -> tuple[list[str], list[str]]:
    """(columns that went, columns that came), each in its own order."""
    return [c for c in before if c not in after], [c for c in after if c not in before]


def read_yearly(spark: SparkSession, paths: dict[int, str], sep: str = ";") -> dict[int, DataFrame]:
    """Delimited files with a header each, every column as text."""
    return {year: spark.read.csv(path, sep=sep, header=True, multiLine=True, escape='"') for year, path in paths.items()}


def coverage_threshold(frame: DataFrame, coverage: Column, share: float = 0.75, scaled_to: float = 1.5) -> DataFrame:
    """One row (threshold): ``share`` where the median coverage says that it is a share, else the same in per cent."""
    return frame.agg(F.when(F.median(coverage) <= scaled_to, share).otherwise(share * 100).alias("threshold"))


def well_covered(frame: DataFrame, coverage: Column, share: float = 0.75, scaled_to: float = 1.5) -> DataFrame:
    """Rows of enough coverage, and those of which none is known; the scale is told from the data."""
    threshold = F.broadcast(coverage_threshold(frame, coverage, share, scaled_to).withColumnRenamed("threshold", "_threshold"))
    return frame.crossJoin(threshold).where(coverage.isNull() | (coverage >= F.col("_threshold"))).drop("_threshold")
