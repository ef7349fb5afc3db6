"""Every query of the library by name, with the SQL that it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import article_queries, connector_queries, detector_queries, feed_queries, refresh_queries, series_queries, source_queries, story_queries

MODULES = (series_queries, detector_queries, feed_queries, source_queries, story_queries, refresh_queries, article_queries, connector_queries)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: q for m in MODULES for k, q in m.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {k: q for m in MODULES for k, q in m.SQL.items()}
