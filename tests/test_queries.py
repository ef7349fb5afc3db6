"""Queries against their SQL over the smallest tables, and the entry module with and without the corpus part."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
#: One query or more of every kind of operator; the rest are held against their SQL at sf0.01 by hand.
SHOWN = [
    "annual_rollup", "latest_row", "rolling12_window", "first_difference", "trailing_run", "keep_last_dedup", "topk_per_group", "ratio_rollup",
    "dimension_join", "code_crosswalk", "index_intersection", "host_suffix_join", "totals_suppress_details", "catalog_upsert", "merged_feed",
    "last_good_fallback", "feed_manifest", "event_ids", "union_counts", "health_ratios", "topics", "canonical_urls", "number_parsers",
    "series_comparison", "table_evidence", "stream_tumbling", "stream_last_good", "stream_sessions",
    "sdmx_xml_observations", "sdmx_json_observations", "json_stat_cells", "rss_feed_items", "csv_document_rows", "html_document_rows", "xlsx_document_rows",
    "zipped_document_rows", "payload_rejections", "document_dispatch", "indicator_classes", "row_tests", "national_goals", "number_formats", "exact_rounding",
    "published_stories", "quarantined_stories", "curated_stories", "replaced_stories", "same_year_benchmark",
    "event_merge", "event_payloads", "published_event_rows", "gapped_robust_stats", "stream_late_rows", "stream_redelivered", "stream_restated_months", "published_versions",
    "page_links", "ranked_links", "attachment_evidence", "named_domains", "article_verification", "verification_stages", "national_areas", "story_headlines", "registry_order",
    "labelled_reports", "fetch_plan", "fetch_gaps", "header_drift", "waste_detections", "air_detections", "goal_detections", "grid_means",
    "preferred_member_rows", "named_sheet_rows",
]


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else round(value, 8)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value if isinstance(value, (int, str, bool, type(None))) else str(value)


def rows(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(([plain(r[i]) for i in order] for r in found), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(SF).iterdir():
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", SHOWN)
def test_agrees_with_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    want = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_every_sql_has_its_query():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
    assert not [n for n in registry.QUERIES if n.startswith("op") and n[2].isdigit()]


def test_entry_without_the_corpus_part():
    """The entry module imports and offers the other queries where the corpus modules are missing."""
    code = "import sys; sys.modules['tidemark.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).parents[1], check=True)
    assert said.stdout.split() == [str(len(registry.QUERIES)), str(len(registry.ORACLE_SQL))]
