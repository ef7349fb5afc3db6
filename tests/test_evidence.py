"""Evidence from tables and series on small cases that define it."""

import pytest

from tidemark.operators.evidence import compare_series, has_break, revision_status, table_evidence

HEADER = ["Share of ports (%)", "2011", "2012"]


@pytest.mark.parametrize(
    "cells, delta",
    [
        ([HEADER, ["Harbour A", "17,3", "19,8"]], 2.5),
        ([["title of the table"], [], HEADER, ["Harbour A", "17.3 %", "19"]], 1.7),
        ([["Ports", "2011", "2012"], ["Harbour A", "17", "19"]], None),
        ([["Ports", "2011", "2012"], ["Harbour A in percent", "17", "19"]], 2.0),
        ([["Share of ports (%)", "2003", "2012"], ["Harbour A", "17", "19"]], None),
        ([HEADER, ["Harbour A", "n.d.", "19"]], None),
        ([HEADER, ["Harbour A", "1750 tons", "150,9"]], None),
        ([HEADER, ["abc", "17", "19"]], None),
        ([HEADER, ["Harbour A", "17"]], None),
        ([["alone"]], None),
        ([], None),
    ],
)
def test_table_evidence(spark, cells, delta):
    tables = spark.createDataFrame([("https://example.org/a", "table:1", "", cells)], "source_url string, location string, unit_hint string, cells array<array<string>>")
    assert [r["delta"] for r in table_evidence(tables).collect()] == ([] if delta is None else [delta])


@pytest.mark.parametrize(
    "changed, reason",
    [
        ({}, None),
        ({"notes": "Discontinuity: not comparable before"}, "methodological_break"),
        ({"method_id": ""}, "missing_dimensions"),
        ({"first": "1997"}, "non_adjacent_years"),
        ({"value": None}, "insufficient_observations"),
        ({"source_url": "ftp://example.org/a"}, "source_url"),
        ({"unit": "%"}, "invalid_percentage"),
    ],
)
def test_compare_series(spark, changed, reason):
    base = {"source_url": "https://example.org/a", "dataset": "SHIPS", "indicator": "Arrivals", "unit": "ships", "territory": "XA", "method_id": "M7", "notes": ""}
    row = {k: changed.get(k, v) for k, v in base.items()}
    data = [(*row.values(), changed.get("first", "1999"), 731.0), (*row.values(), "2000", changed.get("value", 815.5))]
    schema = ", ".join(f"{c} string" for c in (*base, "period")) + ", value double"
    found = compare_series(spark.createDataFrame(data, schema)).first()
    assert found["reason"] == reason and found["delta"] == (84.5 if reason is None else None)


@pytest.mark.parametrize(
    "content, status",
    [('{"notes": "Break in the series of ships"}', "methodological_break"), ('{"comment": "unchanged"}', "metadata_read"), ("[1]", "unsupported_revision_metadata"), ("{", "unreadable_revision_metadata"), (None, "unreadable_revision_metadata")],
)
def test_bulletins(spark, content, status):
    rows = spark.createDataFrame([(content,)], "c string")
    assert rows.select(revision_status(rows["c"])).first()[0] == status and rows.select(has_break(rows["c"])).first()[0] is (status == "methodological_break")
