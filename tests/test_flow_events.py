"""The table of series that all detectors of flows read."""

import datetime

from tidemark.operators import flow_events as X


def test_series_of_flows(spark):
    """Missing values leave their month out of one flow only, sums over twelve months stand beside the months, and years come from all rows."""
    day = lambda i: datetime.date(2020 + i // 12, i % 12 + 1, 1)
    rows = [(1, 7, "a", day(i), 10.0, i, None if i == 3 else 1) for i in range(25)] + [(2, 7, "b", day(i), 30.0, 2, None) for i in range(24)]
    facts = spark.createDataFrame(rows, "entity long, parent int, name string, period date, weight double, births long, deaths long")
    found = {(r["indicator"], r["entity"]): r for r in X.flow_series(facts, ["births", "deaths"], [2020, 2021], day(23)).collect()}
    assert set(found) == {("births", 1), ("births", 2), ("deaths", 1)}
    births, deaths = found["births", 1], found["deaths", 1]
    assert (births["months"], births["dense"]) == ([float(i) for i in range(24)], True)
    assert births["rolling"] == [float(sum(range(i, i + 12))) for i in range(13)]
    assert (births["years"], births["annual"], births["rest_rates"]) == ([2020, 2021], [66.0, 210.0], [800.0, 800.0])
    assert (deaths["months"], deaths["rolling"], deaths["dense"]) == ([1.0] * 23, [12.0] * 12, False)
    assert (deaths["annual"], deaths["rest_rates"], deaths["weight"]) == ([11.0, 12.0], [0.0, 0.0], 10.0)
