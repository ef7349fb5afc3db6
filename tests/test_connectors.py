"""Reports, plans and drifting files on the cases that break them."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import reports as R
from tidemark.operators import connectors as C
from tidemark.operators import fetch_plan as P
from tidemark.sources import yearly as Y

TEXT = "Anno 2030. Totale 10 1.234,5 11 1.300 12 1.400,25 13 1.500 -1,5% 2% Produzione totale 7 8,5 Perdite di rete nessuna"
ROWS = [
    R.Row("power", "Totale", "MW", (1, 3, 5, 7), 8, 1000, 2000),
    R.Row("narrow", "Totale", "MW", (1, 3, 5, 7), 8, 1600, 2000),
    R.Row("output", "Produzione totale", "GWh", (0, 1), 2),
    R.Row("more", "Produzione totale", "GWh", (0, 2), 2),
    R.Row("other", "Importazioni", "GWh", (0,), 1),
]


def test_rows_of_reports(spark):
    reports = spark.createDataFrame([(1, "a", TEXT), (2, "b", None), (3, "c", "TOTALE\n\n 1 -2,5 3\t4 5 6 7 1.999,9")], "key int, name string, text string")
    found = {(r[0], r[2]): (r["values"], r["error"]) for r in R.read_reports(reports, ROWS, ["1", "2", "3", "4"]).collect()}
    assert found[1, "power"] == ([1234.5, 1300.0, 1400.25, 1500.0], None) and found[1, "narrow"] == (None, "out_of_range")
    assert found[1, "output"] == ([7.0, 8.5], None) and found[1, "more"] == (None, "too_few_values") and found[1, "other"] == (None, "missing_row")
    assert {found[2, r.name] for r in ROWS} == {(None, "missing_row")}
    assert found[3, "power"] == ([-2.5, 4.0, 6.0, 1999.9], None) and len(found) == 15


def test_long_numbers_without_dots_are_whole(spark):
    numbers = R.window_numbers(F.col("text"))
    found = spark.createDataFrame([("6517 1.285.333,8 12345,5% -2030 7",)], "text string").select(numbers.alias("x")).first()["x"]
    assert found == [6517.0, 1285333.8, 12345.5, -2030.0, 7.0]


def test_what_is_to_be_fetched(spark):
    published = spark.createDataFrame([(2023, "12"), (2023, "13"), (2024, "2"), (2024, None), (2024, "x"), (2025, "0")], "year int, month string")
    provinces = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "province string")
    latest = P.latest_months(published)
    assert {tuple(r) for r in latest.collect()} == {(2023, 12), (2024, 2)}
    done = [(2023, m, p, "ok", m) for m in range(1, 13) for p in "AB"] + [(2024, m, p, "ok", 20) for m in (1, 2) for p in "AB"]
    manifest = spark.createDataFrame([*done, (2023, 5, "A", "error", 99), (2023, 6, "B", "error", 1), (2030, 1, "Z", "ok", 1)], "year int, month int, province string, status string, fetched_at int")
    plan = {tuple(r) for r in P.fetch_plan(latest, provinces, manifest).collect()}
    assert plan == {(2023, 5, "A", "failed"), (2024, 2, "A", "provisional"), (2024, 2, "B", "provisional")}
    assert P.fetch_plan(latest, provinces, manifest, restate=0).count() == 1 and P.fetch_plan(latest, provinces, manifest.limit(0)).count() == 28
    rows = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, v string, n int")
    assert [r["v"] for r in P.complete(rows, latest, provinces, manifest, ["k"], [F.col("n")]).collect()] == ["y"]
    with pytest.raises(P.GapError, match="2023-07, province B"):
        P.complete(rows, latest, provinces, manifest.where("not (year = 2023 and month = 7 and province = 'B')"), ["k"], [F.col("n")])
    with pytest.raises(P.GapError, match="no rows"):
        P.complete(rows.limit(0), latest, provinces, manifest, ["k"], [F.col("n")])


def test_headers_that_drift(spark):
    layout = Y.Layout({"region": "Regione", "total": r"Totale( RU)? \(t\)"}, {"code": "Codice.*"})
    frame = lambda columns, row: spark.createDataFrame([row], ", ".join(f"`{c}` string" for c in columns))
    files = {
        2001: frame(["Regione", "Totale (t)"], ("A", "1")),
        2002: frame([" totale ru (T) ", "REGIONE", "Codice Istat", "Note"], ("2", "B", "07", "n")),
        2003: frame(["Regione", "Totale"], ("C", "3")),
    }
    rows, told = Y.aligned(files, layout, 2)
    assert sorted(tuple(r) for r in rows.collect()) == [(2001, "A", "1", None), (2002, "B", "2", "07")]
    assert {r["year"]: (r["status"], r["missing"], r["absent"], r["unknown"]) for r in told.collect()} == {
        2001: ("read", [], ["code"], []), 2002: ("read", [], [], ["Note"]), 2003: ("missing_columns", ["total"], ["code"], ["Totale"])
    }
    with pytest.raises(ValueError, match="2 of 3 files"):
        Y.aligned(files, layout, 3)
    assert Y.header_difference(["a", "b"], ["b", "c"]) == (["a"], ["c"])


def test_yearly_files_are_read_as_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Regione;Totale (t)\n"x;\ny";007\n', encoding="utf-8")
    frame = Y.read_yearly(spark, {2001: str(tmp_path / "a.csv")})[2001]
    assert [tuple(r) for r in frame.collect()] == [("x;\ny", "007")]


@pytest.mark.parametrize("scale", [1, 100])
def test_coverage_tells_its_scale(spark, scale):
    rows = spark.createDataFrame([(1, 0.9 * scale), (2, 0.75 * scale), (3, 0.7 * scale), (4, None)], "k int, c double")
    assert sorted(r["k"] for r in Y.well_covered(rows, F.col("c")).collect()) == [1, 2, 4]
    assert Y.well_covered(rows.where("c is null"), F.col("c")).count() == 1


def test_waste_of_rows_without_numbers(spark):
    rows = [(2000 + y, r, p, s, w) for y in range(7) for r, p, s, w in (("A", "100", "1,5", str(10 + y)), ("A", "50", "n.d.", "7"), ("B", "....", "2", "4"), (None, "9", "9", "9"))]
    frame = spark.createDataFrame(rows, "year int, region string, population string, sorted_t string, waste_t string")
    found = {(r["entity"], r["unit"]): r["values"] for r in C.waste_series(frame).collect()}
    assert set(found) == {("A", "%"), ("B", "%"), ("Italia", "%"), ("Italia", "kg/ab")}
    assert found["A", "%"] == [100 * 1.5 / (10 + y) for y in range(7)] and found["B", "%"] == [50.0] * 7
    assert found["Italia", "kg/ab"] == [1000 * (14 + y) / 150 for y in range(7)]
    assert C.detected(C.waste_series(frame.where("year < 2005"))).count() == 0


def test_missing_values_keep_no_place_in_detections(spark):
    series = spark.createDataFrame([("e", "i", "%", [str(y) for y in range(8)], [1.0, None, 2.0, float("nan"), 1.5, 1.8, 1.2, 9.0])], "entity string, indicator string, unit string, periods array<string>, values array<double>")
    row = C.detected(series).first()
    assert row["values"] == [1.0, 2.0, 1.5, 1.8, 1.2, 9.0] and row["periods"] == ["0", "2", "4", "5", "6", "7"] and row["latest"] == "7" and "RECORD_MAX" in row["patterns"]
