"""Snapshots that fail midway, merges that run again, and streams that restart."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import snapshots as P
from tidemark.sources import shared_files as files
from tidemark.streaming import observations as O
from tidemark.streaming import restatement as R

ROWS = "month date, flag string, value double, version int"


def table_of(spark, rows, schema="k int, v string"):
    return spark.createDataFrame(rows, schema)


def test_a_write_that_ends_midway_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "feed")
    P.publish(table_of(spark, [(1, "old")]), root)

    def ends(folder):
        raise RuntimeError("the job ends here")

    with pytest.raises(RuntimeError):
        P.publish(table_of(spark, [(2, "new")]), root, after_write=ends)
    assert [tuple(r) for r in P.last_good(spark, root).collect()] == [(1, "old")]
    assert [m["version"] for m in P.versions(spark, root)] == [1]
    P.publish(table_of(spark, [(3, "newer"), (4, None)]), root)
    assert sorted(tuple(r) for r in P.last_good(spark, root).collect()) == [(3, "newer"), (4, None)] and P.current(spark, root)["previous"] == 1


def test_rows_that_change_before_they_are_read_are_not_published(spark, tmp_path):
    root = str(tmp_path / "feed")
    P.publish(table_of(spark, [(1, "a")]), root)
    with pytest.raises(P.SnapshotError):
        P.publish(table_of(spark, [(1, "b")]), root, after_write=lambda f: table_of(spark, [(1, "c")]).write.mode("overwrite").parquet(f"{f}/rows"))
    assert P.last_good(spark, root).first()["v"] == "a"


def test_a_published_version_that_was_changed_is_told(spark, tmp_path):
    root = str(tmp_path / "feed")
    made = P.publish(table_of(spark, [(1, "a"), (2, "b")]), root, facts={"feed": "año"})
    assert P.current(spark, root)["feed"] == "año" and '\n  "feed": "año"' in files.read_text(spark, f"{made['folder']}/MANIFEST.json")
    table_of(spark, [(1, "a"), (2, "B")]).write.mode("overwrite").parquet(f"{made['folder']}/rows")
    with pytest.raises(P.SnapshotError):
        P.last_good(spark, root)
    assert P.last_good(spark, root, verify=False).count() == 2


def test_checks_keep_the_last_good_version(spark, tmp_path):
    root, least = str(tmp_path / "feed"), {"enough": F.count("*") >= 2}
    with pytest.raises(P.SnapshotError):
        P.refreshed(table_of(spark, [(1, "a")]), root, least)
    assert P.refreshed(table_of(spark, [(1, "a"), (2, "b")]), root, least)[1] is False
    rows, recovered = P.refreshed(table_of(spark, []), root, least)
    assert recovered and rows.count() == 2 and not files.exists(spark, f"{root}/none") and files.names(spark, f"{root}/none") == []


def test_empty_tables_and_columns_with_any_name(spark, tmp_path):
    root = str(tmp_path / "feed")
    P.publish(table_of(spark, [], "n_rows int, `content_hash` string"), root)
    assert P.last_good(spark, root).count() == 0 and P.last_good(spark, root).columns == ["n_rows", "content_hash"]


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    path, keys = str(tmp_path / "months"), ["month", "flag"]
    january, february = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    merge = R.merge_into(path, keys, "month")
    one = spark.createDataFrame([(january, "A", 1.0, 0), (february, "A", 2.0, 0), (february, None, 5.0, 0)], ROWS)
    two = spark.createDataFrame([(february, "A", 3.0, 1), (february, "A", None, 1)], ROWS)
    for n, rows in enumerate((one, two, two, one)):
        merge(rows, n)
    schema = R.restated(one, keys).schema
    found = {(r["month"], r["flag"]): (r["value"], r["version"], r["first_value"], r["versions"]) for r in R.merged_table(spark, path, schema).collect()}
    assert found == {(january, "A"): (1.0, 0, 1.0, [0]), (february, "A"): (3.0, 1, 2.0, [0, 1]), (february, None): (5.0, 0, 5.0, [0])}


def test_a_stream_goes_on_after_a_batch_that_failed(spark, tmp_path):
    path, keys = str(tmp_path / "stream"), ["month", "flag"]
    month = dt.date(2024, 3, 1)
    merge = R.merge_into(path, keys, "month")

    def fails(rows, n):
        merge(rows, n)
        raise RuntimeError("lost before the batch is committed")

    rows = lambda value, version: spark.createDataFrame([(month, "A", value, version)], ROWS).write.parquet(f"{path}/in/{version}")
    stream = lambda: R.file_stream(spark, f"{path}/in", spark.createDataFrame([], ROWS).schema, 1)
    rows(1.0, 0)
    R.refresh(stream(), path, merge, "append")
    rows(4.0, 1)
    with pytest.raises(Exception, match="lost before"):
        R.refresh(stream(), path, fails, "append")
    rows(9.0, 2)
    R.refresh(stream(), path, merge, "append")
    found = R.merged_table(spark, path, R.restated(spark.createDataFrame([], ROWS), keys).schema).first()
    assert (found["value"], found["first_value"], found["versions"]) == (9.0, 1.0, [0, 1, 2])


def test_late_rows_are_left_out_after_a_restart(spark, tmp_path):
    path, schema = str(tmp_path / "late"), "ts timestamp, kind string, value double"
    day = lambda d, h=0: dt.datetime(2024, 5, d, h)
    refreshes = [[(day(1), "a", 1.0), (day(2), "a", 2.0)], [(day(1, 5), "a", 4.0), (day(9), "a", 8.0)], [(day(1, 6), "a", 16.0), (day(8), "b", 32.0)]]
    for k, rows in enumerate(refreshes):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/in/{k}")
        stream = O.tumbling(R.file_stream(spark, f"{path}/in", spark.createDataFrame([], schema).schema), "ts", ["kind"], "value", late="2 days")
        R.refresh(stream, path, R.numbered_batches(path))
    found = R.newest_of_batches(spark, path, stream.schema, ["window_start", "kind"])
    assert {(r["window_start"].day, r["kind"]): r["total"] for r in found.collect()} == {(1, "a"): 5.0, (2, "a"): 2.0, (9, "a"): 8.0, (8, "b"): 32.0}


def test_the_newest_month_of_an_open_year_is_provisional(spark):
    months = [(dt.date(2024, m, 1),) for m in (11, 12)] + [(dt.date(2025, 1, 1),)]
    df = spark.createDataFrame(months, "m date")
    flags = lambda newest: [r[0] for r in df.orderBy("m").select(R.provisional(F.col("m"), F.lit(newest))).collect()]
    assert flags(dt.date(2025, 1, 1)) == [False, False, True] and flags(dt.date(2024, 12, 1)) == [False] * 3
