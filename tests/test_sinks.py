"""Sinks, guards and merged feeds."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import links as L
from tidemark.functions import text as T
from tidemark.operators import events as E
from tidemark.operators import evidence as V
from tidemark.operators import series as S
from tidemark.sources import documents as D
from tidemark.sources import shared_files as files


def test_tables_of_text_come_back(spark, tmp_path):
    rows = spark.createDataFrame([("a", ["x", "y"], 1.5), ("b", None, None)], "name string, many array<string>, v double")
    D.write_tsv(rows, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("part-*"))) == 1
    back = D.read_tsv(spark, str(tmp_path / "t"), ["name", "many", "v"])
    assert sorted(tuple(r) for r in back.collect()) == [("a", "x|y", "1.5"), ("b", "", "")]
    with pytest.raises(Exception):
        D.read_tsv(spark, str(tmp_path / "t"), ["name", "other", "v"]).collect()


def test_documents_of_a_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_bytes(b"one")
    (tmp_path / "sub" / "b.csv").write_bytes(b"\xff")
    (tmp_path / "c.txt").write_bytes(b"no")
    found = {r["path"].rsplit("/", 1)[1]: (bytes(r["content"]), r["length"], len(r["sha256"])) for r in D.read_documents(spark, str(tmp_path), "*.csv").collect()}
    assert found == {"a.csv": (b"one", 3, 64), "b.csv": (b"\xff", 1, 64)}


def test_files_of_the_driver(spark, tmp_path):
    path = f"{tmp_path}/x/doc.json"
    files.write_json(spark, path, {"a": "è", "b": [1, None]})
    files.write_json(spark, path, spark.createDataFrame([("è", [("k", 2)])], "a string, b array<struct<n:string,v:int>>").first())
    assert files.read_json(spark, path) == {"a": "è", "b": [{"n": "k", "v": 2}]} and "è" in files.read_text(spark, path) and files.names(spark, f"{tmp_path}/x")[-1] == "doc.json"
    assert files.qualified(spark, "/x/y") == "file:/x/y" and files.qualified(spark, "file:/x") == "file:/x"
    table = files.written(spark.range(3).toDF("n"), "rows")
    assert table.count() == 3 and files.exists(spark, files.shared_folder(spark))


def test_guards_name_the_checks_that_fail(spark):
    rows = spark.createDataFrame([(1,), (None,)], "v int")
    assert E.guarded(rows, {"some": F.count("*") > 1}) is rows
    with pytest.raises(ValueError, match="known, many$"):
        E.guarded(rows, {"some": F.count("*") > 1, "known": F.count_if(F.col("v").isNull()) == 0, "many": F.count("*") > 5})


def test_feeds_are_merged_by_id(spark):
    schema = "id string, scope string, period string, score double, summary string"
    one = spark.createDataFrame([("a", "GENERAL", "2024-05", 70.0, "x"), ("b", "GENERAL", "2023", 90.0, "old"), ("c", "GREEN", "2019", 60.0, "nel 2018")], schema)
    two = spark.createDataFrame([("a", "GENERAL", "2024", 80.0, "nel 2024"), ("d", "LOCALE", "2024", 66.0, "nel 2023")], schema).withColumn("extra", F.lit(1))
    found = {r["id"]: (r["score"], r["extra"]) for r in E.merge_feeds([one, two]).collect()}
    assert found == {"a": (80.0, 1), "c": (60.0, None)}
    assert E.merge_feeds([one.limit(0)]).collect() == []


def test_bounds_of_evidence_are_parameters(spark):
    cells = [["Share (%)", "2001", "2002"]] + [[f"part {i:02}", "1", "2"] for i in range(30)]
    tables = spark.createDataFrame([("https://example.org/a", "t", "", cells)], "source_url string, location string, unit_hint string, cells array<array<string>>")
    assert [V.table_evidence(tables, n).count() for n in (V.MOST_PER_TABLE, 3, None)] == [20, 3, 30]
    rows = [("https://example.org/a", "D", f"i{i:02}", "t", "T", "M", "", str(y), float(y)) for i in range(5) for y in (2001, 2002) if i or y == 2001]
    observations = spark.createDataFrame(rows, "source_url string, dataset string, indicator string, unit string, territory string, method_id string, notes string, period string, value double")
    assert V.compare_series(observations).count() == 5
    assert sorted(r["indicator"] for r in V.compare_series(observations, 2).collect()) == ["i01", "i02"]


def test_registry_and_ranked_links(spark):
    rows = [("b", "P", "x", "Zeta", "1"), ("B", "P", "X", "alfa", "2"), ("a", "P", "y", "", "3"), ("A", "C", "z", "m", "4"), ("A", "C", "z", "m", "4"), (None, "P", "x", "n", "5")]
    frame = spark.createDataFrame(rows, "region string, area_type string, area string, municipality string, municipality_code string")
    assert [r["municipality_code"] for r in S.registry(frame).collect()] == ["4", "2", "1"]
    links = spark.createDataFrame([(["u/a", "u/Data-b", "u/data-table", "u/c"],), ([],)], "l array<string>")
    assert [r[0] for r in links.select(L.ranked(F.col("l"), ["DATA", "table"], 3)).collect()] == [["u/data-table", "u/Data-b", "u/a"], []]
    subject = spark.createDataFrame([("CASA", ["bari", "roma"], ["3,5%"]), ("x", [], [])], "t string, p array<string>, n array<string>")
    assert [r[0] for r in subject.select(T.headline(F.col("t"), F.col("p"), F.col("n"))).collect()] == ["Casa, nuovo dato per Bari: 3,5%", "Dati, nuovo aggiornamento statistico per Italia"]
