"""Classic grid files written here by hand, byte by byte."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.sources import grids as G

CODES = {"S1": 2, ">i2": 3, ">i4": 4, ">f4": 5, ">f8": 6}


def classic(version, records, dims, variables):
    """``variables``: (name, dimension places, attributes, kind, values); records lie interleaved, each padded to four bytes."""
    number = (lambda v: struct.pack(">q", v)) if version == 5 else (lambda v: struct.pack(">i", v))
    offset = (lambda v: struct.pack(">i", v)) if version == 1 else (lambda v: struct.pack(">q", v))
    code = lambda v: struct.pack(">i", v)
    padded = lambda b: b.ljust(-(-len(b) // 4) * 4, b"\0")
    name = lambda t: number(len(t)) + padded(t.encode())

    def attribute(key, kind, value):
        raw = value.encode() if kind == "S1" else np.array([value], kind).tobytes()
        return name(key) + code(CODES[kind]) + number(len(value) if kind == "S1" else 1) + padded(raw)

    def header(begins):
        out = b"CDF" + bytes([version]) + number(records) + code(10) + number(len(dims)) + b"".join(name(n) + number(s) for n, s in dims)
        out += code(0) + number(0) + code(11) + number(len(variables))
        for (n, places, attributes, kind, values), begin in zip(variables, begins):
            own = b"".join(attribute(*a) for a in attributes)
            out += name(n) + number(len(places)) + b"".join(map(number, places)) + code(12 if attributes else 0) + number(len(attributes)) + own
            out += code(CODES[kind]) + number(0) + offset(begin)
        return out

    at, begins, body = len(header([0] * len(variables))), [], b""
    by_record = [dims[v[1][0]][1] == 0 if v[1] else False for v in variables]
    for (_, _, _, kind, values), rec in zip(variables, by_record):
        if not rec:
            begins.append(at + len(body))
            body += padded(np.array(values, kind).tobytes())
        else:
            begins.append(None)
    parts = [[np.array(row, v[3]).tobytes() for row in v[4]] if rec else None for v, rec in zip(variables, by_record)]
    lone = sum(by_record) == 1
    start = at + len(body)
    for i, p in enumerate(parts):
        if p is not None:
            begins[i] = start
            start += len(p[0]) if lone else len(padded(p[0]))
    for r in range(records):
        body += b"".join(p[r] if lone else padded(p[r]) for p in parts if p is not None)
    return header(begins) + body


DIMS = [("time", 0), ("lat", 2), ("lon", 3), ("letters", 4)]
FIELD = np.arange(6).reshape(2, 3) + 280.0


def plain(version):
    packed = [("scale_factor", ">f8", 0.5), ("add_offset", ">f8", 10.0), ("_FillValue", ">i2", -1), ("units", "S1", "mm")]
    return classic(
        version, 2, DIMS,
        [
            ("names", [3], [], "S1", list("abcd")),
            ("t2m", [1, 2], [("units", "S1", "K")], ">f4", FIELD),
            ("tp", [0, 1, 2], packed, ">i2", [[[1, 2, 3], [4, -1, 6]], [[7, 8, 9], [-1, -1, 12]]]),
            ("count", [0], [], ">i4", [5, 6]),
        ],
    )


@pytest.mark.parametrize("version", [1, 2, 5])
def test_variables_of_every_version(version):
    found = {v.name: (v, x) for v, x in G.variables(plain(version))}
    assert set(found) == {"t2m", "tp", "count"} and found["t2m"][1].tolist() == FIELD.ravel().tolist()
    v, x = found["tp"]
    nan = float("nan")
    assert v.dimensions == ["time", "lat", "lon"] and v.shape == [2, 2, 3] and v.attributes["units"] == "mm"
    np.testing.assert_array_equal(x, [10.5, 11, 11.5, 12, nan, 13, 13.5, 14, 14.5, nan, nan, 16])
    assert found["count"][1].tolist() == [5, 6]


def test_one_variable_of_records_is_not_padded():
    data = classic(1, 3, [("time", 0), ("x", 3)], [("temperature_2m", [0, 1], [("missing_value", ">i2", 0)], ">i2", [[1, 2, 3], [0, 5, 6], [7, 8, 9]])])
    ((v, x),) = G.variables(data)
    np.testing.assert_array_equal(x, [1, 2, 3, float("nan"), 5, 6, 7, 8, 9])
    assert v.shape == [3, 3] and v.by_record


def test_means_of_files(spark):
    hot = classic(2, 0, [("x", 2)], [("mean_temperature", [0], [], ">f8", [274.15, 276.15]), ("t2m", [0], [("units", "S1", "degC")], ">f8", [float("nan"), 5.0])])
    files = [("a.nc", plain(1)), ("b.nc", hot), ("c.nc", b"\x89HDF\r\n"), ("d.nc", None), ("e.nc", plain(2)[:90]), ("f.nc", classic(1, 0, [("x", 1)], [("other", [0], [], ">i4", [1])]))]
    blocks = G.grid_blocks(spark.createDataFrame(files, "path string, content binary").repartition(3), 4)
    errors = {r["path"] for r in blocks.where("error is not null").collect()}
    assert errors == {"c.nc", "d.nc", "e.nc"}
    assert {(r["path"], r["variable"], r["first"]) for r in blocks.where("path = 'a.nc' and variable = 'tp'").collect()} == {("a.nc", "tp", 0), ("a.nc", "tp", 4), ("a.nc", "tp", 8)}
    found = {(r["path"], r["quantity"]): (round(r["mean"], 6), r["cells"]) for r in G.spatial_means(blocks).collect()}
    assert found == {("a.nc", "temperature_c"): (9.35, 6), ("a.nc", "precipitation_mm_day"): (round(116.0 / 9, 6), 9), ("b.nc", "temperature_c"): (5.0, 1)}


def test_units(spark):
    rows = spark.createDataFrame([(300.0, "K"), (2.0, " M "), (3.0, "mm"), (4.0, None)], "v double, u string")
    assert [round(r[0], 6) for r in rows.select(G.in_usual_units(F.col("v"), F.col("u"))).collect()] == [26.85, 2000.0, 3.0, 4.0]
