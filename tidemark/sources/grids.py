"""Gridded arrays: classic NetCDF files decoded in tasks to blocks of values, and their means over space.

Read are the classic formats with 32-bit and 64-bit offsets and 64-bit data (versions 1, 2 and 5); files of the HDF5 kind
are told by ``documents.magic`` and give an error here. A variable is sent in blocks with the place of their first value, so a
large grid is no one row.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values of a block.
BLOCK_VALUES = 4096
# Fixed values of the format: kinds of numbers by their code, and the tags of lists in a header.
_KINDS = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: "u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
_DIMENSIONS, _VARIABLES, _ATTRIBUTES = 10, 11, 12


class Variable(NamedTuple):
    name: str
    dimensions: list[str]
    shape: list[int]
    attributes: dict[str, object]
    kind: str
    begin: int
    by_record: bool


class _Header:
    """Reads the header of a classic file from its bytes."""

    def __init__(self, data: bytes):
        if data[:3] != b"CDF" or data[3:4] not in (b"\1", b"\2", b"\5"):
            raise ValueError("no classic NetCDF file")
        self.data, self.at = data, 4
        self.count = ">q" if data[3] == 5 else ">i"
        self.offset = ">i" if data[3] == 1 else ">q"
        self.records = self._number(self.count)
        dims = self._list(_DIMENSIONS, lambda: (self._name(), self._number(self.count)))
        self.attributes = self._attributes()
        self.variables = self._list(_VARIABLES, lambda: self._variable(dims))

    def _number(self, form: str) -> int:
        (value,) = struct.unpack_from(form, self.data, self.at)
        self.at += struct.calcsize(form)
        return value

    def _name(self) -> str:
        size = self._number(self.count)
        name = self.data[self.at : self.at + size].decode()
        self.at += -(-size // 4) * 4
        return name

    def _list(self, tag: int, item) -> list:
        found, size = self._number(">i"), self._number(self.count)
        if found not in (0, tag):
            raise ValueError("damaged header")
        return [item() for _ in range(size)]

    def _values(self):
        kind, size = _KINDS[self._number(">i")], self._number(self.count)
        width = np.dtype(kind).itemsize * size
        raw = self.data[self.at : self.at + width]
        self.at += -(-width // 4) * 4
        return raw.decode(errors="replace").rstrip("\0") if kind == "S1" else np.frombuffer(raw, kind).tolist()

    def _attributes(self) -> dict[str, object]:
        return dict(self._list(_ATTRIBUTES, lambda: (self._name(), self._values())))

    def _variable(self, dims: list[tuple[str, int]]) -> Variable:
        name = self._name()
        own = [dims[self._number(self.count)] for _ in range(self._number(self.count))]
        attributes = self._attributes()
        kind = _KINDS[self._number(">i")]
        self._number(self.count)
        begin = self._number(self.offset)
        return Variable(name, [n for n, _ in own], [size for _, size in own], attributes, kind, begin, bool(own) and own[0][1] == 0)


def variables(data: bytes) -> Iterator[tuple[Variable, np.ndarray]]:
    """Each variable of numbers with its values, flat in row-major order; missing ones are NaN, packed ones unpacked."""
    header = _Header(data)
    of_record = [v for v in header.variables if v.by_record]
    width = lambda v: np.dtype(v.kind).itemsize * int(np.prod(v.shape[1:] if v.by_record else v.shape, dtype=np.int64))
    padded = lambda v: -(-width(v) // 4) * 4
    step = width(of_record[0]) if len(of_record) == 1 else sum(map(padded, of_record))
    for v in header.variables:
        if v.kind == "S1":
            continue
        if v.by_record:
            rows = (np.frombuffer(data, v.kind, width(v) // np.dtype(v.kind).itemsize, v.begin + i * step) for i in range(header.records))
            raw = np.concatenate([np.zeros(0, v.kind), *rows])
            v = v._replace(shape=[header.records, *v.shape[1:]])
        else:
            raw = np.frombuffer(data, v.kind, width(v) // np.dtype(v.kind).itemsize, v.begin)
        values = raw.astype(np.float64)
        for name in ("_FillValue", "missing_value"):
            if v.attributes.get(name):
                values[raw == np.array(v.attributes[name][0]).astype(v.kind)] = np.nan
        scale, shift = (v.attributes.get(name, [default])[0] for name, default in (("scale_factor", 1.0), ("add_offset", 0.0)))
        yield v, values * scale + shift


_BLOCK = pa.schema(
    [("path", pa.string()), ("variable", pa.string()), ("units", pa.string()), ("dimensions", pa.list_(pa.string())), ("shape", pa.list_(pa.int64())), ("first", pa.int64()), ("values", pa.list_(pa.float64())), ("error", pa.string())]
)


def _decoded(block_values: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                try:
                    for v, values in variables(content.as_py() or b""):
                        units = v.attributes.get("units", "")
                        for first in range(0, max(1, len(values)), block_values):
                            row = (path, v.name, units if isinstance(units, str) else "", v.dimensions, v.shape, first, values[first : first + block_values].tolist(), None)
                            yield pa.RecordBatch.from_pylist([dict(zip(_BLOCK.names, row))], schema=_BLOCK)
                except (ValueError, KeyError, IndexError, struct.error) as e:
                    yield pa.RecordBatch.from_pylist([{"path": path, "error": str(e) or type(e).__name__}], schema=_BLOCK)

    return rows


def grid_blocks(documents: DataFrame, block_values: int = BLOCK_VALUES) -> DataFrame:
    """Files (path, content) to (path, variable, units, dimensions, shape, first, values, error): values of every numeric variable in blocks.

    ``first`` is the flat place of a block's first value, in row-major order of ``shape``. A file that cannot be read is
    one row with its error; a null content is such a file.
    """
    schema = "path string, variable string, units string, dimensions array<string>, shape array<long>, first long, values array<double>, error string"
    return documents.select("path", "content").mapInArrow(_decoded(block_values), schema)


# Parts of the names of variables, and the unit that is meant where a file names none.
WANTED = {"temperature_c": (["t2m", "temperature"], "K"), "precipitation_mm_day": (["tp", "precipitation"], "m")}


def spatial_means(blocks: DataFrame, wanted: dict[str, tuple[list[str], str]] | None = None) -> DataFrame:
    """(path, quantity, mean, cells) of the known values of each file's variable for a quantity, in usual units.

    ``wanted`` gives a quantity the parts of variables' names, in lower case, and its unit where the file has none. A variable
    whose name is one of the parts goes first, others by name. Means are put together from sums of blocks.
    """
    known = F.filter("values", lambda v: v.isNotNull() & ~F.isnan(v))
    total = F.aggregate(known, F.lit(0.0), lambda a, v: a + v)
    out = None
    for quantity, (names, unit) in (wanted or WANTED).items():
        low = F.lower("variable")
        fits = low.isin(names) | F.exists(F.lit(names), lambda n: F.contains(low, n))
        sums = blocks.where(F.col("error").isNull() & fits).groupBy("path", "variable", "units").agg(F.sum(total).alias("total"), F.sum(F.size(known)).alias("cells"))
        order = F.struct((~F.lower("variable").isin(names)).alias("far"), F.col("variable"))
        best = sums.groupBy("path").agg(F.min_by(F.struct("units", "total", "cells"), order).alias("b"))
        units = F.when(F.trim("b.units") == "", unit).otherwise(F.coalesce("b.units", F.lit(unit)))
        mean = in_usual_units(F.try_divide("b.total", "b.cells"), units)
        part = best.select("path", F.lit(quantity).alias("quantity"), mean.alias("mean"), F.col("b.cells").cast("long").alias("cells"))
        out = part if out is None else out.unionByName(part)
    return out


def in_usual_units(value: Column, units: Column) -> Column:
    """Kelvin as degrees Celsius, metres as millimetres; other units as they are."""
    unit = F.lower(F.trim(units))
    return F.when(unit.isin("k", "kelvin"), value - 273.15).when(unit.isin("m", "m of water equivalent", "m day-1", "m/day"), value * 1000).otherwise(value)
