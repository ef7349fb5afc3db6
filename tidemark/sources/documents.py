"""Documents as bytes or text: format sniffing, payload checks, and tables from CSV, JSON, HTML and XLSX.

Decoders that no Spark source offers (HTML tables, spreadsheets inside ZIP) run on Arrow batches with
the standard library; everything else is an expression. PDF, ODS, legacy XLS and NetCDF have no
decoder here: their rows say so.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.delimited import BATCH_SIZE, cells_of, cells_size, csv_cells  # noqa: F401

MOST_BYTES = 80 << 20
LEAST_BYTES = 16
CELLS = "array<array<string>>"
#: Rows after which a decoder hands on what it has, and BATCH_SIZE bytes likewise.
BATCH_ROWS = 2000


class Bounds(NamedTuple):
    """How much of a document is read; None reads all of it. What is left out is reported with the tables."""

    tables: int | None = 30
    table_rows: int | None = 160
    sheets: int | None = 30
    sheet_rows: int | None = 2000
    columns: int | None = 40


WHOLE = Bounds(None, None, None, None, None)


def text_of(content: Column) -> Column:
    """Bytes as UTF-8 text; what is none becomes the replacement character."""
    return F.make_valid_utf8(content.cast("string"))


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A table with a header, every column a string, empty instead of null; a missing column fails, and lines of white space alone are no rows."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).csv(path, sep="\t", header=True, enforceSchema=False, mode="FAILFAST").na.fill("")


def read_documents(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, content, length, sha256) of every file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content", "length", F.sha2("content", 256).alias("sha256"))


def magic(content: Column) -> Column:
    """Format by the first bytes, the text formats by their first characters."""
    head, text = F.hex(F.substring(content, 1, 8)), F.lower(F.ltrim(F.regexp_replace(text_of(F.substring(content, 1, 512)), r"^[\ufeff\s]+", "")))
    return (
        F.when(head.startswith("504B0304"), "zip")
        .when(head.startswith("D0CF11E0A1B11AE1"), "ole")
        .when(head.startswith("25504446"), "pdf")
        .when(head.startswith("89484446"), "hdf")
        .when(head.startswith("434446"), "netcdf")
        .when(F.startswith(text, F.lit("<?xml")) | F.startswith(text, F.lit("<rss")), "xml")
        .when(F.startswith(text, F.lit("<!doctype html")) | F.startswith(text, F.lit("<html")), "html")
        .when(F.startswith(text, F.lit("{")) | F.startswith(text, F.lit("[")), "json")
        .otherwise("text")
    )


def rejection(name: Column, content: Column) -> Column:
    """Why a payload is not what its name says; null where it is."""
    kind, extension = magic(content), F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    text = F.lower(text_of(F.substring(content, 1, 4096)))
    return (
        F.when(F.octet_length(content) < LEAST_BYTES, "too_small")
        .when(F.octet_length(content) > MOST_BYTES, "too_large")
        .when(kind == "pdf", "pdf")
        .when(F.contains(text, F.lit("serviceexceptionreport")), "service_exception")
        .when(F.contains(text, F.lit("<rss")), "rss")
        .when(extension.isin("csv", "tsv", "txt") & kind.isin("html", "xml"), "markup_instead_of_csv")
        .when(extension.isin("xlsx", "zip", "ods") & (kind != "zip"), "not_a_zip")
        .when((extension == "json") & (kind != "json"), "not_json")
    )


def is_public_https(url: Column) -> Column:
    """An https address of a host that is not private."""
    name = F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))
    private = name.isin("localhost", "127.0.0.1", "[::1]", "::1") | name.rlike(r"\.(localhost|local|internal)$")
    return (F.try_parse_url(url, F.lit("PROTOCOL")) == "https") & (name != "") & ~private


def json_cells(text: Column) -> Column:
    """The first table of a JSON document: its root list, or what stands under data or tables."""
    root = F.from_json(text, CELLS)
    under = F.from_json(text, f"struct<data:{CELLS}, tables:array<{CELLS}>>")
    return F.coalesce(F.when(F.ltrim(text).startswith("["), root), under["data"], F.get(under["tables"], F.lit(0)))


class _Tables(HTMLParser):
    def __init__(self):
        super().__init__()
        self.tables: list[tuple[str, list[list[str]]]] = []
        self.open: list[dict] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append({"caption": "", "rows": [], "cell": None, "in_caption": False})
        elif self.open:
            t = self.open[-1]
            if tag == "caption":
                t["in_caption"] = True
            elif tag == "tr":
                self._close_cell(t)
                t["rows"].append([])
            elif tag in ("td", "th"):
                self._close_cell(t)
                t["cell"] = ""

    def _close_cell(self, t):
        if t["cell"] is not None:
            if not t["rows"]:
                t["rows"].append([])
            t["rows"][-1].append(" ".join(t["cell"].split()))
            t["cell"] = None

    def handle_endtag(self, tag):
        if not self.open:
            return
        t = self.open[-1]
        if tag in ("td", "th", "tr"):
            self._close_cell(t)
        elif tag == "caption":
            t["in_caption"] = False
        elif tag == "table":
            self._close_cell(t)
            self.tables.append((t["caption"].strip(), [r for r in t["rows"] if r]))
            self.open.pop()

    def handle_data(self, data):
        if self.open:
            t = self.open[-1]
            if t["in_caption"]:
                t["caption"] += data
            elif t["cell"] is not None:
                t["cell"] += data


#: A tag with quoted attributes at most, and the elements whose content is not markup.
_SIMPLE_TAG = re.compile(r'<(/[A-Za-z][A-Za-z0-9]*|[A-Za-z][A-Za-z0-9]*(?=[ \n>]))(?:[ \n]+[A-Za-z][A-Za-z0-9-]*="[^"<>]*")*>')
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext", "svg", "math"}


def html_tables(text: str, bounds: Bounds = Bounds()) -> tuple[list[tuple[str, list[list[str]], int]], int]:
    """(caption, cells, rows left out) of the tables of a page, and how many tables are left out."""
    parser = _Tables()
    parts = _SIMPLE_TAG.split(text.removeprefix("<!DOCTYPE html>"))
    if any("<" in part for part in parts[::2]) or not _RAW.isdisjoint(map(str.lower, parts[1::2])):
        parser.feed(text)
        parser.close()
    else:  # nothing but plain tags and text: the parts are what the parser would tell
        parser.handle_data(unescape(parts[0]))
        for tag, data in zip(parts[1::2], parts[2::2]):
            tag = tag.lower()
            if tag[0] == "/":
                parser.handle_endtag(tag[1:])
            else:
                parser.handle_starttag(tag, ())
            if data:
                parser.handle_data(unescape(data))
    while parser.open:
        parser.handle_endtag("table")
    found = [(caption[:160], cells[: bounds.table_rows], len(cells) - len(cells[: bounds.table_rows])) for caption, cells in parser.tables[: bounds.tables]]
    return found, len(parser.tables) - len(found)


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_CELL, _VALUE = f"{_NS}c", f"{_NS}v"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


@lru_cache(4096)
def _letters_index(letters: str) -> int:
    n = 0
    for letter in re.match("[A-Z]*", letters)[0]:
        n = n * 26 + ord(letter) - 64
    return n - 1


def column_index(reference: str) -> int:
    """0 for A1, 26 for AA1."""
    return _letters_index(reference.rstrip("0123456789"))


def xlsx_sheets(content: bytes, bounds: Bounds = Bounds(), only: str | None = None) -> tuple[list[tuple[str, list[list[str]], int]], int]:
    """(name, cells, rows left out or cut) of the sheets of a workbook, or the ``only`` ones of a name, read as the ZIP of XML that it is, and how many sheets are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        sheets = ET.fromstring(book.read("xl/workbook.xml")).findall(f"{_NS}sheets/{_NS}sheet")
        wanted = [sheet for sheet in sheets[: bounds.sheets] if only is None or sheet.get("name", "") == only]
        shared = []
        if wanted and "xl/sharedStrings.xml" in names:
            for item in ET.fromstring(book.read("xl/sharedStrings.xml")).findall(f"{_NS}si"):
                shared.append("".join(t.text or "" for t in item.iter(f"{_NS}t")))
        targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        out = []
        for sheet in wanted:
            target = targets[sheet.get(_REL)].lstrip("/")
            root = ET.fromstring(book.read(target if target.startswith("xl/") else f"xl/{target}"))
            cells = []
            rows = root.findall(f"{_NS}sheetData/{_NS}row")
            cut = len(rows) - len(rows[: bounds.sheet_rows])
            for row in rows[: bounds.sheet_rows]:
                line: list[str] = []
                wide = False
                for i, cell in enumerate(row.findall(_CELL)):
                    place = column_index(cell.get("r", "")) if cell.get("r") else i
                    if bounds.columns is not None and place >= bounds.columns:
                        wide = True
                        continue
                    line += [""] * (place + 1 - len(line))
                    value = cell.find(_VALUE)
                    if cell.get("t") == "inlineStr":
                        line[place] = "".join(t.text or "" for t in cell.iter(f"{_NS}t"))
                    elif value is not None:
                        line[place] = shared[int(value.text)] if cell.get("t") == "s" else value.text or ""
                cells.append(line)
                cut += wide
            out.append((sheet.get("name", ""), cells, cut))
        return out, len(sheets) - len(sheets[: bounds.sheets])


def unzipped(content: bytes, wanted: str, depth: int = 2) -> Iterator[tuple[str, bytes]]:
    """(name, content) of the members whose name matches, also of ZIPs inside the ZIP."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for member in archive.namelist():
            if re.search(wanted, member, re.I):
                yield member, archive.read(member)
            elif depth > 1 and member.lower().endswith(".zip"):
                for name, data in unzipped(archive.read(member), wanted, depth - 1):
                    yield f"{member}/{name}", data


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of batches one by one, so that no batch is held as Python objects too."""
    for batch in batches:
        columns = batch.columns
        for i in range(batch.num_rows):
            yield tuple(column[i].as_py() for column in columns)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Rows as record batches that end at BATCH_ROWS rows or BATCH_SIZE bytes, whichever comes first."""
    kept, held = [], 0
    made = lambda: pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*kept), schema)], schema=schema)
    for row in rows:
        kept.append(row)
        held += size(row)
        if len(kept) >= BATCH_ROWS or held >= BATCH_SIZE:
            yield made()
            kept, held = [], 0
    if kept:
        yield made()


def _member_rows(wanted: str, depth: int):
    schema = pa.schema([("path", pa.string()), ("content", pa.binary()), ("error", pa.string()), ("archive", pa.string()), ("place", pa.int32())])

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for path, content in _documents(batches):
            try:
                for place, (member, data) in enumerate(unzipped(content or b"", wanted, depth)):
                    yield f"{path}/{member}", data, None, path, place
            except (zipfile.BadZipFile, RuntimeError, NotImplementedError) as e:
                yield path, None, type(e).__name__, path, None

    return lambda batches: _batched(members(batches), schema, lambda row: len(row[1] or b""))


def zip_members(documents: DataFrame, wanted: str = "", depth: int = 2) -> DataFrame:
    """Archives (path, content) to their members (path, content, error, archive, place) by name, also of ZIPs inside; one that cannot be read is a row with its error."""
    return documents.select("path", "content").mapInArrow(_member_rows(wanted, depth), "path string, content binary, error string, archive string, place int")


def chosen_members(documents: DataFrame, wanted: str, preferred: str, depth: int = 2) -> DataFrame:
    """Of each archive the first member whose name matches ``preferred``, or else ``wanted``; archives that cannot be read keep their row."""
    members = zip_members(documents, wanted, depth)
    name = F.substr("path", F.length("archive") + 2)
    order = F.struct((~name.rlike(f"(?i){preferred}")).alias("other"), F.coalesce("place", F.lit(0)).alias("place"))
    best = members.groupBy("archive").agg(F.min_by(F.struct("path", "content", "error"), order).alias("m"))
    return best.select("m.path", "m.content", "m.error", "archive")


def _sheet_rows(sheet: str, bounds: Bounds, depth: int):
    schema = pa.schema([("archive", pa.string()), ("place", pa.int32()), ("path", pa.string()), ("cells", pa.list_(pa.list_(pa.string()))), ("cut", pa.int64())])

    def named(path: str, content: bytes) -> Iterator[tuple]:
        for place, (member, data) in enumerate(unzipped(content, r"\.xlsx$", depth)):
            try:
                found, _ = xlsx_sheets(data, bounds, sheet)
            except (KeyError, ValueError, zipfile.BadZipFile, ET.ParseError):
                continue
            if found:
                yield path, place, f"{path}/{member}", *found[0][1:]
                return

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for path, content in _documents(batches):
            try:
                yield from named(path, content or b"")
            except (zipfile.BadZipFile, RuntimeError, NotImplementedError):
                pass

    return lambda batches: _batched(rows(batches), schema, lambda row: cells_size(row[3]))


def books_with_sheet(documents: DataFrame, sheet: str, bounds: Bounds = Bounds(), depth: int = 2) -> DataFrame:
    """Of each archive the cells of the first workbook, also in ZIPs inside, that has a sheet of that name: (archive, path, cells, cut).

    Workbooks after it are not decoded; those that cannot be read have no sheets.
    """
    found = documents.select("path", "content").mapInArrow(_sheet_rows(sheet, bounds, depth), f"archive string, place int, path string, cells {CELLS}, cut long")
    best = found.groupBy("archive").agg(F.min_by(F.struct("path", "cells", "cut"), "place").alias("b"))
    return best.select("archive", "b.path", "b.cells", "b.cut")


def _decoder(bounds: Bounds):
    schema = pa.schema(
        [("source_url", pa.string()), ("location", pa.string()), ("unit_hint", pa.string()), ("cells", pa.list_(pa.list_(pa.string()))), ("error", pa.string()), ("cut", pa.int64()), ("json", pa.string())]
    )

    def tables(path: str, kind: str, text: str | None, content: bytes | None) -> Iterator[tuple]:
        if kind == "json":
            yield path, "json:1", "", None, None, 0, text
        elif kind in ("csv", "tsv", "text"):
            yield path, f"{kind}:1", "", cells_of(text), None, 0, None
        elif kind in ("html", "xlsx"):
            try:
                found, beyond = html_tables((content or b"").decode("utf-8", "replace"), bounds) if kind == "html" else xlsx_sheets(content or b"", bounds)
            except (KeyError, ValueError, zipfile.BadZipFile, ET.ParseError) as e:
                yield path, f"{kind}:1", "", [], type(e).__name__, 0, None
                return
            for i, (hint, cells, cut) in enumerate(found):
                yield path, f"{kind}:{i + 1}", hint, cells, None, cut, None
            if beyond:
                yield path, f"{kind}:{len(found) + 1}", "", None, "left_out", beyond, None
        else:
            yield path, f"{kind}:0", "", None, "unsupported_format", 0, None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for document in _documents(batches):
            yield from tables(*document)

    return lambda batches: _batched(rows(batches), schema, lambda row: cells_size(row[3]) + len(row[6] or ""))


def document_tables(documents: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """Documents (path, content) to tables (source_url, location, unit_hint, cells, error, cut), by extension and first bytes.

    A document that cannot be read gives one row with its error. ``cut`` counts the rows of a table beyond ``bounds``;
    tables beyond them are one row with the error left_out and their number. ``WHOLE`` leaves nothing out.
    Every format is decoded in one pass, so that what made the documents runs once.
    """
    extension = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)(?:$|[?#])", 1))
    kind = (
        F.when(extension == "htm", "html")
        .when(extension.isin("csv", "tsv", "json", "html", "xlsx", "xls", "pdf", "ods"), extension)
        .when(magic(F.col("content")) == "zip", "xlsx")
        .otherwise(F.coalesce(magic(F.col("content")), F.lit("text")))
    )
    rows = documents.select("path", "content", kind.alias("kind"))
    text = F.when(F.col("kind").isin("csv", "tsv", "text", "json"), F.coalesce(text_of(F.col("content")), F.lit("")))
    raw = F.when(F.col("kind").isin("html", "xlsx"), F.col("content"))
    found = rows.select("path", "kind", text.alias("text"), raw.alias("content")).mapInArrow(
        _decoder(bounds), f"source_url string, location string, unit_hint string, cells {CELLS}, error string, cut long, json string"
    )
    listed = F.col("json").isNotNull()
    found = found.withColumns({"cells": F.when(listed, json_cells(F.col("json"))).otherwise(F.col("cells")), "unit_hint": F.when(listed, F.coalesce(F.get_json_object("json", "$.unit"), F.lit(""))).otherwise(F.col("unit_hint"))})
    error = F.when(listed & F.col("cells").isNull(), "no_table").otherwise(F.col("error"))
    return found.select("source_url", "location", "unit_hint", "cells", error.alias("error"), "cut")


def write_tsv(rows: DataFrame, path: str) -> None:
    """One file with a header; arrays are joined by bars. The rows of a published feed fit one task."""
    flat = [F.array_join(f.name, "|").alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in rows.schema]
    rows.select(*flat).coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="")
