"""WARC archives and revisit resolution.

Pages become response records in gzip archives, one or more a partition. The headers of all records
are shuffled by payload digest; of equal payloads the record with the smallest page id stays a
response, and the others are joined to it. The archives are then written anew, record by record, with
fresh headers: revisit records name the response they repeat and hold no payload. Only headers are
ever shuffled, payloads stay where they are.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import col, qualified, scratch, spread_join, stored, trimmed
from tidemark.llm._files import opened, put

#: Payload and header bytes, and records, after which a task starts another archive.
ARCHIVE_BYTES = 64 << 20
ARCHIVE_RECORDS = 50_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = "path string, number long, page_id long, url string, type string, digest string, payload_bytes long, record_id string, refers_to_record string"
_TYPES = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 3, pa.int64(), pa.string(), pa.string()]
_NAMES = [f.split()[0] for f in HEADERS.split(", ")]


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in [*fields, ("Content-Length", str(len(block)))]]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n") + packer.flush()


def _line(text: str | None) -> str:
    """A header value: line ends and edges would not come back."""
    return " ".join((text or "").split())


def response_record(page_id: int | None, url: str | None, payload: bytes, date: str, record_id: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    return _record(
        [
            ("WARC-Type", "response"),
            ("WARC-Record-ID", f"<{record_id}>"),
            ("WARC-Date", date),
            ("WARC-Target-URI", _line(url)),
            ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
            *([("X-Page-ID", str(page_id))] if page_id is not None else []),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        http + payload,
    )


def revisit_record(header: dict, original: dict, date: str) -> bytes:
    return _record(
        [
            ("WARC-Type", "revisit"),
            ("WARC-Record-ID", f"<{header['record_id']}>"),
            ("WARC-Date", date),
            ("WARC-Target-URI", _line(header["url"])),
            ("WARC-Profile", PROFILE),
            ("WARC-Payload-Digest", f"sha1:{header['digest']}"),
            ("WARC-Refers-To", f"<{original['record_id']}>"),
            ("WARC-Refers-To-Target-URI", _line(original["url"])),
            ("WARC-Refers-To-Date", date),
            *([("X-Page-ID", str(header["page_id"]))] if header["page_id"] is not None else []),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n",
    )


def records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an archive, read member by member."""
    with opened(uri) as file:
        rest = file.read(1 << 16)
        while rest:
            member, parts = zlib.decompressobj(31), []
            while not member.eof:
                if not rest:
                    raise ValueError(f"{uri} ends inside a record")
                parts.append(member.decompress(rest))
                rest = member.unused_data if member.eof else file.read(1 << 16)
            rest = rest or file.read(1 << 16)
            data = b"".join(parts)
            end = data.index(b"\r\n\r\n")
            lines = data[:end].decode().split("\r\n")
            fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
            yield fields, data[end + 4 : end + 4 + int(fields["Content-Length"])]


def _header(uri: str, number: int, fields: dict[str, str], block: bytes) -> tuple:
    payload = None
    if fields["WARC-Type"] == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if f"sha1:{payload_digest(payload)}" != fields["WARC-Payload-Digest"]:
            raise ValueError(f"record {number} of {uri} is damaged")
    page = fields.get("X-Page-ID")
    return (
        uri,
        number,
        None if page is None else int(page),
        fields["WARC-Target-URI"],
        fields["WARC-Type"],
        fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        None if payload is None else len(payload),
        fields["WARC-Record-ID"].strip("<>"),
        fields["WARC-Refers-To"].strip("<>") if "WARC-Refers-To" in fields else None,
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)], names=_NAMES)


def _archive(root: str, date: str, archive_bytes: int, crawl: str):
    """Record ids follow from the crawl and the record's place: a task that runs again gives the same ones, another crawl does not."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        pages = ((p, u, (h or "").encode()) for b in batches for p, u, h in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html"))))
        page, archive = next(pages, None), 0
        while page is not None:
            path, headers = f"{root}/pages-{task:06d}-{archive:04d}.warc.gz", []

            def parts():
                nonlocal page
                size = 0
                while page is not None and size < archive_bytes and len(headers) < ARCHIVE_RECORDS:
                    name, url, payload = page
                    record_id = f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{crawl}/{task}/{archive}/{len(headers)}')}"
                    headers.append((path, len(headers), name, _line(url), "response", payload_digest(payload), len(payload), record_id, None))
                    size += len(payload) + len(url or "") + 512
                    yield response_record(name, url, payload, date, record_id)
                    page = next(pages, None)

            put(path, parts())
            archive += 1
            yield _batch(headers)

    return run


def write_archives(pages: DataFrame, page_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2026-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES, path: str | None = None) -> DataFrame:
    """Writes every page as a response record and gives the headers of all records."""
    root = qualified(pages.sparkSession, path) if path else scratch(pages.sparkSession, "warc")
    rows = pages.select(col(page_col).cast("long").alias("page_id"), col(url_col).cast("string").alias("url"), col(html_col).alias("html"))
    return stored(rows.mapInArrow(_archive(root, date, archive_bytes, uuid.uuid4().hex), HEADERS), "headers")


def resolve_revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(path, number, original) of records that repeat another; original has its record_id, url and page_id.

    Of equal payloads of at least ``min_bytes`` the smallest page id is the original, a missing id
    coming last and the earlier record first.
    """
    eligible = headers.where(F.col("payload_bytes") >= min_bytes)
    order = F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "path", "number", "record_id", "url")
    originals = eligible.groupBy("digest", "payload_bytes").agg(F.min(order).alias("original"), F.count("*").alias("rows")).where("rows > 1")
    found = spread_join(eligible, stored(originals, "originals"), ["digest", "payload_bytes"], "rows")
    return found.where(F.col("record_id") != F.col("original.record_id")).select(
        "path", "number", F.struct("original.record_id", "original.url", "original.page_id").alias("original")
    )


def _rewrite(root: str, date: str):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, found in zip(batch.column("path").to_pylist(), batch.column("repeats").to_pylist()):
                originals = {r["number"]: r["original"] for r in found or ()}
                path = f"{root}/{source.rsplit('/', 1)[1]}"

                def parts():
                    for number, (fields, block) in enumerate(records(source)):
                        head = dict(zip(_NAMES, _header(source, number, fields, block)))
                        if number in originals:
                            yield revisit_record(head, originals[number], date)
                        else:
                            yield response_record(head["page_id"], head["url"], block[block.index(b"\r\n\r\n") + 4 :], date, head["record_id"])

                put(path, parts())
                yield pa.RecordBatch.from_arrays([pa.array([path])], names=["path"])

    return run


def write_deduplicated(headers: DataFrame, repeats: DataFrame, date: str = "2026-01-02T00:00:00Z", path: str | None = None) -> DataFrame:
    """Writes each archive anew and gives the paths of the new ones. An archive's repeats are bounded by its records."""
    root = qualified(headers.sparkSession, path) if path else scratch(headers.sparkSession, "warc_deduplicated")
    by_archive = repeats.groupBy("path").agg(F.collect_list(F.struct("number", "original")).alias("repeats"))
    archives = headers.select("path").distinct().join(by_archive, "path", "left")
    archives = stored(archives, "archives")
    return stored(archives.repartition(max(1, archives.count())).mapInArrow(_rewrite(root, date), "path string"), "archives")


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            rows = []
            for number, (fields, block) in enumerate(records(path)):
                rows.append(_header(path, number, fields, block))
                if len(rows) == 4096:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)


def read_archives(archives: DataFrame) -> DataFrame:
    """Headers of every record; payloads are checked against their digests on the way."""
    return archives.repartition(max(1, archives.count())).mapInArrow(_headers, HEADERS)


def deduplicated_archives(pages: DataFrame, page_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record read back.

    Null html counts as empty. Of equal payloads of at least ``min_bytes`` bytes one is a response,
    that with the smallest page id (the first of repeated rows, rows without an id last); refers_to is
    its page id. White space in urls is made single. An empty table gives an empty result. Other
    columns are ignored.
    """
    headers = write_archives(pages, page_col, url_col, html_col)
    archives = write_deduplicated(headers, resolve_revisits(headers, min_bytes))
    found = stored(read_archives(archives), "read_back")
    columns = "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to"
    responses, revisits = found.where("type = 'response'"), found.where("type = 'revisit'").drop("payload_bytes")
    named = revisits.groupBy("refers_to_record").agg(F.count("*").alias("rows"))
    original = responses.select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"), "payload_bytes")
    repeats = spread_join(revisits, stored(named.join(original, "refers_to_record"), "originals"), ["refers_to_record"], "rows")
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(repeats.select(*columns))
