"""Addresses by RFC 3986: parts, resolution of relative references, and the attachments that a page links to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.arrays import bound
from tidemark.functions.text import anchors, host

#: The expression of the RFC's appendix B.
_PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
#: Endings of files that hold tables.
TABLE_FILES = ["csv", "tsv", "xlsx", "xls", "ods", "json", "xml", "zip"]


def parts(address: Column) -> Column:
    """Struct (scheme, authority, path, query, fragment); a part that is not there is null, but for the path."""
    part = lambda i: F.regexp_extract(address, _PARTS, i)
    there = lambda pattern, i: F.when(address.rlike(pattern), part(i))
    return F.struct(
        F.when(address.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), part(1)).alias("scheme"),
        there(r"^(?:[^:/?#]+:)?//", 2).alias("authority"),
        part(3).alias("path"),
        there(r"^[^#?]*\?", 4).alias("query"),
        there("#", 5).alias("fragment"),
    )


def without_dots(path: Column) -> Column:
    """A path whose segments . and .. have been followed; .. does not leave the root."""

    def follow(done: Column, segment: Column, at_end: Column) -> Column:
        up = F.when((F.size(done) > 1) | ((F.size(done) == 1) & (F.get(done, F.lit(0)) != "")), F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(done)
        kept = F.when(segment == ".", done).when(segment == "..", up).otherwise(F.concat(done, F.array(segment)))
        return F.when(at_end & segment.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)

    empty = F.array().cast("array<string>")
    places = lambda s: F.transform(s, lambda x, i: F.struct(x.alias("x"), (i == F.size(s) - 1).alias("at_end")))
    return F.array_join(F.aggregate(bound(F.split(path, "/", -1), places), empty, lambda done, s: follow(done, s["x"], s["at_end"])), "/")


def resolved(base: Column, reference: Column) -> Column:
    """The address that a reference on a page of address ``base`` means; null where either is null."""
    return F.when(base.isNotNull() & reference.isNotNull(), bound(parts(base), lambda b: bound(parts(F.trim(reference)), lambda r: _resolved(b, r))))


def _resolved(b: Column, r: Column) -> Column:
    merged = F.when(b["authority"].isNotNull() & (b["path"] == ""), F.concat(F.lit("/"), r["path"])).otherwise(F.concat(F.regexp_replace(b["path"], "[^/]*$", ""), r["path"]))
    own = r["scheme"].isNotNull() | r["authority"].isNotNull()
    path = (
        F.when(own | F.startswith(r["path"], F.lit("/")), without_dots(r["path"]))
        .when(r["path"] == "", b["path"])
        .otherwise(without_dots(merged))
    )
    query = F.when(own | (r["path"] != ""), r["query"]).otherwise(F.coalesce(r["query"], b["query"]))
    after = lambda mark, part: F.when(part.isNotNull(), F.concat(F.lit(mark), part)).otherwise("")
    scheme, authority = F.coalesce(r["scheme"], b["scheme"]), F.when(own, r["authority"]).otherwise(b["authority"])
    return F.concat(F.when(scheme.isNotNull(), F.concat(scheme, F.lit(":"))).otherwise(""), after("//", authority), path, after("?", query), after("#", r["fragment"]))


def page_links(html: Column, base: Column) -> Column:
    """Distinct addresses that a page links to, in page order, relative ones resolved and without fragments."""
    bare = F.transform(anchors(html), lambda a: F.regexp_replace(resolved(base, F.replace(a, F.lit("&amp;"), F.lit("&"))), "#.*$", ""))
    return F.array_distinct(F.filter(bare, lambda a: a.isNotNull() & (a != "")))


def attachments(html: Column, base: Column, endings: list[str] | None = None, most: int | None = None) -> Column:
    """Files of a page's own host that it links to, by the ending of their path, in page order; ``most`` of them, None for all."""
    ending = rf"(?i)\.({'|'.join(endings or TABLE_FILES)})$"
    own = F.filter(page_links(html, base), lambda a: (host(a) == host(base)) & (host(a) != "") & parts(a)["path"].rlike(ending))
    return own if most is None else F.slice(own, 1, most)


def ranked(links: Column, words: list[str], most: int | None = None) -> Column:
    """Links by how many of the words their address holds, most first, equal ones in page order; ``most`` of them, None for all."""
    hits = lambda a: F.size(F.filter(F.lit(words), lambda w: F.contains(F.lower(a), F.lower(w))))
    placed = F.array_sort(F.transform(links, lambda a, i: F.struct((-hits(a)).alias("less"), i.alias("i"), a.alias("a"))))["a"]
    return placed if most is None else F.slice(placed, 1, most)
