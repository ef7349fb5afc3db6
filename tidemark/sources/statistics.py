"""Statistical exchange formats as DataFrames: SDMX in XML, CSV and JSON, JSON-stat cubes, and RSS.

What is parsed passes ``explode_outer`` before any condition on it: Spark tests before an ``explode`` whether there is an element, and
moves conditions below what they test, and would parse each document once more for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.arrays import bound

_VALUE = "struct<_id:string,_value:string>"
_SERIES = (
    f"struct<SeriesKey:struct<Value:array<{_VALUE}>>,Attributes:struct<Value:array<{_VALUE}>>,"
    f"Obs:array<struct<ObsDimension:struct<_value:string>,ObsValue:struct<_value:string>>>>"
)
# Fields of SDMX-CSV that are no dimensions, and the names of the five dimensions in order of preference.
CSV_ATTRIBUTES = ["OBS_STATUS", "DECIMALS", "OBS_CONF", "UNIT_MULT"]
TIME_KEYS, VALUE_KEYS = ["TIME_PERIOD", "TIME"], ["OBS_VALUE", "OBS_VALUE_NUMERIC"]
ALIASES = {
    "dataset": ["DATAFLOW", "DATAFLOW_ID"],
    "indicator": ["INDICATOR", "MEASURE", "KEY"],
    "unit": ["UNIT_MEASURE", "UNIT"],
    "territory": ["REF_AREA", "GEO"],
    "method_id": ["METHODOLOGY", "METHODOLOGY_ID"],
}


def _without_prefixes(xml: Column) -> Column:
    """Tags without their name-space prefixes; what stands in CDATA is text and stays."""
    tags = lambda part: F.regexp_replace(F.regexp_replace(part, r"<(/?)[A-Za-z0-9_.\-]+:", "<$1"), r"\sxmlns(:\w+)?=\"[^\"]*\"", "")
    opened = F.split(xml, r"<!\[CDATA\[")
    rest = F.transform(
        F.slice(opened, 2, F.greatest(F.size(opened) - 1, F.lit(0))),
        lambda part: F.concat(F.lit("<![CDATA["), F.substring_index(part, "]]>", 1), F.when(F.contains(part, F.lit("]]>")), F.lit("]]>")).otherwise(""), tags(F.substr(part, F.length(F.substring_index(part, "]]>", 1)) + 4))),
    )
    return F.when(F.contains(xml, F.lit("<![CDATA[")), F.concat(tags(F.get(opened, F.lit(0))), F.array_join(rest, ""))).otherwise(tags(xml))


def sdmx_xml(documents: DataFrame, content: str = "text") -> DataFrame:
    """(…, series, dims map, period, value) of each numeric observation of generic SDMX-ML; other columns are kept.

    The series of a document are parsed together, and one by one only where that does not give as many: a broken one then leaves the others.
    """
    rest = [c for c in documents.columns if c != content]
    body = F.regexp_extract_all(_without_prefixes(F.col(content)), F.lit(r"(?s)(<Series[\s>].*?</Series>)"), F.lit(1))
    options = {"valueTag": "_text"}

    def parsed(bodies: Column) -> Column:
        whole = F.from_xml(F.concat(F.lit("<All>"), F.array_join(bodies, ""), F.lit("</All>")), f"struct<Series:array<{_SERIES}>>", options)["Series"]
        return bound(whole, lambda found: F.when(F.size(found) == F.size(bodies), found).otherwise(F.transform(bodies, lambda one: F.from_xml(one, _SERIES, options))))

    def first_values(both: Column) -> Column:
        known = F.filter(both, lambda v: v["_id"].isNotNull() & v["_value"].isNotNull())
        return bound(known, lambda k: F.filter(k, lambda v, i: (i == 0) | ~F.exists(F.slice(k, 1, i), lambda u: u["_id"] == v["_id"])))

    series = documents.select(*rest, F.posexplode_outer(bound(body, parsed)).alias("series", "_s"))
    both = F.concat(F.coalesce("_s.SeriesKey.Value", F.array()), F.coalesce("_s.Attributes.Value", F.array()))
    dims = F.map_from_entries(F.transform(first_values(both), lambda v: F.struct(v["_id"], v["_value"])))
    rows = series.select(*rest, "series", dims.alias("dims"), F.col("_s.Obs").alias("_obs")).select(*rest, "series", "dims", F.explode_outer("_obs").alias("_o"))
    return rows.select(*rest, "series", "dims", F.col("_o.ObsDimension._value").alias("period"), F.col("_o.ObsValue._value").try_cast("double").alias("value")).where(
        "period is not null and value is not null"
    )


def with_dimensions(rows: DataFrame, dims: str = "dims") -> DataFrame:
    """Adds the five comparison dimensions out of a map, each by its first known name; empty where there is none."""
    get = lambda names: F.coalesce(*(F.when(F.col(dims)[n] != "", F.col(dims)[n]) for n in names), F.lit(""))
    return rows.withColumns({k: get(names) for k, names in ALIASES.items()})


def sdmx_csv(table: DataFrame) -> DataFrame:
    """A table read with a header to (dims map, notes, period, value), by the first time and value keys that it has."""
    time = next((c for c in TIME_KEYS if c in table.columns), None)
    value = next((c for c in VALUE_KEYS if c in table.columns), None)
    if not time or not value:
        raise ValueError("unsupported_schema")
    names = [c for c in table.columns if c not in {time, value, *CSV_ATTRIBUTES}]
    dims = F.create_map(*(x for c in names for x in (F.lit(c), F.coalesce(F.col(c), F.lit("")))))
    notes = F.concat_ws(" ", *(F.col(c) for c in ("COMMENT_OBS", "BREAK_IN_SERIES") if c in names))
    return table.select(dims.alias("dims"), notes.alias("notes"), F.col(time).alias("period"), F.col(value).alias("value"))


_DIMENSION = "struct<id:string,values:array<struct<id:string>>>"
_INDEXED = (
    f"struct<dataflow:string,structure:struct<dimensions:struct<series:array<{_DIMENSION}>,observation:array<{_DIMENSION}>>>,"
    "dataSets:array<struct<series:map<string,struct<observations:map<string,array<double>>>>>>>"
)


def sdmx_json_indexed(documents: DataFrame, content: str = "text") -> DataFrame:
    """(…, dims map, period, value) of SDMX-JSON whose keys index its structure; keys that do not resolve are left out.

    Keys are resolved where their document is, so that its structure is not copied for each of its observations.
    """
    rest = [c for c in documents.columns if c != content]
    doc = documents.select(*rest, F.from_json(content, _INDEXED).alias("_d"))
    dims = F.col("_d.structure.dimensions.series")
    times = F.col("_d.structure.dimensions.observation")
    flow = F.map_filter(F.create_map(F.lit("DATAFLOW"), F.col("_d.dataflow")), lambda k, v: v.isNotNull())

    def named(names: Column, raw: Column) -> Column:
        whole = (F.size(names) == F.size(dims)) & F.forall(names, lambda n: n["v"].isNotNull())
        own = bound(F.map_from_entries(names), lambda m: F.map_concat(m, F.map_filter(flow, lambda k, v: ~F.map_contains_key(m, k))))
        return F.when(whole, F.struct(own.alias("dims"), raw.alias("raw")))

    def series(key: Column, observations: Column) -> Column:
        name = lambda p, i: bound(F.get(dims, i), lambda d: F.struct(d["id"].alias("k"), F.get(d["values"], p.try_cast("int"))["id"].alias("v")))
        return bound(F.transform(F.split(key, ":"), name), lambda names: named(names, observations))

    some = lambda values: F.filter(values, lambda v: v.isNotNull())
    found = F.transform(some(F.col("_d.dataSets")), lambda s: some(F.transform(F.map_entries(s["series"]), lambda e: series(e["key"], e["value"]["observations"]))))
    dated = lambda raw: F.transform(F.map_entries(raw), lambda o: F.struct(F.get(times[0]["values"], o["key"].try_cast("int"))["id"].alias("period"), F.get(o["value"], F.lit(0)).alias("value")))
    kept = lambda x: F.struct(x["dims"].alias("dims"), F.filter(dated(x["raw"]), lambda o: o["period"].isNotNull()).alias("found"))
    readable = (F.size(dims) > 0) & (F.size(times) == 1) & times[0]["id"].isin(TIME_KEYS)
    rows = doc.select(*rest, F.explode_outer(F.when(readable, F.transform(F.flatten(some(found)), kept))).alias("_s"))
    rows = rows.select(*rest, F.col("_s.dims").alias("dims"), F.explode_outer("_s.found").alias("_o")).where("_o is not null")
    return rows.select(*rest, "dims", "_o.period", "_o.value")


def sdmx_json_flat(documents: DataFrame, content: str = "text") -> DataFrame:
    """(…, five dimensions, notes, period, value) of flat observations; documents of another format give none."""
    rest = [c for c in documents.columns if c != content]
    item = "struct<dataset:string,indicator:string,unit:string,territory:string,method_id:string,period:string,value:double,notes:string,comment:string>"
    rows = documents.select(*rest, F.from_json(content, f"struct<format:string,observations:array<{item}>>").alias("_d"))
    rows = rows.where(F.col("_d.format").rlike(r"_sdmx_flat_v1$")).select(*rest, F.explode("_d.observations").alias("_o"))
    names = ["dataset", "indicator", "unit", "territory", "method_id"]
    return rows.select(
        *rest, *(F.coalesce(F.col(f"_o.{n}"), F.lit("")).alias(n) for n in names), F.concat_ws(" ", "_o.notes", "_o.comment").alias("notes"), "_o.period", "_o.value"
    )


def json_stat(documents: DataFrame, content: str = "text") -> DataFrame:
    """(…, coords map, value) of every cell of a JSON-stat cube: row-major places to coordinates by strides.

    A document is read once, its values as the text that stands there: only then is known whether they are a list or an object.
    Strides, and the labels of each dimension in the order of their places, are made once a cube.
    """
    rest = [c for c in documents.columns if c != content]
    shape = "struct<id:array<string>,size:array<int>,value:string,dimension:map<string,struct<category:struct<index:map<string,int>>>>>"
    cube = documents.select(*rest, F.from_json(content, shape).alias("_d"))
    given = F.col("_d.value")
    read = lambda kind: F.from_json(F.concat(F.lit('{"v":'), given, F.lit("}")), f"struct<v:{kind}>")["v"]
    flat = F.when(given.startswith("["), F.transform(read("array<double>"), lambda v, i: F.struct(i.alias("i"), v.alias("v")))).when(
        given.startswith("{"), F.transform(F.map_entries(read("map<string,double>")), lambda e: F.struct(e["key"].try_cast("int").alias("i"), e["value"].alias("v")))
    )
    sizes = F.col("_d.size")
    stride = lambda k: F.aggregate(F.slice(sizes, k + 2, F.size(sizes)), F.lit(1).cast("bigint"), lambda a, s: a * s)

    def labels(name: Column) -> Column:
        """The labels of a dimension by place, of several with the same one the first."""
        index = F.filter(F.map_entries(F.col("_d.dimension")[name]["category"]["index"]), lambda e: e["value"].isNotNull())
        in_order = F.sort_array(F.transform(index, lambda e, i: F.struct(e["value"].alias("place"), i.alias("i"), e["key"].alias("label"))))
        return bound(in_order, lambda o: F.filter(o, lambda e, i: (i == 0) | (F.get(o, i - 1)["place"] != e["place"])))

    def dimension(name: Column, k: Column) -> Column:
        return F.struct(name.alias("name"), stride(k).alias("stride"), F.element_at(sizes, k + 1).cast("bigint").alias("size"), labels(name).alias("labels"))

    shaped = cube.select(*rest, F.transform("_d.id", dimension).alias("_dims"), F.filter(flat, lambda c: c["i"].isNotNull() & c["v"].isNotNull()).alias("_flat"))
    cells = shaped.select(*rest, "_dims", F.explode_outer("_flat").alias("_cell")).where("_cell is not null")

    def label(found: Column, place: Column) -> Column:
        """Places mostly run from 0 without a gap; where not, the label is searched."""
        here = F.get(found, place)
        return F.when(here["place"] == place, here["label"]).otherwise(F.get(F.filter(found, lambda e: e["place"] == place), F.lit(0))["label"])

    def entry(d: Column) -> Column:
        place = F.pmod(F.floor(F.col("_cell.i") / d["stride"]), d["size"]).cast("int")
        return F.struct(d["name"].alias("k"), bound(place, lambda p: label(d["labels"], p)).alias("v"))

    return cells.select(*rest, F.map_from_entries(F.transform("_dims", entry)).alias("coords"), F.col("_cell.v").alias("value"))


def rss_items(feeds: DataFrame, content: str = "text", most: int | None = 18) -> DataFrame:
    """(…, n, title, url, summary, published_raw) of the first ``most`` items of each feed that have a title and a link, None for all.

    ``n`` counts those items from 0 in the order of the feed.
    """
    rest = [c for c in feeds.columns if c != content]
    items = F.regexp_extract_all(F.col(content), F.lit(r"(?s)(<item[\s>].*?</item>)"), F.lit(1))
    fields = "struct<title:string,link:string,description:string,pubDate:string>"
    trimmed = lambda text: F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")

    def item(xml: Column) -> Column:
        names = (("title", "title"), ("link", "url"), ("description", "summary"), ("pubDate", "published_raw"))
        return bound(F.from_xml(_without_prefixes(xml), fields), lambda read: F.struct(*(trimmed(read[x]).alias(y) for x, y in names)))

    good = F.filter(F.transform(items, item), lambda i: (i["title"] != "") & (i["url"] != ""))
    kept = feeds.select(*rest, good.alias("_good"))
    rows = kept.select(*rest, F.posexplode(F.col("_good") if most is None else F.slice("_good", 1, most)).alias("_n", "_i"))
    return rows.select(*rest, F.col("_n").alias("n"), *(F.col(f"_i.{c}").alias(c) for c in ("title", "url", "summary", "published_raw")))


def years_to_rows(table: DataFrame, keys: list[str], pattern: str = r"^V?((?:19|20)\d{2})(?:\.0+)?$", value: str = "value") -> DataFrame:
    """Wide tables with a column per year to (keys, year, value): the year columns are found by name."""
    import re

    years = {c: int(m[1]) for c in table.columns if (m := re.match(pattern, c))}
    if not years:
        raise ValueError("no year columns")
    long = table.unpivot([F.col(f"`{k}`") for k in keys], [F.col(f"`{c}`").cast("string").alias(str(y)) for c, y in years.items()], "year", value)
    return long.withColumn("year", F.col("year").cast("int"))
