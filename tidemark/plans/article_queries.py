"""Links, names and the verification of claims over pages, texts and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import links as L
from tidemark.functions import classes as C
from tidemark.functions import numbers as N
from tidemark.functions import text as T
from tidemark.operators import evidence as V
from tidemark.operators import names as M
from tidemark.operators import series as S
from tidemark.operators import verification as W
from tidemark.plans.facts import ordered_means, placed, table, written
from tidemark.sources import documents as D

QUERIES, SQL = {}, {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def _text(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


# --- links ---------------------------------------------------------------------------------------


@query(
    r"""WITH a AS (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]+)"', 1) AS l FROM pages),
u AS (SELECT page_id, url, list_distinct(l) AS d, l FROM a),
r AS (SELECT page_id, unnest(list_filter(l, lambda x, i: list_position(l, x) = i)) AS href, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS root FROM u)
SELECT page_id, count(*) AS n_links, string_agg(DISTINCT root || replace(href, '&amp;', '&'), ' ' ORDER BY root || replace(href, '&amp;', '&')) AS links FROM r GROUP BY page_id"""
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses that each page links to, resolved against its own."""
    found = table(spark, sf_dir, "pages").select("page_id", L.page_links(F.col("html"), F.col("url")).alias("l")).where(F.size("l") > 0)
    return found.select("page_id", F.size("l").cast("long").alias("n_links"), F.array_join(F.array_sort("l"), " ").alias("links"))


@query(
    """WITH y AS (SELECT l_suppkey AS supplier, l_returnflag AS flag, avg(l_discount) FILTER (year(l_shipdate) = 1999) * 100 AS a, avg(l_discount) FILTER (year(l_shipdate) = 2000) * 100 AS b FROM lineitem GROUP BY 1, 2)
SELECT supplier, 'rate of flag ' || flag AS indicator, CAST(printf('%.3f', CAST(printf('%.2f', b) AS DOUBLE) - CAST(printf('%.2f', a) AS DOUBLE)) AS DOUBLE) AS delta FROM y WHERE a IS NOT NULL AND b IS NOT NULL"""
)
def attachment_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence in the tables that pages of suppliers link to: by relative address, of the same host, as files of cells."""
    lines = placed(spark, sf_dir, "lineitem")
    year = lambda y: F.when(F.year("l_shipdate") == y, F.col("l_discount"))
    shown = lambda c: F.coalesce(F.replace(F.format_string("%.2f", N.exact_round(F.col(c) * 100, 2)), F.lit("."), F.lit(",")), F.lit(".."))
    rates = ordered_means(lines, [F.col("l_suppkey").alias("k"), F.col("l_returnflag")], a=year(1999), b=year(2000)).withColumns({"a": shown("a"), "b": shown("b")})
    row = _text('"rate of flag ', F.col("l_returnflag"), '";', F.col("a"), ";", F.col("b"))
    files = rates.groupBy("k").agg(F.array_join(F.array_sort(F.collect_list(row)), "\r\n").alias("body"))
    files = files.select(_text("https://stat.example.org/tables/", F.col("k"), ".csv").alias("path"), F.encode(_text("Share (%);1999;2000\r\n", F.col("body")), "UTF-8").alias("content"))
    page = _text('<a href="../../tables/./', F.col("s_suppkey"), '.csv?v=1#top">table</a><a href="//other.example.com/tables/1.csv">', 'elsewhere</a><a href="notes.pdf">notes</a>')
    pages = table(spark, sf_dir, "supplier").select("s_suppkey", page.alias("html"), _text("https://stat.example.org/suppliers/", F.col("s_suppkey"), "/index.html").alias("url"))
    linked = pages.select("s_suppkey", F.explode(L.attachments(F.col("html"), F.col("url"))).alias("url")).withColumn("path", F.regexp_replace("url", r"\?.*$", ""))
    evidence = V.table_evidence(D.document_tables(files.join(linked.select("path").distinct(), "path", "left_semi")).where("error is null"))
    return linked.join(evidence, linked["path"] == evidence["source_url"]).select(F.col("s_suppkey").alias("supplier"), "indicator", "delta")


@query(
    r"""WITH a AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS root, regexp_extract_all(html, '<a href="([^"]+)"', 1) AS l FROM pages),
u AS (SELECT page_id, list_filter(list_transform(l, lambda x: root || replace(x, '&amp;', '&')), lambda x, i: list_position(l, l[i]) = i) AS l FROM a WHERE len(l) > 0),
e AS (SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) AS i FROM u),
s AS (SELECT page_id, link, i, CAST(contains(lower(link), 'th') AS INTEGER) + CAST(contains(lower(link), 'an') AS INTEGER) + CAST(contains(lower(link), 'e') AS INTEGER) AS hits FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY hits DESC, i) AS n FROM s)
SELECT page_id, string_agg(link, ' ' ORDER BY n) AS links FROM r WHERE n <= 12 GROUP BY page_id"""
)
def ranked_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve links of each page whose addresses hold most of some words."""
    found = table(spark, sf_dir, "pages").select("page_id", L.ranked(L.page_links(F.col("html"), F.col("url")), ["TH", "an", "e"], 12).alias("l"))
    return found.where(F.size("l") > 0).select("page_id", F.array_join("l", " ").alias("links"))


# --- names ---------------------------------------------------------------------------------------


@query(
    """WITH n AS (SELECT lower(string_split(text, ' ')[1] || ' ' || string_split(text, ' ')[2]) AS name, 'd' || (item_id % 9) || '.example.org' AS domain, item_id AS rank FROM benchmark WHERE len(string_split(text, ' ')) > 1),
h AS (SELECT doc_id, domain, min(rank) AS rank FROM documents JOIN n ON contains(lower(text), name) GROUP BY 1, 2),
g AS (SELECT doc_id, string_agg(domain, ' ' ORDER BY rank, domain) AS domains FROM h GROUP BY 1)
SELECT doc_id, coalesce(domains, '') AS domains FROM documents LEFT JOIN g USING (doc_id)"""
)
def named_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains whose names, the first two words of benchmark items, occur in documents."""
    words = F.split("text", " ")
    items = table(spark, sf_dir, "benchmark").where(F.size(words) > 1)
    names = items.select(F.array_join(F.slice(words, 1, 2), " ").alias("name"), _text("d", F.pmod("item_id", F.lit(9)), ".example.org").alias("domain"), F.col("item_id").alias("rank"))
    found = M.named_domains(table(spark, sf_dir, "documents").select("doc_id", "text"), names)
    return found.select("doc_id", F.array_join("domains", " ").alias("domains"))


# --- verification --------------------------------------------------------------------------------

_STAGES = ("direct_primary_link", "named_or_topic_domain_search", "broad_primary_search")


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as claims: their price with a decimal comma, their year, and words."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    price = F.format_string("%.2f", "o_totalprice")
    words = F.array(F.lower("c_mktsegment"), F.lit("order"), F.lit("total"))
    numbers = F.array(F.replace(price, F.lit("."), F.lit(",")), F.year("o_orderdate").cast("string"))
    return rows.select(F.col("o_orderkey").alias("claim"), numbers.alias("numbers"), words.alias("keywords"), price.alias("price"), "o_orderstatus", "o_orderpriority", "o_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")


def _primary_pages(claims: DataFrame) -> DataFrame:
    """(claim, url, text, html): a page an order, on one of three hosts by its status; customers in debt have a wrong price."""
    kind = F.when(F.col("o_orderstatus") == "F", "direct").when(F.col("o_orderstatus") == "O", "topic").otherwise("broad")
    url = _text("https://", kind, ".example.org/o/", F.col("claim"), "/page.html")
    told = F.when(F.col("c_acctbal") < 0, "0.07").otherwise(F.col("price"))
    body = _text("Order of the ", F.lower("c_mktsegment"), " sector, total ", told, " in all.")
    link = F.when(F.col("o_orderpriority") == "1-URGENT", '<a href="series-break.json">revision</a>').otherwise("")
    return claims.select("claim", "o_custkey", url.alias("url"), body.alias("text"), _text("<p>", body, "</p><a href='data.csv'>data</a>", link).alias("html"))


def _resolved(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    claims = _claims(spark, sf_dir)
    pages = _primary_pages(claims)
    page_of = lambda host: lambda open_: W.trusted_hosts(
        open_.select("claim", F.lit(0).alias("place"), _text(f"https://{host}.example.org/o/", F.col("claim"), "/page.html").alias("url")),
        spark.createDataFrame([("direct.example.org",), ("topic.example.org",)], "domain string"),
    )
    found, did = W.in_stages(claims, list(zip(_STAGES, map(page_of, ("direct", "topic", "broad")))), pages.select("url", "text"))
    return found, did, pages


_VERIFIED = """v AS (SELECT o_orderkey AS claim, o_custkey, o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS stage, c_acctbal >= 0 OR contains('0.07', printf('%.2f', o_totalprice)) AS holds
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query(
    f"""WITH {_VERIFIED}
SELECT claim, stage, ['{_STAGES[0]}', '{_STAGES[1]}', '{_STAGES[2]}'][stage] AS method, CASE WHEN stage < 3 THEN 79 ELSE 64 END AS verification_score,
  CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS BIGINT) AS n_series, CASE WHEN o_orderpriority <> '1-URGENT' THEN 1.5::DOUBLE END AS delta FROM v WHERE holds"""
)
def article_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims settled in three stages, with the series of their page's attachment unless a bulletin tells of a break."""
    found, _, pages = _resolved(spark, sf_dir)
    own = written(pages.join(found.select("url"), "url", "left_semi"), "settled-pages")
    folder = F.regexp_replace("url", "[^/]*$", "")
    bulletins = own.select(F.concat(folder, F.lit("series-break.json")).alias("url"), F.lit('{"notes": "methodological break"}').alias("content"))
    share = F.pmod("o_custkey", F.lit(80))
    cells = _text("Share (%);2000;2001\r\npart of the whole;", share, ",0;", share + 1, ",5\r\n")
    files = own.select(F.concat(folder, F.lit("data.csv")).alias("path"), F.encode(cells, "UTF-8").alias("content"))
    evidence = V.table_evidence(D.document_tables(files).where("error is null"))
    series = W.page_series(own, evidence, W.withheld_pages(own, bulletins)).groupBy("url").agg(F.count("*").alias("n_series"), F.max("delta").alias("delta"))
    rows = found.join(series, "url", "left")
    return rows.select("claim", "stage", "method", "verification_score", F.coalesce("n_series", F.lit(0).cast("long")).alias("n_series"), "delta")


@query(
    f"""WITH {_VERIFIED}, s AS (SELECT CAST(n AS INTEGER) AS stage, (SELECT count(*) FROM v WHERE NOT (holds AND v.stage < n)) AS open, (SELECT count(*) FROM v WHERE holds AND v.stage = n) AS settled FROM range(1, 4) r(n))
SELECT stage, ['{_STAGES[0]}', '{_STAGES[1]}', '{_STAGES[2]}'][stage] AS method, open, open AS tried, settled FROM s"""
)
def verification_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many claims each stage found open, tried and settled: none is looked at again once it is settled."""
    return _resolved(spark, sf_dir)[1]


# --- classes, headlines, registry ----------------------------------------------------------------

_DOMAINS = ["Sanità e salute", "Istruzione e formazione", "Condizioni economiche", "Ambiente", "Mercato del LAVORO", "Popolazione", "Turismo", "Strutture produttive", "Cultura", "Infrastrutture", "Giustizia"]
_INDICATORS = ["Posti letto ospedalieri", "Speranza di vita", "Rischio di povertà", "Indice di Gini", "Reddito netto", "Spesa media"]
_SERIES = [("Lavoro e redditi", "x"), ("Prezzi e consumi", "Vendite al dettaglio"), ("Prezzi e consumi", "Inflazione"), ("Imprese", "x"), ("Turismo e mobilità", "x"), ("Conti", "x")]


def _listed(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _rules_sql() -> str:
    one = lambda text, words: "true" if not words else "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"
    quoted = lambda name: name.replace("'", "''")
    return " ".join(f"WHEN {one('lower(d)', of)} AND {one('lower(k)', by)} THEN '{quoted(name)}'" for name, of, by in C.NATIONAL_AREAS)


@query(
    f"""WITH r AS (SELECT p_partkey, {_listed(_DOMAINS)}[p_partkey % {len(_DOMAINS)} + 1] AS d, {_listed(_INDICATORS)}[p_size % {len(_INDICATORS)} + 1] AS k, {_listed([a for a, _ in _SERIES])}[p_partkey % {len(_SERIES)} + 1] AS a, {_listed([n for _, n in _SERIES])}[p_partkey % {len(_SERIES)} + 1] AS n FROM part)
SELECT p_partkey, CASE {_rules_sql()} ELSE d END AS area, CASE WHEN a = 'Prezzi e consumi' AND n = 'Vendite al dettaglio' THEN 'Potere d''acquisto e consumi' WHEN a = 'Lavoro e redditi' THEN 'Lavoro e mercato del lavoro'
  WHEN a = 'Prezzi e consumi' THEN 'Prezzi e inflazione' WHEN a = 'Imprese' THEN 'Imprese e industria' WHEN a = 'Turismo e mobilità' THEN 'Turismo' ELSE a END AS series_area FROM r"""
)
def national_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of the national compendium and of monitored series."""
    pick = lambda values, by: F.get(F.lit(values), F.pmod(by, F.lit(len(values))).cast("int"))
    part = table(spark, sf_dir, "part").select(
        "p_partkey", pick(_DOMAINS, F.col("p_partkey")).alias("d"), pick(_INDICATORS, F.col("p_size")).alias("k"), pick([a for a, _ in _SERIES], F.col("p_partkey")).alias("a"), pick([n for _, n in _SERIES], F.col("p_partkey")).alias("n")
    )
    return part.select("p_partkey", C.area(F.col("d"), F.col("k"), C.NATIONAL_AREAS).alias("area"), C.series_area(F.col("a"), F.col("n")).alias("series_area"))


@query(
    """WITH o AS (SELECT o_orderkey, ['LAVORO', 'MOBILITA', 'ALTRO', 'CASA'][o_custkey % 4 + 1] AS t, CASE o_orderstatus WHEN 'F' THEN 'valle d''aosta' WHEN 'O' THEN 'roma' END AS p, CASE WHEN o_orderpriority <> '1-URGENT' THEN printf('%.1f', o_totalprice / 1000) || '%' END AS v FROM orders)
SELECT o_orderkey, CASE t WHEN 'LAVORO' THEN 'Lavoro' WHEN 'MOBILITA' THEN 'Mobilità' WHEN 'CASA' THEN 'Casa' ELSE 'Dati' END || CASE WHEN v IS NULL THEN ', nuovo aggiornamento statistico per ' ELSE ', nuovo dato per ' END
  || CASE p WHEN 'roma' THEN 'Roma' WHEN 'valle d''aosta' THEN 'Valle D''aosta' ELSE 'Italia' END || CASE WHEN v IS NULL THEN '' ELSE ': ' || v END AS headline FROM o"""
)
def story_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headlines of topics, places and figures."""
    topics = F.lit(["LAVORO", "MOBILITA", "ALTRO", "CASA"])
    place = F.when(F.col("o_orderstatus") == "F", F.lit(["valle d'aosta", "roma"])).when(F.col("o_orderstatus") == "O", F.lit(["roma"])).otherwise(F.array().cast("array<string>"))
    value = F.concat(F.format_string("%.1f", N.exact_round(F.col("o_totalprice") / 1000, 1)), F.lit("%"))
    figures = F.when(F.col("o_orderpriority") != "1-URGENT", F.array(value, F.lit("7"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.headline(F.get(topics, F.pmod("o_custkey", F.lit(4)).cast("int")), place, figures).alias("headline"))


@query(
    """WITH t AS (SELECT r_name AS region, CASE WHEN n_nationkey % 2 = 0 THEN 'Provincia' ELSE 'Città metropolitana' END AS kind, CASE WHEN s_suppkey % 3 = 0 THEN lower(n_name) ELSE n_name END AS area, s_name AS municipality FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT region, string_agg(municipality, ' ' ORDER BY kind, lower(area), lower(municipality), area) AS municipalities FROM t GROUP BY region"""
)
def registry_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Territories, each twice in the source, in the order of the registry: the municipalities of each region."""
    t = {n: table(spark, sf_dir, n) for n in ("supplier", "nation", "region")}
    named = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    kind = F.when(F.col("n_nationkey") % 2 == 0, "Provincia").otherwise("Città metropolitana")
    name = F.when(F.col("s_suppkey") % 3 == 0, F.lower("n_name")).otherwise(F.col("n_name"))
    rows = named.select(F.col("r_name").alias("region"), kind.alias("area_type"), name.alias("area"), F.col("s_name").alias("municipality"), F.col("s_suppkey").cast("string").alias("municipality_code"))
    ordered = S.registry(rows.unionByName(rows)).withColumn("at", F.monotonically_increasing_id())
    return ordered.groupBy("region").agg(F.array_join(F.array_sort(F.collect_list(F.struct("at", "municipality")))["municipality"], " ").alias("municipalities"))
