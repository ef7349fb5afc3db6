"""Classes, row tests and the story flow over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import classes as C
from tidemark.functions import numbers as N
from tidemark.functions import text as T
from tidemark.operators import stories as S
from tidemark.plans.facts import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _any_sql(text: str, words: list[str]) -> str:
    return "(" + (" OR ".join(f"contains({text}, {_quoted(w)})" for w in words) or "true") + ")"


def _pick(values: list[str], place: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (place % len(values) + 1).cast("int"))


def _pick_sql(values: list[str], place: str) -> str:
    return "[" + ", ".join(map(_quoted, values)) + f"][({place}) % {len(values)} + 1]"


# --- classes -------------------------------------------------------------------------------------

_DOMAINS = ["Salute", "Istruzione e formazione", "Benessere economico", "Ambiente", "Qualità dei servizi", "Lavoro", "Sicurezza", "Relazioni sociali", "Innovazione", "Politica"]
_MEASURES = [
    "Posti letto ospedalieri", "Rischio di povertà", "Indice di Gini", "Reddito medio", "Speranza di vita", "Rifiuti urbani", "Consumo di suolo", "Specie protette",
    "Mobilità ciclabile", "Energia elettrica da fonti rinnovabili", "Emissioni di gas serra", "Altro",
]
_AREA_SQL = "CASE " + " ".join(f"WHEN {_any_sql('lower(d)', a)} AND {_any_sql('lower(m)', b)} THEN {_quoted(n)}" for n, a, b in C.AREAS) + " ELSE d END"
_PILLAR_SQL = "CASE " + " ".join(f"WHEN {_any_sql('lower(m)', w)} THEN {_quoted(n)}" for n, w in C.PILLARS) + " " + " ".join(f"WHEN g = {k} THEN {_quoted(n)}" for k, n in C.GOAL_PILLARS.items()) + " END"


@query(f"WITH p AS (SELECT p_partkey, {_pick_sql(_DOMAINS, 'p_partkey')} AS d, {_pick_sql(_MEASURES, 'p_size')} AS m, p_size % 17 AS g FROM part) SELECT p_partkey, {_AREA_SQL} AS area, {_PILLAR_SQL} AS pillar FROM p")
def indicator_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    measure = _pick(_MEASURES, F.col("p_size"))
    return table(spark, sf_dir, "part").select("p_partkey", C.area(_pick(_DOMAINS, F.col("p_partkey")), measure).alias("area"), C.green_pillar(measure, F.col("p_size") % 17).alias("pillar"))


_PLACES = ["Torino", "Milàno", "Asti", "Città Metropolitana di X", "ROMA ", "Lecce"]


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 6 IN (0, 1, 3, 4) THEN 'Città metropolitana' ELSE 'Provincia' END AS area_type FROM supplier")
def area_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _pick(_PLACES, F.col("s_suppkey"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", C.area_type(name, name).alias("area_type"))


@query(
    """SELECT l_suppkey, CASE WHEN count(*) FILTER (l_tax > 0.07 AND l_discount > 0.09) > 0 THEN 'structured_endpoint_verified' WHEN count(*) FILTER (l_returnflag = 'R' AND l_discount > 0.05) > 0 THEN 'official_portal_reachable' ELSE 'blocked' END AS status FROM lineitem GROUP BY 1"""
)
def probe_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count_if((F.col("l_tax") > 0.07) & (F.col("l_discount") > 0.09)).alias("verified"), F.count_if((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.05)).alias("ok")
    )
    return checks.select("l_suppkey", C.probe_status(F.col("verified"), F.col("ok")).alias("status"))


# --- row tests -----------------------------------------------------------------------------------

_SEXES = ["Totale", " TOTALI", "t", "Maschi", "Femmine", "total "]


@query(
    """SELECT l_orderkey, l_linenumber, l_linenumber % 6 NOT IN (3, 4) AS total_sex, CASE WHEN l_suppkey % 30 > 0 AND l_returnflag <> 'R' THEN lpad(CAST(l_suppkey % 30 AS VARCHAR), 2, '0') END AS region,
  l_linenumber % 6 = 0 AND month(l_shipdate) + l_linenumber BETWEEN 1 AND 12 AND l_linestatus = 'O' AS monthly FROM lineitem"""
)
def row_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synonyms of the total, codes of regions, and monthly totals with a code."""
    sex = _pick(_SEXES, F.col("l_linenumber"))
    code = F.concat(F.lit("20-"), F.lpad((F.col("l_suppkey") % 30).cast("string"), 2, "0"), F.when(F.col("l_returnflag") == "R", "-001").otherwise("-000"))
    month = F.month("l_shipdate") + F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", C.is_total_sex(sex).alias("total_sex"), C.region_of(code).alias("region"), C.is_monthly_total(sex, month, F.when(F.col("l_linestatus") == "O", code)).alias("monthly")
    )


@query(
    """SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS counted FROM lineitem WHERE l_linenumber IN (6, 7) AND l_linestatus = 'O' GROUP BY 1
HAVING count(*) FILTER (l_discount > 0.02) >= 6"""
)
def national_goals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the whole country for goals 6 and 7, counts with gaps as zero, series with six values or more."""
    line = F.col("l_linenumber")
    goal = F.concat(F.when(line == 5, "Target ").otherwise("goal  "), F.when(line < 5, line % 5 + 1).otherwise(line).cast("string"), F.lit(" - x"))
    level = F.when(F.col("l_linestatus") == "O", "Totale Italia (NUTS 0)").otherwise("Regioni (NUTS 2)")
    rows = table(spark, sf_dir, "lineitem").where(C.is_national_goal(goal, level, F.when(F.col("l_tax") > 0.02, "Territorio")))
    text = F.when(F.col("l_returnflag") == "A", F.col("l_quantity").cast("string")).when(F.col("l_returnflag") == "R", "n.d.")
    series = rows.groupBy("l_suppkey").agg(F.sum(C.count_or_zero(text)).alias("counted"), F.count_if(F.col("l_discount") > 0.02).alias("n"))
    return series.where(C.enough_values(F.array_repeat(F.lit(1), F.col("n").cast("int")))).select("l_suppkey", "counted")


_SHORT = "replace(rtrim(rtrim(printf('%.2f', v), '0'), '.'), '.', ',')"
_THOUSANDS = "replace(format('{:,.0f}', v), ',', '.')"
_MILLIONS = "replace(printf('%.2f mln', v / 1000000), '.', ',')"


@query(
    f"""WITH p AS (SELECT p_partkey, CAST((p_partkey * 7919) % 2000000 AS DOUBLE) / (CASE p_size % 3 WHEN 0 THEN 1 WHEN 1 THEN 100 ELSE 4000 END) + 0.003 AS v FROM part)
SELECT p_partkey, CASE WHEN v >= 1000000 THEN {_MILLIONS} WHEN v >= 10000 THEN {_THOUSANDS} ELSE {_SHORT} END AS series, CASE WHEN v >= 1000 THEN {_THOUSANDS} WHEN v >= 100 THEN replace(printf('%.1f', v), '.', ',') ELSE {_SHORT} END AS wellbeing,
  CASE WHEN v >= 1000 THEN {_THOUSANDS} ELSE {_SHORT} END AS cities, CASE WHEN v >= 1000000 THEN {_MILLIONS} WHEN v >= 1000 THEN {_THOUSANDS} ELSE {_SHORT} END AS green FROM p"""
)
def number_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size") % 3
    v = ((F.col("p_partkey") * 7919) % 2000000).cast("double") / F.when(size == 0, 1).when(size == 1, 100).otherwise(4000) + 0.003
    return table(spark, sf_dir, "part").select("p_partkey", *(N.locale_format(v, style).alias(style) for style in ("series", "wellbeing", "cities", "green")))


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal > lag THEN 'sale' WHEN c_acctbal < lag THEN 'scende' ELSE 'resta stabile' END AS verb, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code, lower(replace(c_name, '#', '-')) AS slug, lower(replace(c_name, '#', '')) AS key,
  CAST(printf('%.5e', c_acctbal / 3) AS DOUBLE) AS six_digits FROM (SELECT *, round(c_acctbal / 1000) * 1000 AS lag FROM customer)"""
)
def names_and_verbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes filled with zeros, slugs, word keys, six significant digits, and verbs of movement."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey", N.movement(F.col("c_acctbal"), F.round(F.col("c_acctbal") / 1000) * 1000).alias("verb"), N.zero_filled(F.col("c_custkey").cast("string"), 6).alias("code"),
        T.slug(F.col("c_name")).alias("slug"), T.word_key(F.col("c_name")).alias("key"), N.significant(F.col("c_acctbal") / 3, 6).alias("six_digits"),
    )


@query(
    """SELECT p_partkey, CAST(printf('%.2f', p_retailprice / 8) AS DOUBLE) AS two, CAST(printf('%.0f', p_size / 2.0) AS DOUBLE) AS none, CAST(printf('%.2f', -(p_size + 0.675)) AS DOUBLE) AS negative FROM part"""
)
def exact_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halves to even of the binary value, not of how it reads."""
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey", N.exact_round(F.col("p_retailprice") / 8, 2).alias("two"), N.exact_round(size / 2, 0).alias("none"), N.exact_round(-(size + 0.675), 2).alias("negative")
    )


# --- stories -------------------------------------------------------------------------------------

_STORY_SQL = """WITH s AS (SELECT l_orderkey * 100 + l_linenumber AS key, l_shipdate + to_minutes(CAST(l_suppkey % 1440 AS INTEGER)) AS published_at, CASE WHEN l_returnflag = 'R' THEN 'quarantined' ELSE 'published' END AS p,
  CASE WHEN l_linenumber < 3 THEN 'verified' WHEN l_linenumber = 3 THEN 'verified_primary_match' ELSE 'needs_primary_source' END AS e, l_discount > 0.05 AS primary_source, l_linestatus = 'O' AS media, l_tax > 0.04 AS strong, l_partkey, l_quantity FROM lineitem)
"""


@query(
    _STORY_SQL
    + """SELECT key || '-' || l_partkey || '-' || l_quantity AS id, row_number() OVER (PARTITION BY CAST(published_at AS DATE) ORDER BY media DESC, published_at DESC, key || '-' || l_partkey || '-' || l_quantity) AS position
FROM s WHERE p = 'published' AND e IN ('verified', 'verified_primary_match') AND primary_source AND (NOT media OR strong)"""
)
def published_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The publication gate and the order of a day."""
    line = F.col("l_linenumber")
    stories = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey") * 100 + line, "l_partkey", "l_quantity").alias("id"),
        (F.col("l_shipdate") + F.make_dt_interval(mins=(F.col("l_suppkey") % 1440).cast("int"))).alias("published_at"),
        F.when(F.col("l_returnflag") == "R", "quarantined").otherwise("published").alias("publication_status"),
        F.when(line < 3, "verified").when(line == 3, "verified_primary_match").otherwise("needs_primary_source").alias("editorial_status"),
        F.when(F.col("l_discount") > 0.05, S.PRIMARY).otherwise("journalistic_source").alias("role"),
        F.when(F.col("l_linestatus") == "O", S.MEDIA).alias("discovery_role"),
        F.when(F.col("l_tax") > 0.04, S.STRONG).alias("evidence_gate"),
    )
    return S.day_positions(S.publishable(stories)).select("id", F.col("position").cast("long").alias("position"))


@query(
    f"""WITH i AS (SELECT doc_id, coalesce(text, '') || ' di ogni anno' AS title, CASE WHEN doc_id % 5 = 0 THEN 'quota di imprese' ELSE 'senza' END AS summary, n_chars % 100 AS score, doc_id % 6 AS age, CASE WHEN doc_id % 7 = 0 THEN ['2024'] ELSE [CAST(n_chars AS VARCHAR), '2024', CAST(doc_id AS VARCHAR)] END AS numbers, doc_id % 4 AS kind FROM documents),
q AS (SELECT *, list_filter(numbers, lambda n: NOT regexp_full_match(n, '20[0-9][0-9]')) AS found FROM i)
SELECT doc_id, CAST(least(75, greatest(45, score)) AS BIGINT) AS news_score, array_to_string(found[1:6], '|') AS claims, CASE kind WHEN 0 THEN 'example.org' WHEN 1 THEN 'Bureau' ELSE 'b.example.org' END AS domain
FROM q WHERE age BETWEEN 1 AND 3 AND len(found) > 0 AND score >= 45 AND length(title) + CASE WHEN kind = 1 THEN 9 ELSE 0 END >= 24 AND kind < 3 AND {_any_sql("lower(title || ' ' || summary)", T.STAT_TERMS)}"""
)
def quarantined_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fresh items with figures wait for a primary source; an aggregator's items carry their publisher."""
    kind = F.col("doc_id") % 4
    title = F.concat(F.coalesce("text", F.lit("")), F.lit(" di ogni anno"), F.when(kind == 1, " - Bureau").otherwise(""))
    now = F.lit("2024-01-10 12:00:00").cast("timestamp")
    items = table(spark, sf_dir, "documents").select(
        "doc_id", title.alias("title"), F.when(F.col("doc_id") % 5 == 0, "quota di imprese").otherwise("senza").alias("summary"), (F.col("n_chars") % 100).alias("score"),
        (now - F.make_dt_interval(days=(F.col("doc_id") % 6).cast("int")) + F.make_dt_interval(secs=F.lit(5))).alias("published"), 
        F.when(F.col("doc_id") % 7 == 0, F.array(F.lit("2024"))).otherwise(F.array(F.col("n_chars").cast("string"), F.lit("2024"), F.col("doc_id").cast("string"))).alias("numbers"),
        _pick(["https://www.example.org/a", "https://news.google.com/rss/b", "http://b.example.org:80/c?x", "ftp://c.example.org"], F.col("doc_id")).alias("url"),
    )
    found = S.quarantined(items, now)
    return found.select("doc_id", "news_score", F.array_join("claims", "|").alias("claims"), "domain")


_RULES = [
    {"match": ["#00", "1"], "headline": "Rule one", "source": "example.org", "topic": "LAVORO"},
    {"match": ["2"], "headline": "Rule two", "source": "example.net", "topic": "CASA"},
]


@query(
    """SELECT c_custkey, CASE WHEN contains(c_name, '#00') AND contains(c_name, '1') THEN 'Rule one' WHEN contains(c_name, '2') THEN 'Rule two' ELSE c_name END AS headline,
  CASE WHEN contains(c_name, '#00') AND contains(c_name, '1') THEN 'LAVORO' WHEN contains(c_name, '2') THEN 'CASA' ELSE c_mktsegment END AS topic,
  CASE WHEN (contains(c_name, '#00') AND contains(c_name, '1')) OR contains(c_name, '2') THEN 'published' ELSE 'quarantined' END AS publication_status FROM customer"""
)
def curated_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    stories = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("headline"), F.col("c_mktsegment").alias("topic"), F.lit("quarantined").alias("publication_status"))
    return S.with_curated(stories, _RULES).select("c_custkey", "headline", "topic", "publication_status")


@query(
    """WITH o AS (SELECT 'E' || event_id AS id, user_id AS link, event_type IN ('click', 'view') AS legacy, ts AS seen FROM events WHERE value IS NOT NULL),
n AS (SELECT CASE WHEN c_acctbal > 8000 THEN 'E' || c_custkey ELSE 'C' || c_custkey END AS id, c_custkey AS link FROM customer),
first_seen AS (SELECT link, min(seen) AS seen FROM o WHERE legacy GROUP BY 1)
SELECT o.id, seen AS published_at FROM o WHERE o.id NOT IN (SELECT id FROM n) AND NOT (legacy AND EXISTS (SELECT 1 FROM n WHERE n.link = o.link AND n.id <> o.id))
UNION ALL SELECT n.id, CASE WHEN o.id IS NOT NULL THEN o.seen ELSE coalesce(f.seen, TIMESTAMP '2030-01-01') END FROM n LEFT JOIN o ON o.id = n.id LEFT JOIN first_seen f ON f.link = n.link"""
)
def replaced_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templated stories give way to new ones of the same address."""
    headline = F.when(F.col("event_type").isin("click", "view"), "Lavoro, nuovo dato per Asti").otherwise("Lavoro in crescita")
    old = table(spark, sf_dir, "events").where("value is not null").select(
        F.concat(F.lit("E"), "event_id").alias("id"), F.concat(F.lit("http://www.example.org/"), "user_id", F.lit("/?a")).alias("url"), headline.alias("headline"), F.col("ts").cast("timestamp_ntz").alias("published_at")
    )
    new = table(spark, sf_dir, "customer").select(
        F.concat(F.when(F.col("c_acctbal") > 8000, "E").otherwise("C"), "c_custkey").alias("id"), F.concat(F.lit("https://example.org/"), "c_custkey").alias("url"), F.lit("Nuovo").alias("headline"),
        F.lit("2030-01-01").cast("timestamp_ntz").alias("published_at"),
    )
    return S.replace_legacy(old, new).select("id", "published_at")


@query("SELECT o_custkey AS section, o_orderkey AS id, o_totalprice AS total FROM orders WHERE o_totalprice > 1000")
def visible_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stories by the ids of an index."""
    orders = table(spark, sf_dir, "orders")
    index = orders.groupBy(F.col("o_custkey").alias("section")).agg(F.collect_list("o_orderkey").alias("ids"))
    return S.visible(index, orders.where("o_totalprice > 1000").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("total")))


@query("SELECT l_partkey AS id FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1")
def overlapping_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.overlaps(table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("section"), F.col("l_partkey").alias("id")))


@query(
    """WITH y AS (SELECT l_suppkey AS territory, l_returnflag AS indicator, CAST(year(l_shipdate) AS INTEGER) AS y, sum(l_quantity) AS v FROM lineitem GROUP BY ALL),
n AS (SELECT indicator, y, sum(v) AS v FROM y WHERE y <> 1998 GROUP BY ALL),
l AS (SELECT territory, indicator, list(y ORDER BY y) AS p FROM y GROUP BY ALL)
SELECT territory, l.indicator, CASE WHEN b.v IS NOT NULL THEN a.v END AS before, CASE WHEN a.v IS NOT NULL THEN b.v END AS latest FROM l LEFT JOIN n a ON a.indicator = l.indicator AND a.y = p[-2] LEFT JOIN n b ON b.indicator = l.indicator AND b.y = p[-1]"""
)
def same_year_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local series beside the country's values of the same two years; a year that is missing there gives none."""
    year = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("territory"), F.col("l_returnflag").alias("indicator"), F.year("l_shipdate").alias("y")).agg(F.sum("l_quantity").alias("v"))
    arrays = lambda rows, *keys: rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("y", "v"))).alias("r")).select(F.lit("D").alias("domain"), *keys, F.col("r.y").alias("periods"), F.col("r.v").alias("values"))
    country = year.where("y <> 1998").groupBy("indicator", "y").agg(F.sum("v").alias("v"))
    found = S.national_values(arrays(year, "territory", "indicator"), arrays(country, "indicator"))
    return found.select("territory", "indicator", F.get("national", F.lit(0)).alias("before"), F.get("national", F.lit(1)).alias("latest"))


@query("SELECT l_orderkey, l_linenumber, (CASE WHEN l_returnflag = 'R' THEN 85 WHEN l_returnflag = 'A' THEN 79 END) >= 80 AND l_linestatus = 'O' AS strong FROM lineitem WHERE l_returnflag <> 'N' UNION ALL SELECT l_orderkey, l_linenumber, false FROM lineitem WHERE l_returnflag = 'N'")
def strong_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.when(F.col("l_returnflag") == "R", 85).when(F.col("l_returnflag") == "A", 79)
    words = F.array(F.lit("tasso"), F.when(F.col("l_linestatus") == "O", "quota").otherwise("tasso"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.strong_match(score, words).alias("strong"))
