"""Streams over several refreshes and published versions, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import snapshots as P
from tidemark.plans.facts import shared, table
from tidemark.streaming import observations as O
from tidemark.streaming import restatement as R

QUERIES, SQL = {}, {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


# --- late rows -----------------------------------------------------------------------------------

#: Refreshes of six days each; errors arrive eight days late and sign-ups one, where two are allowed.
REFRESHES, DAYS = 7, 6
_DELAY = "CASE event_type WHEN 'error' THEN INTERVAL 8 DAY WHEN 'signup' THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END"
_DELIVERED = f"""e AS (SELECT *, CAST(least({REFRESHES - 1}, date_diff('day', (SELECT CAST(min(ts) AS DATE) FROM events), CAST(ts + {_DELAY} AS DATE)) // {DAYS}) AS INTEGER) AS k FROM events),
m AS (SELECT n, (SELECT max(ts) FROM e WHERE k < n) - INTERVAL 2 DAY AS mark FROM range({REFRESHES}) r(n))"""


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the refresh ``k`` that brings them."""
    rows = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first = F.to_date(F.lit(rows.agg(F.min("ts")).first()[0]))
    days = F.datediff(F.to_date(F.col("ts") + F.expr(_DELAY)), first)
    return rows.withColumn("k", F.least(F.lit(REFRESHES - 1), F.floor(days / DAYS).cast("int")))


def _refreshes(spark: SparkSession, name: str, delivered: DataFrame, transform, batch=None) -> tuple[str, DataFrame]:
    """Brings one refresh after another into a folder and runs the stream over each from its checkpoint on."""
    path = shared(spark, f"stream-{name}")
    schema = delivered.drop("k").schema
    for k in range(REFRESHES):
        delivered.where(F.col("k") == k).drop("k").write.parquet(f"{path}/in/{k}")
        stream = transform(R.file_stream(spark, f"{path}/in", schema))
        R.refresh(stream, path, (batch or R.numbered_batches)(path))
    return path, stream


@query(
    f"""WITH {_DELIVERED}
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM e JOIN m ON k = m.n
WHERE mark IS NULL OR date_trunc('day', ts) + INTERVAL 1 DAY > mark GROUP BY 1, 2"""
)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts over refreshes: rows that come after their day has passed the watermark are left out."""
    daily = lambda rows: O.tumbling(rows, "ts", ["event_type"], "value", late="2 days")
    path, stream = _refreshes(spark, "late", _delivered(spark, sf_dir), daily)
    found = R.newest_of_batches(spark, path, stream.schema, ["window_start", "event_type"])
    return found.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(
    f"""WITH {_DELIVERED}
SELECT event_id, user_id, event_type FROM e JOIN m ON k = m.n WHERE mark IS NULL OR ts > mark"""
)
def stream_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that every refresh brings twice, and the next one again if they are purchases: each once, none that comes too late."""
    rows = _delivered(spark, sf_dir)
    again = rows.where("event_type = 'purchase'").withColumn("k", F.least(F.col("k") + 1, F.lit(REFRESHES - 1)))
    once = lambda stream: O.first_seen(stream, "ts", ["event_id"], "2 days").select("event_id", "user_id", "event_type")
    path, stream = _refreshes(spark, "redelivered", rows.unionByName(rows).unionByName(again), once)
    return spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(f"{path}/rows").select(*stream.columns)


# --- restated months -----------------------------------------------------------------------------

_CUTS = 4
_MONTHS_SQL = f"""WITH s AS (SELECT min(CAST(l_shipdate AS DATE)) AS a, max(CAST(l_shipdate AS DATE)) AS z FROM lineitem),
c AS (SELECT CAST(k AS INTEGER) AS k, a + CAST(date_diff('day', a, z) * (k + 1) // {_CUTS} AS INTEGER) AS cut, CASE WHEN k = 0 THEN a ELSE a + CAST(date_diff('day', a, z) * k // {_CUTS} AS INTEGER) END AS before FROM s, range({_CUTS}) r(k)),
p AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_returnflag AS flag, k, sum(l_quantity) AS v FROM lineitem JOIN c ON CAST(l_shipdate AS DATE) <= cut AND date_trunc('month', l_shipdate) >= date_trunc('month', before) GROUP BY 1, 2, 3)
SELECT month, flag, arg_max(v, k) AS value, arg_min(v, k) AS first_value, string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) AS versions,
  month = (SELECT max(month) FROM p) AND month(month) <> 12 AS provisional FROM p GROUP BY month, flag"""


@query(_MONTHS_SQL)
def stream_restated_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly quantities over four refreshes, each of which begins with the month that the one before had in part: it is restated."""
    lines = table(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    first, span = lines.agg(F.min("day"), F.datediff(F.max("day"), F.min("day"))).first()
    path, keys = shared(spark, "stream-months"), ["month", "flag"]
    cut = lambda k: F.date_add(F.lit(first), span * k // _CUTS)
    for k in range(_CUTS):
        some = lines.where((F.col("day") <= cut(k + 1)) & (F.trunc("day", "month") >= F.trunc(cut(k), "month")))
        rows = some.groupBy(F.trunc("day", "month").alias("month"), F.col("l_returnflag").alias("flag")).agg(F.sum("l_quantity").alias("value"))
        rows = rows.withColumn("version", F.lit(k))
        rows.write.parquet(f"{path}/in/{k}")
        R.refresh(R.file_stream(spark, f"{path}/in", rows.schema), path, R.merge_into(path, keys, "month"), "append")
    found = R.merged_table(spark, path, R.restated(rows, keys).schema)
    newest = F.lit(found.agg(F.max("month")).first()[0])
    versions = F.array_join(F.col("versions").cast("array<string>"), ",")
    return found.select(*keys, "value", "first_value", versions.alias("versions"), R.provisional(F.col("month"), newest).alias("provisional"))


# --- published versions --------------------------------------------------------------------------


def _spending(orders: DataFrame, before: Column) -> DataFrame:
    return orders.where(before).groupBy(F.col("o_custkey").alias("customer")).agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"))


@query(
    """WITH c AS (SELECT min(o_orderdate) + (max(o_orderdate) - min(o_orderdate)) / 2 AS half FROM orders)
SELECT CAST(1 AS INTEGER) AS version, count(DISTINCT o_custkey) AS n_rows, CAST(NULL AS INTEGER) AS previous, true AS as_written, false AS current FROM orders, c WHERE o_orderdate < half
UNION ALL SELECT 2, count(DISTINCT o_custkey), 1, true, true FROM orders"""
)
def published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a table and a third that its checks refuse: count and digest of each read back, and which is current."""
    orders = table(spark, sf_dir, "orders")
    root = shared(spark, "published")
    first, last = orders.agg(F.unix_micros(F.min("o_orderdate").cast("timestamp")), F.unix_micros(F.max("o_orderdate").cast("timestamp"))).first()
    half = F.unix_micros(F.col("o_orderdate").cast("timestamp")) < first + (last - first) // 2
    checks = {"has_rows": F.count("*") > 0, "spent_known": F.count_if(F.col("spent").isNull()) == 0}
    P.publish(_spending(orders, half), root, checks)
    P.publish(_spending(orders, F.lit(True)), root, checks)
    P.refreshed(_spending(orders, F.lit(False)), root, checks)
    now, out = P.current(spark, root)["version"], None
    for m in P.versions(spark, root):
        read = spark.read.parquet(f"{m['folder']}/rows")
        digest = F.coalesce(P.content_hash(read).cast("string"), F.lit("0"))
        row = read.agg(F.count("*").alias("n_rows"), (digest == m["content_hash"]).alias("as_written"))
        row = row.select(F.lit(m["version"]).alias("version"), "n_rows", F.lit(m["previous"]).cast("int").alias("previous"), "as_written", F.lit(m["version"] == now).alias("current"))
        out = row if out is None else out.unionByName(row)
    return out
