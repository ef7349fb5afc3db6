"""Verification in stages: each looks only at the claims that the ones before it left open.

A stage brings candidates, pages where a claim may have come from. They are read, scored and the first that holds settles
the claim; its result is a written table, and the next stage gets the claims without one. Series of a settled
page come from its own tables and its attachments, unless a companion bulletin of the same page tells of a
break, which withholds them all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import links as L
from tidemark.functions.text import host
from tidemark.operators import evidence as V
from tidemark.sources.shared_files import written

#: What a stage is: its name, and from the open claims their candidates (claim, place, url, trusted).
Stage = tuple[str, Callable[[DataFrame], DataFrame]]
# Words by which a link to a bulletin is told.
BULLETIN_WORDS = ["revision", "metodolog", "series-break", "serie-storica"]


def settled(claims: DataFrame, candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """(claim, url, place, verification_score, matched_numbers, matched_keywords) of the first candidate of each claim that holds.

    ``claims`` (claim, numbers, keywords), ``candidates`` (claim, place, url, trusted) in order of place, ``pages``
    (url, text). Candidates whose page is unknown or has no text do not hold.
    """
    first = candidates.groupBy("claim", "url").agg(F.min("place").alias("place"), F.collect_set(F.coalesce("trusted", F.lit(False))).alias("t"))
    tried = first.join(claims, "claim").select(F.struct("claim", "place").alias("claim"), F.col("url").alias("doc"), "numbers", "keywords", F.explode("t").alias("trusted"))
    found = V.verify_claims(tried, pages.where("text is not null").select(F.col("url").alias("doc"), "text")).where("verified")
    hit = F.struct("claim.place", F.col("doc").alias("url"), "verification_score", "matched_numbers", "matched_keywords").alias("hit")
    best = found.select("claim.claim", hit)
    return best.groupBy("claim").agg(F.min("hit").alias("hit")).select("claim", "hit.*")


def in_stages(claims: DataFrame, stages: list[Stage], pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(settled claims with stage and method, what each stage did: stage, method, open, tried, settled).

    Null claims and claims that no stage settles are in neither. Repeated claims are settled once.
    """
    spark = claims.sparkSession
    open_, found, done = written(claims.where("claim is not null").dropDuplicates(["claim"]), "open-1"), None, []
    pages = written(pages, "pages")
    for number, (method, candidates) in enumerate(stages, 1):
        brought = written(candidates(open_).select("claim", F.col("place").cast("long").alias("place"), "url", "trusted").join(open_.select("claim"), "claim", "left_semi"), f"candidates-{number}")
        part = settled(open_, brought, pages).withColumns({"stage": F.lit(number), "method": F.lit(method)})
        part = written(part, f"settled-{number}")
        counts = open_.count(), brought.select("claim").distinct().count(), part.count()
        done.append((number, method, *counts))
        found = part if found is None else found.unionByName(part)
        if number < len(stages):
            open_ = written(open_.join(part.select("claim"), "claim", "left_anti"), f"open-{number + 1}")
    return found, spark.createDataFrame(done, "stage int, method string, open long, tried long, settled long")


def withheld_pages(pages: DataFrame, bulletins: DataFrame) -> DataFrame:
    """(url) of the pages (url, html) that link a bulletin (url, content) of their own host which tells of a break.

    A bulletin is a JSON file whose address holds one of the words for revisions; its content is JSON text.
    """
    told = F.exists(F.array(*map(F.lit, BULLETIN_WORDS)), lambda w: F.contains(F.lower("bulletin"), w))
    linked = pages.select("url", F.explode(L.attachments(F.col("html"), F.col("url"), ["json"])).alias("bulletin")).where(told)
    broken = bulletins.where(V.revision_status(F.col("content")) == "methodological_break").select(F.col("url").alias("bulletin")).distinct()
    return linked.join(broken, "bulletin", "left_semi").select("url").distinct()


def page_series(pages: DataFrame, documents: DataFrame, withheld: DataFrame, attached: int | None = 3, each: int | None = 4, most: int | None = 12) -> DataFrame:
    """(url, n, source_url, location, indicator, observations, delta) of each page: its own evidence, then that of its attachments.

    ``documents`` are evidence rows of table_evidence by source_url. Of a page's attachments the first ``attached`` are
    read, ``each`` rows of each, and ``most`` rows of a page; None reads all. Pages ``withheld`` have none.
    """
    own = pages.select("url", F.lit(0).alias("file"), F.col("url").alias("source_url"))
    files = L.attachments(F.col("html"), F.col("url"), most=attached)
    linked = pages.select("url", F.posexplode(files).alias("file", "source_url")).withColumn("file", F.col("file") + 1)
    rows = own.unionByName(linked).join(withheld, "url", "left_anti").join(documents, "source_url")
    at = F.regexp_extract("location", r":row:(\d+)$", 1).cast("int")
    of_file = Window.partitionBy("url", "file").orderBy(F.regexp_replace("location", r":row:\d+$", ""), at)
    rows = rows.withColumn("k", F.row_number().over(of_file))
    rows = rows if each is None else rows.where((F.col("file") == 0) | (F.col("k") <= each))
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("url").orderBy("file", "k")))
    rows = rows if most is None else rows.where(F.col("n") <= most)
    return rows.select("url", "n", "source_url", "location", "indicator", "observations", "delta")


def trusted_hosts(candidates: DataFrame, domains: DataFrame) -> DataFrame:
    """Candidates with ``trusted``: whether their host is one of the ``domains`` or lies below it."""
    from tidemark.functions.text import host_suffixes

    named = candidates.withColumn("_host", host(F.col("url")))
    hosts = named.select("_host").distinct().withColumn("_d", F.explode(host_suffixes(F.col("_host"))))
    known = hosts.join(domains.select(F.col("domain").alias("_d")).distinct(), "_d", "left_semi").select("_host").distinct()
    return named.join(known.withColumn("trusted", F.lit(True)), "_host", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False))).drop("_host")
