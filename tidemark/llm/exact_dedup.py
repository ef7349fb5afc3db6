"""Exact dedup on DataFrame functions alone: an extendible-hash index in shared files.

The directory of the index is addressed by the top bits of the hash of a normalised text. It is laid
out first, from the number of distinct hashes below each prefix: a bucket with more entries than fit is
split by one bit more, the directory doubling until no bucket is overfull. Rows then find their bucket
through their slot. Rows that agree are combined before they are sent, so that a text that a third of
all rows repeat comes as a few entries with counts. The task that owns a bucket combines the entries of
each text, chains texts whose hashes collide, and writes its range of hashes sorted. Bodies with equal
hashes are compared by their bytes. A row is looked up by slot, bucket, hash and place in the chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._common import BROADCAST_ROWS, col, id_and_text, only_ids, spread_join, stored

#: Entries that a bucket holds before it splits.
BUCKET_ENTRIES = 50_000
#: Leading bits of a hash that splits may use: 16 million directory slots at most.
MOST_DEPTH = 24


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space."""
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", " ")


def _leading(depth: int) -> Column:
    return F.shiftrightunsigned(F.col("hash"), 64 - depth) if depth else F.lit(0).cast("long")


def directory(hashes: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> tuple[int, DataFrame]:
    """(global depth, slots): each slot of leading bits with the bucket that owns it, for distinct ``hash`` values.

    Starts with one bucket. While one is overfull the directory doubles: slots of buckets that fit
    point to them still, overfull ones split by their next bit.
    """
    cells = stored(hashes.groupBy(_leading(MOST_DEPTH).alias("cell")).count(), "cells")
    fitting, depth, prefix = None, 0, F.lit(0).cast("long")
    while True:
        loads = cells.groupBy(prefix.alias("prefix")).agg(F.sum("count").alias("entries"))
        loads = stored(loads.select(F.lit(depth).alias("depth"), "prefix", "entries"), "loads")
        fits = F.col("entries") <= (bucket_entries if depth < MOST_DEPTH else 1 << 62)
        fitting = loads.where(fits) if fitting is None else fitting.unionByName(loads.where(fits))
        full = loads.where(~fits).select("prefix")
        if full.isEmpty():
            break
        cells = cells.withColumn("prefix", prefix).join(full, "prefix", "left_semi").select("cell", "count")
        depth += 1
        prefix = F.shiftright("cell", MOST_DEPTH - depth)
    spare = F.lit(depth) - F.col("depth")
    first = F.expr(f"shiftleft(prefix, {depth} - depth)")
    slots = fitting.select(
        F.concat_ws(":", "depth", "prefix").alias("bucket"),
        F.explode(F.sequence(first, first + F.expr(f"shiftleft(1L, {depth} - depth)") - 1)).alias("slot"),
        spare.alias("spare_bits"),
    )
    return depth, stored(slots, "directory")


def _bucketed(rows: DataFrame, depth: int, slots: DataFrame) -> DataFrame:
    """Rows with the bucket that the directory names for their slot; a directory too large to broadcast is dealt in copies."""
    rows = rows.withColumn("slot", _leading(depth))
    slots = slots.select("slot", "bucket")
    if slots.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(slots), "slot").drop("slot")
    copies = slots.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(31))))
    return rows.withColumn("copy", F.pmod(F.xxhash64("row"), F.lit(32)).cast("int")).join(copies, ["slot", "copy"]).drop("slot", "copy")


def _numbered(keyed: DataFrame, texts: DataFrame) -> DataFrame:
    """``keyed`` with ``clash``: 0, but for texts that share both digests with another, whose bodies are numbered."""
    repeated = stored(keyed.groupBy("hash").count().where("count > 1").select("hash"), "repeated")
    bodies = texts.select(F.xxhash64("body").alias("hash"), F.sha2("body", 256).alias("text_sha256"), "body")
    if repeated.count() <= BROADCAST_ROWS:
        bodies = bodies.join(F.broadcast(repeated), "hash", "left_semi").distinct()
    else:
        bodies = bodies.distinct().join(repeated, "hash", "left_semi")
    alike = bodies.groupBy("hash", "text_sha256").agg(F.count("*").alias("bodies")).where("bodies > 1")
    alike = stored(alike.select("hash", "text_sha256"), "alike")
    if alike.isEmpty():
        return keyed.withColumn("clash", F.lit(0))
    texts = stored(texts, "bodies")  # rows get their numbers once more, and keep these
    return _told_apart(_keyed(texts), texts, alike)


def _keyed(texts: DataFrame) -> DataFrame:
    """(row, id, hash, text_sha256) of rows (row, id, body), as a written table."""
    return stored(texts.select("row", "id", F.xxhash64("body").alias("hash"), F.sha2("body", 256).alias("text_sha256")), "keyed")


def _told_apart(keyed: DataFrame, texts: DataFrame, alike: DataFrame) -> DataFrame:
    """Numbers the bodies of each (hash, text_sha256) of ``alike``."""
    bodies = texts.withColumns({"hash": F.xxhash64("body"), "text_sha256": F.sha2("body", 256)}).join(alike, ["hash", "text_sha256"])
    numbers = bodies.select("hash", "text_sha256", "body").distinct()
    numbers = numbers.withColumn("clash", F.row_number().over(Window.partitionBy("hash", "text_sha256").orderBy("body")))
    of_row = stored(bodies.join(numbers, ["hash", "text_sha256", "body"]).select("row", "clash"), "clashes")
    return stored(keyed.join(of_row, "row", "left").na.fill(0, ["clash"]), "keyed")


def build_index(keyed: DataFrame, depth: int, slots: DataFrame) -> DataFrame:
    """Writes the index and reads it back: (bucket, hash, link, text_sha256, clash, keep_id, keep_row, group_size) an entry.

    ``keyed`` is a written table (row, id, hash, text_sha256, clash); ``link`` is the place of an entry in
    the chain of its hash.
    """
    key = ["bucket", "hash", "text_sha256", "clash"]
    sent = _bucketed(keyed, depth, slots).groupBy(*key).agg(
        F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")).alias("keep"), F.count("*").alias("group_size")
    )
    owned = sent.repartition("bucket")
    chain = Window.partitionBy("bucket", "hash").orderBy("text_sha256", "clash")
    owned = owned.select(*key, F.col("keep.id").alias("keep_id"), F.col("keep.row").alias("keep_row"), "group_size", F.row_number().over(chain).alias("link"))
    return stored(owned.sortWithinPartitions("bucket", "hash", "link"), "index")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row.

    Texts are equal when they are identical after each run of ASCII white space became one space;
    the row with the smallest id of each group is kept. Null text counts as empty, and empty texts
    are equal. Rows without an id come after all others; exactly one row of a group is kept, also
    where rows repeat their id. An empty table gives an empty result. Other columns are ignored.
    """
    texts = id_and_text(docs, id_col, text_col)
    body = texts.select(F.monotonically_increasing_id().alias("row"), "id", normalised(F.col("text")).alias("body"))
    keyed = _numbered(_keyed(body), body)
    depth, slots = directory(keyed.select("hash").distinct(), bucket_entries)
    index = build_index(keyed, depth, slots)
    found = spread_join(_bucketed(keyed, depth, slots), index, ["bucket", "hash", "text_sha256", "clash"], "group_size")
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that exact_dedup keeps: one of each group, also where rows repeat their id or have none.

    An id whose rows all go is dropped by id. Rows of an id of which some stay, and rows without an
    id, are told apart by the digest of their text; of rows that have both in common one is taken.
    """
    found = exact_dedup(docs, id_col, text_col)
    verdicts = found.groupBy("doc_id").agg(F.bool_or("kept").alias("some"), F.bool_and("kept").alias("every"))
    verdicts = stored(verdicts.where("not every").select("doc_id", "some"), "verdicts")
    rest = only_ids(docs, id_col, verdicts.where("doc_id is not null").select("doc_id"), "left_anti").select(*map(col, docs.columns))
    unnamed = verdicts.where("doc_id is null").first()
    if unnamed:
        rest = rest.where(col(id_col).isNotNull())
    if verdicts.where("some").isEmpty():
        return rest
    rows = only_ids(docs, id_col, verdicts.where("some and doc_id is not null").select("doc_id"))
    if unnamed and unnamed["some"]:
        rows = rows.unionByName(docs.where(col(id_col).isNull()))
    digest = F.sha2(normalised(F.coalesce(col(text_col), F.lit(""))), 256)
    one = rows.groupBy(col(id_col).alias("id"), digest.alias("digest")).agg(F.first(F.struct(*map(col, docs.columns))).alias("whole"))
    kept = found.where("kept").select("doc_id", "text_sha256")
    one = one.join(kept, one["id"].eqNullSafe(kept["doc_id"]) & (one["digest"] == kept["text_sha256"]), "left_semi")
    return rest.unionByName(one.select("whole.*"))
