"""Names in texts: one Aho-Corasick automaton finds all of them in one pass, instead of a comparison of all pairs.

Names go to the tasks as a broadcast whose size is counted first. More than ``NAME_BYTES`` of them are dealt into
blocks, each with a pass over the texts and its hits united, so no name is left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.shared_files import written

#: Bytes of names, domains and ranks that one pass holds.
NAME_BYTES = 32 << 20
_HITS = "array<struct<rank:bigint,domain:string>>"


class _Names:
    """Names on their way to the tasks, where they arrive as an automaton over (name, [(rank, domain), ...])."""

    def __init__(self, table: pa.Table):
        self.table = table

    def __reduce__(self):
        return _automaton, (self.table,)


def _automaton(table: pa.Table) -> ahocorasick.Automaton:
    found: dict[str, list] = {}
    for name, rank, domain in zip(*(table[c].to_pylist() for c in ("name", "rank", "domain"))):
        found.setdefault(name, []).append((rank, domain))
    out = ahocorasick.Automaton()
    for name, hits in found.items():
        out.add_word(name, (name, hits))
    out.make_automaton()
    return out


def _scan(broadcast):
    kind = pa.list_(pa.struct([("rank", pa.int64()), ("domain", pa.string())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = broadcast.value
        for batch in batches:
            hits = []
            for text in batch.column("text"):
                met = {name: own for _, (name, own) in automaton.iter(text.as_py())} if len(automaton) else {}
                hits.append([{"rank": rank, "domain": domain} for own in met.values() for rank, domain in own])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(hits, kind)], names=["row", "hits"])

    return rows


def named_domains(texts: DataFrame, names: DataFrame, text_col: str = "text", out_col: str = "domains", name_bytes: int = NAME_BYTES) -> DataFrame:
    """``texts`` with an array of the distinct domains whose names occur in the text, by the rank of the name.

    ``names`` has (name, domain, rank); a name occurs where its lower-case letters do, inside words too. Null or empty
    names and null domains are left out; null texts name nothing. One name may have several domains, one domain several
    names, of which the lowest rank counts; equal ranks go by domain.
    """
    spark = texts.sparkSession
    usable = names.select(F.lower("name").alias("name"), "domain", F.col("rank").cast("long").alias("rank")).where("name <> '' and domain is not null")
    usable = written(usable.groupBy("name", "domain").agg(F.min("rank").alias("rank")), "names")
    size = usable.agg(F.sum(F.octet_length("name") + F.octet_length("domain") + 8)).first()[0] or 0
    blocks = max(1, -(-size // name_bytes))
    row = f"row_{uuid.uuid4().hex[:8]}"
    whole = written(texts.select("*", F.monotonically_increasing_id().alias(row)), "texts")
    lower = whole.select(F.col(row).alias("row"), F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("text"))
    hits = None
    for i in range(blocks):
        block = usable.where(F.pmod(F.xxhash64("name"), F.lit(blocks)) == i).toArrow()
        part = lower.mapInArrow(_scan(spark.sparkContext.broadcast(_Names(block))), f"row long, hits {_HITS}").where(F.size("hits") > 0)
        hits = part if hits is None else hits.unionByName(part)
    first = hits.select("row", F.inline("hits")).groupBy("row", "domain").agg(F.min("rank").alias("rank"))
    met = first.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "domain")))["domain"].alias("domains"))
    found = whole.join(met.select(F.col("row").alias(row), F.col("domains").alias(f"{row}_domains")), row, "left")
    domains = F.coalesce(F.col(f"{row}_domains"), F.array().cast("array<string>"))
    return found.select(*(F.col(f"`{c}`") for c in texts.columns), domains.alias(out_col))
