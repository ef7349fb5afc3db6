"""Robust statistics against numpy, with missing values of both kinds."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import arrays as A
from tidemark.functions import links as L
from tidemark.functions import numbers as N
from tidemark.functions import text as T
from tidemark.operators import detectors as D
from tidemark.plans.detector_queries import short_sql

NAN = float("nan")
SERIES = [
    [1.0, None, 3.0, NAN, 5.0],
    [4.0, 1.0, 2.0, 2.0, 9.0, 7.0],
    [None, NAN, None],
    [NAN, 2.0],
    [],
    [3.0, 3.0, 3.0],
    [5.0, NAN, NAN, 1.0, None, 4.0, 4.0],
]


def plain(series):
    x = np.array([NAN if v is None else v for v in series])
    known = x[~np.isnan(x)]
    slopes = [(x[j] - x[i]) / (j - i) for i in range(len(x)) for j in range(i + 1, len(x)) if not np.isnan(x[j] - x[i])]
    slope = np.median(slopes) if slopes else None
    med = np.median(known) if len(known) else None
    mad = np.median(np.abs(known - med)) * 1.4826 if len(known) else None
    sd = known.std() if len(known) else None
    scale = 0.0 if len(known) < 3 else mad if mad > 1e-9 else sd if sd > 1e-9 else 0.0
    cut = [v - slope * i for i, v in enumerate(x) if not np.isnan(v)] if slopes else []
    return med, mad, sd, scale, slope, np.median(cut) if cut else None, known.sum(), len(known)


@pytest.mark.parametrize("place", range(len(SERIES)))
def test_missing_values_are_ignored(spark, place):
    rows = spark.createDataFrame([(SERIES[place],)], "v array<double>")
    v = rows["v"]
    found = rows.select(A.median(v), A.mad(v), A.sd(v), A.robust_scale(v), A.theil_sen(v), A.intercept(v, A.theil_sen(v)), A.total(v), A.mean(v) * 0 + 1).first()
    for got, want in zip(found[:7], plain(SERIES[place])):
        assert (got is None and want is None) or math.isclose(got, want, abs_tol=1e-12), (SERIES[place], found)


def test_rank_correlation_needs_all_values(spark):
    rows = spark.createDataFrame([([1.0, 2.0, 2.0, 8.0],), ([1.0, None, 3.0],), ([1.0, NAN, 3.0],), ([2.0, 2.0],)], "v array<double>")
    found = [r[0] for r in rows.select(A.spearman_time(rows["v"])).collect()]
    assert math.isclose(found[0], 0.9486832980505138) and found[1:] == [0.0, 0.0, 0.0]


def test_spread_to_the_last_bit_of_the_sql(spark):
    """five values of which one is a step away have a spread of 0.4 steps, and 1 / 0.4 is the threshold of anomalies."""
    draw = random.Random(1)
    rows = [(i, [round(0.05 + draw.choice([-2, -1, -1, 0, 0, 0, 0, 0, 0, 0, 1, 1]) * 1e-4, 4) for _ in range(draw.choice([6, 7]))]) for i in range(500)]
    found = D.short_series(spark.createDataFrame(rows, "entity int, values array<double>"), D.GREEN).select("entity", F.array_join("patterns", "|"), *(F.round(c, 6) for c in ("z", "z_level", "score")))
    con = duckdb.connect()
    con.execute("CREATE TABLE t (entity INTEGER, x DOUBLE[])")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    want = con.sql(short_sql(D.GREEN, "s AS (SELECT entity, x, CAST(NULL AS DOUBLE[]) AS wh FROM t)")).fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(want)


@pytest.mark.parametrize("f", [A.median, A.mad, A.sd, A.robust_scale, A.theil_sen, N.inferred_separators, N.percent_or_number, N.dotted_thousands, T.topic, T.term_score, T.places, T.number_variants, T.host_suffixes, L.without_dots])
def test_what_is_measured_is_computed_once(spark, f):
    """F9, F12, F14, F20, F23 to F25: an input that an expression names several times, or within a lambda, is computed as often."""
    assert str(f(F.col("given"))).count("given") == 1
