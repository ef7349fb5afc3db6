"""Numbers out of the text of reports whose tables stand as labelled rows: a label, then the row's numbers."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import collapsed

#: Characters after a label that its numbers may take.
WINDOW = 500
# Digits without dots are one number, however many they are.
_NUMBER = r"(-?(?:\d{1,3}(?:\.\d{3})+|\d+)(?:,\d+)?%?)"


@dataclass(frozen=True)
class Row:
    """A series of a report: the label of its row, which of the row's numbers are its values, and what must hold.

    ``places`` count from 0; the row must have ``least`` numbers, and the last value must lie from ``low`` to ``high``.
    """

    name: str
    label: str
    unit: str
    places: tuple[int, ...]
    least: int
    low: float = float("-inf")
    high: float = float("inf")


def labelled_window(text: Column, label: str) -> Column:
    """What follows the first ``label`` that numbers can follow, up to the next word of four letters; empty where there is none."""
    word = r"[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ ]{3,}"
    return F.regexp_extract(collapsed(text), rf"(?i){re.escape(label)}\s+(.{{1,{WINDOW}}}?)(?={word}|$)", 1)


def window_numbers(window: Column) -> Column:
    """The numbers of a window, dots for thousands and a comma for decimals, per cent signs dropped."""
    tokens = F.regexp_extract_all(window, F.lit(_NUMBER), F.lit(1))
    plain = lambda t: F.replace(F.replace(F.rtrim(t, F.lit("%")), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.transform(tokens, lambda t: plain(t).cast("double"))


def read_reports(reports: DataFrame, rows: list[Row], periods: list[str], text_col: str = "text") -> DataFrame:
    """(…, name, unit, periods, values, error) of every report and row; the other columns of ``reports`` are kept.

    A row of which anything is amiss has its error and no values: ``missing_row``, ``too_few_values`` or ``out_of_range``,
    as a changed layout would otherwise give numbers that look right. Null texts miss every row.
    """
    rest = [c for c in reports.columns if c != text_col]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    found = []
    for row in rows:
        window = labelled_window(text, row.label)
        numbers = window_numbers(window)
        values = F.array(*(F.get(numbers, F.lit(i)) for i in row.places))
        last = F.element_at(values, -1)
        error = (
            F.when(F.length(window) == 0, "missing_row")
            .when(F.size(numbers) < max(row.least, max(row.places) + 1), "too_few_values")
            .when(~last.between(row.low, row.high), "out_of_range")
        )
        found.append(F.struct(F.lit(row.name).alias("name"), F.lit(row.unit).alias("unit"), F.when(error.isNull(), values).alias("values"), error.alias("error")))
    each = reports.select(*(F.col(f"`{c}`") for c in rest), F.explode(F.array(*found)).alias("_row"))
    return each.select(*(F.col(f"`{c}`") for c in rest), "_row.name", "_row.unit", F.lit(periods).alias("periods"), "_row.values", "_row.error")
