"""Classes of indicators, places and probes, and the row tests of the publishers' tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import folded

# Areas by words of the domain and, where there are any, of the indicator; the first that fits counts.
AREAS = [
    ("Sanità", ["salute"], ["ospedal", "medic", "servizi sanitari", "rinuncia", "spesa sanitaria", "infermier"]),
    ("Salute", ["salute"], []),
    ("Istruzione", ["istruzione"], []),
    ("Povertà", ["economico"], ["povert", "deprivazione", "disagio economic"]),
    ("Disuguaglianza", ["economico"], ["disuguaglianza", "gini", "s80", "dispersione del reddito"]),
    ("Redditi", ["economico"], ["reddito", "retribuzione"]),
    ("Potere d'acquisto e consumi", ["economico"], []),
    ("Ambiente", ["ambiente"], []),
    ("Servizi e qualità locale", ["servizi"], []),
    ("Lavoro e mercato del lavoro", ["lavoro"], []),
    ("Territorio e mobilità", ["sicurezza"], []),
    ("Società e cultura", ["paesaggio", "cultura", "sociali"], []),
    ("Imprese e industria", ["innovazione"], []),
]
# The same for the national compendium.
NATIONAL_AREAS = [
    ("Sanità", ["sanità", "salute"], ["ospedal", "medic", "sanitari", "spesa sanitaria", "posti letto", "istituti di cura"]),
    ("Salute", ["sanità", "salute"], []),
    ("Istruzione", ["istruzione"], []),
    ("Povertà", ["condizioni economiche"], ["povert", "depriv", "disagio"]),
    ("Disuguaglianza", ["condizioni economiche"], ["disuguagl", "gini", "s80"]),
    ("Redditi", ["condizioni economiche"], ["reddito", "retribuz"]),
    ("Potere d'acquisto e consumi", ["condizioni economiche"], []),
    ("Ambiente", ["ambiente"], []),
    ("Lavoro e mercato del lavoro", ["lavoro"], []),
    ("Popolazione e demografia", ["popolazione"], []),
    ("Turismo", ["turismo"], []),
    ("Imprese e industria", ["strutture produttive"], []),
    ("Società e cultura", ["cultura"], []),
    ("Territorio e mobilità", ["infrastrutture", "trasporti"], []),
]
# Areas of monitored series that are shown under another name, and the two series of one that go elsewhere.
SERIES_AREAS = {
    "Lavoro e redditi": "Lavoro e mercato del lavoro",
    "Prezzi e consumi": "Prezzi e inflazione",
    "Imprese": "Imprese e industria",
    "Turismo e mobilità": "Turismo",
}
CONSUMPTION_SERIES = ["Vendite al dettaglio", "Fiducia dei consumatori"]
# Green pillars by words of a measure, and by goal where no word fits.
PILLARS = [
    ("Economia circolare", ["rifiut", "ricicl", "raccolta differenziata", "materiali", "circolare", "discarica", "compost"]),
    ("Risorse idriche e suolo", ["acqua", "idric", "suolo", "sicc", "desertif", "erosion", "frana", "alluvion", "impermeabil", "territorio naturale"]),
    (
        "Tutela della biodiversità",
        ["biodivers", "fauna", "flora", "habitat", "natura 2000", "specie", "ittic", "forest", "aree marine", "aree protette", "braccon"],
    ),
    ("Mobilità sostenibile", ["mobilit", "trasporto pubblico", "autovetture elettriche", "veicoli elettr", "bev", "phev", "passeggeri", "ciclab", "biciclett"]),
    (
        "Transizione energetica",
        ["energia rinnov", "fonti rinnov", "energetic", "elettric", "fotovolta", "eolic", "solare", "efficienza energetica", "combustibili fossili"],
    ),
    (
        "Crisi climatica e decarbonizzazione",
        ["gas serra", "emission", "co2", "co₂", "temperatura", "clima", "pm2", "pm10", "no2", "nox", "sox", "nh3", "qualità dell'aria"],
    ),
]
GOAL_PILLARS = {
    6: "Risorse idriche e suolo",
    7: "Transizione energetica",
    12: "Economia circolare",
    13: "Crisi climatica e decarbonizzazione",
    14: "Tutela della biodiversità",
    15: "Tutela della biodiversità",
}
GOALS = [6, 7, 11, 12, 13, 14, 15]
TOTAL_SEX = ["totale", "totali", "total", "t"]
METROPOLITAN = [
    "torino", "milano", "venezia", "genova", "bologna", "firenze", "roma", "napoli", "bari", "reggio di calabria", "palermo", "catania", "messina", "cagliari", "sassari",
]


def has_any(text: Column, words: list[str]) -> Column:
    """Whether one of the words occurs; without words, yes."""
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(text, w)) if words else F.lit(True)


def area(domain: Column, indicator: Column, rules: list[tuple[str, list[str], list[str]]] | None = None) -> Column:
    """Area of an indicator by the first rule that fits; the domain itself where none does."""
    d, k = F.lower(domain), F.lower(indicator)
    return F.coalesce(*(F.when(has_any(d, of_domain) & has_any(k, of_indicator), name) for name, of_domain, of_indicator in rules or AREAS), domain)


def series_area(original: Column, name: Column) -> Column:
    """Area that a monitored series is shown under."""
    shown = F.create_map(*(F.lit(x) for pair in SERIES_AREAS.items() for x in pair))
    spent = (original == "Prezzi e consumi") & name.isin(CONSUMPTION_SERIES)
    return F.when(spent, "Potere d'acquisto e consumi").otherwise(F.coalesce(F.try_element_at(shown, original), original))


def green_pillar(measure: Column, goal: Column) -> Column:
    """Pillar of a measure by its words, else by its goal; null where neither tells."""
    low = F.lower(measure)
    by_goal = F.create_map(*(F.lit(x) for pair in GOAL_PILLARS.items() for x in pair))
    return F.coalesce(*(F.when(has_any(low, words), name) for name, words in PILLARS), F.try_element_at(by_goal, goal))


def area_type(raw: Column, name: Column) -> Column:
    """Whether a second-level area is a metropolitan city, by its title or its name."""
    metropolitan = F.contains(folded(raw), F.lit("metropolitana")) | F.trim(folded(name)).isin(METROPOLITAN)
    return F.when(metropolitan, "Città metropolitana").otherwise("Provincia")


def probe_status(verified: Column, reachable: Column) -> Column:
    """Status of a source by the number of its verified resources and of its answers."""
    return F.when(verified > 0, "structured_endpoint_verified").when(reachable > 0, "official_portal_reachable").otherwise("blocked")


def is_total_sex(sex: Column) -> Column:
    return F.coalesce(F.lower(F.trim(sex)).isin(TOTAL_SEX), F.lit(False))


def region_of(code: Column) -> Column:
    """Region number of a code such as 12-07-000; null for other levels and for groups of regions (00)."""
    number = F.regexp_extract(F.trim(code), r"^\d{2}-(\d{2})-000$", 1)
    return F.when(~number.isin("", "00"), number)


def goal_number(goal: Column) -> Column:
    return F.regexp_extract(goal, r"(?i)^Goal\s+(\d+)", 1).try_cast("int")


def is_national_goal(goal: Column, level: Column, dimension: Column) -> Column:
    """Rows of the whole country for the environmental goals, not split by another dimension."""
    whole = F.coalesce(F.lower(F.trim(dimension)), F.lit("")).isin("", "territorio")
    return F.coalesce(goal_number(goal).isin(GOALS) & F.contains(level, F.lit("Italia (NUTS 0)")) & whole, F.lit(False))


def is_monthly_total(sex: Column, month: Column, code: Column) -> Column:
    """Monthly rows of both sexes with a code; the yearly sums beyond month 12 are none."""
    return F.coalesce((sex == "Totale") & month.between(1, 12) & code.isNotNull(), F.lit(False))


def enough_values(values: Column, least: int = 6) -> Column:
    return F.size(F.filter(values, lambda v: v.isNotNull())) >= least


def count_or_zero(value: Column) -> Column:
    """A count out of text; what is missing or no number is zero."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0))
