"""Text keys, scores and classifications of a statistics news radar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.arrays import bound

# Fixed values of the radar's vocabulary.
STAT_TERMS = [
    "dato", "dati", "statistica", "statistiche", "rapporto", "osservatorio", "indagine", "rilevazione", "percento", "%", "aumento", "calo",
    "crescita", "diminuzione", "record", "massimo", "minimo", "media", "milioni", "miliardi", "tasso", "quota", "indice", "variazione", "occupazione",
    "disoccupazione", "natalità", "mortalità", "inflazione", "prezzi", "consumi", "salari", "redditi", "imprese", "export", "import", "mutui",
    "immobili", "scuola", "studenti", "sanità", "salute", "energia", "emissioni", "rifiuti",
]
RECORD_WORDS = ["record", "massimo storico", "minimo storico", "mai così", "più alto", "più basso"]
GEO = [
    "abruzzo", "basilicata", "calabria", "campania", "emilia-romagna", "friuli-venezia giulia", "lazio", "liguria", "lombardia", "marche", "molise",
    "piemonte", "puglia", "sardegna", "sicilia", "toscana", "trentino-alto adige", "umbria", "valle d'aosta", "veneto", "roma", "milano", "napoli",
    "torino", "palermo", "bologna", "firenze", "genova", "venezia", "bari",
]
TOPICS = {
    "LAVORO": ["lavor", "occupaz", "disoccup", "salari", "stipendi"],
    "ECONOMIA": ["pil", "inflaz", "prezzi", "consumi", "redditi", "imprese", "export", "import", "pressione fiscale", "fisco", "tasse", "profitti", "risparmio"],
    "SALUTE": ["salute", "sanità", "farmac", "osped", "medic"],
    "ISTRUZIONE": ["scuola", "student", "universit", "invalsi", "istruzione"],
    "AMBIENTE": ["ambiente", "clima", "emission", "rifiuti", "suolo", "acqua", "biodivers"],
    "ENERGIA": ["energia", "elettric", "gas", "rinnovabil"],
    "MOBILITA": ["auto", "veicol", "immatricol", "trasport"],
    "CASA": ["casa", "immobil", "mutui", "affitti"],
    "DEMOGRAFIA": ["nascit", "natalità", "mortalità", "popolazione", "resident"],
}
STOP_WORDS = [
    "italia", "italiano", "italiani", "oggi", "ieri", "anno", "anni", "dati", "dato", "statistiche", "statistica", "rapporto", "secondo", "oltre",
    "sono", "della", "delle", "degli", "dello", "nella", "nelle", "con", "per", "tra", "fra", "che", "del", "dei", "gli", "una", "uno", "più", "meno",
    "news",
]
KEY_STOP_WORDS = [
    "italia", "dati", "statistiche", "statistica", "rapporto", "news", "record",
]
EDITORIAL = [
    "pronostico", "quote e statistiche", "scommesse", "oddschecker", "calendario partite", "ospita", "evento", "festival", "dal 2027/28 limite",
    "decreto scuola", "sarà a industria italiana summit", "summit 2026",
]
ACCENTED, PLAIN = "àáâäãèéêëìíîïòóôöõùúûüçñ", "aaaaaeeeeiiiiooooouuuucn"
# The sign or digit is looked for first: what a word is costs more to tell.
_NUMBERS = r"(?U)((?=[+\-\d])(?<!\w)[+-]?(?:20\d{2}|\d{1,3}(?:[\.,]\d+)?)\s*(?:%|milioni|miliardi|mila)?)"


def _listed(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def _any(text: Column, words: list[str]) -> Column:
    return bound(text, lambda t: F.exists(_listed(words), lambda w: F.contains(t, w)))


def term_score(text: Column) -> Column:
    """Five for each statistical term that occurs in a lower-case text, 35 at most."""
    return F.least(F.lit(35), 5 * bound(text, lambda t: F.size(F.filter(_listed(STAT_TERMS), lambda w: F.contains(t, w)))))


def collapsed(text: Column) -> Column:
    """White space single and trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def folded(text: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(text), ACCENTED, PLAIN)


def name_key(text: Column) -> Column:
    """Letters and digits of a folded name: equal for spellings that differ in accents, case and marks."""
    return F.regexp_replace(folded(text), "[^a-z0-9]", "")


def word_key(text: Column) -> Column:
    """Lower-case letters of any script and digits."""
    return F.regexp_replace(F.lower(text), r"(?U)[\W_]", "")


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(folded(text), "[^a-z0-9]+", "-"), "^-|-$", "")


def html_text(html: Column) -> Column:
    """Text of a page without script, style, navigation and frame elements; the common entities decoded."""
    bare = F.regexp_replace(html, r"(?is)<(script|style|nav|footer|header|aside)\b.*?</\1\s*>|<!--.*?-->", " ")
    text = F.regexp_replace(bare, "(?s)<[^>]*>", " ")
    for entity, char in {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return collapsed(text)


def numbers(text: Column) -> Column:
    """Number tokens with their unit words."""
    return F.regexp_extract_all(F.lower(text), F.lit(_NUMBERS), F.lit(1))


def number_core(token: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(F.lower(token), "milioni|miliardi|mila|%", ""), "[^0-9,.\\-]", "")
    return F.regexp_replace(bare, r"^[ .,\-]+|[ .,\-]+$", "")


def number_variants(token: Column) -> Column:
    """Spellings of a number: comma and dot exchanged, thousands with and without a mark."""

    def every(core: Column) -> Column:
        joined = F.when(core.rlike(r"^\d{1,3}[.,]\d{3}$"), F.regexp_replace(core, "[.,]", ""))
        return F.array(core, F.replace(core, F.lit(","), F.lit(".")), F.replace(core, F.lit("."), F.lit(",")), joined)

    return F.filter(F.array_distinct(F.array_compact(bound(number_core(token), every))), lambda v: v != "")


def candidate_score(text: Column, found: Column | None = None) -> Column:
    """How much a text looks like statistics news, 0 to 100; ``found`` are its numbers, where they are known already."""
    figures = F.size(numbers(text) if found is None else found)

    def points(low: Column) -> Column:
        return (
            term_score(low)
            + F.when(low.rlike(r"(?U)(?=\d)\b(20\d{2}|\d{1,2}[\.,]\d+\s*%\b)"), 10).otherwise(0)
            + F.when(_any(low, RECORD_WORDS), 15).otherwise(0)
            + F.when(_any(low, GEO), 5).otherwise(0)
        )

    return F.least(F.lit(100), bound(F.lower(text), points) + F.least(F.lit(30), figures * 6))


def title_keywords(title: Column) -> Column:
    """The first eight distinct words of four letters or more that are no stop words."""
    words = F.regexp_extract_all(F.lower(title), F.lit("([a-zà-ù]{4,})"), F.lit(1))
    return F.slice(F.array_distinct(F.filter(words, lambda w: ~w.isin(STOP_WORDS))), 1, 8)


def topic(text: Column) -> Column:
    """The first topic of which a word occurs."""

    def first(low: Column) -> Column:
        out = None
        for name, words in TOPICS.items():
            hit = _any(low, words)
            out = F.when(hit, name) if out is None else out.when(hit, name)
        return out.otherwise("ALTRO")

    return bound(F.lower(text), first)


# How a topic is named in a headline.
LABELS = {
    "LAVORO": "Lavoro", "ECONOMIA": "Economia", "SALUTE": "Salute", "ISTRUZIONE": "Istruzione", "AMBIENTE": "Ambiente", "ENERGIA": "Energia",
    "MOBILITA": "Mobilità", "CASA": "Casa", "DEMOGRAFIA": "Demografia",
}


def headline(subject: Column, where: Column, figures: Column) -> Column:
    """Headline of a topic, the first of its places and the first of its figures; the whole country and no figure where there are none."""
    label = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in LABELS.items() for x in pair)), subject), F.lit("Dati"))
    place = F.coalesce(F.initcap(F.get(where, F.lit(0))), F.lit("Italia"))
    value = F.get(figures, F.lit(0))
    told = F.concat(label, F.lit(", nuovo dato per "), place, F.lit(": "), value)
    return F.when(value.isNotNull() & (value != ""), told).otherwise(F.concat(label, F.lit(", nuovo aggiornamento statistico per "), place))


def places(text: Column) -> Column:
    """Places that stand in the text as whole words, sorted, twelve at most."""
    whole = lambda low, g: F.contains(low, F.lit(g)) & low.rlike(r"(?U)(?<!\w)" + g.replace(".", r"\.") + r"(?!\w)")
    hits = lambda low: F.array(*(F.when(whole(low, g), F.lit(g)) for g in sorted(GEO)))
    return F.slice(F.array_compact(bound(F.lower(text), hits)), 1, 12)


def is_editorial(title: Column) -> Column:
    return _any(F.lower(title), EDITORIAL)


def host(url: Column) -> Column:
    """Lower-case host without www. and port; empty where there is none."""
    return F.coalesce(F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^www\.", ""), F.lit(""))


def host_suffixes(name: Column) -> Column:
    """The host and every domain above it: a suffix match becomes an equi join."""
    ends = lambda parts: F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return bound(F.split(name, r"\."), ends)


def canonical_url(url: Column) -> Column:
    """https, bare host, path without slashes at its end; no query, no fragment."""
    path = F.regexp_replace(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "/+$", "")
    return F.concat(F.lit("https://"), host(url), path)


def title_key(title: Column) -> Column:
    return F.array_join(F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "[^a-z0-9à-ù ]", " "), " "), lambda w: w != ""), " ")


def real_numbers(tokens: Column) -> Column:
    """Distinct cores that are no years, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(tokens, number_core), lambda v: (v != "") & ~v.rlike(r"^20\d{2}$"))))


def fingerprint(url: Column, title: Column, subject: Column, tokens: Column) -> Column:
    """Identity of a story: by url and title; without a title by url and topic; without a url by topic, title and numbers."""
    key, link = title_key(title), canonical_url(url)
    known = F.trim(F.coalesce(url, F.lit(""))) != ""
    seed = F.when(known & (key != ""), F.concat_ws("|", link, key)).when(known, F.concat_ws("|", link, subject)).otherwise(F.concat_ws("|", subject, key, F.array_join(real_numbers(tokens), "|")))
    return F.substring(F.sha2(seed, 256), 1, 24)


def semantic_key(title: Column, subject: Column, tokens: Column) -> Column:
    """Digest of topic, the first seven long words as a set, and the numbers: near repeats of a story share it."""
    head = F.element_at(F.split(F.element_at(F.split(F.lower(title), " - "), 1), " \\| "), 1)
    words = F.filter(F.split(F.regexp_replace(head, "[^a-z0-9à-ù ]", " "), " +"), lambda w: (F.length(w) >= 4) & ~w.isin(KEY_STOP_WORDS))
    core = F.array_join(F.array_sort(F.array_distinct(F.slice(words, 1, 7))), " ")
    return F.substring(F.sha2(F.concat_ws("|", subject, core, F.array_join(real_numbers(tokens), "|")), 256), 1, 20)


def rfc822(text: Column) -> Column:
    """Time of a feed's date: the day name is not read; null without a zone."""
    bare = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", "")
    zoned = F.regexp_replace(bare, r"\s(GMT|UTC|UT|Z)$", " +0000")
    return F.when(zoned.rlike(r"[+-]\d{4}$"), F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm:ss xx")))


def is_fresh(published: Column, now: Column, days: int = 3) -> Column:
    """Between ``now`` and so many days before; the future is not fresh."""
    age = F.unix_micros(now) - F.unix_micros(published)
    return F.coalesce(age.between(0, days * 86_400_000_000), F.lit(False))


def day_bucket(published: Column, now: Column, zone: str = "Europe/Rome") -> Column:
    """OGGI, IERI or ARCHIVIO by the calendar days of a zone."""
    day = lambda t: F.to_date(F.from_utc_timestamp(t, zone))
    age = F.datediff(day(now), day(published))
    return F.when(age == 0, "OGGI").when(age == 1, "IERI").otherwise("ARCHIVIO")


def article_score(candidate: Column, geos: Column, found: Column) -> Column:
    half = F.floor(candidate / 2).cast("int")
    return F.least(F.lit(100), 50 + half + F.when(F.size(geos) > 0, 10).otherwise(0) + F.when(F.size(found) >= 2, 5).otherwise(0))


def publisher(title: Column) -> Column:
    """What follows the last " - " of an aggregator's title."""
    parts = F.split(title, " - ")
    return F.when(F.size(parts) > 1, F.trim(F.element_at(parts, -1)))


def anchors(html: Column) -> Column:
    """Distinct href values in page order."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r'(?i)<a\b[^>]*?\bhref\s*=\s*["\']?([^"\'\s>]+)'), F.lit(1)))
