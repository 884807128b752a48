"""Text normalisation, rule tables and matching."""

from __future__ import annotations

import html
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


BLANKS = "[ \t\n\x0b\f\r]+"

#: Words that mention a kind of place, tried without regard to case but for the shop.
PLACE_WORDS = {
    "airport": "Flughafen|Flughäfen|Flughafenterminal",
    "attraction": "Sehenswürdigkeit|Museum|Museen",
    "bar": "Bar|Bars|Kneipe|Kneipen|Gaststätte|Gaststätten",
    "cafe": "Café|Cafés|Cafe|Cafes",
    "fast_food": "Imbiss|Schnellrestaurant|Fastfoodrestaurant",
    "hotel": "Hotel|Hotels|Hotellobby",
    "marketplace": "Wochenmarkt|Weihnachtsmarkt|Marktplatz",
    "nightclub": "Diskothek|Diskotheken|Nachtclub|Nachtclubs|Tanzlokal",
    "park": "Park|Parkanlage|Parkanlagen",
    "parking": "Parkplatz|Parkhaus|Tiefgarage",
    "restaurant": "Restaurant|Restaurants",
    "shop": "Supermarkt|Supermärkte|Geschäft|Geschäfte|Einkaufszentrum|Kaufhaus|Spätkauf|Laden",
    "station": "(?:(?:U|S|U- und S)-)?Bahnhof|Bahnhöfe|Bahnsteig|Bahnsteigen",
}

#: Headline rules in the order in which they are tried. A deprivation of liberty is no robbery: its word is taken out first.
HEADLINES = [
    ("Raub", "raub|ausgeraub|überf(?:all|äll)"),
    ("Diebstahl", "diebstahl|diebe|trickdieb|gestohlen|einbr(?:uch|üch)|einbrecher|aufbrecher"),
    ("Gewalt", "angriff|angegriffen|angreif|greift|verletz|attack|messer|schuss|schüsse|körperverletz|getötet|tötungs|mord|geschlagen|polizist.*mitgeschleift"),
    ("Sachbeschädigung", "sachbeschädig|beschädigt|vandal|brandstift|in brand gesetzt"),
    ("Bedrohung", "bedroht|bedrohung|erpress"),
    ("Sexualdelikt", "sexual|sexuell|vergewaltig"),
    ("Betäubungsmittel", "drogen|betäubungsmittel|dealer|rauschmittel|heroin|kokain"),
    ("Betrug", "betrug|betrüger"),
    ("Waffendelikt", "waffenhandel|waffendelikt|waffengesetz"),
    ("Eigentumsdelikt", "geldausgabeautomat|geldautomat"),
]

#: Signs of a serious case in a lower-case headline.
SIGNATURES = [
    ("bias_assault", r"\bkörperverletzung\b.{0,100}\brassistisch\w*"),
    ("body_found", r"\bauffinden\b.{0,80}\bleichnam\w*"),
    ("fatal_assault", r"\bkörperverletzung\b.{0,40}\btodesfolge\b"),
    ("homicide", r"\b(?:versucht\w*\s+)?tötungsdelikt\b|\bmord\b"),
    ("senior_robbery", r"\büberfall\w*.{0,80}\bsenior\w*"),
    ("sexual", r"\bsexualdelikt\b|\bsexuell\w*\s+(?:übergriff|belästigung)\w*"),
    ("shooting", r"\bschussabgab\w*|\bschusswaffe\b"),
]
MONTHS = ["Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"]


def _single_forms() -> tuple[str, str]:
    """Characters of the basic plane whose compatibility form is one other character, with that form; dashes become hyphens."""
    pairs = {chr(c): f for c in range(0xA0, 0xFFFE) if len(f := unicodedata.normalize("NFKC", chr(c))) == 1 and f != chr(c)}
    pairs |= dict.fromkeys("‐‑‒–—−", "-")
    return "".join(pairs), "".join(pairs.values())


FORMS = _single_forms()
#: Umlauts written as letter and mark, ligatures, and the sharp s.
SPELLINGS = {"a\u0308": "ä", "o\u0308": "ö", "u\u0308": "ü", "ﬁ": "fi", "ﬂ": "fl", "ß": "ss"}
#: What makes German place names alike, tried in turn on text in lower case: pattern and what stands for it.
ALIKE = {
    r"\bs-(?:\s+und|\s*/)?\s*u-(bahnhof)s?\b": "s+u-$1",  # a station of both kinds, in all its spellings
    r"(?<=\bbahnhof)s\b": "",  # genitives
    r"[ \t]*-[ \t\n]*": "-",
    r"str\.(?=[\s,;/]|$)": "strasse",
    r"\s+": " ",
}


def collapsed(text: Column) -> Column:
    """White space of ASCII made one blank, none at the ends; null stays null."""
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def stripped(page: Column) -> Column:
    """Text between tags, references left as they are."""
    return collapsed(F.regexp_replace(F.regexp_replace(page, "(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), "<[^>]+>", " "))


def first_rule(text: Column, rules: list[tuple[str, str]], flags: str = "(?iU)", default: str | None = None) -> Column:
    """The label of the first rule that the text meets: an ordered ladder as one expression."""
    return F.coalesce(*[F.when(F.regexp_like(text, F.lit(f"{flags}{p}")), F.lit(label)) for label, p in rules], F.lit(default))


def all_rules(text: Column, rules: list[tuple[str, str]], flags: str = "(?iU)") -> Column:
    """The labels of all rules that the text meets, in the rules' order."""
    return F.array_compact(F.array(*[F.when(F.regexp_like(text, F.lit(f"{flags}{p}")), F.lit(label)) for label, p in rules]))


def place_mentions(text: Column) -> Column:
    """Kinds of places that a text mentions, in order. Only the shop heeds case: the noun is a shop, the verb an invitation."""
    rules = [(k, rf"\b(?:{p})\b") for k, p in PLACE_WORDS.items()]
    return F.array_compact(F.array(*[F.when(F.regexp_like(text, F.lit(("(?U)" if k == "shop" else "(?iU)") + p)), F.lit(k)) for k, p in rules]))


def category(title: Column, default: str = "Sonstiges") -> Column:
    return first_rule(F.replace(F.lower(title), F.lit("freiheitsberaub"), F.lit("freiheits ")), HEADLINES, "(?U)", default)


def case_signatures(title: Column) -> Column:
    return all_rules(F.lower(title), SIGNATURES, "(?U)")


def header_times(body: Column) -> Column:
    """Dates with a time in the first 500 characters, each once."""
    return F.array_distinct(F.regexp_extract_all(F.substring(collapsed(body), 1, 500), F.lit(r"\b(\d{2}\.\d{2}\.\d{4},?\s*\d{1,2}:\d{2})\b"), F.lit(1)))


def weekday_date(text: Column) -> Column:
    """The date in "Montag, 3. März 2026"; null if there is none or no such day."""
    pattern = rf"(\d{{1,2}})\.\s*({'|'.join(MONTHS)})\s+(\d{{4}})"
    months = F.create_map(*[x for k, m in enumerate(MONTHS, 1) for x in (F.lit(m), F.lit(f"{k:02d}"))])
    day, month, year = (F.regexp_extract(text, pattern, k) for k in (1, 2, 3))
    return F.when(day != "", F.try_to_date(F.concat_ws("-", year, F.element_at(months, month), F.lpad(day, 2, "0")), "yyyy-MM-dd"))


def quoted(body: Column, quote: Column, least: int = 15) -> Column:
    """Whether a quote of ``least`` characters or more stands word for word in the body, white space aside; null counts as no."""
    q = collapsed(quote)
    return F.coalesce((F.length(q) >= least) & (F.instr(collapsed(body), q) > 0), F.lit(False))


def normalised(text: Column) -> Column:
    """Compatibility forms, case, sharp s, dashes, short forms of Straße, station genitives and white space made alike; null stays null."""
    plain = F.lower(F.translate(text, *FORMS))
    plain = reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), SPELLINGS.items(), plain)
    return F.trim(reduce(lambda t, p: F.regexp_replace(t, f"(?U){p[0]}", p[1]), ALIKE.items(), plain))


@F.pandas_udf(T.StringType())
def unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


#: Where a sentence ends: after its mark and before a letter or opening quote, but not after a short form, nor between a day and its month or a number and a unit of police.
SENTENCE_END = (
    r"(?U)(?<=[.!?])(?<!\b(?:st|dr|nr|ca)\.)(?<!\bbzw\.)(?<!\b[zu]\.)(?<!\b(?:z\. b|u\. a)\.)\s+"
    rf"(?<!\d\.\s(?=(?:{'|'.join(m.lower() for m in MONTHS)}|(?:einsatz)?hundertschaft|mordkommission)))(?=[\p{{L}}„“])"
)


def sentences(text: Column) -> Column:
    """Sentences of a whole text in normal form; no text has none."""
    return F.filter(F.split(normalised(text), SENTENCE_END), lambda s: F.trim(s) != "")


#: How the words before the last of a German name bend, and what a name's last word takes on.
BENT = {"sche$": "schen", "^(alte|neue|grosse|kleine)$": "$1n", "^(kleine|grosse)r$": "$1n"}
TAKES = {"(ring|weg|damm|park|ufer|garten)$": "s", "platz$": "es"}


def name_aliases(name: Column) -> Column:
    """Inflected forms under which a German name may be written, sorted, the name itself among them."""
    words = F.split(normalised(name), " ")
    bent = F.transform(F.slice(words, F.lit(1), F.size(words) - 1), lambda w: reduce(lambda x, p: F.regexp_replace(x, p[0], p[1]), BENT.items(), w))
    forms = F.array(F.array_join(words, " "), F.array_join(F.concat(bent, F.slice(words, -1, 1)), " "))
    takes = lambda f: F.coalesce(*[F.when(F.regexp_like(f, F.lit(end)), F.lit(more)) for end, more in TAKES.items()])
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(forms, F.transform(forms, lambda f: F.concat(f, takes(f)))))))


def fingerprint(*columns: Column | str) -> Column:
    """SHA-256 over columns as JSON in the order given, nulls included; it binds rows of this engine alone."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def escaped_xml(text: Column) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")], text)
