"""Mentions of places in the sentences of all documents, with phrases of police reports mixed in; DuckDB searches the same texts for the same cues.

DuckDB's patterns know neither look-ahead nor letters, digits or blanks beyond ASCII, so these are replaced in its texts and patterns alike, and what looks ahead is written in another way.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import mentions as m
from tessella.functions.text import normalised
from tessella.sources.tables import table

#: What may stand before a name, and after one; each sentence gets one of either.
LEFT = (
    "tatort: berlin-mitte, ", "hinweise nimmt die wache in der ", "der vorfall geschah nahe der ", "sie wurden in das kommissariat ", "zeugen brachten den verletzten mann zur ", "er ging in richtung ", "ein auto, aus der ",
    "für die unfallaufnahme war die ", "ein mann wurde geschlagen, als der täter über die ", "beamte nahmen ihn in der ", "eine frau hörte an der ", "er war aus der ", "trotz einer schussabgabe setzte er die fahrt in der ",
    "daraufhin fuhr er zur ", "der verkehr staute sich zwischen ", "ein fahrrad wurde in der ", "er lief eilig über die ", "das geschah im ortsteil ", "sie wohnt in berlin-", "unfallort: ", "sie warteten am u-bahnhof ",
    "gäste im restaurant „", "zwei frauen befuhren die ", "bei einem unfall befuhren sie die ", "wir umbefuhren ", "ein taxi fuhr gegen 12:30 uhr in den ", "ein taxi fuhr gegen den ", "ort: am bahnsteig des u-bahnhofs ",
    "tatort: hamburg-altona, u-bahn-linie u3 (u3), haltestelle ", "unfallort: alte gasse / ", "im bereich zwischen der ", "zuerst kam ein bus, später dann ging es in der ", "",
)
RIGHT = (
    "", ", danach wurde ein mann festgenommen", " entgegen", " gebracht", ", wo sie den rettungsdienst riefen", " kommend, prallte gegen einen baum", " zwei stunden lang zu", " und der täter floh", " fest", " einen lauten knall",
    " unterwegs", " fort", ", wobei er stürzte", ", wobei er sang", "; jemand schlug zu", "allee und dem ring, hiess es", "strasse und dem alten weg kam es zum unfall", "weg und der brücke. dort", " gesperrt, der verkehr stand",
)
#: Titles and bodies of reports on operations.
TITLES = ("", "verbundeinsatz: ", "bilanz der verkehrswoche: ", "bilanz: ", "ergebnisse der bundesweiten verkehrssicherheitsaktion ", "thementag drogen ")
BODIES = (" es gab stationäre und mobile verkehrskontrollen", " bei kontrollen überprüften beamte viele fahrzeuge", " man leitete strafverfahren ein", " kontrollen ergaben ordnungswidrigkeiten", "")


def _plain(text: str) -> str:
    """ASCII letters for others, one for one, in results: rare ones for those of German words and a low line for the rest."""
    return "".join(c if c.isascii() or not c.isalpha() else {"ä": "x", "ö": "j", "ü": "q", "ß": "z"}.get(c, "_") for c in text)


ACCENTS = "äöüßàâæçéèêëîïôœùûÿñáíóú"
#: What stands for German letters, and for digits beyond ASCII, in texts that DuckDB searches: capitals, which lower-case texts lack, so that no other word becomes a cue.
_GERMAN, _CAPITALS, _DIGIT = "äöüß", "AOUS", "N"
#: Characters beyond ASCII that words may hold (letters, marks, letter numbers, connectors, joiners, letters in circles and squares), and all white space but what DuckDB's patterns know.
_IN_WORDS = r"[^\x00-\x7f\P{L}]|[^\x00-\x7f\P{M}]|\p{Nl}|[^\x00-\x7f\P{Pc}]|[\x{200c}\x{200d}\x{24b6}-\x{24e9}\x{1f130}-\x{1f149}\x{1f150}-\x{1f169}\x{1f170}-\x{1f189}]"
_BLANKS = r"[\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def replaced(text: str) -> str:
    """SQL for a lower-case text with another character, of one kind with it to DuckDB's patterns, for every letter, digit or blank that they do not know; one for one."""
    digits = f"regexp_replace(translate({text}, '{_GERMAN}', '{_CAPITALS}'), '[^\\x00-\\x7f\\P{{Nd}}]', '{_DIGIT}', 'g')"
    return f"regexp_replace(regexp_replace({digits}, '{_IN_WORDS}', '_', 'g'), '{_BLANKS}', chr(9), 'g')"


def _searched(pattern: str) -> str:
    """A pattern for texts that are replaced."""
    assert not re.search(r"\[[^]]*\\d|(?<!\\)[A-Z]", pattern), pattern
    return pattern.translate(str.maketrans(_GERMAN, _CAPITALS)).replace(r"\d", f"[0-9{_DIGIT}]")


def _lower(text: str) -> str:
    """SQL for a text in lower case; of all letters, a dotted capital I becomes two characters, which DuckDB leaves out."""
    return f"lower(replace({text}, 'İ', 'i' || chr(775)))"


def _picked(values: tuple[str, ...], by: str) -> F.Column:
    """One of the values in turn, whatever the number's sign; the first where there is none."""
    return F.element_at(F.array(*map(F.lit, values)), F.expr(f"int(pmod(coalesce({by}, 0), {len(values)})) + 1"))


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, nr (number of the sentence), sentence, start and end: the last word of every sentence of a document, named again after its first word, between two phrases."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.lower(F.regexp_replace("text", r"[\r\n\t]+", " ")), r"[.!?] +")).alias("nr", "s"))
    words = docs.select("doc_id", "nr", F.substring_index("s", " ", 1).alias("first"), F.substring_index("s", " ", -1).alias("name"), "s").filter("length(s) >= 3")
    said = words.select("doc_id", "nr", "name", F.concat_ws(" ", "first", _picked(LEFT, "doc_id * 31 + nr * 17")).alias("lead"), _picked(RIGHT, "doc_id * 7 + nr * 5").alias("right"), F.substr("s", F.length("first") + 1).alias("rest"))
    return said.select("doc_id", "nr", F.concat("lead", "name", "right", "rest").alias("sentence"), F.length("lead").alias("start"), (F.length("lead") + F.length("name")).alias("end"))


def mention_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mentions(spark, sf_dir).select("doc_id", "nr", m.role(F.col("sentence"), F.col("start"), F.col("end")).alias("role"))


def mention_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of each mention's clause, and where the mention is in it."""
    return _mentions(spark, sf_dir).select("doc_id", "nr", m.clause_lengths(F.col("sentence"), F.col("start"), F.col("end")).alias("c")).select("doc_id", "nr", "c.before", "c.length")


def mention_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mentions(spark, sf_dir).select("doc_id", "nr", m.tests(F.col("sentence"), F.col("start"), F.col("end")).alias("t")).select("doc_id", "nr", "t.*")


def aggregate_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which reports sum up an operation: every document after a title and between two phrases."""
    docs = table(spark, sf_dir, "documents").select("doc_id", _picked(TITLES, "doc_id").alias("title"), F.concat_ws("", _picked(BODIES, "doc_id div 6"), F.lit(". "), normalised(F.col("text")), F.lit("."), _picked(BODIES, "doc_id div 30")).alias("body"))
    return docs.select("doc_id", m.tells_totals(F.col("title"), F.col("body")).alias("totals"))


def section_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roads (letters beyond ASCII replaced) between which something happened, of the sentences that name such a section."""
    bounds = F.translate(F.array_join(m.section_bounds(F.col("sentence")), " / "), ACCENTS, _plain(ACCENTS))
    return _mentions(spark, sf_dir).select("doc_id", "nr", bounds.alias("bounds")).filter("bounds <> ''")


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _pick_sql(values: tuple[str, ...], by: str) -> str:
    return f"list_extract({_list(values)}, CAST((coalesce({by}, 0) % {len(values)} + {len(values)}) % {len(values)} AS INT) + 1)"


def _like(text: str, pattern: str) -> str:
    """Whether the other engine finds a pattern; what follows an action "an" may be part of the match, and times after "gegen" are taken out before."""
    pattern = pattern.replace(r"(?=\s*[,.;]|$)", r"(?:\s*[,.;]|$)")
    clock = r"(?!\s+\d{1,2}(?::\d{2})?\s*uhr)"
    if clock in pattern:
        text, pattern = f"regexp_replace({text}, '{_searched(r'\bgegen(\s+\d{1,2}(?::\d{2})?\s*uhr)')}', 'gege_\\1', 'g')", pattern.replace(clock, "")
    assert not re.search(r"\(\?[=!]", pattern), pattern
    return f"regexp_matches({text}, '{_searched(pattern).replace(chr(39), chr(39) * 2)}')"


#: From a table h (lead, name, rest, with letters replaced) its clauses, and all cues.
CLAUSES_SQL = f"""b AS (SELECT *, regexp_replace(lead, '(?s)^.*(?:{_searched(m.BREAK)}|{_searched(m.LINKED)}({_searched(m.NEXT_ACTION)}))', '\\1') AS before, regexp_extract(rest, '(?s)^(.*?)(?:$|{_searched(m.BREAK)}|{_searched(m.LINKED)}(?:{_searched(m.NEXT_ACTION)}))', 1) AS near_after FROM h),
c AS (SELECT *, CASE WHEN {_like('substr(rest, length(near_after) + 1)', r'^,\s*wobei\b')} AND {_like('substr(rest, length(near_after) + 1)', m.either(*m.ACTS))} THEN rest ELSE near_after END AS after FROM b)"""
_SAID = f"""WITH d AS (SELECT doc_id, string_split_regex({_lower("regexp_replace(text, '[\\r\\n\\t]+', ' ', 'g')")}, '[.!?] +') AS ss FROM documents),
e AS (SELECT doc_id, unnest(range(len(ss))) AS nr, unnest(ss) AS s FROM d),
f AS (SELECT doc_id, nr, s, regexp_extract(s, '^([^ ]*)', 1) AS first, regexp_extract(s, '([^ ]*)$', 1) AS name FROM e WHERE length(s) >= 3),
g AS (SELECT doc_id, CAST(nr AS INT) AS nr, name, first || ' ' || {_pick_sql(LEFT, 'doc_id * 31 + nr * 17')} AS lead, {_pick_sql(RIGHT, 'doc_id * 7 + nr * 5')} || substr(s, length(first) + 1) AS rest FROM f),
h AS (SELECT doc_id, nr, lead || name || rest AS said, {replaced('lead')} AS lead, {replaced('name')} AS name, {replaced('rest')} AS rest FROM g),
{CLAUSES_SQL}"""
_PARTS = {"sentence": "lead || name || rest", "lead": "lead", "near": "right(before, 100)", "after": "after", "clause": "before || name || after"} | {f"last{n}": f"right(lead, {n})" for n in (180, 65, 45)}
CUES_SQL = f"""q AS (SELECT *, {', '.join(f'{_like("(" + _PARTS[part] + ")", pattern)} AS "{name}"' for name, (part, pattern) in m.CUES.items())}, contains(name, 'bahnhof') AS "named" FROM c)"""
_CUES = f"{_SAID}, {CUES_SQL}"


#: What stands before the first name of a section and between its names, and how names are shown.
_START, _, _LINK = (_searched(p) for p in re.split(f"({re.escape(f'({m._NAME})')})", m.BETWEEN)[:3])
_SHOWN = f"translate({{0}}, '{ACCENTS}', '{_plain(ACCENTS)}')"


def condition_sql(text: str) -> str:
    return re.sub(r"\b([a-z_]+)\b", r'"\1"', text)


#: The role and the tests of a row of q.
ROLE_SQL = "CASE " + " ".join(f"WHEN {condition_sql(c)} THEN '{name}'" for name, c in m.ROLES) + " ELSE 'primary' END"
QUERIES = {
    "mention_roles": (mention_roles, f"{_CUES} SELECT doc_id, nr, {ROLE_SQL} AS role FROM q"),
    "mention_clauses": (mention_clauses, f"{_SAID} SELECT doc_id, nr, CAST(length(before) AS INT) AS before, CAST(length(before || name || after) AS INT) AS length FROM c"),
    "mention_contexts": (mention_contexts, f"{_CUES} SELECT doc_id, nr, {', '.join(f'{condition_sql(c)} AS {name}' for name, c in m.TESTS.items())} FROM q"),
    "aggregate_reports": (aggregate_reports, f"""WITH r AS (SELECT doc_id, {replaced(_pick_sql(TITLES, 'doc_id'))} AS title, {replaced(f"{_pick_sql(BODIES, 'doc_id // 6')} || '. ' || coalesce({_lower('text')}, '') || '.' || {_pick_sql(BODIES, 'doc_id // 30')}")} AS body FROM documents)
SELECT doc_id, ({_like('title', m.JOINT)} AND {_like('body', m.STATIONED)}) OR ({_like('body', m.CONTROLS)} AND {_like('body', m.OFFENCES)} AND ({_like('title', m.REVIEW)} AND {_like('title', m.THEMES)} AND {_like('body', m.COUNTED)} OR {_like('title', m.CAMPAIGN)})) AS totals FROM r"""),
    "section_bounds": (section_bounds, f"""{_SAID}, t AS (SELECT said, doc_id, nr, regexp_extract(lead || name || rest, '^((?s:.*?){_START})({m._NAME})({_LINK})({m._NAME})(?:{_searched(m.FOLLOWED)})', ['p', 'a', 'l', 'b']) AS n FROM h),
u AS (SELECT doc_id, nr, n, trim(substr(said, length(n.p) + 1, length(n.a)), ' ') AS a, trim(substr(said, length(n.p || n.a || n.l) + 1, length(n.b)), ' ') AS b FROM t)
SELECT doc_id, nr, {_SHOWN.format("a || ' / ' || b")} AS bounds FROM u WHERE {_like("trim(n.a, ' ')", f'{m.either(*m.ROADS)}$')} AND {_like("trim(n.b, ' ')", f'{m.either(*m.ROADS)}$')}"""),
}
