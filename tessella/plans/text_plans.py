"""Text, page and evidence queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import text as tx
from tessella.operators import names
from tessella.operators.graph import grouped
from tessella.plans.state_plans import BODY
from tessella.session import ship
from tessella.sources.tables import table


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invented prose with a German headline in front, by id."""
    heads = ["Raub in der Bar am Bahnhof", "Freiheitsberaubung im Hotel", "Einbruch im Supermarkt", "Angriff im Park", "Auto in Brand gesetzt am Parkplatz", "Bedrohung im Café", "Drogen im Nachtclub", "Betrug im Restaurant", "Schusswaffe am Flughafen", "Mord im Museum", "Gäste zum Fest geladen", ""]
    head = F.element_at(F.array(*map(F.lit, heads)), (F.col("doc_id") % len(heads) + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(" ", head, F.col("text")).alias("title"))


HEADS_SQL = """WITH t AS (SELECT doc_id, concat_ws(' ', list_extract(['Raub in der Bar am Bahnhof', 'Freiheitsberaubung im Hotel', 'Einbruch im Supermarkt', 'Angriff im Park', 'Auto in Brand gesetzt am Parkplatz', 'Bedrohung im Café', 'Drogen im Nachtclub', 'Betrug im Restaurant', 'Schusswaffe am Flughafen', 'Mord im Museum', 'Gäste zum Fest geladen', ''], CAST(doc_id % 12 + 1 AS INT)), text) AS title FROM documents)"""
#: A word's edge in an engine whose own knows ASCII alone.
_L, _R = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"


def _word_case(kind: str, words: str) -> str:
    flags = "" if kind == "shop" else "(?i)"
    return f"CASE WHEN regexp_matches(title, '{flags}{_L}({words}){_R}') THEN '{kind}' END"


def mention_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _titles(spark, sf_dir).select("doc_id", F.concat_ws(",", tx.place_mentions(F.col("title"))).alias("kinds"))


def category_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _titles(spark, sf_dir).select("doc_id", tx.category(F.col("title")).alias("category"))


def case_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _titles(spark, sf_dir).select("doc_id", F.explode(tx.case_signatures(F.col("title"))).alias("signature"))


def html_listing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of a listing; the last of a repeated target wins."""
    pages = table(spark, sf_dir, "pages")
    found = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('(<a href="[^"]*">[^<]*</a>)'), F.lit(1))).alias("seq", "a"))
    links = found.select("page_id", "seq", F.regexp_extract("a", '<a href="([^"]*)">', 1).alias("href"), F.regexp_extract("a", ">([^<]*)<", 1).alias("label"))
    return links.groupBy("page_id", "href").agg(F.max_by("label", "seq").alias("label"))


def html_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return table(spark, sf_dir, "pages").select("page_id", tx.collapsed(tx.unescaped(tx.stripped(F.col("html")))).alias("text"))


def html_stripped_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.length(tx.stripped(F.col("html"))).cast("bigint").alias("n_chars"))


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses in canonical form: host without www or m, path without a trailing slash, no query or fragment."""
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace(F.lower(F.regexp_extract(u, "^[a-z]+://([^/?#]*)", 1)), r"^(www|m)\.", "").alias("host"), F.regexp_replace(F.regexp_extract(u, "^[a-z]+://[^/?#]*([^?#]*)", 1), "/+$", "").alias("path"), u.rlike("^https://[^@/]+(/|$)").alias("safe"))


def upstream_two_stage_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages meet official reports by host and number; what is left, by a number that only one report has."""
    pages = table(spark, sf_dir, "pages").select("page_id", (F.col("page_id") % 20).alias("src"), F.regexp_extract("url", r"/([0-9]+)", 1).try_cast("bigint").alias("number"))
    reports = table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract("source", "([0-9]+)", 1).try_cast("bigint").alias("src"), (F.col("doc_id") * 2).alias("number"))
    direct = pages.join(reports, ["src", "number"]).select("page_id", "doc_id", F.lit("address").alias("stage"))
    unique = reports.groupBy("number").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")).filter("n = 1")
    rest = pages.join(direct, "page_id", "left_anti").join(unique, "number").select("page_id", "doc_id", F.lit("number").alias("stage"))
    return direct.union(rest)


def quote_evidence_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes of benchmark items, each of twelve words, and the documents in which they stand word for word.

    Documents meet quotes by the hash of any five words in a row, and are then searched for the whole quote.
    """
    fives = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - 4), lambda k: F.xxhash64(F.array_join(F.slice(w, k, 5), " ")))
    items = table(spark, sf_dir, "benchmark").select("item_id", F.split(tx.collapsed(F.coalesce("text", F.lit(""))), " ").alias("w")).filter("size(w) >= 12")
    quotes = items.select("item_id", F.explode(F.sequence(F.lit(1), F.size("w") - 11, F.lit(12))).alias("k"), "w").select("item_id", F.col("k").cast("bigint").alias("word"), F.slice("w", F.col("k"), 12).alias("q"))
    quotes = quotes.select("item_id", "word", F.array_join("q", " ").alias("quote"), F.xxhash64(F.array_join(F.slice("q", 1, 5), " ")).alias("h"))
    bodies = table(spark, sf_dir, "documents").select("doc_id", tx.collapsed(F.coalesce("text", F.lit(""))).alias("body"))
    seen = bodies.select("doc_id", F.split("body", " ").alias("w")).filter("size(w) >= 12").select("doc_id", F.explode(F.array_distinct(fives(F.col("w")))).alias("h"))
    pairs = seen.join(quotes, "h").select("doc_id", "item_id", "word", "quote")
    return pairs.join(bodies, "doc_id").filter(tx.quoted(F.col("body"), F.col("quote"))).select("doc_id", "item_id", "word").distinct()


def text_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(tx.collapsed(F.coalesce("text", F.lit(""))), 256).alias("sha256"))


def identical_article_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_fingerprint(spark, sf_dir).groupBy("sha256").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")).filter("copies > 1")


#: Spellings and their normal forms, put around names.
SPELT = {"Str.": "strasse", "– S- und U-Bahnhofs": "-s+u-bahnhof", "GROẞE  Str. ,": "grosse strasse ,", "des U-Bahnhofs Ｎｒ.": "des u-bahnhof nr.", "Ka\u0308the - Weg": "käthe-weg"}
BEFORE, AFTER = ("Alte", "Kleiner", "Deutsche", "Hohe"), ("Platz", "Weg", "Tor")


def _picked(values: tuple[str, ...], by: str) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.expr(by) % len(values) + 1).cast("int"))


def normalise_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names in capitals before spellings of streets and stations, in normal form."""
    return table(spark, sf_dir, "part").select("p_partkey", tx.normalised(F.concat(F.upper("p_name"), F.lit("  "), _picked(tuple(SPELT), "p_partkey"))).alias("name"))


def name_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat_ws(" ", _picked(BEFORE, "p_partkey"), "p_name", _picked(AFTER, "p_partkey div 4"))
    return table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(",", tx.name_aliases(name)).alias("aliases"))


def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.size(tx.sentences(F.coalesce("text", F.lit("")))).cast("bigint").alias("sentences"))


def dictionary_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of the benchmark's words, by threes (the last of an item by what is left), in all documents."""
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    threes = table(spark, sf_dir, "benchmark").select(words.alias("w")).filter("size(w) > 0")
    named = threes.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w"), F.lit(3)), lambda k: F.array_join(F.slice("w", k, 3), " "))))
    docs = table(spark, sf_dir, "documents").select("doc_id", LETTERS(F.col("text")).alias("text"))
    return names.dictionary_matches(docs, "doc_id", "text", named).withColumnRenamed("id", "doc_id")


def LETTERS(text: F.Column) -> F.Column:  # noqa: N802
    """What is neither a letter nor a digit made a blank, so that another engine sees the same words at the same places."""
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))


_WORDS = r"""WITH RECURSIVE i AS (SELECT regexp_extract_all(lower(text), '\S+') AS w FROM benchmark),
n0 AS (SELECT regexp_extract_all(replace(array_to_string(w[k : k + 2], ' '), 'ß', 'ss'), '[\p{L}\p{N}_]+') AS n FROM (SELECT w, unnest(range(1, len(w) + 1, 3)) AS k FROM i)),
n AS (SELECT DISTINCT len(n) AS words, array_to_string(n, ' ') AS name FROM n0 WHERE len(n) > 0),
d AS (SELECT doc_id, string_split(replace(lower(trim(regexp_replace(text, '[^\p{L}\p{N}]+', ' ', 'g'))), 'ß', 'ss'), ' ') AS w FROM documents WHERE text IS NOT NULL),
h AS (SELECT doc_id, k, words, name FROM (SELECT doc_id, k, words AS m, array_to_string(w[k : k + words - 1], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM d), (SELECT DISTINCT words FROM n) WHERE k + words - 1 <= len(w)) JOIN n ON g = name AND m = words),
b AS (SELECT doc_id, k, max(words) AS words, max_by(name, words) AS name FROM h GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS r FROM b),
x AS (SELECT a.doc_id, a.r, a.k, a.words, a.name, min(c.r) AS nxt FROM o a LEFT JOIN o c ON c.doc_id = a.doc_id AND c.k >= a.k + a.words AND c.k < a.k + a.words + 400 GROUP BY ALL),
y AS (SELECT x.doc_id, x.r, x.k, x.words, x.name, coalesce(nxt, (SELECT min(r) FROM o WHERE o.doc_id = x.doc_id AND o.k >= x.k + x.words)) AS nxt FROM x),
z AS (SELECT doc_id, r, k, words, name, nxt FROM y WHERE r = 1 UNION ALL SELECT y.doc_id, y.r, y.k, y.words, y.name, y.nxt FROM z JOIN y ON y.doc_id = z.doc_id AND y.r = z.nxt)
SELECT z.doc_id, name, CAST(length(array_to_string(w[1 : k - 1], ' ')) + CASE WHEN k > 1 THEN 1 ELSE 0 END AS BIGINT) AS start, CAST(length(array_to_string(w[1 : k + words - 1], ' ')) AS BIGINT) AS end FROM z JOIN d USING (doc_id)"""


def header_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("Tatzeit: "), F.date_format("ts", "dd.MM.yyyy, HH:mm"), F.lit(" Uhr, Montag, 3. März 2026")).alias("body"))
    return e.select("event_id", F.element_at(tx.header_times(F.col("body")), 1).alias("time"), F.try_to_timestamp(F.element_at(tx.header_times(F.col("body")), 1), F.lit("dd.MM.yyyy, HH:mm")).cast("date").alias("day"), tx.weekday_date(F.col("body")).alias("written"))


def occurrence_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of one occurrence, joined by links between equal texts and between neighbours in a chain of follow-ups."""
    d = text_fingerprint(spark, sf_dir)
    first = d.groupBy("sha256").agg(F.min("doc_id").alias("v"))
    copies = d.join(first, "sha256").select(F.col("doc_id").alias("u"), "v")
    follow = d.filter("doc_id % 10 IN (1, 2)").select(F.col("doc_id").alias("u"), (F.col("doc_id") - 1).alias("v"))
    return grouped(d.select("doc_id"), "doc_id", copies.union(follow)).select("doc_id", F.col("root").alias("group_id"))


OCCURRENCE_SQL = f"""WITH RECURSIVE s AS (SELECT doc_id, sha256({BODY}) AS h FROM documents), c AS (SELECT doc_id AS u, min(doc_id) OVER (PARTITION BY h) AS v FROM s),
e AS (SELECT u, v FROM c WHERE u <> v UNION SELECT doc_id, doc_id - 1 FROM documents WHERE doc_id % 10 IN (1, 2) AND doc_id - 1 IN (SELECT doc_id FROM documents)), b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
r(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b.v, r.root FROM r JOIN b ON r.node = b.u) SELECT node AS doc_id, min(root) AS group_id FROM r GROUP BY node"""
_STRIP = r"trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '[ \t\n\x0b\f\r]+', ' ', 'g'))"
_TITLE = "replace(lower(title), 'freiheitsberaub', 'freiheits ')"

QUERIES = {
    "mention_kinds": (mention_kinds, HEADS_SQL + f" SELECT doc_id, concat_ws(',', {', '.join(_word_case(k, w) for k, w in tx.PLACE_WORDS.items())}) AS kinds FROM t"),
    "category_ladder": (category_ladder, HEADS_SQL + f" SELECT doc_id, CASE {' '.join(f"WHEN regexp_matches({_TITLE}, '{p}') THEN '{k}'" for k, p in tx.HEADLINES)} ELSE 'Sonstiges' END AS category FROM t"),
    "case_signatures": (case_signatures, HEADS_SQL + f" SELECT doc_id, unnest(['homicide', 'shooting']) AS signature FROM t WHERE false UNION ALL SELECT doc_id, 'homicide' FROM t WHERE regexp_matches(lower(title), '{_L}mord{_R}') UNION ALL SELECT doc_id, 'shooting' FROM t WHERE regexp_matches(lower(title), '{_L}schusswaffe{_R}')"),
    "html_listing_links": (html_listing_links, """WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>')) AS a, generate_subscripts(regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>'), 1) AS seq FROM pages),
l AS (SELECT page_id, seq, regexp_extract(a, '<a href="([^"]*)">', 1) AS href, regexp_extract(a, '>([^<]*)<', 1) AS label FROM a) SELECT page_id, href, max_by(label, seq) AS label FROM l GROUP BY ALL"""),
    "html_visible_text": (html_visible_text, None),
    "html_stripped_length": (html_stripped_length, f"SELECT page_id, length({_STRIP}) AS n_chars FROM pages"),
    "url_parts": (url_parts, r"""SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^(www|m)\.', '') AS host, regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS path, regexp_matches(url, '^https://[^@/]+(/|$)') AS safe FROM pages"""),
    "upstream_two_stage_match": (upstream_two_stage_match, """WITH p AS (SELECT page_id, page_id % 20 AS src, TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) AS number FROM pages), r AS (SELECT doc_id, TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT) AS src, doc_id * 2 AS number FROM documents),
d AS (SELECT page_id, doc_id FROM p JOIN r USING (src, number)), u AS (SELECT number, min(doc_id) AS doc_id FROM r GROUP BY number HAVING count(*) = 1)
SELECT page_id, doc_id, 'address' AS stage FROM d UNION ALL SELECT page_id, doc_id, 'number' FROM p JOIN u USING (number) WHERE page_id NOT IN (SELECT page_id FROM d)"""),
    "quote_evidence_check": (quote_evidence_check, f"""WITH b AS (SELECT item_id, string_split({BODY}, ' ') AS w FROM benchmark), q AS (SELECT item_id, unnest(range(1, len(w) - 10, 12)) AS word, w FROM b WHERE len(w) >= 12), t AS (SELECT item_id, word, array_to_string(w[word:word + 11], ' ') AS quote FROM q), d AS (SELECT doc_id, {BODY} AS body FROM documents)
SELECT DISTINCT doc_id, item_id, word FROM d JOIN t ON contains(body, quote)"""),
    "text_fingerprint": (text_fingerprint, f"SELECT doc_id, sha256({BODY}) AS sha256 FROM documents"),
    "identical_article_dups": (identical_article_dups, f"SELECT sha256({BODY}) AS sha256, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1"),
    "normalise_names": (normalise_names, f"SELECT p_partkey, replace(lower(p_name) || ' ' || list_extract([{', '.join(repr(v) for v in SPELT.values())}], CAST(p_partkey % {len(SPELT)} + 1 AS INT)), ' -', '-') AS name FROM part"),
    "name_variants": (name_variants, """WITH n AS (SELECT p_partkey, list_extract(['alte', 'kleiner', 'deutsche', 'hohe'], CAST(p_partkey % 4 + 1 AS INT)) AS a, list_extract(['alten', 'kleinen', 'deutschen', 'hohe'], CAST(p_partkey % 4 + 1 AS INT)) AS b, lower(p_name) || list_extract([' platz', ' weg', ' tor'], CAST((p_partkey // 4) % 3 + 1 AS INT)) AS r, list_extract(['es', 's', ''], CAST((p_partkey // 4) % 3 + 1 AS INT)) AS e FROM part),
f AS (SELECT DISTINCT p_partkey, unnest([a || ' ' || r, b || ' ' || r, a || ' ' || r || e, b || ' ' || r || e]) AS f FROM n) SELECT p_partkey, string_agg(f, ',' ORDER BY f) AS aliases FROM f GROUP BY 1"""),
    "sentence_split": (sentence_split, None),
    "dictionary_match": (dictionary_match, _WORDS),
    "header_times": (header_times, "SELECT event_id, strftime(ts, '%d.%m.%Y, %H:%M') AS time, CAST(ts AS DATE) AS day, DATE '2026-03-03' AS written FROM events"),
    "occurrence_groups": (occurrence_groups, OCCURRENCE_SQL),
}
