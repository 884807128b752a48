"""Decision ledgers against the sources they were made on: joins by id and hash, merges, coverage and counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.text import collapsed
from tessella.plans.state_plans import BODY
from tessella.sources.tables import table

VERDICTS, TAGS = ("supported", "no_support", "uncertain"), ("quality", "toxic", "theft", "fraud")
METHODS = ("source_coordinate", "osm_point", "osm_line", "osm_polygon", "osm_intersection")
STATUSES = ("current", "stale", "pending")


def _sql_pick(values: tuple[str, ...], by: str) -> str:
    return f"list_extract([{', '.join(repr(v) for v in values)}], CAST({by} % {len(values)} + 1 AS INT))"


def _pick(values: tuple[str, ...], by: F.Column) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), (by % len(values) + 1).cast("int"))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles: id, body and its hash."""
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", collapsed(F.coalesce("text", F.lit(""))).alias("body")).withColumn("sha256", F.sha2("body", 256))


def decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of labelled articles; every ninth was made on an older text."""
    n, d = F.col("doc_id"), sources(spark, sf_dir).select("doc_id", "sha256")
    rows = table(spark, sf_dir, "labels").join(d, "doc_id")
    return rows.select("doc_id", F.when(n % 9 == 0, F.sha2("sha256", 256)).otherwise(F.col("sha256")).alias("seen"), F.when(n % 7 == 0, "uncertain").when(F.col("toxic") == 1, "supported").otherwise("no_support").alias("verdict"), _pick(METHODS, n).alias("method"), (n % 4).alias("incidents"))


LEDGER_SQL = f"""WITH s AS (SELECT doc_id, source, lang, {BODY} AS body, sha256({BODY}) AS sha256 FROM documents),
d AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN sha256(sha256) ELSE sha256 END AS seen, CASE WHEN doc_id % 7 = 0 THEN 'uncertain' WHEN toxic = 1 THEN 'supported' ELSE 'no_support' END AS verdict, {_sql_pick(METHODS, 'doc_id')} AS method, doc_id % 4 AS incidents FROM labels JOIN s USING (doc_id)),
i AS (SELECT s.*, seen, verdict, method, incidents, CASE WHEN seen IS NULL THEN 'pending' WHEN seen = sha256 THEN 'current' ELSE 'stale' END AS status FROM s LEFT JOIN d USING (doc_id))"""


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every article with its decision: current, stale if its text has changed since, pending if there is none."""
    status = F.when(F.col("seen").isNull(), "pending").when(F.col("seen") == F.col("sha256"), "current").otherwise("stale")
    return sources(spark, sf_dir).join(decided(spark, sf_dir), "doc_id", "left").withColumn("status", status)


def scene_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory(spark, sf_dir).select("doc_id", "status", F.when(F.col("status") == "current", F.col("verdict")).alias("verdict"))


def current_supported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supported decisions that were made on the text as it is: joined by id and hash."""
    d = decided(spark, sf_dir).filter("verdict = 'supported'").withColumnRenamed("seen", "sha256")
    return d.join(sources(spark, sf_dir), ["doc_id", "sha256"]).select("doc_id", "source", "method")


def review_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By source: current, stale and pending articles, and the incidents of the current ones."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    return inventory(spark, sf_dir).groupBy("source").agg(*map(count, STATUSES), F.coalesce(F.sum(F.when(F.col("status") == "current", F.col("incidents"))), F.lit(0)).alias("incidents"))


def source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each sheet of two articles of a source is complete, and what blocks it: any stale, pending or empty article."""
    rows = inventory(spark, sf_dir).groupBy("source", F.expr("doc_id div 2").alias("sheet")).agg(F.bool_and(F.col("status") == "current").alias("complete"), F.bool_or(F.col("status") == "stale").alias("a"), F.bool_or(F.col("status") == "pending").alias("b"), F.bool_or(F.col("body") == "").alias("c"))
    return rows.select("source", "sheet", "complete", F.concat_ws(",", *[F.when(F.col(c), F.lit(name)) for c, name in (("a", "stale"), ("b", "pending"), ("c", "empty"))]).alias("blocking"))


def active_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a snapshot that are still active, by kind, with the last time any was seen."""
    return table(spark, sf_dir, "events").filter("value > 0").groupBy("event_type").agg(F.count("*").alias("active"), F.max(F.to_date("ts")).alias("last_seen"))


def scope_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources(spark, sf_dir).groupBy("lang", "source").agg(F.count("*").alias("articles"))


def ledger_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A geometry ledger by verdict and by method, from one grouping."""
    sets = decided(spark, sf_dir).groupingSets([["verdict"], ["method"]], "verdict", "method").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    return sets.select(F.when(F.col("g") == 1, "verdict").otherwise("method").alias("counter"), F.coalesce("verdict", "method").alias("value"), "n")


def candidate_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a candidate map: events, incidents, locations, primary ones, and those that a method resolves."""
    i = inventory(spark, sf_dir).filter("status = 'current'")
    return i.agg(F.count("*").alias("events"), F.coalesce(F.sum("incidents"), F.lit(0)).alias("incidents"), F.coalesce(F.sum(F.col("incidents") + 1), F.lit(0)).alias("locations"), F.count_if(F.col("incidents") > 0).alias("primaries"), F.count_if(F.col("method").isin("source_coordinate", "osm_point", "osm_intersection")).alias("resolved"))


def map_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of announcements and of their incidents, each counted by itself."""
    i = inventory(spark, sf_dir).filter("status <> 'pending'")
    own = i.groupBy(F.col("verdict").alias("category")).agg(F.count("*").alias("announcements"))
    each = i.select(F.explode(F.sequence(F.lit(0), F.col("incidents"))).alias("k"), "doc_id").groupBy(_pick(VERDICTS, F.col("doc_id") + F.col("k")).alias("category")).agg(F.count("*").alias("incidents"))
    return own.join(each, "category", "full_outer").select("category", F.coalesce("announcements", F.lit(0)).alias("announcements"), F.coalesce("incidents", F.lit(0)).alias("incidents"))


def build_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over a build: methods with how many events they mapped and how many they left without a point."""
    mapped = F.col("method").isin("source_coordinate", "osm_point", "osm_intersection")
    return inventory(spark, sf_dir).groupBy(F.coalesce("method", F.lit("none")).alias("method")).agg(F.count_if(mapped).alias("mapped"), F.count_if(~F.coalesce(mapped, F.lit(False))).alias("unlocated"), F.count_if(F.col("method") == "osm_line").alias("road_ranges"))


def index_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of objects, of which each may have several, and objects by geometry."""
    roles = F.array_compact(F.array(F.when(F.col("p_size") % 2 == 0, "road"), F.when(F.col("p_size") % 3 == 0, "place"), F.when(F.col("p_size") % 5 == 0, "station")))
    p = table(spark, sf_dir, "part").select("p_type", F.explode_outer(roles).alias("role"))
    return p.groupBy(F.coalesce("role", F.lit("none")).alias("role"), "p_type").agg(F.count("*").alias("objects"))


def scope_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By kind: rows of all tiles against distinct objects, and the categories under which the kind is shown."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    return lines.groupBy("p_type").agg(F.count("*").alias("tile_rows"), F.count_distinct("l_partkey").alias("objects"), F.concat_ws(",", F.array_sort(F.collect_set("l_returnflag"))).alias("categories"))


def coverage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a host by whether one, several or no articles have their number."""
    number = F.regexp_extract("url", "/([0-9]+)", 1).try_cast("bigint")
    pages = table(spark, sf_dir, "pages").select("page_id", number.alias("number"))
    # An article has its own number, some that of another too, and some none.
    numbers = F.array_compact(F.array(F.when(F.col("doc_id") % 4 != 0, F.col("doc_id")), F.when(F.col("doc_id") % 6 == 0, F.expr("doc_id div 2"))))
    found = table(spark, sf_dir, "documents").select(F.explode(numbers).alias("number")).groupBy("number").agg(F.count("*").alias("n"))
    rows = pages.join(found, "number", "left")
    return rows.groupBy(F.when(F.col("n").isNull(), "unmatched").when(F.col("n") == 1, "matched").otherwise("several").alias("coverage")).agg(F.count("*").alias("pages"))


def relation_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of related reports that more than one of their members counts."""
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("counted"), F.min("turn").alias("first"))
    return rows.filter("counted > 1")


def cluster_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extent of each nation's sites: the longer side of their box."""
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select("s_nationkey", (k * 37 % 1000).alias("x"), (k * 91 % 1000).alias("y"))
    return s.groupBy("s_nationkey").agg(F.count("*").alias("sites"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("span"))


def map_decision_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions with their article and geometry; what any of the three lacks is reported and not dropped."""
    d = table(spark, sf_dir, "orders").select(F.expr("o_orderkey div 3").alias("doc_id"), F.col("o_orderstatus").alias("verdict")).groupBy("doc_id").agg(F.min("verdict").alias("verdict"))
    geometry = table(spark, sf_dir, "part").select((F.col("p_partkey") * 3).alias("doc_id"), F.col("p_type").alias("geometry"))
    rows = d.join(sources(spark, sf_dir).select("doc_id", "sha256"), "doc_id", "left").join(geometry, "doc_id", "left")
    return rows.select("doc_id", "verdict", "geometry", F.concat_ws(",", F.when(F.col("sha256").isNull(), "article"), F.when(F.col("geometry").isNull(), "geometry")).alias("missing"))


def geometry_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests by their object ids: how many an order asks for and how many the index has."""
    asked = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") + F.col("l_linenumber") % 2 * F.lit(10**6)).alias("p_partkey")).distinct()
    index = table(spark, sf_dir, "part").select("p_partkey", F.lit(True).alias("known"))
    return asked.join(index, "p_partkey", "left").groupBy("l_orderkey").agg(F.count("*").alias("asked"), F.count("known").alias("found"))


def geocode_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs paired by id: which methods became which, and how many points moved by more than 100 m."""
    n = F.col("doc_id")
    old = decided(spark, sf_dir).select("doc_id", F.col("method").alias("before"), (n * 37 % 1000).alias("x"))
    new = decided(spark, sf_dir).select("doc_id", _pick(METHODS, n + F.floor(n / 10)).alias("after"), (n * 37 % 1000 + n % 7 * 40).alias("nx"))
    return old.join(new, "doc_id").groupBy("before", "after").agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("nx") - F.col("x")) > 100).alias("moved"))


def translation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with their translation from a pack that is keyed by hash; those without one stay as they are."""
    pack = table(spark, sf_dir, "nation").select(F.sha2("n_name", 256).alias("sha256"), F.concat(F.lit("de:"), F.lower("n_name")).alias("translation"))
    texts = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, F.col("c_mktsegment")).otherwise(F.col("n_name")).alias("text"))
    return texts.withColumn("sha256", F.sha2("text", 256)).join(F.broadcast(pack), "sha256", "left").select("c_custkey", F.coalesce("translation", "text").alias("shown"), F.col("translation").isNotNull().alias("translated"))


def source_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References by the tail of a compound id."""
    refs = table(spark, sf_dir, "lineitem").select(F.concat_ws(":", F.lit("osm"), F.lit("node"), "l_partkey").alias("ref"))
    return refs.groupBy(F.element_at(F.split("ref", ":"), -1).cast("bigint").alias("p_partkey")).agg(F.count("*").alias("uses")).join(table(spark, sf_dir, "part"), "p_partkey").select("p_partkey", "p_name", "uses")


def phase_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phases of a conversation whose quote, its last word, no longer stands in the text of the turn that they name."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    quotes = c.select("conv_id", "turn", (F.col("turn") + F.col("conv_id") % 2).alias("named"), F.regexp_extract("text", r"(\S+)\s*$", 1).alias("quote"))
    rows = quotes.join(c.select("conv_id", F.col("turn").alias("named"), F.col("text").alias("there")), ["conv_id", "named"], "left")
    return rows.select("conv_id", "turn", F.coalesce((F.col("quote") != "") & F.contains("there", F.col("quote")), F.lit(False)).alias("holds"))


def reviewed_street_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed streets by id; a name that has changed since the review is a conflict."""
    reviewed = table(spark, sf_dir, "lineitem").select("l_partkey", F.when(F.col("l_partkey") % 10 == 0, "old name").alias("old")).distinct()
    rows = reviewed.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select("p_partkey", "p_name", (F.coalesce("old", "p_name") == F.col("p_name")).alias("agrees"))


def named_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announcements and the objects that they name, by id or alias, unless the object is of a kind that they exclude."""
    k = F.col("l_partkey")
    named = table(spark, sf_dir, "lineitem").select("l_orderkey", F.explode(F.array_distinct(F.array(k, k + F.col("l_linenumber") % 3 * F.lit(10**6)))).alias("alias"), "l_returnflag")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", F.explode(F.array(F.col("p_partkey"), F.col("p_partkey") + F.lit(10**6))).alias("alias"))
    found = named.join(parts, "alias").filter((F.col("l_returnflag") != "R") | (F.col("p_type") != "ECONOMY"))
    return found.groupBy("l_orderkey").agg(F.count_distinct("p_partkey").alias("objects"))


def identity_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts with one native object get its id; with several or none they stay as they were. Counts never change."""
    ledger = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count_distinct(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("n"), F.min(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("native"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("context")).join(ledger, "o_orderkey", "left")
    return rows.select("o_orderkey", "context", F.when(F.col("n") == 1, F.col("native")).alias("native"), F.when(F.col("n") > 1, "several").when(F.col("n") == 1, "one").otherwise("none").alias("objects"))


def merged_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledgers of two reviewers as one; ids that both decided are told from those of one."""
    d = decided(spark, sf_dir).select("doc_id", "verdict")
    both = d.filter("doc_id % 3 < 2").select("doc_id", "verdict", F.lit("a").alias("who")).unionByName(d.filter("doc_id % 3 > 0").select("doc_id", F.when(F.col("doc_id") % 11 == 0, "uncertain").otherwise(F.col("verdict")).alias("verdict"), F.lit("b").alias("who")))
    return both.groupBy("doc_id").agg(F.when(F.count_distinct("verdict") == 1, F.min("verdict")).otherwise("conflict").alias("verdict"), F.concat_ws("", F.array_sort(F.collect_set("who"))).alias("reviewers"))


def summary_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored summaries against the records they sum: the tag's counts that do not agree."""
    from tessella.plans.stats_plans import tag_verdict_pivot

    now = tag_verdict_pivot(spark, sf_dir)
    stored = now.select("tag", (F.col("supported") + F.when(F.col("tag") == "toxic", 1).otherwise(0)).alias("stored"))
    return now.join(stored, "tag").select("tag", "supported", "stored", (F.col("supported") == F.col("stored")).alias("agrees"))


def upgraded_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assessments of few tags as assessments of all: what an older record does not know was not evaluated."""
    tags = spark.createDataFrame([(t,) for t in TAGS], "tag string")
    old = table(spark, sf_dir, "labels").select("doc_id", F.expr("stack(2, 'quality', quality, 'toxic', toxic) AS (tag, value)"))
    every = table(spark, sf_dir, "labels").select("doc_id").crossJoin(F.broadcast(tags))  # a fixed list of tags for each record
    return every.join(old, ["doc_id", "tag"], "left").select("doc_id", "tag", F.coalesce(F.when(F.col("value") == 1, "supported").when(F.col("value") == 0, "no_support"), F.lit("not_evaluated")).alias("verdict"))


def review_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as they are handed in: refused if their text is stale, the verdict unknown or the quote not in the text; the last accepted one of an id stands."""
    n = F.col("doc_id")
    s = sources(spark, sf_dir)
    words = F.regexp_extract("body", r"(\S+ \S+) *$", 1)
    handed = s.select("doc_id", "body", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("seq"), "sha256", words.alias("last"))
    problem = F.when((n + F.col("seq")) % 9 == 0, "stale").when((n + F.col("seq")) % 8 == 0, "verdict").when((F.col("last") == "") | ((n + F.col("seq")) % 5 == 0), "quote")
    good = handed.select("doc_id", "seq", problem.alias("problem"), _pick(VERDICTS, n + F.col("seq")).alias("verdict"))
    return good.groupBy("doc_id").agg(F.max_by("verdict", F.when(F.col("problem").isNull(), F.col("seq"))).alias("verdict"), F.concat_ws(",", F.array_sort(F.collect_set("problem"))).alias("refused"))


def scope_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City scopes whose evidence stands in the article, whatever its case."""
    s = sources(spark, sf_dir)
    evidence = F.when(F.col("doc_id") % 3 == 0, F.upper(F.regexp_extract("body", r"^(\S+)", 1))).otherwise(F.lit("nowhere at all"))
    return s.select("doc_id", F.coalesce((F.length(evidence) > 0) & F.contains(F.lower("body"), F.lower(evidence)), F.lit(False)).alias("accepted"))


def frozen_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The articles of a batch as they were when it was frozen; ids that the source lacks are told."""
    batch = table(spark, sf_dir, "labels").select("doc_id").union(table(spark, sf_dir, "part").select("p_partkey")).distinct()
    return batch.join(sources(spark, sf_dir).select("doc_id", "sha256"), "doc_id", "left").select("doc_id", "sha256", F.col("sha256").isNotNull().alias("found"))


def decision_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored decisions whose hash, made again from what they hold, differs from the stored one."""
    key = lambda v: F.sha2(F.concat_ws("|", F.col("doc_id").cast("string"), "method", v), 256)
    d = decided(spark, sf_dir).withColumn("stored", key(F.when(F.col("doc_id") % 13 == 0, "changed").otherwise(F.col("verdict"))))
    return d.select("doc_id", (key(F.col("verdict")) == F.col("stored")).alias("intact"))


def review_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of a chain of reviews: each names the hash of the one before; where it breaks."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    named = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.when(F.col("turn") % 5 == 4, F.sha2("h", 256)).otherwise(F.col("h")).alias("names"), F.col("h").alias("before"))
    return c.join(named, ["conv_id", "turn"]).groupBy("conv_id").agg(F.count("*").alias("links"), F.min(F.when(F.col("names") != F.col("before"), F.col("turn"))).alias("broken_at"))


def owner_approval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities whose set of events is what their owner approved: digests of both, whatever the order of rows."""
    digest = lambda h: F.concat_ws(":", F.count("*"), F.bit_xor(h))
    rows = sources(spark, sf_dir).select("lang", F.conv(F.substring("sha256", 1, 15), 16, 10).cast("bigint").alias("h"), "doc_id")
    now = rows.groupBy("lang").agg(digest(F.col("h")).alias("digest"))
    approved = rows.filter("NOT (lang = 'fr' AND doc_id % 10 = 0)").groupBy("lang").agg(digest(F.col("h")).alias("approved"))
    return now.join(approved, "lang", "left").select("lang", "digest", F.coalesce(F.col("digest") == F.col("approved"), F.lit(False)).alias("released"))


QUERIES = {
    "scene_inventory": (scene_inventory, LEDGER_SQL + " SELECT doc_id, status, CASE WHEN status = 'current' THEN verdict END AS verdict FROM i"),
    "current_supported": (current_supported, LEDGER_SQL + " SELECT doc_id, source, method FROM i WHERE verdict = 'supported' AND status = 'current'"),
    "review_summary": (review_summary, LEDGER_SQL + " SELECT source, count(*) FILTER (status = 'current') AS current, count(*) FILTER (status = 'stale') AS stale, count(*) FILTER (status = 'pending') AS pending, CAST(coalesce(sum(incidents) FILTER (status = 'current'), 0) AS BIGINT) AS incidents FROM i GROUP BY 1"),
    "source_audit": (source_audit, LEDGER_SQL + " SELECT source, doc_id // 2 AS sheet, bool_and(status = 'current') AS complete, concat_ws(',', CASE WHEN bool_or(status = 'stale') THEN 'stale' END, CASE WHEN bool_or(status = 'pending') THEN 'pending' END, CASE WHEN bool_or(body = '') THEN 'empty' END) AS blocking FROM i GROUP BY 1, 2"),
    "active_by_kind": (active_by_kind, "SELECT event_type, count(*) AS active, max(CAST(ts AS DATE)) AS last_seen FROM events WHERE value > 0 GROUP BY 1"),
    "scope_groups": (scope_groups, "SELECT lang, source, count(*) AS articles FROM documents GROUP BY ALL"),
    "ledger_counters": (ledger_counters, LEDGER_SQL + " SELECT 'verdict' AS counter, verdict AS value, count(*) AS n FROM d GROUP BY 2 UNION ALL SELECT 'method', method, count(*) FROM d GROUP BY 2"),
    "candidate_counters": (candidate_counters, LEDGER_SQL + " SELECT count(*) AS events, CAST(coalesce(sum(incidents), 0) AS BIGINT) AS incidents, CAST(coalesce(sum(incidents + 1), 0) AS BIGINT) AS locations, count(*) FILTER (incidents > 0) AS primaries, count(*) FILTER (method IN ('source_coordinate', 'osm_point', 'osm_intersection')) AS resolved FROM i WHERE status = 'current'"),
    "map_counters": (map_counters, LEDGER_SQL + f""", a AS (SELECT verdict AS category, count(*) AS n FROM d GROUP BY 1), e AS (SELECT {_sql_pick(VERDICTS, '(doc_id + k)')} AS category, count(*) AS n FROM (SELECT doc_id, unnest(range(0, incidents + 1)) AS k FROM d) GROUP BY 1)
SELECT coalesce(a.category, e.category) AS category, coalesce(a.n, 0) AS announcements, coalesce(e.n, 0) AS incidents FROM a FULL JOIN e ON a.category = e.category"""),
    "build_audit": (build_audit, LEDGER_SQL + ", m AS (SELECT coalesce(method, 'none') AS method, coalesce(method IN ('source_coordinate', 'osm_point', 'osm_intersection'), false) AS ok FROM i) SELECT method, count(*) FILTER (ok) AS mapped, count(*) FILTER (NOT ok) AS unlocated, count(*) FILTER (method = 'osm_line') AS road_ranges FROM m GROUP BY 1"),
    "index_counters": (index_counters, "WITH r AS (SELECT p_type, unnest(CASE WHEN p_size % 2 > 0 AND p_size % 3 > 0 AND p_size % 5 > 0 THEN ['none'] ELSE list_filter([CASE WHEN p_size % 2 = 0 THEN 'road' END, CASE WHEN p_size % 3 = 0 THEN 'place' END, CASE WHEN p_size % 5 = 0 THEN 'station' END], lambda x: x IS NOT NULL) END) AS role FROM part) SELECT role, p_type, count(*) AS objects FROM r GROUP BY ALL"),
    "scope_receipt": (scope_receipt, "SELECT p_type, count(*) AS tile_rows, count(DISTINCT l_partkey) AS objects, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS categories FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"),
    "coverage_audit": (coverage_audit, "WITH p AS (SELECT page_id, TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) AS number FROM pages), n AS (SELECT number, count(*) AS n FROM (SELECT doc_id AS number FROM documents WHERE doc_id % 4 <> 0 UNION ALL SELECT doc_id // 2 FROM documents WHERE doc_id % 6 = 0) GROUP BY 1) SELECT CASE WHEN n IS NULL THEN 'unmatched' WHEN n = 1 THEN 'matched' ELSE 'several' END AS coverage, count(*) AS pages FROM p LEFT JOIN n USING (number) GROUP BY 1"),
    "relation_dups": (relation_dups, """SELECT conv_id, count(*) FILTER (role = 'user') AS counted, min(turn) AS first FROM conversations GROUP BY 1 HAVING count(*) FILTER (role = 'user') > 1"""),
    "cluster_spans": (cluster_spans, "WITH s AS (SELECT s_nationkey, s_suppkey * 37 % 1000 AS x, s_suppkey * 91 % 1000 AS y FROM supplier) SELECT s_nationkey, count(*) AS sites, greatest(max(x) - min(x), max(y) - min(y)) AS span FROM s GROUP BY 1"),
    "map_decision_join": (map_decision_join, "WITH d AS (SELECT o_orderkey // 3 AS doc_id, min(o_orderstatus) AS verdict FROM orders GROUP BY 1) SELECT d.doc_id, verdict, p_type AS geometry, concat_ws(',', CASE WHEN s.doc_id IS NULL THEN 'article' END, CASE WHEN p_type IS NULL THEN 'geometry' END) AS missing FROM d LEFT JOIN documents s ON d.doc_id = s.doc_id LEFT JOIN part ON p_partkey * 3 = d.doc_id"),
    "geometry_requests": (geometry_requests, "WITH a AS (SELECT DISTINCT l_orderkey, l_partkey + l_linenumber % 2 * 1000000 AS p FROM lineitem) SELECT l_orderkey, count(*) AS asked, count(p_partkey) AS found FROM a LEFT JOIN part ON p = p_partkey GROUP BY 1"),
    "geocode_transitions": (geocode_transitions, LEDGER_SQL + f" SELECT method AS before, {_sql_pick(METHODS, '(doc_id + doc_id // 10)')} AS after, count(*) AS n, count(*) FILTER (doc_id % 7 * 40 > 100) AS moved FROM d GROUP BY ALL"),
    "translation_join": (translation_join, "WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment ELSE n_name END AS text FROM customer JOIN nation ON c_nationkey = n_nationkey) SELECT c_custkey, CASE WHEN n_name IS NULL THEN text ELSE 'de:' || lower(n_name) END AS shown, n_name IS NOT NULL AS translated FROM t LEFT JOIN nation ON sha256(text) = sha256(n_name)"),
    "source_references": (source_references, "SELECT p_partkey, p_name, count(*) AS uses FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"),
    "phase_quotes": (phase_quotes, r"""WITH c AS (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations), q AS (SELECT conv_id, turn, turn + conv_id % 2 AS named, regexp_extract(text, '(\S+)\s*$', 1) AS quote FROM c)
SELECT q.conv_id, q.turn, coalesce(quote <> '' AND contains(c.text, quote), false) AS holds FROM q LEFT JOIN c ON q.conv_id = c.conv_id AND q.named = c.turn"""),
    "reviewed_street_join": (reviewed_street_join, "SELECT DISTINCT p_partkey, p_name, p_partkey % 10 <> 0 AS agrees FROM lineitem JOIN part ON l_partkey = p_partkey"),
    "named_objects": (named_objects, """WITH n AS (SELECT l_orderkey, l_returnflag, unnest([l_partkey, l_partkey + l_linenumber % 3 * 1000000]) AS a FROM lineitem), p AS (SELECT p_partkey, p_type, unnest([p_partkey, p_partkey + 1000000]) AS a FROM part) SELECT l_orderkey, count(DISTINCT p_partkey) AS objects FROM n JOIN p USING (a) WHERE l_returnflag <> 'R' OR p_type <> 'ECONOMY' GROUP BY 1"""),
    "identity_apply": (identity_apply, "WITH l AS (SELECT l_orderkey, count(DISTINCT l_partkey) AS n, min(l_partkey) AS native FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) SELECT o_orderkey, o_custkey AS context, CASE WHEN n = 1 THEN native END AS native, CASE WHEN n > 1 THEN 'several' WHEN n = 1 THEN 'one' ELSE 'none' END AS objects FROM orders LEFT JOIN l ON o_orderkey = l_orderkey"),
    "merged_ledgers": (merged_ledgers, LEDGER_SQL + ", b AS (SELECT doc_id, verdict, 'a' AS who FROM d WHERE doc_id % 3 < 2 UNION ALL SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'uncertain' ELSE verdict END, 'b' FROM d WHERE doc_id % 3 > 0) SELECT doc_id, CASE WHEN count(DISTINCT verdict) = 1 THEN min(verdict) ELSE 'conflict' END AS verdict, string_agg(DISTINCT who, '' ORDER BY who) AS reviewers FROM b GROUP BY 1"),
    "summary_check": (summary_check, """WITH t AS (SELECT unnest(['quality', 'toxic', 'theft']) AS tag), n AS (SELECT 'quality' AS tag, count(*) AS n FROM labels JOIN documents USING (doc_id) WHERE doc_id % 7 <> 0 AND quality = 1 UNION ALL SELECT 'toxic', count(*) FROM labels JOIN documents USING (doc_id) WHERE doc_id % 7 <> 0 AND toxic = 1)
SELECT tag, coalesce(n, 0) AS supported, coalesce(n, 0) + CAST(tag = 'toxic' AS BIGINT) AS stored, tag <> 'toxic' AS agrees FROM t LEFT JOIN n USING (tag)"""),
    "upgraded_tags": (upgraded_tags, "SELECT doc_id, tag, CASE WHEN tag IN ('theft', 'fraud') THEN 'not_evaluated' WHEN CASE tag WHEN 'quality' THEN quality ELSE toxic END = 1 THEN 'supported' ELSE 'no_support' END AS verdict FROM labels, (SELECT unnest(['quality', 'toxic', 'theft', 'fraud']) AS tag)"),
    "review_records": (review_records, LEDGER_SQL + rf""", h AS (SELECT doc_id, unnest([0, 1]) AS seq, regexp_extract(body, '(\S+ \S+) *$', 1) AS last FROM s), p AS (SELECT doc_id, seq, CASE WHEN (doc_id + seq) % 9 = 0 THEN 'stale' WHEN (doc_id + seq) % 8 = 0 THEN 'verdict' WHEN last = '' OR (doc_id + seq) % 5 = 0 THEN 'quote' END AS problem, {_sql_pick(VERDICTS, '(doc_id + seq)')} AS verdict FROM h)
SELECT doc_id, max_by(verdict, CASE WHEN problem IS NULL THEN seq END) AS verdict, coalesce(string_agg(DISTINCT problem, ',' ORDER BY problem), '') AS refused FROM p GROUP BY 1"""),
    "scope_records": (scope_records, LEDGER_SQL + r" SELECT doc_id, doc_id % 3 = 0 AND regexp_extract(body, '^(\S+)', 1) <> '' AND contains(lower(body), lower(upper(regexp_extract(body, '^(\S+)', 1)))) AS accepted FROM s"),
    "frozen_sources": (frozen_sources, LEDGER_SQL + ", b AS (SELECT doc_id FROM labels UNION SELECT p_partkey FROM part) SELECT b.doc_id, sha256, sha256 IS NOT NULL AS found FROM b LEFT JOIN s ON b.doc_id = s.doc_id"),
    "decision_hashes": (decision_hashes, LEDGER_SQL + " SELECT doc_id, doc_id % 13 <> 0 AS intact FROM d"),
    "review_chain": (review_chain, "SELECT conv_id, count(*) AS links, min(turn) FILTER (turn % 5 = 0) AS broken_at FROM conversations c WHERE EXISTS (SELECT 1 FROM conversations p WHERE p.conv_id = c.conv_id AND p.turn + 1 = c.turn) GROUP BY 1"),
    "owner_approval": (owner_approval, LEDGER_SQL + ", h AS (SELECT lang, doc_id, CAST('0x' || substr(sha256, 1, 15) AS BIGINT) AS h FROM s), n AS (SELECT lang, count(*) || ':' || bit_xor(h) AS digest, bool_or(lang = 'fr' AND doc_id % 10 = 0) AS differs FROM h GROUP BY 1) SELECT lang, digest, lang IS NOT NULL AND NOT differs AS released FROM n"),
}
