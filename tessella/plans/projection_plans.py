"""Projections of records for the map, sources and sinks read back, and rule tables of the record contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.functions import geo
from tessella.functions.text import quoted, stripped
from tessella.operators import gates
from tessella.plans.ledger_plans import LEDGER_SQL, inventory
from tessella.plans.state_plans import BODY
from tessella.session import shared_path
from tessella.sources import publish
from tessella.sources.tables import ANNOUNCED, announcements, decisions, placed, placed_sql, table


def _place(df: DataFrame, key: str) -> DataFrame:
    return placed(df, key).withColumns({"lon": F.round("lon", 6), "lat": F.round("lat", 6)})


def compact_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates of a record rounded to six places throughout, its working geometry left out."""
    line = F.array(F.struct("lon", "lat"), F.struct((F.col("lon") + F.col("id") / 7e6).alias("lon"), (F.col("lat") - F.col("id") / 3e6).alias("lat")))
    rows = announcements(spark, sf_dir).select("id", line.alias("line"), F.lit("not for readers").alias("location_geometry"))
    kept = rows.select("id", F.transform("line", lambda p: F.struct(F.round(p.lon, 6).alias("lon"), F.round(p.lat, 6).alias("lat"))).alias("line"))
    return kept.select("id", F.element_at("line", 1)["lon"].alias("lon1"), F.element_at("line", 1)["lat"].alias("lat1"), F.element_at("line", 2)["lon"].alias("lon2"), F.element_at("line", 2)["lat"].alias("lat2"))


def canonical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in canonical form: rounded, with a known precision and a month; what fails is told apart and not dropped."""
    rows = announcements(spark, sf_dir).select("id", "month", "precision", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), F.when(F.col("k") % 9 != 0, F.col("category")).alias("category"))
    return rows.select("id", "month", "lon", "lat", F.when(F.col("category").isNull(), "category").when(F.col("precision") == "district", "precision").alias("problem"))


def scene_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes of an order: each place once with what happened there, in the order of the lines."""
    lines = table(spark, sf_dir, "lineitem")
    scenes = lines.groupBy("l_orderkey", (F.col("l_suppkey") % 10).alias("place")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag"))).alias("i"), F.max("l_quantity").alias("most"))
    return scenes.select("l_orderkey", "place", F.concat_ws(",", F.transform("i", lambda x: x.l_returnflag)).alias("incidents"), F.when(F.col("most") > 40, "primary").otherwise("reference").alias("role"))


def event_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with what the map shows of them: customer and nation, the number of their lines and places, and the main one."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("incidents"), F.count_distinct("l_suppkey").alias("places"), F.max_by("l_suppkey", F.struct("l_quantity", "l_suppkey")).alias("main_place"))
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = o.join(lines, "o_orderkey", "left")
    return rows.select("o_orderkey", "n_name", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.coalesce("incidents", F.lit(0)).alias("incidents"), F.coalesce("places", F.lit(0)).alias("places"), "main_place", F.when(F.col("main_place").isNull(), "unlocated").when(F.col("places") == 1, "point").otherwise("several").alias("shown_as"))


def phase_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as phases in order: their roles, first and last turn, and how long each text is."""
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.length(F.coalesce("text", F.lit(""))).alias("n")))).alias("p"))
    return c.select("conv_id", F.concat_ws(">", F.transform("p", lambda x: x.role)).alias("phases"), F.concat_ws(",", F.transform("p", lambda x: x.n.cast("string"))).alias("lengths"), F.element_at("p", 1)["turn"].alias("first"), F.element_at("p", -1)["turn"].alias("last"))


def search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What can be searched for: objects whose name says more than their kind."""
    p = _place(table(spark, sf_dir, "part"), "p_partkey").withColumn("name", F.when(F.col("p_partkey") % 5 == 0, F.col("p_type")).otherwise(F.col("p_name")))
    return p.filter(F.col("name") != F.col("p_type")).select("p_partkey", "name", F.col("p_type").alias("kind"), "lon", "lat")


def geometry_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collections of geometries, one level within another, flattened to their parts in order."""
    inner = F.transform(F.sequence(F.lit(0), F.col("p_size") % 3), lambda k: F.concat(F.lit("point-"), k))
    parts = F.flatten(F.array(F.array(F.lit("line")), inner, F.array(F.col("p_type"))))
    return table(spark, sf_dir, "part").select("p_partkey", F.posexplode(parts).alias("seq", "part")).select("p_partkey", F.col("seq").cast("bigint").alias("seq"), "part")


def display_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes of reviewers, shown only with the very text that they were written for."""
    return inventory(spark, sf_dir).select("doc_id", F.when(F.col("status") == "current", F.concat_ws(": ", "method", "verdict")).alias("note"), (F.col("status") == "stale").alias("withheld"))


def display_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects completed for display: a label where they have no name, their category, and whether they are background only."""
    p = table(spark, sf_dir, "part").withColumn("name", F.when(F.col("p_size") % 4 != 0, F.col("p_name")))
    return p.select("p_partkey", F.coalesce("name", F.initcap("p_type")).alias("label"), F.lower("p_type").alias("category"), F.col("name").isNull().alias("background"))


def scope_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base with an overlay upon it: the overlay's values where it has any, the base's else, and what only the overlay has."""
    base = table(spark, sf_dir, "part").filter("p_partkey % 5 <> 0").select("p_partkey", F.col("p_type").alias("kind"))
    over = table(spark, sf_dir, "part").filter("p_size > 25").select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("over"))
    return base.join(over, "p_partkey", "full_outer").select("p_partkey", F.coalesce("over", "kind").alias("kind"))


def compact_circles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings that are circles of 50 m to 0.35 m become a point and a radius; all others stay rings."""
    n, bump = F.col("id"), F.when(F.col("id") % 3 == 0, 0.3).when(F.col("id") % 3 == 1, 0.5).otherwise(0.0)
    ring = geo.circle(F.col("x"), F.col("y"))
    rows = announcements(spark, sf_dir).select("id", "x", "y", F.transform(ring, lambda p, k: F.struct((p.x + F.when(k == n % 32, bump * F.cos(F.radians(F.lit(0.0)))).otherwise(0.0)).alias("x"), p.y.alias("y"))).alias("ring"))
    worst = F.array_max(F.transform("ring", lambda p: F.abs(F.sqrt((p.x - F.col("x")) * (p.x - F.col("x")) + (p.y - F.col("y")) * (p.y - F.col("y"))) - 50)))
    return rows.select("id", F.when((F.size("ring") == 33) & (worst <= 0.35), "point").otherwise("ring").alias("sent_as"))


def route_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each way the routes that it is a member of, by order and place in the route."""
    m = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber"))).alias("m"))
    return m.select("l_partkey", F.size("m").cast("bigint").alias("memberships"), F.element_at("m", 1)["l_orderkey"].alias("first_route"), F.concat_ws(",", F.transform("m", lambda x: x.l_linenumber.cast("string"))).alias("places"))


def platform_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of a platform in the order in which it lists them, each once."""
    p = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("p"))
    return p.select("l_orderkey", F.concat_ws(",", F.array_distinct(F.transform("p", lambda x: (x.l_suppkey % 20).cast("string")))).alias("points"))


def track_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of a track between two stops that it passes, whichever comes first; none if it passes either not at all or more than once."""
    k = F.col("p_partkey")
    t = table(spark, sf_dir, "part").select("p_partkey", F.transform(F.sequence(F.lit(0), k % 12 + 3), lambda n: (k + n * n) % 40).alias("track"), (k % 40).alias("a"), ((k + 9) % 40).alias("b"))
    once = lambda s: F.size(F.filter("track", lambda x: x == F.col(s))) == 1
    i, j = F.array_position("track", F.col("a")), F.array_position("track", F.col("b"))
    cut = F.when(once("a") & once("b") & (F.col("a") != F.col("b")), F.slice("track", F.least(i, j).cast("int"), (F.abs(i - j) + 1).cast("int")))
    return t.select("p_partkey", F.concat_ws(",", F.transform(F.when(i > j, F.reverse(cut)).otherwise(cut), lambda x: x.cast("string"))).alias("segment"))


def boundary_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether announcements lie in a city's boundary ring; the point of one outside is withheld, and one without a point is unresolved."""
    corners = [(13.15, 52.38), (13.5, 52.36), (13.58, 52.55), (13.3, 52.63), (13.15, 52.38)]
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in corners])
    lon = F.when(F.col("id") % 7 != 0, F.col("lon"))
    scope = F.when(lon.isNull(), "unresolved").when(geo.in_ring(lon, F.col("lat"), ring), "in_city").otherwise("outside")
    return announcements(spark, sf_dir).select("id", scope.alias("scope"), F.when(scope == "in_city", F.round(lon, 6)).alias("lon"))


_RING = [(13.15, 52.38), (13.5, 52.36), (13.58, 52.55), (13.3, 52.63), (13.15, 52.38)]
_CROSS = " + ".join(f"CAST(({b!r}::DOUBLE > lat) <> ({d!r}::DOUBLE > lat) AND lon < ({c!r}::DOUBLE - {a!r}::DOUBLE) * (lat - {b!r}::DOUBLE) / ({d!r}::DOUBLE - {b!r}::DOUBLE) + {a!r}::DOUBLE AS INT)" for (a, b), (c, d) in zip(_RING, _RING[1:], strict=False))


def published_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announcements published as a generation by month, and one month of it read again by the manifest."""
    folder = shared_path(spark, "generation")
    rows = announcements(spark, sf_dir).select("id", "month", "category")
    publish.publish({"events": (rows, ["month"])}, folder, [("ids", gates.repeated(rows, "id"))])
    return publish.current(spark, folder, "events").filter("month = '2024-01'").groupBy("month", "category").agg(F.count("*").alias("count"))


def published_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes written by kind and tile, and what two tiles of a kind hold, each once though both may have it."""
    s = placed(table(spark, sf_dir, "supplier"), "s_suppkey")
    boxes = s.select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, "road").otherwise("place").alias("kind"), F.col("lon").alias("west"), F.col("lat").alias("south"), (F.col("lon") + F.col("s_suppkey") % 7 * 0.01).alias("east"), (F.col("lat") + F.col("s_suppkey") % 5 * 0.01).alias("north"))
    folder = shared_path(spark, "tiles")
    publish.tiled(boxes).write.partitionBy("kind", "tile").parquet(folder)
    found = spark.read.parquet(folder).filter("kind = 'road' AND tile IN ('330_2096', '331_2096')")
    return found.groupBy("s_suppkey").agg(F.count("*").alias("tiles"))


def pack_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that no line reviews yet, in packs of 200 in key order."""
    done = table(spark, sf_dir, "lineitem").filter("l_quantity > 30").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    packs = publish.review_packs(table(spark, sf_dir, "orders").select("o_orderkey"), done, "o_orderkey", 200)
    return packs.groupBy(F.col("batch").cast("bigint").alias("batch")).agg(F.count("*").alias("records"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))


def staged_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions staged as lines of JSON and read back under their closed contract."""
    path = shared_path(spark, "decisions")
    table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("toxic") == 1, "supported").otherwise("no_support").alias("verdict")).write.json(path)
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("verdict", T.StringType())])
    return decisions(spark, path, schema).groupBy("verdict").agg(F.count("*").alias("decisions"), F.max(F.col("id").cast("bigint")).alias("last_id"))


def export_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An analytics export of JSON lines, two tables of it read under a schema and joined."""
    folder = shared_path(spark, "export")
    table(spark, sf_dir, "part").select(F.col("p_partkey").alias("path_id"), F.concat(F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("-"))).alias("path")).write.json(f"{folder}/paths")
    table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("path_id"), F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("hits")).write.json(f"{folder}/hit_stats")
    paths, hits = spark.read.schema("path_id bigint, path string").json(f"{folder}/paths"), spark.read.schema("path_id bigint, day date, hits bigint").json(f"{folder}/hit_stats")
    return hits.join(paths, "path_id").groupBy("path").agg(F.sum("hits").alias("hits"), F.count_distinct("day").alias("days"))


def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of 50 articles to review, with whether the text still has the hash that was stored."""
    rows = inventory(spark, sf_dir).select("doc_id", "status", (F.sha2("body", 256) == F.col("sha256")).alias("verified"))
    return rows.orderBy("doc_id").offset(50).limit(50)


def scan_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active lines of each customer's latest complete order, with the hash of what they held."""
    o = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("s"))
    lines = table(spark, sf_dir, "lineitem").filter("l_returnflag <> 'R'")
    found = o.join(lines, F.col("s.o_orderkey") == F.col("l_orderkey"))
    return found.select("l_orderkey", "l_linenumber", "l_partkey", F.sha2(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"), 256).alias("sha256"))


def snapshot_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared totals of a snapshot's categories against what its pages hold, and ids that two categories share."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("category"), "o_custkey")
    held = o.groupBy("category").agg(F.count("*").alias("held"), F.count_distinct("o_custkey").alias("ids"))
    declared = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P' OR o_orderpriority < '3'").groupBy(F.col("o_orderpriority").alias("category")).agg(F.count("*").alias("declared"))
    return held.join(declared, "category", "left").select("category", "held", "ids", F.coalesce("declared", F.lit(0)).alias("declared"), (F.col("held") == F.coalesce("declared", F.lit(0))).alias("complete"))


def checkpoint_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints of sources in one pass: discovered, fetched, missing and broken articles, and whether the cursor came to its end."""
    d = table(spark, sf_dir, "documents")
    broken = F.col("doc_id") % 21 == 0
    return d.groupBy("source").agg(F.count("*").alias("discovered"), F.count_if(~broken & F.col("text").isNotNull()).alias("fetched"), F.count_if(F.col("text").isNull()).alias("missing"), F.count_if(broken).alias("broken"), (F.max("doc_id") % 2 == 0).alias("complete"))


def city_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a city's scope through a view and plain SQL, with counts of what stays out."""
    table(spark, sf_dir, "documents").select("doc_id", "lang", F.coalesce("n_chars", F.lit(0)).alias("n_chars")).createOrReplaceTempView("tessella_reports")
    return spark.sql("SELECT lang, count_if(n_chars >= 30) AS selected, count_if(n_chars < 30) AS too_short, coalesce(max(doc_id) FILTER (WHERE n_chars >= 30), -1) AS last_id FROM tessella_reports GROUP BY lang")


def daily_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered sections of daily reports; a report whose numbers are not those of its list of contents is not split."""
    n = F.col("o_orderkey") % 4 + 1
    body = F.concat_ws("\n", F.transform(F.sequence(F.lit(1), n), lambda k: F.concat(F.when((F.col("o_orderkey") % 10 == 0) & (k == n), k + 1).otherwise(k), F.lit(". Section of "), F.col("o_custkey"), F.lit("\nText "), k)))
    heads = F.regexp_extract_all(body, F.lit(r"(?m)^(\d+)\. "), F.lit(1)).cast("array<bigint>")
    texts = F.filter(F.split(body, r"(?m)^\d+\. "), lambda s: s != "")
    good = heads == F.transform(F.sequence(F.lit(1), n), lambda k: k.cast("bigint"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.posexplode(F.when(good, texts)).alias("seq", "text"))
    return rows.select("o_orderkey", (F.col("seq") + 1).cast("bigint").alias("number"), F.regexp_extract("text", r"Text (\d+)", 1).alias("found"))


def local_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose visible text holds all of the text that was supplied with them, and whether their bytes have the declared hash."""
    p = table(spark, sf_dir, "pages").withColumn("supplied", F.when(F.col("page_id") % 4 == 0, "words that no page has").otherwise(F.substring(stripped(F.col("html")), 30, 60)))
    declared = F.when(F.col("page_id") % 6 == 0, F.sha2("url", 256)).otherwise(F.sha2("html", 256))
    return p.select("page_id", quoted(stripped(F.col("html")), F.col("supplied")).alias("holds"), (F.sha2("html", 256) == declared).alias("intact"))


def _rules(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, str, dict]]:
    lines = table(spark, sf_dir, "lineitem").withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    part = table(spark, sf_dir, "part")
    return {
        "event_time_rules": (table(spark, sf_dir, "events").withColumn("precision", F.element_at(F.array(*map(F.lit, ("day", "minute", "century"))), (F.col("event_id") % 3 + 1).cast("int"))), "event_id", {
            "precision": F.col("precision").isin("day", "minute"), "date": F.try_to_date(F.date_format("ts", "yyyy-MM-dd"), "yyyy-MM-dd").isNotNull(), "quote": F.length("props") >= 9}),
        "transit_rules": (part, "p_partkey", {"mode": F.col("p_type").isin("ECONOMY", "STANDARD", "PROMO"), "extent": (F.col("p_size") % 4 != 0) | (F.col("p_type") != "PROMO")}),
        "poi_context_rules": (lines, "key", {"radius": F.col("l_quantity").between(0, 45), "scope": (F.col("l_returnflag") == "R") == (F.col("l_quantity") > 25)}),
        "geometry_rules": (part, "p_partkey", {"point": (F.col("p_type") != "ECONOMY") | (F.col("p_size") <= 25), "line": (F.col("p_type") != "STANDARD") | (F.col("p_size") > 10)}),
        "semantic_rules": (table(spark, sf_dir, "orders"), "o_orderkey", {"flags": F.col("o_orderstatus") != "P", "minimum": F.col("o_totalprice") >= 1000, "prefix": F.col("o_orderpriority").rlike("^[1-4]-")}),
        "source_review_rules": (inventory(spark, sf_dir), "doc_id", {"review": F.col("status") != "stale", "scenes": (F.col("verdict") != "supported") | (F.col("incidents") > 0), "body": F.col("body") != ""}),
    }


def _rule_query(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gates.violations(*_rules(spark, sf_dir)[name])

    return query


def unique_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context triples of an order that occur more than once."""
    t = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", (F.col("l_suppkey") % 5).alias("kind"), "l_returnflag").agg(F.count("*").alias("n"))
    return t.filter("n > 1")


def evidence_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested evidence flattened to path and quote, each with whether it stands in exactly one of the two bodies that may be its origin."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("body"))
    bodies = c.filter("turn < 2").groupBy("conv_id").agg(F.coalesce(F.max(F.when(F.col("turn") == 0, F.col("body"))), F.lit("")).alias("a"), F.coalesce(F.max(F.when(F.col("turn") == 1, F.col("body"))), F.lit("")).alias("b"))
    first = lambda s: F.regexp_extract(s, r"^(\S+)", 1)
    evidence = F.struct(F.struct(first("a").alias("quote")).alias("when"), F.array(first("b"), F.lit("nowhere")).alias("where"))
    leaves = F.flatten(F.array(F.array(F.struct(F.lit("when.quote").alias("path"), F.col("e.when.quote").alias("quote"))), F.transform("e.where", lambda q, k: F.struct(F.concat(F.lit("where."), k).alias("path"), q.alias("quote")))))
    rows = bodies.withColumn("e", evidence).select("conv_id", "a", "b", F.explode(leaves).alias("l")).filter("l.quote <> ''")
    origins = F.contains("a", F.col("l.quote")).cast("int") + F.contains("b", F.col("l.quote")).cast("int")
    return rows.select("conv_id", "l.path", (origins == 1).alias("one_origin"))


def _violations_sql(key: str, source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT CAST({key} AS VARCHAR) AS key, '{name}' AS reason FROM {source} WHERE NOT coalesce({good}, false)" for name, good in rules.items())


_KEY = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
QUERIES = {
    "compact_values": (compact_values, f"{ANNOUNCED} SELECT id, round(lon, 6) AS lon1, round(lat, 6) AS lat1, round(lon + id / 7e6::DOUBLE, 6) AS lon2, round(lat - id / 3e6::DOUBLE, 6) AS lat2 FROM ann"),
    "canonical_events": (canonical_events, f"{ANNOUNCED} SELECT id, month, round(lon, 6) AS lon, round(lat, 6) AS lat, CASE WHEN k % 9 = 0 THEN 'category' WHEN precision = 'district' THEN 'precision' END AS problem FROM ann"),
    "scene_projection": (scene_projection, "SELECT l_orderkey, l_suppkey % 10 AS place, string_agg(l_returnflag, ',' ORDER BY l_linenumber, l_partkey, l_returnflag) AS incidents, CASE WHEN max(l_quantity) > 40 THEN 'primary' ELSE 'reference' END AS role FROM lineitem GROUP BY 1, 2"),
    "event_projection": (event_projection, """WITH l AS (SELECT l_orderkey, count(*) AS incidents, count(DISTINCT l_suppkey) AS places, arg_max(l_suppkey, l_quantity * 1e9 + l_suppkey) AS main_place FROM lineitem GROUP BY 1)
SELECT o_orderkey, n_name, strftime(o_orderdate, '%Y-%m') AS month, coalesce(incidents, 0) AS incidents, coalesce(places, 0) AS places, main_place, CASE WHEN main_place IS NULL THEN 'unlocated' WHEN places = 1 THEN 'point' ELSE 'several' END AS shown_as FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey LEFT JOIN l ON o_orderkey = l_orderkey"""),
    "phase_projection": (phase_projection, "SELECT conv_id, string_agg(role, '>' ORDER BY turn, role) AS phases, string_agg(CAST(length(coalesce(text, '')) AS VARCHAR), ',' ORDER BY turn, role) AS lengths, min(turn) AS first, max(turn) AS last FROM conversations GROUP BY 1"),
    "search_index": (search_index, f"WITH {placed_sql('p', 'part', 'p_partkey')} SELECT p_partkey, p_name AS name, p_type AS kind, round(lon, 6) AS lon, round(lat, 6) AS lat FROM p WHERE p_partkey % 5 <> 0 AND p_name <> p_type"),
    "geometry_parts": (geometry_parts, "WITH l AS (SELECT p_partkey, list_concat(['line'], list_concat(list_transform(range(0, p_size % 3 + 1), lambda k: 'point-' || k), [p_type])) AS l FROM part) SELECT p_partkey, CAST(unnest(range(0, len(l))) AS BIGINT) AS seq, unnest(l) AS part FROM l"),
    "display_notes": (display_notes, LEDGER_SQL + " SELECT doc_id, CASE WHEN status = 'current' THEN method || ': ' || verdict END AS note, status = 'stale' AS withheld FROM i"),
    "display_features": (display_features, "SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN p_name ELSE upper(p_type[1]) || lower(p_type[2:]) END AS label, lower(p_type) AS category, p_size % 4 = 0 AS background FROM part"),
    "scope_overlay": (scope_overlay, "SELECT p_partkey, CASE WHEN p_size > 25 AND p_size % 2 = 0 THEN p_brand WHEN p_partkey % 5 <> 0 THEN p_type END AS kind FROM part WHERE p_partkey % 5 <> 0 OR p_size > 25"),
    "compact_circles": (compact_circles, f"""{ANNOUNCED}, b AS (SELECT id, CASE id % 3 WHEN 0 THEN 0.3 WHEN 1 THEN 0.5 ELSE 0 END AS bump, 2 * pi() * (id % 32) / 32 AS a FROM ann) SELECT id, CASE WHEN abs(sqrt(pow(50 * cos(a) + bump, 2) + pow(50 * sin(a), 2)) - 50) <= 0.35 THEN 'point' ELSE 'ring' END AS sent_as FROM b"""),
    "route_members": (route_members, "SELECT l_partkey, count(*) AS memberships, min(l_orderkey) AS first_route, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_orderkey, l_linenumber) AS places FROM lineitem GROUP BY 1"),
    "platform_points": (platform_points, """WITH f AS (SELECT l_orderkey, l_suppkey % 20 AS p, min(struct_pack(a := l_linenumber, b := l_suppkey)) AS f FROM lineitem GROUP BY ALL) SELECT l_orderkey, string_agg(CAST(p AS VARCHAR), ',' ORDER BY f) AS points FROM f GROUP BY 1"""),
    "track_segments": (track_segments, """WITH t AS (SELECT p_partkey AS k, list_transform(range(0, p_partkey % 12 + 4), lambda n: (p_partkey + n * n) % 40) AS t, p_partkey % 40 AS a, (p_partkey + 9) % 40 AS b FROM part), i AS (SELECT *, list_position(t, a) AS i, list_position(t, b) AS j, len(list_filter(t, lambda x: x = a)) AS na, len(list_filter(t, lambda x: x = b)) AS nb FROM t),
c AS (SELECT *, CASE WHEN na = 1 AND nb = 1 THEN list_slice(t, least(i, j), greatest(i, j)) END AS c FROM i) SELECT k AS p_partkey, coalesce(array_to_string(CASE WHEN i > j THEN list_reverse(c) ELSE c END, ','), '') AS segment FROM c"""),
    "boundary_scope": (boundary_scope, f"{ANNOUNCED}, s AS (SELECT id, lon, CASE WHEN id % 7 = 0 THEN 'unresolved' WHEN ({_CROSS}) % 2 = 1 THEN 'in_city' ELSE 'outside' END AS scope FROM ann) SELECT id, scope, CASE WHEN scope = 'in_city' THEN round(lon, 6) END AS lon FROM s"),
    "published_month": (published_month, f"{ANNOUNCED} SELECT month, category, count(*) AS count FROM ann WHERE month = '2024-01' GROUP BY ALL"),
    "published_tiles": (published_tiles, f"""WITH {placed_sql('s', 'supplier', 's_suppkey')}, b AS (SELECT *, floor(lon / 0.04) AS x0, floor(lat / 0.025) AS y0, floor((lon + s_suppkey % 7 * 0.01::DOUBLE) / 0.04) AS x1, floor((lat + s_suppkey % 5 * 0.01::DOUBLE) / 0.025) AS y1 FROM s WHERE s_suppkey % 2 = 0)
SELECT s_suppkey, CAST(CAST(x0 <= 330 AND x1 >= 330 AS INT) + CAST(x0 <= 331 AND x1 >= 331 AS INT) AS BIGINT) AS tiles FROM b WHERE y0 <= 2096 AND y1 >= 2096 AND x0 <= 331 AND x1 >= 330"""),
    "pack_batches": (pack_batches, "WITH p AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 200 AS batch FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 30)) SELECT batch, count(*) AS records, min(o_orderkey) AS first, max(o_orderkey) AS last FROM p GROUP BY 1"),
    "staged_decisions": (staged_decisions, "SELECT CASE WHEN toxic = 1 THEN 'supported' ELSE 'no_support' END AS verdict, count(*) AS decisions, max(doc_id) AS last_id FROM labels GROUP BY 1"),
    "export_tables": (export_tables, "SELECT '/' || replace(p_name, ' ', '-') AS path, count(*) AS hits, count(DISTINCT CAST(l_shipdate AS DATE)) AS days FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"),
    "review_rows": (review_rows, LEDGER_SQL + " SELECT doc_id, status, true AS verified FROM i ORDER BY doc_id LIMIT 50 OFFSET 50"),
    "scan_candidates": (scan_candidates, """WITH o AS (SELECT o_custkey, max(struct_pack(d := o_orderdate, k := o_orderkey)).k AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT l_orderkey, l_linenumber, l_partkey, sha256(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_returnflag)) AS sha256 FROM lineitem JOIN o ON k = l_orderkey WHERE l_returnflag <> 'R'"""),
    "snapshot_totals": (snapshot_totals, "SELECT o_orderpriority AS category, count(*) AS held, count(DISTINCT o_custkey) AS ids, count(*) FILTER (o_orderstatus <> 'P' OR o_orderpriority < '3') AS declared, bool_and(o_orderstatus <> 'P' OR o_orderpriority < '3') AS complete FROM orders GROUP BY 1"),
    "checkpoint_counts": (checkpoint_counts, "SELECT source, count(*) AS discovered, count(*) FILTER (doc_id % 21 <> 0 AND text IS NOT NULL) AS fetched, count(*) FILTER (text IS NULL) AS missing, count(*) FILTER (doc_id % 21 = 0) AS broken, max(doc_id) % 2 = 0 AS complete FROM documents GROUP BY 1"),
    "city_selection": (city_selection, "SELECT lang, count(*) FILTER (coalesce(n_chars, 0) >= 30) AS selected, count(*) FILTER (coalesce(n_chars, 0) < 30) AS too_short, coalesce(max(doc_id) FILTER (coalesce(n_chars, 0) >= 30), -1) AS last_id FROM documents GROUP BY 1"),
    "daily_items": (daily_items, "SELECT o_orderkey, k AS number, CAST(k AS VARCHAR) AS found FROM (SELECT o_orderkey, unnest(range(1, o_orderkey % 4 + 2)) AS k FROM orders WHERE o_orderkey % 10 <> 0)"),
    "local_documents": (local_documents, "SELECT page_id, page_id % 4 <> 0 AND length(trim(substr(t, 30, 60))) >= 15 AS holds, page_id % 6 <> 0 AS intact FROM (SELECT page_id, " + r"trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '[ \t\n\x0b\f\r]+', ' ', 'g'))" + " AS t FROM pages)"),
    "event_time_rules": (_rule_query("event_time_rules"), _violations_sql("event_id", "events", {"precision": "event_id % 3 < 2", "date": "ts IS NOT NULL", "quote": "length(props) >= 9"})),
    "transit_rules": (_rule_query("transit_rules"), _violations_sql("p_partkey", "part", {"mode": "p_type IN ('ECONOMY', 'STANDARD', 'PROMO')", "extent": "p_size % 4 <> 0 OR p_type <> 'PROMO'"})),
    "poi_context_rules": (_rule_query("poi_context_rules"), _violations_sql(_KEY, "lineitem", {"radius": "l_quantity BETWEEN 0 AND 45", "scope": "(l_returnflag = 'R') = (l_quantity > 25)"})),
    "geometry_rules": (_rule_query("geometry_rules"), _violations_sql("p_partkey", "part", {"point": "p_type <> 'ECONOMY' OR p_size <= 25", "line": "p_type <> 'STANDARD' OR p_size > 10"})),
    "semantic_rules": (_rule_query("semantic_rules"), _violations_sql("o_orderkey", "orders", {"flags": "o_orderstatus <> 'P'", "minimum": "o_totalprice >= 1000", "prefix": "regexp_matches(o_orderpriority, '^[1-4]-')"})),
    "source_review_rules": (_rule_query("source_review_rules"), LEDGER_SQL + " " + _violations_sql("doc_id", "i", {"review": "status <> 'stale'", "scenes": "verdict <> 'supported' OR incidents > 0", "body": "body <> ''"})),
    "unique_triples": (unique_triples, "SELECT l_orderkey, l_suppkey % 5 AS kind, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1"),
    "evidence_leaves": (evidence_leaves, r"""WITH b AS (SELECT conv_id, coalesce(max(coalesce(text, '')) FILTER (turn = 0), '') AS a, coalesce(max(coalesce(text, '')) FILTER (turn = 1), '') AS b FROM conversations WHERE turn < 2 GROUP BY 1),
l AS (SELECT *, unnest(['when.quote', 'where.0', 'where.1']) AS path, unnest([regexp_extract(a, '^(\S+)', 1), regexp_extract(b, '^(\S+)', 1), 'nowhere']) AS q FROM b) SELECT conv_id, path, CAST(contains(a, q) AS INT) + CAST(contains(b, q) AS INT) = 1 AS one_origin FROM l WHERE q <> ''"""),
}
