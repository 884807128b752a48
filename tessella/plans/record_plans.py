"""Queries over published records: scenes, follow-ups, evidence, closures, gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.text import collapsed
from tessella.operators import gates
from tessella.operators.graph import reachable
from tessella.plans.map_plans import scenes
from tessella.plans.state_plans import BODY
from tessella.sources.tables import ANNOUNCED, MAPPABLE, announcements, table

SCENES_SQL = f"""{ANNOUNCED}, s AS (SELECT id, month, k, unnest(range(0, k % 4 + 1)) AS n FROM ann),
t AS (SELECT id, k, n, list_extract(['incident','arrest','accident'], CAST((k + n) % 3 + 1 AS INT)) AS role, list_extract(['point','street','place','address','district'], CAST((id + n) % 5 + 1 AS INT)) AS precision, n = k % 5 AS main FROM s)"""


def scene_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each scene, with what is drawn for it."""
    rows = announcements(spark, sf_dir)
    flat = rows.select("id", F.posexplode(scenes(rows)).alias("seq", "s"))
    drawn = F.when(F.col("s.precision") == "district", "none").when(F.col("s.precision") == "street", "line").when(F.col("s.main"), "count_point").otherwise("reference_point")
    return flat.select("id", F.col("seq").cast("bigint").alias("seq"), F.col("s.role").alias("role"), drawn.alias("drawn"))


def unplaced_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages of an announcement that no scene on the map shows."""
    rows = announcements(spark, sf_dir)
    shown = F.transform(F.filter(scenes(rows), lambda s: s.precision.isin(*MAPPABLE)), lambda s: s.role)
    rest = F.array_except(F.array(F.lit("incident"), F.lit("arrest"), F.lit("accident")), shown)
    return rows.select("id", F.size(rest).cast("bigint").alias("unplaced"), F.concat_ws(",", rest).alias("stages"))


def followup_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report follows the one earlier report it refers to; two references, or a later one, link nothing."""
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "ts")
    refs = e.select("id", "ts", F.explode(F.array_distinct(F.array(F.col("id") * 7 % 1000, F.when(F.col("id") % 3 == 0, F.col("id") - 1), F.when(F.col("id") % 5 == 0, F.col("id") + 1)))).alias("ref")).filter("ref IS NOT NULL")
    earlier = refs.join(e.select(F.col("id").alias("ref"), F.col("ts").alias("t")), "ref").filter(F.struct("t", "ref") < F.struct("ts", "id"))
    return earlier.groupBy("id").agg(F.count("*").alias("n"), F.min("ref").alias("follows")).filter("n = 1").select("id", "follows")


def reference_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each primary report reaches over reviewed links, cycles included."""
    n = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier")
    edges = s.filter(n % 4 != 3).select(n.alias("u"), F.when(n % 4 == 2, n - 2).otherwise(n + 1).alias("v")).join(s.select(n.alias("v")), "v", "left_semi").select("u", "v")
    return reachable(s.filter(n % 4 == 0).select(n.alias("start")), edges).groupBy("start").agg(F.count("*").alias("reached"), F.sum("node").alias("nodes_sum"))


def assessment_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supplement fills what was not evaluated and never overwrites; a different verdict is a conflict."""
    d = table(spark, sf_dir, "labels")
    old = d.filter("doc_id % 4 <> 0").select("doc_id", F.when(F.col("doc_id") % 5 == 0, "not_evaluated").when(F.col("toxic") == 1, "supported").otherwise("no_support").alias("old"))
    new = d.filter("doc_id % 3 <> 0").select("doc_id", F.when(F.col("doc_id") % 7 == 0, "not_evaluated").when((F.col("toxic") == 1) | (F.col("doc_id") % 11 == 0), "supported").otherwise("no_support").alias("new"))
    known = lambda c: F.nullif(F.col(c), F.lit("not_evaluated"))
    both = old.join(new, "doc_id", "full_outer")
    return both.select("doc_id", F.when(known("old") != known("new"), "conflict").otherwise(F.coalesce(known("old"), known("new"), F.lit("not_evaluated"))).alias("verdict"))


def evidence_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of one (customer, supplier) pair from several lines as one row, each kind once, in order."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_suppkey") % 10).alias("place"), F.struct("l_returnflag", "l_linestatus").alias("e"))
    kinds = lines.groupBy("l_partkey", "place").agg(F.array_sort(F.collect_set("e")).alias("s"), F.count("*").alias("links"))
    return kinds.select("l_partkey", "place", "links", F.concat_ws(",", F.transform("s", lambda x: F.concat(x.l_returnflag, x.l_linestatus))).alias("kinds"))


def month_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of each day's rows that does not depend on their order: their number, and sums and differences of their hashes, all of which combine before the shuffle."""
    h = F.sha2(F.concat_ws("|", "id", "category"), 256)
    part = lambda at: F.conv(F.substring(h, at, 15), 16, 10).cast("bigint")
    rows = announcements(spark, sf_dir).select("day", part(1).alias("a"), part(16).alias("b"))
    sums = F.concat_ws(":", F.count("*"), F.bit_xor("a"), F.bit_xor("b"), F.sum(F.col("a") % 1_000_000_007), F.sum(F.col("b") % 1_000_000_009))
    return rows.groupBy("day").agg(F.sha2(sums, 256).alias("digest"))


def address_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A street and number stand for their least point if all their points lie within 50 m."""
    k = F.col("c_custkey")
    a = table(spark, sf_dir, "customer").select("c_mktsegment", (k % 97).alias("number"), (k % 97 * 500 + k % 23 * 3).alias("x"), (k % 89).alias("y"))
    found = a.groupBy("c_mktsegment", "number").agg(F.min(F.struct("x", "y")).alias("p"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("span"))
    return found.filter("span <= 50").select("c_mktsegment", "number", "p.x", "p.y")


def road_segment_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of a way between two of its own vertices, in the way's direction or against it."""
    k = F.col("p_partkey")
    way = table(spark, sf_dir, "part").select("p_partkey", F.transform(F.sequence(F.lit(0), k % 9 + 2), lambda n: k + n * 3).alias("way"))
    a, b = F.array_position("way", k + k % 3 * 3), F.array_position("way", k + (k + 1) % 5 * 3)
    cut = F.when((a > 0) & (b > 0) & (a != b), F.slice("way", F.least(a, b).cast("int"), (F.abs(a - b) + 1).cast("int")))
    return way.select("p_partkey", F.concat_ws(",", F.when(a > b, F.reverse(cut)).otherwise(cut)).alias("segment"))


def record_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with which record; an unknown outcome is a violation."""
    o = table(spark, sf_dir, "orders").withColumn("price", F.when(F.col("o_orderkey") % 500 != 0, F.col("o_totalprice")))
    return gates.violations(o, "o_orderkey", {"status": F.col("o_orderstatus").isin("F", "O"), "price": F.col("price") > 0, "text": F.col("o_orderpriority").rlike("^[0-9]-")})


def berlin_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publication times in Berlin; a local time that does not exist or exists twice is rejected."""
    hours = table(spark, sf_dir, "events").select("event_id", F.expr("timestamp_ntz'2024-03-30 12:00:00' + make_dt_interval(int(event_id % 2 * 210), int(event_id % 30), int(event_id % 60))").alias("local"))
    back = lambda t: F.convert_timezone(F.lit("UTC"), F.lit("Europe/Berlin"), t)
    early, late = F.col("local") - F.expr("INTERVAL 2 HOURS"), F.col("local") - F.expr("INTERVAL 1 HOURS")
    fits = (back(early) == F.col("local")).cast("int") + (back(late) == F.col("local")).cast("int")
    return hours.select("event_id", fits.cast("bigint").alias("readings"), F.when(fits == 1, F.when(back(early) == F.col("local"), early).otherwise(late)).alias("utc"))


def export_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits with the names of their paths and countries; a hit of an unknown path keeps a null name."""
    hits = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_quantity") <= 48, F.col("l_partkey")).alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"))
    named = hits.join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", "left").join(table(spark, sf_dir, "supplier"), "s_suppkey")
    return named.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy("p_name", "n_name").agg(F.count("*").alias("hits"))


def public_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct short texts that a translation must cover, by hash."""
    t = table(spark, sf_dir, "documents").select(F.explode(F.array("source", "lang", F.substring(collapsed(F.coalesce("text", F.lit(""))), 1, 20))).alias("t")).filter("t <> ''")
    return t.distinct().select("t", F.sha2("t", 256).alias("sha256"))


QUERIES = {
    "scene_features": (scene_features, SCENES_SQL + " SELECT id, n AS seq, role, CASE WHEN precision = 'district' THEN 'none' WHEN precision = 'street' THEN 'line' WHEN main THEN 'count_point' ELSE 'reference_point' END AS drawn FROM t"),
    "unplaced_stages": (unplaced_stages, SCENES_SQL + """, g AS (SELECT id, list(role) FILTER (precision <> 'district') AS shown FROM t GROUP BY id), r AS (SELECT id, list_filter(['incident', 'arrest', 'accident'], lambda x: NOT coalesce(list_contains(shown, x), false)) AS rest FROM g)
SELECT id, len(rest) AS unplaced, coalesce(array_to_string(rest, ','), '') AS stages FROM r"""),
    "followup_links": (followup_links, """WITH r AS (SELECT event_id AS id, ts, event_id * 7 % 1000 AS ref FROM events UNION SELECT event_id, ts, event_id - 1 FROM events WHERE event_id % 3 = 0 UNION SELECT event_id, ts, event_id + 1 FROM events WHERE event_id % 5 = 0)
SELECT id, min(ref) AS follows FROM r JOIN (SELECT event_id AS e, ts AS t FROM events) ON e = ref WHERE t < ts OR t = ts AND ref < id GROUP BY id HAVING count(*) = 1"""),
    "reference_closure": (reference_closure, """WITH RECURSIVE e AS (SELECT s_suppkey AS u, CASE WHEN s_suppkey % 4 = 2 THEN s_suppkey - 2 ELSE s_suppkey + 1 END AS v FROM supplier WHERE s_suppkey % 4 <> 3), f AS (SELECT * FROM e WHERE v IN (SELECT s_suppkey FROM supplier)),
r(start, node) AS (SELECT s_suppkey, s_suppkey FROM supplier WHERE s_suppkey % 4 = 0 UNION SELECT start, v FROM r JOIN f ON node = u) SELECT start, count(*) AS reached, CAST(sum(node) AS BIGINT) AS nodes_sum FROM r GROUP BY start"""),
    "assessment_merge": (assessment_merge, """WITH o AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN toxic = 1 THEN 'supported' ELSE 'no_support' END AS v FROM labels WHERE doc_id % 4 <> 0), n AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN toxic = 1 OR doc_id % 11 = 0 THEN 'supported' ELSE 'no_support' END AS v FROM labels WHERE doc_id % 3 <> 0)
SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, CASE WHEN o.v <> n.v THEN 'conflict' ELSE coalesce(o.v, n.v, 'not_evaluated') END AS verdict FROM o FULL JOIN n ON o.doc_id = n.doc_id"""),
    "evidence_merge": (evidence_merge, "SELECT l_partkey, l_suppkey % 10 AS place, count(*) AS links, string_agg(DISTINCT l_returnflag || l_linestatus, ',' ORDER BY l_returnflag || l_linestatus) AS kinds FROM lineitem GROUP BY 1, 2"),
    "month_digest": (month_digest, f"""{ANNOUNCED}, h AS (SELECT day, sha256(concat_ws('|', id, category)) AS h FROM ann), p AS (SELECT day, CAST('0x' || substr(h, 1, 15) AS BIGINT) AS a, CAST('0x' || substr(h, 16, 15) AS BIGINT) AS b FROM h)
SELECT day, sha256(concat_ws(':', count(*), bit_xor(a), bit_xor(b), sum(a % 1000000007), sum(b % 1000000009))) AS digest FROM p GROUP BY day"""),
    "address_lookup": (address_lookup, """WITH a AS (SELECT c_mktsegment, c_custkey % 97 AS number, c_custkey % 97 * 500 + c_custkey % 23 * 3 AS x, c_custkey % 89 AS y FROM customer), s AS (SELECT c_mktsegment, number FROM a GROUP BY ALL HAVING greatest(max(x) - min(x), max(y) - min(y)) <= 50)
SELECT c_mktsegment, number, x, y FROM (SELECT a.*, row_number() OVER (PARTITION BY c_mktsegment, number ORDER BY x, y) AS r FROM a JOIN s USING (c_mktsegment, number)) WHERE r = 1"""),
    "road_segment_cut": (road_segment_cut, """WITH w AS (SELECT p_partkey AS k, list_transform(range(0, p_partkey % 9 + 3), lambda n: p_partkey + n * 3) AS way FROM part), p AS (SELECT *, coalesce(list_position(way, k + k % 3 * 3), 0) AS a, coalesce(list_position(way, k + (k + 1) % 5 * 3), 0) AS b FROM w),
c AS (SELECT *, CASE WHEN a > 0 AND b > 0 AND a <> b THEN list_slice(way, least(a, b), greatest(a, b)) END AS cut FROM p) SELECT k AS p_partkey, coalesce(array_to_string(CASE WHEN a > b THEN list_reverse(cut) ELSE cut END, ','), '') AS segment FROM c"""),
    "record_violations": (record_violations, "SELECT CAST(o_orderkey AS VARCHAR) AS key, 'status' AS reason FROM orders WHERE o_orderstatus NOT IN ('F', 'O') UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'price' FROM orders WHERE o_orderkey % 500 = 0 OR NOT o_totalprice > 0 UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'text' FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[0-9]-')"),
    "berlin_time": (berlin_time, """WITH e AS (SELECT event_id, TIMESTAMP '2024-03-30 12:00:00' + to_days(CAST(event_id % 2 * 210 AS INT)) + to_hours(CAST(event_id % 30 AS INT)) + to_minutes(CAST(event_id % 60 AS INT)) AS l FROM events),
f AS (SELECT event_id, l, l - INTERVAL 2 HOUR AS a, l - INTERVAL 1 HOUR AS b FROM e), z AS (SELECT *, a >= TIMESTAMP '2024-03-31 01:00:00' AND a < TIMESTAMP '2024-10-27 01:00:00' AS oka, b < TIMESTAMP '2024-03-31 01:00:00' OR b >= TIMESTAMP '2024-10-27 01:00:00' AS okb FROM f)
SELECT event_id, CAST(oka AS BIGINT) + CAST(okb AS BIGINT) AS readings, CASE WHEN oka AND NOT okb THEN a WHEN okb AND NOT oka THEN b END AS utc FROM z"""),
    "export_join": (export_join, "SELECT p_name, n_name, count(*) AS hits FROM lineitem LEFT JOIN part ON CASE WHEN l_quantity <= 48 THEN l_partkey END = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL"),
    "public_texts": (public_texts, f"WITH t AS (SELECT unnest([source, lang, substr({BODY}, 1, 20)]) AS t FROM documents) SELECT DISTINCT t, sha256(t) AS sha256 FROM t WHERE t <> ''"),
}
