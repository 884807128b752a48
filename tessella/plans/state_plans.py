"""Change-data queries: discovery, revisions, queues, snapshots, completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.text import collapsed
from tessella.operators import changes, gates
from tessella.sources.tables import table

BODY = r"trim(regexp_replace(coalesce(text, ''), '[ \t\n\x0b\f\r]+', ' ', 'g'))"


def discover_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    old = d.filter("doc_id % 3 <> 0").select("doc_id", F.col("source").alias("district"), "lang")
    new = d.filter("doc_id % 2 = 0").select("doc_id", F.when(F.col("doc_id") % 4 == 0, "").otherwise("new").alias("district"), F.upper("lang").alias("lang"))
    return changes.discovered(old, new, "doc_id", "district")


def accept_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").withColumn("text", F.when(F.col("turn") % 3 == 1, F.concat(F.lit("  "), F.lit("the same words as in the turn before, with blanks "))).otherwise(F.when(F.col("turn") % 3 == 2, F.lit("the same words as in the turn before,  with blanks")).otherwise(F.col("text"))))
    return changes.accepted(turns, "conv_id", "turn", "text")


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("id"), F.col("o_orderdate").alias("published"), F.when(k % 7 != 0, F.col("o_orderstatus")).alias("body"),
        F.when(k % 5 != 0, F.col("o_orderdate") + F.make_dt_interval((k % 20).cast("int"))).alias("checked"), F.when(k % 11 == 0, F.col("o_orderdate") + F.make_dt_interval(F.lit(400))).alias("retry_after"))


REPORTS_SQL = """WITH r AS (SELECT o_orderkey AS id, o_orderdate AS published, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS body,
 CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 20 AS INT)) END AS checked, CASE WHEN o_orderkey % 11 = 0 THEN o_orderdate + INTERVAL 400 DAY END AS retry_after FROM orders)"""


def revisit_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.revisit(_reports(spark, sf_dir), F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"), 50).select("id", "published")


def backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = (F.col("o_orderkey") % 12 + 1).alias("failures")
    return table(spark, sf_dir, "orders").select(failures).groupBy("failures").agg(F.count("*").alias("reports")).withColumn("delay", changes.backoff(F.col("failures")))


def tombstone_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2(collapsed("text"), 256).alias("mark"))
    now = d.filter("doc_id % 5 <> 1").withColumn("mark", F.when(F.col("doc_id") % 4 == 0, F.reverse("mark")).otherwise(F.col("mark")))
    return changes.snapshot(d.filter("doc_id % 5 <> 0"), now, "doc_id", "mark")


def queue_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 queued orders without a report, or whose report is a week old."""
    reports = table(spark, sf_dir, "lineitem").filter("l_orderkey % 3 <> 0").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("checked"))
    queue = table(spark, sf_dir, "orders").select("o_orderkey").join(reports, "o_orderkey", "left")
    return queue.filter(F.col("checked").isNull() | (F.col("checked") < F.lit("1996-06-01").cast("timestamp_ntz"))).orderBy(F.col("checked").isNotNull(), "o_orderkey").limit(100)


def unfetched_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "lineitem").filter("l_quantity > 30").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").join(done, "o_orderkey", "left_anti").groupBy("o_orderpriority").agg(F.count("*").alias("unfetched"))


def verified_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    orders = table(spark, sf_dir, "orders").filter((F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")))
    return orders.join(units, "o_orderkey").groupBy("o_orderpriority").agg(F.count("*").alias("verified"))


def latest_complete_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.latest_complete(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", F.col("o_orderstatus") == "F", "o_orderkey")


def sticky_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Once any run of a year was complete, the year is; with the most pages any run saw."""
    runs = table(spark, sf_dir, "orders").withColumn("summary", F.to_json(F.struct(F.year("o_orderdate").alias("year"), (F.col("o_orderstatus") == "F").alias("complete"), (F.col("o_orderkey") % 90).alias("pages"))))
    read = runs.select("o_custkey", F.get_json_object("summary", "$.year").try_cast("int").alias("year"), F.get_json_object("summary", "$.complete").try_cast("boolean").alias("complete"), F.get_json_object("summary", "$.pages").try_cast("bigint").alias("pages"))
    return read.groupBy("o_custkey", "year").agg(F.bool_or("complete").alias("complete"), F.max("pages").alias("pages"))


def decision_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files of one import must hold the same ids: what each lacks of the first."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    review, scope = d.filter("doc_id % 17 <> 0"), d.filter("doc_id % 19 <> 0")
    return changes.same_ids(review, scope, "doc_id")


def read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was published and what a rebuild gives must be equal in any order: the rows of one side alone."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    rebuilt = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 1000 == 0, F.lit("?")).otherwise(F.col("o_orderstatus"))).repartition("o_orderstatus")
    return gates.differences(o, rebuilt)


def cadence_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks are due after 72 hours, map refreshes once in a calendar month of Berlin."""
    e = table(spark, sf_dir, "events").select("user_id", "ts").groupBy("user_id").agg(F.max("ts").alias("last")).withColumn("last", F.col("last") + F.expr("make_dt_interval(int(user_id % 20))"))
    now = F.lit("2024-02-10 00:30:00").cast("timestamp_ntz")
    local = lambda t: F.date_format(F.convert_timezone(F.lit("UTC"), F.lit("Europe/Berlin"), t), "yyyy-MM")
    return e.select("user_id", (F.col("last") + F.expr("INTERVAL 72 HOURS") <= now).alias("check_due"), (local(F.col("last")) < local(now)).alias("refresh_due"))


QUERIES = {
    "discover_upsert": (discover_upsert, """WITH o AS (SELECT doc_id, source AS district, lang FROM documents WHERE doc_id % 3 <> 0), n AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'new' END AS district, upper(lang) AS lang FROM documents WHERE doc_id % 2 = 0)
SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, coalesce(nullif(n.district, ''), o.district) AS district, coalesce(n.lang, o.lang) AS lang FROM o FULL JOIN n ON o.doc_id = n.doc_id"""),
    "accept_revisions": (accept_revisions, f"""WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 1 THEN '  the same words as in the turn before, with blanks ' WHEN turn % 3 = 2 THEN 'the same words as in the turn before,  with blanks' ELSE text END AS text FROM conversations),
b AS (SELECT conv_id, turn, {BODY} AS body FROM t), s AS (SELECT conv_id, turn, length(body) >= 30 AS ok, CASE WHEN length(body) >= 30 THEN sha256(body) END AS sha256 FROM b),
l AS (SELECT *, lag(sha256) OVER (PARTITION BY conv_id, ok ORDER BY turn) AS last FROM s), c AS (SELECT *, ok AND (last IS NULL OR last <> sha256) AS fresh FROM l)
SELECT conv_id, turn, CASE WHEN NOT ok THEN 'rejected' WHEN last IS NULL THEN 'new' WHEN fresh THEN 'revised' ELSE 'unchanged' END AS status, CASE WHEN ok THEN CAST(sum(CAST(fresh AS INT)) OVER (PARTITION BY conv_id, ok ORDER BY turn) AS BIGINT) END AS revision, sha256 FROM c"""),
    "revisit_queue": (revisit_queue, REPORTS_SQL + """ SELECT id, published FROM r WHERE coalesce(retry_after, TIMESTAMP '1998-01-01') <= TIMESTAMP '1998-01-01' AND (body IS NULL OR checked IS NULL OR checked < TIMESTAMP '1997-12-25' OR published >= TIMESTAMP '1997-12-30')
ORDER BY body IS NOT NULL, checked ASC NULLS FIRST, published DESC, id LIMIT 50"""),
    "backoff_schedule": (backoff_schedule, "WITH f AS (SELECT o_orderkey % 12 + 1 AS failures, count(*) AS reports FROM orders GROUP BY 1) SELECT failures, reports, CAST(least(86400, 300 * pow(2, least(failures - 1, 8))) AS BIGINT) AS delay FROM f"),
    "tombstone_snapshot": (tombstone_snapshot, f"""WITH d AS (SELECT doc_id, sha256({BODY}) AS mark FROM documents), p AS (SELECT * FROM d WHERE doc_id % 5 <> 0), n AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN reverse(mark) ELSE mark END AS mark FROM d WHERE doc_id % 5 <> 1)
SELECT coalesce(p.doc_id, n.doc_id) AS doc_id, CASE WHEN n.doc_id IS NULL THEN 'gone' WHEN p.doc_id IS NULL THEN 'new' WHEN p.mark = n.mark THEN 'unchanged' ELSE 'revised' END AS status, n.doc_id IS NOT NULL AS active FROM p FULL JOIN n ON p.doc_id = n.doc_id"""),
    "queue_left_join": (queue_left_join, """WITH r AS (SELECT l_orderkey, max(l_shipdate) AS checked FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY 1)
SELECT o_orderkey, checked FROM orders LEFT JOIN r ON o_orderkey = l_orderkey WHERE checked IS NULL OR checked < TIMESTAMP '1996-06-01' ORDER BY checked IS NOT NULL, o_orderkey LIMIT 100"""),
    "unfetched_anti": (unfetched_anti, "SELECT o_orderpriority, count(*) AS unfetched FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 30) GROUP BY 1"),
    "verified_inner": (verified_inner, "SELECT o_orderpriority, count(*) AS verified FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1"),
    "latest_complete_scan": (latest_complete_scan, "SELECT o_custkey, o_orderdate, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders WHERE o_orderstatus = 'F') WHERE r = 1"),
    "sticky_completion": (sticky_completion, "SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS year, bool_or(o_orderstatus = 'F') AS complete, max(o_orderkey % 90) AS pages FROM orders GROUP BY ALL"),
    "decision_import": (decision_import, "SELECT doc_id, 'second' AS missing_in FROM documents WHERE doc_id % 17 <> 0 AND doc_id % 19 = 0 UNION ALL SELECT doc_id, 'first' FROM documents WHERE doc_id % 19 <> 0 AND doc_id % 17 = 0"),
    "read_back": (read_back, "SELECT o_orderkey, o_orderstatus, 'first' AS side FROM orders WHERE o_orderkey % 1000 = 0 UNION ALL SELECT o_orderkey, '?', 'second' FROM orders WHERE o_orderkey % 1000 = 0"),
    "cadence_due": (cadence_due, """WITH e AS (SELECT user_id, max(ts) + to_days(CAST(user_id % 20 AS INT)) AS last FROM events GROUP BY 1) SELECT user_id, last + INTERVAL 72 HOUR <= TIMESTAMP '2024-02-10 00:30:00' AS check_due, strftime(last + INTERVAL 1 HOUR, '%Y-%m') < '2024-02' AS refresh_due FROM e"""),
}
