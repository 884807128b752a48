"""Statistics, windows, suppression and evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import statistics as st
from tessella.sources.tables import announcements, table

TAGS = ("quality", "toxic", "theft")


def _repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announcements as several files hold them: every second one again as it was, every tenth again in another category."""
    a = announcements(spark, sf_dir).select("id", F.when(F.col("k") > 0, F.col("month")).alias("month"), "category")
    return a.union(a.filter("id % 2 = 0")).union(a.filter("id % 10 = 0").withColumn("category", F.lit("moved")))


def announcement_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each category among the announcements of a month. Identical repeats count once, ids with differing rows not at all but as conflicts; unknown months stay unknown."""
    ids = _repeated(spark, sf_dir).distinct().groupBy("id").agg(F.count("*").alias("n"), F.min("month").alias("month"), F.min("category").alias("category"))
    counts = ids.groupBy("month", F.when(F.col("n") == 1, F.col("category")).alias("category")).agg(F.count("*").alias("count"))
    totals = counts.groupBy(F.col("month").alias("m")).agg(F.sum(F.when(F.col("category").isNotNull(), F.col("count"))).alias("total"), F.coalesce(F.sum(F.when(F.col("category").isNull(), F.col("count"))), F.lit(0)).alias("conflicts"))
    return counts.filter("category IS NOT NULL").join(totals, F.col("month").eqNullSafe(F.col("m"))).select("month", "category", "count", "conflicts", st.share(F.col("count"), F.col("total")).alias("fraction"))


def _assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as assessments: 1 supports a tag, 0 does not, and every seventh document is uncertain."""
    verdict = lambda c: F.when(F.col("doc_id") % 7 == 0, "uncertain").when(F.col(c) == 1, "supported").otherwise("no_support").alias("verdict")
    rows = table(spark, sf_dir, "labels")
    return rows.select("doc_id", F.lit("quality").alias("tag"), verdict("quality")).union(rows.select("doc_id", F.lit("toxic"), verdict("toxic")))


def tag_verdict_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.verdict_counts(table(spark, sf_dir, "documents"), list(TAGS), _assessments(spark, sf_dir), "doc_id").select("tag", *st.VERDICTS, "records")


def tag_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.indices(tag_verdict_pivot(spark, sf_dir))


def composite_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.composite(tag_indices(spark, sf_dir), {"quality": 2.0, "toxic": 1.0, "theft": 0.0})


VERDICT_SQL = """WITH l AS (SELECT doc_id, 'quality' AS tag, CASE WHEN doc_id % 7 = 0 THEN 'uncertain' WHEN quality = 1 THEN 'supported' ELSE 'no_support' END AS verdict FROM labels UNION ALL SELECT doc_id, 'toxic', CASE WHEN doc_id % 7 = 0 THEN 'uncertain' WHEN toxic = 1 THEN 'supported' ELSE 'no_support' END FROM labels),
d AS (SELECT doc_id, unnest(['quality', 'toxic', 'theft']) AS tag FROM documents), v AS (SELECT tag, count(*) FILTER (verdict = 'supported') AS supported, count(*) FILTER (verdict = 'no_support') AS no_support, count(*) FILTER (verdict = 'uncertain') AS uncertain, count(*) FILTER (verdict IS NULL) AS not_evaluated, count(*) AS records FROM d LEFT JOIN l USING (doc_id, tag) GROUP BY tag),
i AS (SELECT tag, records, (supported + no_support + uncertain)::DOUBLE / nullif(records, 0) AS coverage, supported::DOUBLE / nullif(supported + no_support, 0) AS share_in_resolved, 100 * (supported::DOUBLE / nullif(records, 0)) AS content_index, 100 * ((supported + uncertain + not_evaluated)::DOUBLE / nullif(records, 0)) AS highest_index FROM v)"""


def macro_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supported records of a tag by what supports them; a facet without its parent is an error, counted as such."""
    rows = _assessments(spark, sf_dir).groupBy("doc_id").agg(F.max(F.when(F.col("tag") == "quality", F.col("verdict"))).alias("parent"), F.max(F.when(F.col("tag") == "toxic", F.col("verdict"))).alias("facet"))
    basis = F.when(F.col("doc_id") % 2 == 0, "police_category_stated").otherwise("narrative_lead")
    return rows.filter("facet = 'supported'").groupBy(basis.alias("basis")).agg(F.count("*").alias("facets"), F.count_if(F.expr("parent <> 'supported'")).alias("orphans"))


def city_rollup_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each segment's total over all nations against the sum of its nations, from one grouping."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    sets = c.rollup("c_mktsegment", "n_name").agg(F.count("*").alias("n"), F.grouping_id().alias("g")).filter("g < 3")
    return sets.groupBy("c_mktsegment").agg(F.sum(F.when(F.col("g") == 0, F.col("n"))).alias("sum_of_nations"), F.max(F.when(F.col("g") == 1, F.col("n"))).alias("total")).withColumn("agrees", F.expr("sum_of_nations = total"))


def rolling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = announcements(spark, sf_dir)
    return st.windowed(a.select("category", "day"), "day", a.agg(F.max("day").alias("as_of"))).groupBy("window", "category").agg(F.count("*").alias("count"))


def label_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    guess = table(spark, sf_dir, "documents").filter("doc_id % 11 <> 0").select("doc_id", (~F.contains("text", F.lit("***"))).alias("quality"), F.contains("text", F.lit("stupid")).alias("toxic"))
    return st.confusion(table(spark, sf_dir, "labels"), guess, "doc_id", ["quality", "toxic"])


def suppressed_country_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    views = o.groupBy("c_nationkey").agg(F.count("*").alias("pv")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return st.suppressed(views.select(F.when(F.col("n_nationkey") == 7, "ZZ").otherwise(F.col("n_name")).alias("n_name"), "pv"), "n_name", "pv")


def export_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals that an export states, by order, against the sums of its rows, by line: the orders for which the two disagree."""
    stated = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 7 + 1).alias("stated"))
    summed = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("summed"))
    both = stated.join(summed, "o_orderkey", "full_outer").select("o_orderkey", F.coalesce("stated", F.lit(0)).alias("stated"), F.coalesce("summed", F.lit(0)).alias("summed"))
    return both.filter("stated <> summed")


def review_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by review status, those without a review pending, statuses without records 0."""
    d = table(spark, sf_dir, "documents").join(_assessments(spark, sf_dir).filter("tag = 'toxic'"), "doc_id", "left").groupBy(F.coalesce("verdict", F.lit("pending")).alias("status")).agg(F.count("*").alias("n"))
    every = spark.createDataFrame([(s,) for s in ("supported", "no_support", "uncertain", "pending", "stale")], "status string")
    return every.join(d, "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))


QUERIES = {
    "announcement_fractions": (announcement_fractions, """WITH b AS (SELECT event_id AS id, CASE WHEN CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) > 0 THEN strftime(ts, '%Y-%m') END AS month, event_type AS category FROM events),
a AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE id % 2 = 0 UNION ALL SELECT id, month, 'moved' FROM b WHERE id % 10 = 0), i AS (SELECT id, count(DISTINCT category) AS n, min(month) AS month, min(category) AS category FROM a GROUP BY 1),
t AS (SELECT month, count(*) FILTER (n = 1) AS total, count(*) FILTER (n > 1) AS conflicts FROM i GROUP BY 1), c AS (SELECT month, category, count(*) AS count FROM i WHERE n = 1 GROUP BY 1, 2) SELECT c.month, category, count, conflicts, count::DOUBLE / total AS fraction FROM c JOIN t ON c.month IS NOT DISTINCT FROM t.month"""),
    "tag_verdict_pivot": (tag_verdict_pivot, VERDICT_SQL + " SELECT * FROM v"),
    "tag_indices": (tag_indices, VERDICT_SQL + " SELECT * FROM i"),
    "composite_index": (composite_index, VERDICT_SQL + " SELECT sum(w * content_index) / sum(w) AS composite FROM (SELECT content_index, CASE tag WHEN 'quality' THEN 2.0::DOUBLE WHEN 'toxic' THEN 1.0::DOUBLE END AS w FROM i) WHERE w IS NOT NULL"),
    "macro_basis": (macro_basis, """SELECT CASE WHEN doc_id % 2 = 0 THEN 'police_category_stated' ELSE 'narrative_lead' END AS basis, count(*) AS facets, count(*) FILTER (quality <> 1) AS orphans FROM labels WHERE doc_id % 7 <> 0 AND toxic = 1 GROUP BY 1"""),
    "city_rollup_reconcile": (city_rollup_reconcile, """WITH r AS (SELECT c_mktsegment, n_name, count(*) AS n, grouping(c_mktsegment, n_name) AS g FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (c_mktsegment, n_name)) SELECT c_mktsegment, CAST(sum(n) FILTER (g = 0) AS BIGINT) AS sum_of_nations, max(n) FILTER (g = 1) AS total, sum(n) FILTER (g = 0) = max(n) FILTER (g = 1) AS agrees FROM r WHERE g < 3 GROUP BY 1"""),
    "rolling_windows": (rolling_windows, """WITH e AS (SELECT CAST(ts AS DATE) AS day, event_type AS category FROM events), m AS (SELECT max(day) AS as_of FROM e), w AS (SELECT 'ytd' AS "window", date_trunc('year', as_of) AS first, as_of FROM m UNION ALL SELECT 'last_' || n, as_of - CAST(n - 1 AS INT), as_of FROM m, (SELECT unnest([7, 30, 90]) AS n))
SELECT "window", category, count(*) AS count FROM e JOIN w ON day >= first AND day <= as_of GROUP BY ALL"""),
    "label_confusion": (label_confusion, """WITH p AS (SELECT doc_id, NOT contains(text, '***') AS quality, contains(text, 'stupid') AS toxic FROM documents WHERE doc_id % 11 <> 0),
b AS (SELECT 'quality' AS tag, l.quality = 1 AS g, p.quality AS p, p.doc_id FROM labels l LEFT JOIN p USING (doc_id) UNION ALL SELECT 'toxic', l.toxic = 1, p.toxic, p.doc_id FROM labels l LEFT JOIN p USING (doc_id)),
c AS (SELECT tag, count(*) FILTER (g AND p) AS tp, count(*) FILTER (NOT g AND p) AS fp, count(*) FILTER (g AND NOT p) AS fn, count(*) FILTER (NOT g AND NOT p) AS tn, count(*) FILTER (doc_id IS NULL) AS missing FROM b GROUP BY 1) SELECT *, tp::DOUBLE / nullif(tp + fp, 0) AS "precision", tp::DOUBLE / nullif(tp + fn, 0) AS recall FROM c"""),
    "suppressed_country_stats": (suppressed_country_stats, """WITH s AS (SELECT CASE WHEN n_nationkey = 7 THEN 'ZZ' ELSE n_name END AS code, count(*) AS pv FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1), t AS (SELECT * FROM s WHERE code <> 'ZZ' AND pv >= 20 ORDER BY pv DESC, code LIMIT 8)
SELECT code, CAST(floor(pv / 10) * 10 AS BIGINT) AS pv FROM t UNION ALL SELECT 'OTHER', CAST(floor(sum(pv) / 10) * 10 AS BIGINT) FROM s WHERE code NOT IN (SELECT code FROM t) HAVING sum(pv) >= 20"""),
    "export_reconcile": (export_reconcile, "WITH l AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) SELECT coalesce(o_orderkey, l_orderkey) AS o_orderkey, CASE WHEN o_orderkey IS NULL THEN 0 ELSE o_orderkey % 7 + 1 END AS stated, coalesce(n, 0) AS summed FROM orders FULL JOIN l ON o_orderkey = l_orderkey WHERE CASE WHEN o_orderkey IS NULL THEN 0 ELSE o_orderkey % 7 + 1 END <> coalesce(n, 0)"),
    "review_status": (review_status, VERDICT_SQL + ", r AS (SELECT coalesce(verdict, 'pending') AS status, count(*) AS n FROM documents LEFT JOIN (SELECT * FROM l WHERE tag = 'toxic') USING (doc_id) GROUP BY 1) SELECT status, coalesce(n, 0) AS n FROM (SELECT unnest(['supported', 'no_support', 'uncertain', 'pending', 'stale']) AS status) LEFT JOIN r USING (status)"),
}
