"""Queries that run as streams over a table's files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.session import shared_path
from tessella.streaming.revisions import drained, once, revisions, source, window_counts



def stream_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation as versions of one report, in order of arrival; files hold whole conversations."""
    out = drained(revisions(source(spark, f"{sf_dir}/conversations.parquet"), "conv_id", "turn", "text"), "stream-revisions")
    return spark.read.parquet(out).select(F.col("key").alias("conv_id"), F.col("seq").alias("turn"), "status", "revision")


def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day and kind. Each micro-batch overwrites what it recounted; the last table is whole."""
    out = shared_path(spark, "stream-counts")
    counts = window_counts(source(spark, f"{sf_dir}/events.parquet"), "ts", "event_type").select(F.col("window.start").cast("date").alias("day"), "event_type", "count")
    drained(counts, "stream-counts-run", "complete", lambda batch, _: batch.write.mode("overwrite").parquet(out))
    return spark.read.parquet(out)


def stream_distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by day, each counted once however many events there are: repeats of user and day within the watermark are dropped."""
    events = source(spark, f"{sf_dir}/events.parquet").select("user_id", F.to_date("ts").alias("day"), "ts")
    out = drained(once(events, ["user_id", "day"], "ts", "400 days"), "stream-once")
    return spark.read.parquet(out).groupBy("day").agg(F.count("*").alias("users"))


QUERIES = {
    "stream_revisions": (stream_revisions, r"""WITH b AS (SELECT conv_id, turn, trim(regexp_replace(coalesce(text, ''), '[ \t\n\x0b\f\r]+', ' ', 'g')) AS body FROM conversations), s AS (SELECT conv_id, turn, length(body) >= 30 AS ok, CASE WHEN length(body) >= 30 THEN sha256(body) END AS h FROM b),
l AS (SELECT *, lag(h) OVER (PARTITION BY conv_id, ok ORDER BY turn) AS last FROM s) SELECT conv_id, turn, CASE WHEN NOT ok THEN 'rejected' WHEN last IS NULL THEN 'new' WHEN last <> h THEN 'revised' ELSE 'unchanged' END AS status, CASE WHEN ok THEN CAST(sum(CASE WHEN last IS NULL OR last <> h THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, ok ORDER BY turn) AS BIGINT) END AS revision FROM l"""),
    "stream_window_counts": (stream_window_counts, "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS count FROM events GROUP BY ALL"),
    "stream_distinct_users": (stream_distinct_users, "SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS users FROM events GROUP BY 1"),
}
