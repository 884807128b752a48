"""Change data: versions, queues, snapshots and their completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import collapsed

DAY = 86_400


def discovered(old: DataFrame, new: DataFrame, key: str, kept: str) -> DataFrame:
    """``new`` laid over ``old`` by key: its fields win, but a blank or missing ``kept`` never erases what is known."""
    fields = [c for c in old.columns if c not in (key, kept)]
    merged = old.alias("o").join(new.alias("n"), key, "full_outer")
    seen = F.col(f"n.{kept}").isNotNull() | F.coalesce(*[F.col(f"n.{c}").isNotNull() for c in fields], F.lit(False)) if fields else F.col(f"n.{kept}").isNotNull()
    return merged.select(key, F.coalesce(F.nullif(F.col(f"n.{kept}"), F.lit("")), F.col(f"o.{kept}")).alias(kept), *[F.when(seen, F.coalesce(f"n.{c}", f"o.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in fields])


def accepted(versions: DataFrame, key: str, order: str, body: str, least: int = 30) -> DataFrame:
    """Each version as new, revised, unchanged or rejected (below ``least`` characters), with its revision and hash.

    A version is compared with the last accepted one of its key; rejected ones leave no trace.
    """
    rows = versions.select(key, order, collapsed(F.coalesce(F.col(body), F.lit(""))).alias("_body")).withColumn("_ok", F.length("_body") >= least)
    rows = rows.withColumn("sha256", F.when(F.col("_ok"), F.sha2("_body", 256)))
    before = f"(PARTITION BY {key}, _ok ORDER BY {order})"
    rows = rows.withColumn("_last", F.expr(f"lag(sha256) OVER {before}"))
    rows = rows.withColumn("_new", F.col("_ok") & (F.col("_last").isNull() | (F.col("_last") != F.col("sha256"))))
    status = F.when(~F.col("_ok"), "rejected").when(F.col("_last").isNull(), "new").when(F.col("_new"), "revised").otherwise("unchanged")
    return rows.select(key, order, status.alias("status"), F.when(F.col("_ok"), F.expr(f"sum(int(_new)) OVER {before}")).alias("revision"), "sha256")


def backoff(failures: Column, first: int = 300, most: int = DAY) -> Column:
    """Seconds to wait after so many failures in a row."""
    return F.least(F.lit(most), F.lit(first) * F.pow(F.lit(2), F.least(failures - 1, F.lit(8)))).cast("bigint")


def revisit(reports: DataFrame, start: Column, most: int) -> DataFrame:
    """What to read next: due rows that were never read, not for a week, or published within two days; unread ones first."""
    week, two = start - F.expr("INTERVAL 7 DAYS"), start - F.expr("INTERVAL 2 DAYS")
    due = (F.coalesce(F.col("retry_after"), start) <= start) & (F.col("body").isNull() | F.col("checked").isNull() | (F.col("checked") < week) | (F.col("published") >= two))
    return reports.filter(due).orderBy(F.col("body").isNotNull(), F.col("checked").asc_nulls_first(), F.col("published").desc(), "id").limit(most)


def snapshot(previous: DataFrame, current: DataFrame, key: str, mark: str) -> DataFrame:
    """(key, status, active): new, revised, unchanged or gone rows of a complete snapshot."""
    both = previous.select(key, F.col(mark).alias("_old"), F.lit(True).alias("_had")).join(current.select(key, F.col(mark).alias("_new"), F.lit(True).alias("_has")), key, "full_outer")
    status = F.when(F.col("_has").isNull(), "gone").when(F.col("_had").isNull(), "new").when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("revised")
    return both.select(key, status.alias("status"), F.col("_has").isNotNull().alias("active"))


def latest_complete(scans: DataFrame, by: str, finished: str, complete: Column, field: str) -> DataFrame:
    return scans.filter(complete).groupBy(by).agg(F.max(F.struct(finished, field)).alias("_m")).select(by, f"_m.{finished}", f"_m.{field}")


def same_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, missing_in): ids of one side alone; empty if the id sets are equal."""
    return a.select(key).distinct().join(b, key, "left_anti").withColumn("missing_in", F.lit("second")).union(b.select(key).distinct().join(a, key, "left_anti").withColumn("missing_in", F.lit("first")))
