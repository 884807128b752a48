"""Counts, shares and published figures."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.grid import hex_cell

VERDICTS = ("supported", "no_support", "uncertain", "not_evaluated")


def share(part: Column, whole: Column) -> Column:
    """part / whole; null, not 0, where there is no whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def hexagons(rows: DataFrame, edge: float, *by: str) -> DataFrame:
    """Announcements (id, x, y, precision) by cell: count, approximate count and least id."""
    cell = rows.withColumn("_c", hex_cell(F.col("x"), F.col("y"), edge)).select("*", "_c.i", "_c.j")
    return cell.groupBy(*by, "i", "j").agg(F.count("*").alias("count"), F.count_if(F.col("precision") != "point").alias("approximate_count"), F.min("id").alias("first_id"))


def verdict_counts(records: DataFrame, tags: list[str], assessments: DataFrame, key: str) -> DataFrame:
    """(tag, four verdict counts, records): records without an assessment of a tag are not evaluated.

    Assessed pairs are counted once each; what is left of all records is not evaluated. So no record is multiplied by the tags.
    """
    total = records.agg(F.count("*").alias("records"))
    known = assessments.join(records.select(key), key, "left_semi").groupBy("tag").agg(*[F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS[:3]])
    spark = records.sparkSession
    frame = spark.createDataFrame([(t,) for t in tags], "tag string").join(F.broadcast(total))  # one row: no product
    out = frame.join(known, "tag", "left").select("tag", *[F.coalesce(v, F.lit(0)).alias(v) for v in VERDICTS[:3]], "records")
    return out.withColumn("not_evaluated", F.col("records") - reduce(add, [F.col(v) for v in VERDICTS[:3]]))


def indices(counts: DataFrame) -> DataFrame:
    """Coverage, shares and bounds from verdict counts; null where there are no records."""
    resolved = F.col("supported") + F.col("no_support")
    return counts.select(
        "tag", "records", share(resolved + F.col("uncertain"), F.col("records")).alias("coverage"), share(F.col("supported"), resolved).alias("share_in_resolved"),
        (100 * share(F.col("supported"), F.col("records"))).alias("content_index"), (100 * share(F.col("supported") + F.col("uncertain") + F.col("not_evaluated"), F.col("records"))).alias("highest_index"),
    )


def composite(found: DataFrame, weights: dict[str, float]) -> DataFrame:
    """The weighted mean of content indices; null if an index with weight is unknown."""
    if any(w < 0 for w in weights.values()) or not any(weights.values()):
        raise ValueError("weights must be at least 0, and one above it")
    known = F.create_map(*[x for t, w in weights.items() if w for x in (F.lit(t), F.lit(float(w)))])
    weighed = found.withColumn("_w", F.try_element_at(known, F.col("tag"))).filter("_w IS NOT NULL")
    ready = F.bool_and(F.col("content_index").isNotNull())
    return weighed.agg(F.when(ready, F.sum(F.col("_w") * F.col("content_index")) / F.sum("_w")).alias("composite"))


def windowed(rows: DataFrame, day: str, as_of: DataFrame, spans: tuple[int, ...] = (7, 30, 90)) -> DataFrame:
    """``rows`` once for each window that holds their day: the year so far and the last days, both ends included. Unknown days are in none."""
    windows = [("ytd", F.trunc("as_of", "year"))] + [(f"last_{n}", F.date_sub("as_of", n - 1)) for n in spans]
    dated = rows.join(F.broadcast(as_of))  # one row: no product
    inside = [F.when((F.col(day) >= first) & (F.col(day) <= F.col("as_of")), F.lit(name)) for name, first in windows]
    return dated.withColumn("window", F.explode(F.array_compact(F.array(*inside)))).drop("as_of")


def suppressed(rows: DataFrame, code: str, views: str, least: int = 20, step: int = 10, most: int = 8) -> DataFrame:
    """The published (code, pv): the ``most`` largest countries of ``least`` views or more, the rest as OTHER if it is large enough, all rounded down.

    An unknown country, ZZ, is never named but belongs to the rest.
    """
    sums = rows.groupBy(F.col(code).alias("code")).agg(F.sum(views).alias("pv"))
    named = sums.filter((F.col("code") != "ZZ") & (F.col("pv") >= least)).orderBy(F.desc("pv"), "code").limit(most)
    rest = sums.join(named.select("code"), "code", "left_anti").agg(F.sum("pv").alias("pv")).filter(F.col("pv") >= least).select(F.lit("OTHER").alias("code"), "pv")
    return named.union(rest).select("code", (F.floor(F.col("pv") / step) * step).cast("bigint").alias("pv"))


def confusion(gold: DataFrame, predicted: DataFrame, key: str, tags: list[str]) -> DataFrame:
    """(tag, tp, fp, fn, tn, missing, precision, recall) of predicted flags against gold ones; a missing prediction is only missing."""
    both = gold.join(predicted.select(key, *[F.col(t).alias(f"_{t}") for t in tags], F.lit(True).alias("_has")), key, "left")
    long = both.select("_has", F.explode(F.array(*[F.struct(F.lit(t).alias("tag"), F.col(t).cast("boolean").alias("g"), F.col(f"_{t}").cast("boolean").alias("p")) for t in tags])).alias("r")).select("_has", "r.*")
    out = long.groupBy("tag").agg(F.count_if(F.expr("g AND p")).alias("tp"), F.count_if(F.expr("NOT g AND p")).alias("fp"), F.count_if(F.expr("g AND NOT p")).alias("fn"), F.count_if(F.expr("NOT g AND NOT p")).alias("tn"), F.count_if(F.col("_has").isNull()).alias("missing"))
    return out.select("*", share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), share(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))
