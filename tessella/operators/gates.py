"""Assertions that run before anything is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(ValueError):
    """Rows broke a rule; what was published before stays."""


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, reason) for every rule that a row does not meet; an unknown outcome is a violation."""
    reasons = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return rows.select(F.col(key).cast("string").alias("key"), F.explode(F.array_compact(F.array(*reasons))).alias("reason"))


def repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """(key, reason) for keys that more than one row has."""
    return rows.groupBy(*keys).count().filter("count > 1").select(F.concat_ws("/", *keys).alias("key"), F.lit("repeated key").alias("reason"))


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side alone, repeats counted; empty if the tables are equal in any order."""
    b = b.select(*a.columns)
    return a.exceptAll(b).withColumn("side", F.lit("first")).union(b.exceptAll(a).withColumn("side", F.lit("second")))


def must_be_empty(found: DataFrame, what: str, shown: int = 5) -> None:
    """Raise with a few examples if there are violations. An action of its own, since a check in a lazy plan may never run."""
    if examples := found.limit(shown).collect():
        raise GateError(f"{what}: {[tuple(r) for r in examples]}")


def publication_problems(coverage: DataFrame) -> DataFrame:
    """(problem) of one candidate row (fetched, pending, failed, mapped, unlocated, monthly, previous_fetched)."""
    tests = [
        ("source backlog or errors", (F.col("pending") > 0) | (F.col("failed") > 0)),
        ("mapped and unlocated do not add up to fetched", F.col("mapped") + F.col("unlocated") != F.col("fetched")),
        ("months do not add up to fetched", F.col("monthly") != F.col("fetched")),
        ("fewer reports than published before", F.col("fetched") < F.col("previous_fetched")),
    ]
    return coverage.select(F.explode(F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests]))).alias("problem"))
