"""Structured Streaming: revisions per key, repeats, and counts by window."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessella.functions.text import collapsed
from tessella.session import shared_path, ship


def source(spark: SparkSession, path: str, files_per_batch: int = 8) -> DataFrame:
    """A table's files as a stream; they are read as they come, some in each micro-batch. The path is given as a pattern, since a table may be a single file."""
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{path[:-1]}[{path[-1]}]")


def drained(stream: DataFrame, name: str, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None) -> str:
    """Run a stream over all that is there; the folder to which it wrote. The checkpoint lies in the shared folder, so a lost executor or a restart repeats nothing."""
    spark = stream.sparkSession
    out = shared_path(spark, name)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True)
    query = writer.foreachBatch(each).start() if each else writer.format("parquet").option("path", out).start()
    query.awaitTermination()
    return out


def revisions(versions: DataFrame, key: str, order: str, body: str, least: int = 30) -> DataFrame:
    """(key, order, status, revision) of versions as they arrive: new, revised, unchanged, rejected or late.

    State is one hash, revision and order a key. Versions of a micro-batch are taken in order; one that comes in a later batch than a version after it
    is ``late``: it has no revision and changes none, since what follows it has been settled.
    """
    ship(versions.sparkSession)
    kind = versions.schema[key].dataType.simpleString()

    def handle(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, revision, newest = state.get if state.exists else ("", 0, None)
        rows = pd.concat(list(batches), ignore_index=True).sort_values("_order", kind="stable")
        late = rows["_order"] <= newest if newest is not None else pd.Series(False, rows.index)
        rows["status"] = rows["_hash"].isna().map({True: "rejected", False: "late"}).astype(object)
        good = rows[~late & rows["_hash"].notna()]
        turned = good["_hash"] != good["_hash"].shift(fill_value=last)
        rows.loc[good.index, "revision"] = revision + turned.cumsum()
        rows.loc[good.index, "status"] = turned.map({True: "revised", False: "unchanged"})
        if len(good):
            if not revision:
                rows.loc[good.index[0], "status"] = "new"
            last, revision, newest = good["_hash"].iloc[-1], revision + int(turned.sum()), int(good["_order"].iloc[-1])
        state.update((last, revision, newest))
        out = pd.DataFrame({"key": group[0], "seq": rows["_order"], "status": rows["status"], "revision": rows["revision"] if "revision" in rows else None})
        yield out.astype({"revision": "Int64"})

    text = collapsed(F.coalesce(F.col(body), F.lit("")))
    rows = versions.select(F.col(key).alias("_key"), F.col(order).cast("bigint").alias("_order"), F.when(F.length(text) >= least, F.sha2(text, 256)).alias("_hash"))
    return rows.groupBy("_key").applyInPandasWithState(handle, f"key {kind}, seq bigint, status string, revision bigint", "sha string, revision bigint, seq bigint", "append", GroupStateTimeout.NoTimeout)


def window_counts(events: DataFrame, time: str, by: str, width: str = "1 day", late: str = "2 hours") -> DataFrame:
    """Counts by event-time window, closed once the watermark has passed it."""
    zoned = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    return zoned.groupBy(F.window("_t", width), by).agg(F.count("*").alias("count"))


def once(rows: DataFrame, keys: list[str], time: str, late: str = "2 hours") -> DataFrame:
    """Rows whose keys were not seen within the watermark."""
    return rows.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late).dropDuplicatesWithinWatermark(keys).drop("_t")
