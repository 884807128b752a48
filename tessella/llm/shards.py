"""Sharding by a two-pass external shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import cut, table, text_or_empty


def shuffle_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, bucket_mb: int = 16, seed: int = 17) -> DataFrame:
    """Deal all rows at random into ``shards`` shards whose row counts differ by at most one.

    Pass one scatters the rows by a seeded hash of id and text into buckets of about ``bucket_mb``, as many as the
    bytes need. Pass two sorts each bucket (so that reruns agree), shuffles it by Fisher-Yates with a seeded generator
    (Spark's ``shuffle``), and lays the buckets end to end; equal stretches of that order are the shards and the
    position in a stretch is the slot. The law is therefore ``rows``; grown_shard is null.

    A bucket's rows are held by one task, so its bytes are bounded by ``bucket_mb`` and the longest text. Rows that
    agree in id and text meet in one bucket: ids are expected to be (nearly) unique. A null text has no bytes and the
    checksum of no bytes, 0. A table without rows gives no rows. Returns ``carry`` (the id by default) with size,
    text_crc32, law, shard, slot and grown_shard; other columns are not read.
    """
    carry = [c for c in ([id_col] if carry is None else carry) if c not in ("size", "text_crc32", "law", "shard", "slot", "grown_shard")]
    text = text_or_empty(text_col)
    rows = docs.select(F.struct(*carry).alias("_row"), F.octet_length(text).cast("bigint").alias("_bytes"), F.crc32(text.cast("binary")).alias("_crc"), F.xxhash64(F.lit(seed), F.col(id_col), text).alias("_hash"))
    if text_col not in carry:
        rows = cut(rows, "shard-rows")
    carried = F.col("_bytes") if text_col in carry else F.lit(0)
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(carried + 64), F.lit(0)).alias("b")).first()
    n, buckets = total["n"], max(1, -(-total["b"] // (bucket_mb << 20)))
    rows = rows.withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))
    starts = rows.groupBy("_bucket").agg(F.count("*").alias("_count")).select("_bucket", F.expr("sum(_count) OVER (ORDER BY _bucket) - _count").alias("_start"))
    parts = min(buckets, 20_000)
    dealt = (
        rows.repartition(parts, "_bucket").groupBy("_bucket").agg(F.array_sort(F.collect_list(F.struct("_hash", "_bytes", "_crc", "_row"))).alias("_rows"))
        .sortWithinPartitions("_bucket").select("_bucket", F.shuffle("_rows", seed).alias("_rows"))
    )
    at = dealt.join(starts, "_bucket").select("_start", F.posexplode("_rows").alias("_pos", "_r")).withColumn("_at", F.col("_start") + F.col("_pos"))
    at = at.withColumn("_shard", F.expr(f"_at * {shards} div {max(n, 1)}"))
    return at.select(
        *[F.col(f"_r._row.{c}") for c in carry], (F.col("_r._bytes") + 1).alias("size"), F.col("_r._crc").alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("_shard").cast("int").alias("shard"), F.expr(f"_at - (_shard * {n} + {shards - 1}) div {shards}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffle_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
