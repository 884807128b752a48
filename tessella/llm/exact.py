"""Exact duplicates: a two-pass Bloom filter, then a shuffle of the possibly repeated rows alone."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import cut, table, text_or_empty

WHITE_SPACE = " \t\n\x0b\x0c\r"
#: Least number of ranges of hashes, rows of a chunk, and bytes of a word of the filter in a broadcast table.
RANGES, CHUNK, WORD_BYTES = 64, 1 << 20, 48


def normalised(text: Column) -> Column:
    return reduce(lambda value, char: F.replace(value, F.lit(char), F.lit("")), WHITE_SPACE, text)


def _range(ranges: int) -> Column:
    """The stretch of hashes, of ``ranges`` equal ones, in which a row's hash lies."""
    return F.expr(f"int(shiftright((shiftright(_hash, 33) + {1 << 30}) * {ranges}, 31))")


def _low(hash_range: int, ranges: int) -> int:
    """The least hash of a range."""
    return (-(-(hash_range << 31) // ranges) - (1 << 30)) << 33


def _probe(words: int, hashes: int) -> dict[str, Column]:
    """The word of a (range, short) in a filter with ``words`` words a range, and its bits there."""
    one, key = F.lit(1).cast("bigint"), lambda k: F.xxhash64("_range", "_short", F.lit(k))
    bits = [F.call_function("shiftleft", one, F.pmod(key(k), F.lit(64)).cast("int")) for k in range(hashes)]
    return {"_word": F.col("_range") * F.lit(words).cast("bigint") + F.pmod(key(-1), F.lit(words)), "_mask": reduce(lambda x, y: x.bitwiseOR(y), bits)}


def possibly_repeated(rows: DataFrame, ranges: int, bits_per_row: int, hashes: int) -> tuple[DataFrame, int]:
    """Pass one: the words (_word, _set) of a Bloom filter of the hashes that two rows or more have, and how many words a range has.

    Each task sends 31 bits of its rows' hashes packed, one list for each range of hashes, and of equal ones at most
    two; so what is shuffled are a few long lists of four bytes a row, not rows, and a text that a third of all rows share
    adds two entries a list. The rows' numbers are cut into chunks of ``CHUNK``, which bounds a list's length.
    """
    hashed = rows.select(_range(ranges).alias("_range"), F.shiftright("_row", 20).alias("_chunk"), F.expr(f"int(_hash & {(1 << 31) - 1})").alias("_short"))
    lists = hashed.groupBy("_range", "_chunk").agg(F.sort_array(F.collect_list("_short")).alias("_all"))
    lists = lists.select("_range", F.expr("filter(_all, (x, i) -> i < 2 OR _all[i - 2] <> x)").alias("_some"))
    twice = cut(lists.repartition("_range").select("_range", F.explode("_some").alias("_short")).groupBy("_range", "_short").count().filter("count > 1").drop("count"), "exact-twice")
    words = max(1, -(-twice.count() * bits_per_row // (64 * ranges)))
    probes = _probe(words, hashes)
    return cut(twice.select(probes["_word"].alias("_word"), probes["_mask"].alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_set")), "exact-bloom"), words


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, bits_per_row: int = 32, hashes: int = 3, filter_mb: float = 64) -> DataFrame:
    """Mark each row with the row that stays for its text.

    Texts are equal when they are identical after white space is deleted. Of equal texts the row with the most code
    points stays, then the smallest id; of wholly repeated rows exactly one stays. Null counts as empty, and all empty
    texts are one group. An empty table gives an empty result. Returns ``carry`` (the id by default) with keep_id,
    group_size, kept and text_sha256; other input columns are not read, so their names cannot clash.

    Pass one (``possibly_repeated``) makes a Bloom filter of the hashes that occur at least twice, ``hashes`` bits in one
    64-bit word each. Pass two looks each row up: a row that is not in the filter is unique and goes straight through
    without a shuffle, the others alone are grouped by their digests. The filter is broadcast in slices of at most ``filter_mb``,
    one after the other if it needs several, and each row is looked up in its own slice; rows lie sorted by slice, so that a
    slice's pass reads little else. Counting, choosing and the shuffle before them combine on the map side, so a text
    that a third of all rows share costs one row a task.
    """
    carry = [c for c in ([id_col] if carry is None else carry) if c not in ("keep_id", "group_size", "kept", "text_sha256")]
    text = text_or_empty(text_col)
    rows = docs.select(*carry, F.col(id_col).alias("_id"), F.unhex(F.sha2(normalised(text), 256)).alias("_sha"), F.length(text).alias("_n"), F.monotonically_increasing_id().alias("_row"))
    rows = cut(rows.withColumn("_hash", F.xxhash64("_sha")).sortWithinPartitions("_hash"), "exact-rows")
    ranges = max(RANGES, rows.count() // CHUNK)
    bloom, words = possibly_repeated(rows, ranges, bits_per_row, hashes)
    slices = min(ranges, max(1, math.ceil(bloom.count() * WORD_BYTES / (filter_mb * (1 << 20)))))
    keyed = rows.withColumns({"_range": _range(ranges), "_short": F.expr(f"int(_hash & {(1 << 31) - 1})")}).withColumns(_probe(words, hashes))
    hit = F.coalesce(F.col("_set").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    out = [*carry, "keep_id", "group_size", "kept", F.lower(F.hex("_sha")).alias("text_sha256")]
    unique, maybe = [], []
    for k in range(slices):
        low, high = ranges * k // slices, ranges * (k + 1) // slices
        within = (F.col("_hash") >= _low(low, ranges)) & ((F.col("_hash") < _low(high, ranges)) if high < ranges else F.lit(True))
        part = bloom.filter((F.col("_word") >= low * words) & (F.col("_word") < high * words))
        probed = keyed.filter(within).join(F.broadcast(part), "_word", "left").select(*rows.columns, hit.alias("_hit"))
        if slices > 1:  # written, so that one slice of the filter is in memory at a time
            probed = cut(probed, "exact-probed")
        unique.append(probed.filter("NOT _hit"))
        maybe.append(probed.filter("_hit"))
    once, again = (reduce(DataFrame.unionByName, x) for x in (unique, maybe))
    # Written, so that the join below shuffles both sides for itself and Spark may split a text that many rows share.
    best = cut(again.groupBy("_sha").agg(F.count("*").alias("group_size"), F.min(F.struct((-F.col("_n")).alias("n"), F.col("_id").alias("id"), F.col("_row").alias("row"))).alias("_best")), "exact-best")
    repeated = again.join(best, "_sha").withColumns({"keep_id": F.col("_best.id"), "kept": F.col("_best.row") == F.col("_row")}).select(*out)
    return once.withColumns({"keep_id": F.col("_id"), "group_size": F.lit(1).cast("bigint"), "kept": F.lit(True)}).select(*out).unionByName(repeated)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""
