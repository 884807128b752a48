"""Reading tables, cutting lineage and getting at Arrow text buffers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessella.session import cut as cut
from tessella.session import ship


#: Rows of an Arrow batch at most.
BATCH_ROWS = 2000
#: Groups of ids within which a sample is ranked.
SAMPLE_SPREAD = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(df: DataFrame, bytes_per_row: int, bound_mb: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows fit in ``bound_mb``; without one, Spark shuffles both sides."""
    return F.broadcast(df) if df.count() * bytes_per_row <= bound_mb << 20 else df


def arrow(df: DataFrame, function: Callable, schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the executors, and with workers that give memory back.

    The session's Arrow batches are cut to ``BATCH_ROWS`` rows (unless they are smaller), since executors hold a batch twice, once in each process.
    """
    spark = df.sparkSession
    ship(spark)
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return_memory()
        yield from function(batches)

    return df.mapInArrow(lean, schema)


def return_memory() -> None:
    """Have arrays of a megabyte or more mapped for themselves, so that a long-lived worker does not keep what it once used."""
    try:
        ctypes.CDLL(None).mallopt(-3, 1 << 20)
    except (AttributeError, OSError):  # not glibc
        return
    pa.set_memory_pool(pa.system_memory_pool())


def batch_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    """A record batch of arrays, lists or numpy arrays by name."""
    return pa.RecordBatch.from_arrays([x.cast(f.type) if isinstance(x := columns[f.name], pa.Array) else pa.array(x, f.type) for f in schema], schema=schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def carried(docs: DataFrame, carry: list[str] | None, text_col: str, results: tuple[str, ...]) -> list[str]:
    """The columns that go along with an operator's results: all but the text if not told. A name of a result, or one with a leading underscore, stands for the result alone."""
    names = [c for c in docs.columns if c != text_col] if carry is None else carry
    return [c for c in dict.fromkeys(names) if c not in results and not c.startswith("_")]


def hash_sample(rows: DataFrame, kind: str, id_col: str, per_kind: int, most_rows: int = 153_600) -> DataFrame:
    """About the ``per_kind`` rows with the least hash of the id of each ``kind``, repeated ids once; fewer of each, but of every kind, where all kinds' would be more than ``most_rows``.

    More kinds than ``most_rows`` are no classes to learn: they raise a ValueError. Kinds are counted first, and a cut through the hashes, before any shuffle, leaves a few times ``per_kind`` of each to rank, however many rows
    there are. Ranks are taken within ``SAMPLE_SPREAD`` groups of ids, so that a kind is not one task's.
    """
    return_memory()  # what is sampled is learned from in this process
    rows = rows.select(id_col, kind, F.pmod(F.xxhash64(id_col), F.lit(1 << 40)).alias("_h"))
    counts = cut(rows.groupBy(F.col(kind).alias("_kind")).agg(F.approx_count_distinct("_h").alias("_n")), "sample-kinds")
    kinds, longest = counts.agg(F.count("*"), F.coalesce(F.max(F.octet_length(F.col("_kind").cast("string"))), F.lit(0))).first()
    if kinds > most_rows:
        raise ValueError(f"{kinds} values of {kind} are more than the {most_rows} rows that may be learned from")
    per_kind = max(1, min(per_kind, most_rows // max(1, kinds)))
    share = F.least(F.lit(1.0), (4 * per_kind + 64) / F.col("_n"))
    counts = F.broadcast(counts) if kinds * (longest + 24) <= 64 << 20 else counts
    near = rows.join(counts, F.col(kind) == F.col("_kind")).filter(F.col("_h") < share * (1 << 40)).select(id_col, kind, "_h").distinct()
    each = -(-per_kind // SAMPLE_SPREAD)
    return near.withColumn("_r", F.expr(f"row_number() OVER (PARTITION BY {kind}, _h % {SAMPLE_SPREAD} ORDER BY _h, {id_col})")).filter(F.col("_r") <= each).select(id_col, kind)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow column end to end, and the n + 1 offsets between them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows so that each holds about ``most_bytes`` of text, or a single longer row."""
    for batch in batches:
        _, bounds = utf8(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most_bytes, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
