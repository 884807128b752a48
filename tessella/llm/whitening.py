"""Whitening of embeddings from exact covariances, counted in bit planes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import arrow, arrow_schema, batch_of, cut, table

#: Entries become floor(SCALE * c) + SHIFT; entries beyond LIMIT / SCALE stand at the limit.
SCALE, SHIFT, LIMIT = 1024, 100_000, 1 << 60
#: Entries of vectors whose bit planes are counted at once, and bits of a limb of a sum.
CHUNK, LIMB, LIMBS = 1 << 19, 40, 5


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, lengths, entries): which rows of a list column are kept, the lengths of their vectors and their long entries end to end.

    A vector that is null or holds a null or non-finite entry isn't kept.
    """
    lists = column.cast(pa.large_list(pa.float64()))
    offsets = np.frombuffer(lists.buffers()[1], np.int64)[lists.offset : lists.offset + len(lists) + 1] if len(lists) else np.zeros(1, np.int64)
    entries = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    offsets = offsets - offsets[0]
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    keep = (bad[offsets[1:]] == bad[offsets[:-1]]) & ~lists.is_null().to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    entries = entries[np.repeat(keep, lengths)]
    longs = np.clip(np.floor(entries * SCALE), -LIMIT, LIMIT).astype(np.int64) + SHIFT
    return np.flatnonzero(keep), lengths[keep], longs


def _of_length(batch: pa.RecordBatch, at: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a batch whose vectors have ``dims`` entries, and these as a matrix."""
    rows, lengths, longs = _vectors(batch.column(at))
    fit = lengths == dims
    return rows[fit], longs[np.repeat(fit, lengths)].reshape(-1, dims)


def _limbs(values: np.ndarray) -> list[np.ndarray]:
    """Integers of any size as limbs: the sum of limb k times 2 ** (LIMB * k); the last one has the sign."""
    out = []
    for _ in range(LIMBS - 1):
        out.append((values & ((1 << LIMB) - 1)).astype(np.int64))
        values = values >> LIMB
    return [*out, values.astype(np.int64)]


def _whole(row: object, name: str) -> int:
    return sum(row[f"{name}{k}"] << (LIMB * k) for k in range(LIMBS))


def _sums(name: str) -> list[Column]:
    return [F.sum(f"{name}{k}").alias(f"{name}{k}") for k in range(LIMBS)]


def moments(rows: DataFrame, vector: str) -> tuple[int, int, list[int], list[int], list[int]]:
    """(dims, n, sums, least, most): the most frequent length of a usable vector (the longer of two), how many have it, and their exact sums, least and greatest entries by dimension.

    Every task sends one row for each dimension; what the driver reads doesn't depend on the number of vectors.
    """
    kind = "len int, dim int, n bigint, low bigint, high bigint, " + ", ".join(f"s{k} bigint" for k in range(LIMBS))
    schema = arrow_schema(rows.sparkSession.createDataFrame([], kind).schema)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            _, lengths, longs = _vectors(batch.column(0))
            for d in np.unique(lengths[lengths > 0]).tolist():
                x = longs[np.repeat(lengths == d, lengths)].reshape(-1, d)
                # In two halves, so that no sum of a batch overflows.
                part = [len(x), x.min(0), x.max(0), ((x >> 32).sum(0).astype(object) << 32) + (x & 0xFFFFFFFF).sum(0).astype(object)]
                had = found.get(d)
                found[d] = part if had is None else [had[0] + part[0], np.minimum(had[1], part[1]), np.maximum(had[2], part[2]), had[3] + part[3]]
        for d, (n, low, high, s) in found.items():
            yield batch_of(schema, {"len": np.full(d, d), "dim": np.arange(d), "n": np.full(d, n), "low": low, "high": high} | {f"s{k}": v for k, v in enumerate(_limbs(s))})

    parts = arrow(rows.select(vector), measure, kind).groupBy("len", "dim").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), *_sums("s"))
    parts = cut(parts, "whiten-moments")
    best = parts.filter("dim = 0").orderBy(F.desc("n"), F.desc("len")).first()
    if best is None:
        return 0, 0, [], [], []
    by_dim = parts.filter(F.col("len") == best["len"]).orderBy("dim").collect()
    return best["len"], best["n"], [_whole(r, "s") for r in by_dim], [r["low"] for r in by_dim], [r["high"] for r in by_dim]


def planes_of(shifted: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of a matrix of non-negative integers: for each dimension and bit a run of words that hold that bit of all rows."""
    rows, dims = shifted.shape
    words = -(-rows // 64)
    out = np.zeros((dims, bits, words * 8), np.uint8)
    for p in range(bits):
        packed = np.packbits(((shifted >> p) & 1).astype(np.uint8), axis=0)
        out[:, p, : len(packed)] = packed.T
    return out.view(np.uint64)


def add_products(total: np.ndarray, shifted: np.ndarray, bits: int) -> None:
    """Add the cross-products of the columns of ``shifted`` to ``total`` (limbs by dimension by dimension, at and above the diagonal)."""
    planes = planes_of(shifted, bits)
    dims, _, words = planes.shape
    for a in range(dims):
        others = planes[a:]
        for p in range(bits):
            if not planes[a, p].any():
                continue
            common = np.bitwise_count(others & planes[a, p]).sum(axis=2, dtype=np.int64)
            at = p + np.arange(bits)
            for limb in range(at[0] // LIMB, at[-1] // LIMB + 1):
                use = at // LIMB == limb
                total[limb, a, a:] += common[:, use] @ (np.int64(1) << (at[use] % LIMB))
    for limb in range(LIMBS - 1):
        total[limb + 1] += total[limb] >> LIMB
        total[limb] &= (1 << LIMB) - 1


def cross_products(rows: DataFrame, vector: str, dims: int, least: list[int], most: list[int]) -> dict[tuple[int, int], int]:
    """Exact sums of (x[a] - least[a]) * (x[b] - least[b]) over all vectors, for a <= b.

    Rows are scattered into words bit by bit: plane (a, p) holds bit p of dimension a, and the number of common bits of two planes, weighted by
    2 ** (p + q), is their part of the sum. A task sends one row for each pair of dimensions, whatever it has read.
    """
    bits = max(int(h - low).bit_length() for low, h in zip(least, most, strict=True))
    kind = "a int, b int, " + ", ".join(f"c{k} bigint" for k in range(LIMBS))
    schema = arrow_schema(rows.sparkSession.createDataFrame([], kind).schema)
    shift, (a, b), most_rows = np.array(least, np.int64), np.triu_indices(dims), max(64, CHUNK // dims // 64 * 64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, rows_waiting = np.zeros((LIMBS, dims, dims), np.int64), [], 0
        for batch in batches:
            x = _of_length(batch, 0, dims)[1] - shift
            waiting.append(x)
            rows_waiting += len(x)
            if rows_waiting >= most_rows:
                x = np.concatenate(waiting)
                for k in range(0, len(x) - most_rows + 1, most_rows):
                    add_products(total, x[k : k + most_rows], bits)
                waiting = [x[len(x) // most_rows * most_rows :]]
                rows_waiting = len(waiting[0])
        if rows_waiting:
            add_products(total, np.concatenate(waiting), bits)
        if total.any():
            yield batch_of(schema, {"a": a, "b": b} | {f"c{k}": total[k][a, b] for k in range(LIMBS)})

    if bits == 0:
        return dict.fromkeys(zip(a.tolist(), b.tolist(), strict=True), 0)
    summed = arrow(rows.select(vector), count, kind).groupBy("a", "b").agg(*_sums("c")).collect()
    return {(r["a"], r["b"]): _whole(r, "c") for r in summed}


def principal(n: int, sums: list[int], least: list[int], products: dict[tuple[int, int], int], components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, unit vectors by row, trace) of the covariance with divisor ``n``, falling; its entries are centred as whole numbers and divided last.

    Each vector's entry of the greatest size is positive, so that reruns agree. Eigenvalues that are no more than rounding errors are 0.
    """
    d = len(sums)
    low = [s - n * x for s, x in zip(sums, least, strict=True)]
    v = np.zeros((d, d))
    for (a, b), c in products.items():
        v[a, b] = v[b, a] = (n * c - low[a] * low[b]) / (n * n)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors.T[::-1][:components]
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(1)])
    trace = float(np.trace(v))
    return np.where(values > trace * d * np.finfo(float).eps, values, 0.0), vectors * signs[:, None], trace


def whiten(rows: DataFrame, vector: str = "embedding", carry: list[str] | None = None, components: int = 8) -> DataFrame:
    """Project vectors on their principal components and scale these to variance 1.

    Left out are vectors that are null or hold null or non-finite entries, empty ones, and those whose length isn't the most frequent one (of two
    equally frequent, the longer). Entry c becomes x = floor(1024 c) + 100000 as a long (beyond 2 ** 60, the limit). Returns ``carry`` (all other
    columns by default; a name of a result stands for the result) with n (vectors), deviation (sum of (n x - S)^2, exact: long while its proven
    bound fits, else decimal(38, 0)) and ``whitened`` (an array of (x - S / n) on each component over the root of its eigenvalue), ``explained``
    (an array: eigenvalue over trace) and ``identity_error`` (the largest absolute entry of whitened's measured covariance minus the identity).

    Repeated rows count as often as they occur. A component without variance has null whitened values, and is left out of identity_error; if no
    vector differs from another, explained and identity_error are null. Without a usable vector there are no rows.

    Sums, covariances and the fit pass over all vectors; what a task sends and the driver holds depends on the dimensions alone.
    """
    results = ("n", "deviation", "whitened", "explained", "identity_error")
    carry = [c for c in (carry if carry is not None else [c for c in rows.columns if c != vector]) if c not in results]
    dims, n, sums, least, most = moments(rows, vector)
    values, vectors, trace = principal(n, sums, least, cross_products(rows, vector, dims, least, most), components) if dims else (np.zeros(0), np.zeros((0, 0)), 0.0)
    wide = sum(max(n * h - s, s - n * low) ** 2 for low, h, s in zip(least, most, sums, strict=True)) >= 1 << 63
    kind = rows.select(*carry).schema.add("deviation", T.DecimalType(38, 0) if wide else T.LongType()).add("whitened", T.ArrayType(T.DoubleType()))
    schema = arrow_schema(kind)
    shift, total = np.array(least, np.int64), np.array([s - n * low for s, low in zip(sums, least, strict=True)], object)
    scale = np.divide(1.0, np.sqrt(values), out=np.full(len(values), np.nan), where=values > 0)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import decimal

        for batch in batches:
            at, x = _of_length(batch, batch.num_columns - 1, dims)
            if not len(at) or not dims:
                continue
            # n * x - S, both less n times the least entry: exact in longs where the bound allows it, in Python's integers elsewhere.
            centred = n * (x - shift).astype(object) - total if wide else n * (x - shift) - total.astype(np.int64)
            deviation = (centred * centred).sum(1)
            moved = (centred / n).astype(np.float64) @ vectors.T * scale
            flat = pa.array(moved.ravel(), from_pandas=True)  # nan: a component without variance
            white = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * len(values), pa.int32()), flat)
            kept = {c: batch.column(k).take(pa.array(at)) for k, c in enumerate(carry)}
            yield batch_of(schema, kept | {"deviation": [decimal.Decimal(d) for d in deviation] if wide else deviation, "whitened": white})

    out = cut(arrow(rows.select(*carry, vector), project, kind), "whiten-projected")
    alive = [k for k in range(len(values)) if values[k] > 0]
    w = [F.get("whitened", F.lit(k)) for k in range(len(values))]
    pairs = [(a, b) for a in alive for b in alive if a <= b]
    error = None
    if pairs:
        found = out.agg(*[F.covar_pop(w[a], w[b]).alias(f"c{a}_{b}") for a, b in pairs]).first()
        error = max(abs(found[f"c{a}_{b}"] - (a == b)) for a, b in pairs)
    explained = F.array(*[F.lit(float(v / trace) if trace > 0 else None).cast("double") for v in values]).cast("array<double>")
    return out.select(*carry, F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(table(spark, sf_dir, "embeddings"), carry=["vec_id"])
    each = white.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "value"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "value.whitened", "value.explained", "identity_error")


def brute_force(vectors: list[list[float]], components: int = 8) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(deviations, absolute whitened values, explained) of usable vectors of one length, in Python's integers and numpy."""
    x = [[int(np.floor(np.float64(c) * 1024)) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(v[k] for v in x) for k in range(d)]
    centred = [[n * v[k] - s[k] for k in range(d)] for v in x]
    cov = np.array([[sum(c[a] * c[b] for c in centred) / n**3 for b in range(d)] for a in range(d)])
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    return [sum(c * c for c in v) for v in centred], np.abs(np.array(centred) / n @ basis / np.sqrt(values)), values / np.trace(cov)
