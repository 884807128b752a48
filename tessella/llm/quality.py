"""Quality classifier by compression with dictionaries of good and bad text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import arrow, arrow_schema, batch_of, carried, hash_sample, slices, table, utf8
from tessella.llm.language import fold

LEVEL, BLOCK = 3, 4096


class Model:
    """Two dictionaries, and the logistic curve that turns the difference of compressed sizes into a probability.

    The curve also sees how far the text compresses at all: text that repeats itself compresses to little by either
    dictionary, so that its difference says nothing.
    """

    def __init__(self, bad: bytes, good: bytes):
        self.dictionaries = (bad, good)
        self.centre, self.scale, self.curve = np.zeros(2), np.ones(2), np.zeros(5)

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for raw in self.dictionaries:
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        return out

    def terms(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -6, 6)
        return np.stack([np.ones(len(x)), z[:, 0], z[:, 1], z[:, 1] ** 2, z[:, 0] * z[:, 1]], 1)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        self.centre, self.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        a, self.curve = self.terms(x), np.zeros(5)
        for _ in range(60):  # Newton's method on the ridge-penalised logistic loss
            p = 1 / (1 + np.exp(-np.clip(a @ self.curve, -30, 30)))
            ridge = np.array([1e-6, *[1e-1] * 4])
            self.curve -= np.clip(np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge), a.T @ (p - y) + ridge * self.curve), -2, 2)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.terms(x) @ self.curve, -30, 30)))


def measures(text: bytes | memoryview, compressors: list[zstandard.ZstdCompressor]) -> tuple[float, float]:
    """(bad - good) / (bad + good) of the compressed sizes, by blocks so that the dictionaries matter throughout, and the log of the compressed share; zeros for no text."""
    bad, good = (sum(len(c.compress(text[k : k + BLOCK])) for k in range(0, len(text), BLOCK)) for c in compressors)
    return ((bad - good) / (bad + good), float(np.log((bad + good) / (2 * len(text))))) if bad else (0.0, 0.0)


def fit(rows: list[tuple[str, int]], dictionary_bytes: int = 1 << 18, stretch: int = 1 << 10) -> Model | None:
    """Dictionaries from four fifths of the rows, a stretch of each, and the curve from the rest."""
    if {y for _, y in rows} != {0, 1}:
        return None
    part = [[(t.encode(), y) for k, (t, y) in enumerate(rows) if (k % 5 == 0) == held] for held in (True, False)]
    raw = []
    for label in (0, 1):
        texts = [t for t, y in part[1] if y == label]
        each = max(stretch, dictionary_bytes // max(1, len(texts)))
        raw.append(b"".join(t[max(0, len(t) // 2 - each // 2) :][:each] for t in texts)[-dictionary_bytes:])
    if not raw[0] or not raw[1]:
        return None
    size = min(map(len, raw))
    model = Model(raw[0][-size:], raw[1][-size:])
    compressors = model.compressors()
    rest = part[0] if len({y for _, y in part[0]}) == 2 else part[1]
    model.calibrate(np.array([measures(t, compressors) for t, _ in rest]), np.array([y for _, y in rest], float))
    return model


def learned(docs: DataFrame, labels: DataFrame, rows: Column, id_col: str, text_col: str, label_col: str, per_label: int, most_bytes: int) -> list[tuple[str, int]]:
    """A bounded sample: of each label the ``per_label`` ids with the least hash, of at most ``most_bytes`` of text each."""
    named = labels.filter(rows & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(label_col).alias("_y"), F.max(label_col).alias("_z")).filter("_y = _z")
    chosen = hash_sample(named, "_y", id_col, per_label)
    texts = docs.select(id_col, text_col).filter(F.octet_length(text_col) <= most_bytes).join(F.broadcast(chosen), id_col)
    one = texts.groupBy(F.xxhash64(id_col).alias("h"), F.col(id_col).cast("string").alias("i")).agg(F.min(F.struct(F.col(text_col).alias("t"), F.col("_y").alias("y"))).alias("s"))
    return [(r["s"]["t"], r["s"]["y"]) for r in sorted(one.collect(), key=lambda r: (r["h"], r["i"]))]


def _score(model: Model | None, text_col: str, carry: list[str], schema: pa.Schema, threshold: float) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors() if model else []
        for batch in slices(batches, text_col):
            buf, bounds = utf8(batch.column(batch.schema.get_field_index(text_col)))
            at, view = bounds.tolist(), memoryview(np.ascontiguousarray(buf))
            x = np.array([measures(view[a:b], compressors) for a, b in zip(at, at[1:], strict=False)]) if model else np.zeros((batch.num_rows, 2))
            p = model.score(x) if model else np.full(batch.num_rows, 0.5)
            yield batch_of(schema, {c: batch.column(batch.schema.get_field_index(c)) for c in carry} | {"difference": x[:, 0], "score": p, "predicted": (p >= threshold).astype(np.int32)})

    return score


def quality(docs: DataFrame, labels: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", carry: list[str] | None = None, per_label: int = 1200, most_bytes: int = 1 << 16, threshold: float = 0.3) -> DataFrame:
    """Score every whole text by how much better a dictionary of good text compresses it than one of bad text.

    Learns on the driver from a bounded sample of the labelled rows that ``learn`` allows: at most ``per_label`` of each
    label with at most ``most_bytes`` of text; ids with both labels are left out. Returns ``carry`` with difference, score
    (calibrated, 0 to 1, higher: better) and predicted. Null and empty texts have difference 0 and its score; without labels of both
    kinds every score is 0.5. Repeated rows each get a row, an empty table gives none; a carried column with the name of a result gives way to it.
    Documents are not shuffled.
    """
    carry = carried(docs, carry, text_col, ("difference", "score", "predicted"))
    model = fit(learned(docs, labels, F.lit(True) if learn is None else learn, id_col, text_col, label_col, per_label, most_bytes))
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField("difference", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return arrow(docs.select(*dict.fromkeys([*carry, text_col])), _score(model, text_col, carry, arrow_schema(schema), threshold), schema)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0, carry=["doc_id"])
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "difference")
