"""Substring deduplication: seeds at winnowed anchors, extended both ways to maximal repeats."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import arrow, arrow_schema, batch_of, carried, slices, table, utf8
from tessella.llm.words import AS_WRITTEN, grams, inside, mixed, rows_of, words

#: Words of an anchor. Every window of ``window`` words has window - ANCHOR + 1 of them, and is filed under the least.
ANCHOR = 5
#: Bytes of seeds or texts of a task.
TASK = 64 << 20
SEED = np.dtype([("anchor", "<u8"), ("context", "<u8"), ("doc", "<i8"), ("word", "<u4")])


def anchored(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window its anchor, the least of its grams (winnowing: a sequence of words always has the same), and its own hash.

    The window's hash takes in the anchor's whole context, so two windows that agree in both are the anchor's match
    extended left and right to ``window`` words.
    """
    if len(hashes) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    least = grams(hashes, ANCHOR)
    width, span = window - ANCHOR + 1, 1
    while span < width:  # minima of ever wider spans
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    return least, grams(hashes, window)


def first_seen(anchor: np.ndarray, context: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal windows stand together by document, and for each place in it the smallest document of its window."""
    order = np.lexsort((doc, mixed(anchor ^ mixed(context))))
    a, c = anchor[order], context[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
    return order, doc[order][np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else doc


def runs_of(row: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of stretches of consecutive windows; both arrays sorted."""
    if not len(row):
        return row, word, word
    turn = np.flatnonzero((row[1:] != row[:-1]) | (word[1:] != word[:-1] + 1))
    first, last = np.concatenate([[0], turn + 1]), np.concatenate([turn, [len(row) - 1]])
    return row[first], word[first], word[last]


def _seeds(text_col: str, window: int, parts: int, schema: pa.Schema) -> Callable:
    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows to compare with other batches, packed by part; and the stretches whose windows occur earlier in this batch."""
        for batch in slices(batches, text_col, 4 << 20):
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            buf, bounds = utf8(batch.column(batch.schema.get_field_index(text_col)))
            _, _, hashes, at = words(buf, bounds, AS_WRITTEN)
            anchor, context = anchored(hashes, window)
            keep = np.flatnonzero(inside(at, window, len(anchor)))
            row = rows_of(at)[keep]
            anchor, context, doc, word = anchor[keep], context[keep], ids[row], keep - at[row]
            order, first = first_seen(anchor, context, doc)
            # Whatever has a smaller document here is a repeat already; the smallest alone asks the other batches.
            again = doc[order] > first
            repeat = np.sort(order[again])
            r, lo, hi = runs_of(row[repeat], word[repeat])
            yield batch_of(schema, {"part": ids[r] % parts, "doc": ids[r], "first": lo, "last": hi, "seeds": [None] * len(r)})
            ask = order[~again]
            out = np.zeros(len(ask), SEED)
            out["anchor"], out["context"], out["doc"], out["word"] = anchor[ask], context[ask], doc[ask], word[ask]
            part = mixed(out["anchor"]) % np.uint64(parts)
            out = out[np.lexsort((out["word"], out["doc"], part))]
            edges = np.searchsorted(np.sort(part), np.arange(parts + 1, dtype=np.uint64))
            filled = [p for p in range(parts) if edges[p] < edges[p + 1]]
            yield batch_of(schema, {"part": filled, "doc": [None] * len(filled), "first": [None] * len(filled), "last": [None] * len(filled), "seeds": [packed(out[edges[p] : edges[p + 1]]) for p in filled]})

    return seeds


def narrow(values: np.ndarray) -> bytes:
    """Unsigned integers by as many bytes as the largest needs; the first byte tells."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(values) or int(values.max()) >> 8 * w == 0)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def five(values: np.ndarray) -> bytes:
    return (values >> np.uint64(24)).astype("<u8").view("<u1").reshape(-1, 8)[:, :5].tobytes()


def packed(seeds: np.ndarray) -> bytes:
    """Seeds of one part, sorted by document and word: the anchor once for the windows that share one, 40 bits of each hash."""
    turn = np.ones(len(seeds), bool)
    turn[1:] = (seeds["doc"][1:] != seeds["doc"][:-1]) | (seeds["anchor"][1:] != seeds["anchor"][:-1]) | (seeds["word"][1:] != seeds["word"][:-1] + 1)
    head = np.flatnonzero(turn)
    size = np.diff(np.concatenate([head, [len(seeds)]]))
    doc = seeds["doc"][head]
    new = np.ones(len(head), bool)
    new[1:] = doc[1:] != doc[:-1]
    per = np.diff(np.concatenate([np.flatnonzero(new), [len(head)]]))
    base = int(doc.min())
    counts = np.array([len(per), len(head), len(seeds), base], "<i8").tobytes()
    return b"".join([counts, narrow(doc[new] - base), narrow(per), narrow(seeds["word"][head]), narrow(size), five(seeds["anchor"][head]), five(seeds["context"])])


def unpacked(raw: bytes) -> np.ndarray:
    docs, heads, n, base = (int(x) for x in np.frombuffer(raw, "<i8", 4))
    at = 32

    def take(count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, f"<u{raw[at]}", count, at + 1)
        at += 1 + out.nbytes
        return out

    def take_five(count: int) -> np.ndarray:
        nonlocal at
        out = np.zeros((count, 8), np.uint8)
        out[:, :5] = np.frombuffer(raw, np.uint8, 5 * count, at).reshape(-1, 5)
        at += 5 * count
        return out.view("<u8")[:, 0]

    doc, per, word, size = take(docs), take(docs), take(heads), take(heads)
    anchor, context = take_five(heads), take_five(n)
    out = np.zeros(n, SEED)
    out["doc"] = np.repeat(np.repeat(doc.astype(np.int64) + base, per), size)
    out["anchor"], out["context"] = np.repeat(anchor, size), context
    out["word"] = np.repeat(word, size) + np.arange(n) - np.repeat(np.cumsum(size, dtype=np.int64) - size, size)
    return out


def _joined(schema: pa.Schema) -> Callable:
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The stretches of windows that a smaller document has too; parts come one after the other, settled stretches pass through."""

        def settle(blobs: list[bytes]) -> pa.RecordBatch:
            seeds = np.concatenate([unpacked(b) for b in blobs])
            order, first = first_seen(seeds["anchor"], seeds["context"], seeds["doc"])
            again = seeds[order[seeds["doc"][order] > first]]
            again = again[np.lexsort((again["word"], again["doc"]))]
            doc, lo, hi = runs_of(again["doc"], again["word"].astype(np.int64))
            return batch_of(schema, {"doc": doc, "first": lo, "last": hi})

        held, part = [], None
        for batch in batches:
            asks = batch.filter(pc.is_valid(batch.column(4)))
            if asks.num_rows < batch.num_rows:
                yield batch.filter(pc.is_null(batch.column(4))).select(["doc", "first", "last"])
            for p, blob in zip(asks.column(0).to_pylist(), asks.column(4).to_pylist(), strict=True):
                if p != part and held:
                    yield settle(held)
                    held = []
                part = p
                held.append(blob)
        if held:
            yield settle(held)

    return join


def _remove(text_col: str, carry: list[str], window: int, keep_text: bool, schema: pa.Schema) -> Callable:
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            at_spans = batch.schema.get_field_index("_spans")
            buf, bounds = utf8(batch.column(batch.schema.get_field_index(text_col)))
            start, end, _, at = words(buf, bounds, AS_WRITTEN)
            spans, edges = batch.column(at_spans), np.zeros(len(start) + 1, np.int64)
            flat = spans.flatten()
            lengths = np.array([0 if x is None else x for x in pc.list_value_length(spans).to_pylist()], np.int64)
            base = np.repeat(at[:-1], lengths)
            first, last = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            np.add.at(edges, base + first, 1)
            np.add.at(edges, base + last + window, -1)
            gone = np.cumsum(edges[:-1]) > 0
            n_removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[at])
            tops, texts = [], []
            for k in range(batch.num_rows):
                raw = buf[bounds[k] : bounds[k + 1]].tobytes().split()
                if n_removed[k]:
                    raw = [w for w, g in zip(raw, gone[at[k] : at[k + 1]].tolist(), strict=True) if not g]
                joined = b" ".join(raw)
                tops.append(hashlib.sha256(joined).hexdigest())
                texts.append(joined.decode() if keep_text else None)
            columns = {c: batch.column(batch.schema.get_field_index(c)) for c in carry} | {"n_words": np.diff(at), "n_removed": n_removed, "kept_sha256": tops}
            yield batch_of(schema, columns | ({"kept_text": texts} if keep_text else {}))

    return remove


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, window: int = 13, keep_text: bool = False, parts: int | None = None) -> DataFrame:
    """Remove from every text the words of each run of ``window`` or more words that also begins in a text with a smaller id.

    Windows are judged on the input. Each is filed under its winnowed anchor (the least hash of its five-word grams), so
    the anchors are the seeds on which documents meet; a seed's context hashes extend the match to whole windows both ways,
    and runs of matching windows are the maximal repeats. Within a batch only the smallest document that has a window asks the
    other batches for it: the others are repeats whatever the answer is, so a passage that a third of all documents share costs one seed a
    batch. Seeds travel packed, by part of the anchors' hash; texts are shuffled once, by id, to meet their repeats.

    Windows are compared by 40 bits of anchor and 40 of context, within a part of the anchors. Ids are whole numbers; others fail under ANSI rules. Null and empty texts have no words; texts below ``window``
    words lose none; repeated ids count as one document, so that they do not delete each other. Rows with a null id ask and answer nothing and are kept whole.
    An empty table gives none. Returns ``carry`` with n_words, n_removed, kept_sha256 and, if ``keep_text``, kept_text.
    """
    spark = docs.sparkSession
    carry = carried(docs, carry, text_col, ("n_words", "n_removed", "kept_sha256", "kept_text"))
    # Packed seeds take up to 1.7 times the texts' bytes; parts and partitions follow what is counted, beyond those of the session.
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-17 * total // (10 * TASK)))
    parts = parts or 2 * width
    texts = docs.filter(F.col(id_col).isNotNull() & (F.octet_length(text_col) >= 2 * window - 1)).select(F.col(id_col).cast("bigint").alias("_doc"), F.col(text_col).alias("_text"))
    seed_schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("doc", T.LongType()), T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("seeds", T.BinaryType())])
    run_schema = T.StructType(seed_schema.fields[1:4])
    seeds = arrow(texts, _seeds("_text", window, parts, arrow_schema(seed_schema)), seed_schema)
    runs = arrow(seeds.repartition(width, "part").sortWithinPartitions("part"), _joined(arrow_schema(run_schema)), run_schema)
    spans = runs.repartition(width, "doc").groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("_spans"))
    rows = docs.select(*dict.fromkeys([*carry, text_col]), F.col(id_col).cast("bigint").alias("_doc")).repartition(width, "_doc").join(spans.withColumnRenamed("doc", "_doc"), "_doc", "left")
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()), *([T.StructField("kept_text", T.StringType())] if keep_text else [])])
    return arrow(rows.select(*dict.fromkeys([*carry, text_col]), "_spans"), _remove(text_col, carry, window, keep_text, arrow_schema(schema)), schema)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])


OP5_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM i),
m AS (SELECT g, min(doc_id) AS m FROM g GROUP BY g),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM g JOIN m USING (g) WHERE m < doc_id),
k AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w),
s AS (SELECT k.doc_id, count(r.j) AS n_removed, string_agg(word, ' ' ORDER BY k.j) FILTER (r.j IS NULL) AS kept FROM k LEFT JOIN r ON k.doc_id = r.doc_id AND k.j = r.j GROUP BY k.doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN s USING (doc_id)
"""


def brute_force(docs: list[tuple], window: int = 13) -> list[tuple]:
    """The contract, window by window: for tests on small tables."""
    import re

    split = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in docs}
    first: dict[tuple, int] = {}
    for d, w in split.items():
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in split.items():
        gone = {j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < d for j in range(k, k + window)}
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    return out
