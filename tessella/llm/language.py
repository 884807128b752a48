"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import arrow, arrow_schema, batch_of, carried, hash_sample, slices, table, utf8
from tessella.llm.words import mixed

BUCKET_BITS = 16
ORDERS = (3, 4)
FOLDED = np.full(256, 32, np.uint8)
FOLDED[97:123] = FOLDED[65:91] = np.arange(97, 123)
FOLDED[128:] = np.arange(128, 256)


def folded(buf: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the capitals of Latin-1 in lower case; what is neither letter nor beyond ASCII as a blank."""
    out = FOLDED[buf]
    out[1:][(buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)] += 0x20
    return out


def subwords(text: np.ndarray, order: int) -> np.ndarray:
    """The bucket of the ``order`` bytes that begin at each position."""
    value = np.zeros(len(text) - order + 1, np.uint64)
    for k in range(order):
        value = value << np.uint64(8) | text[k : len(text) - order + 1 + k]
    return (mixed(value + np.uint64(order)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def sums(buf: np.ndarray, bounds: np.ndarray, weights: np.ndarray, piece: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of its subwords' weights, and how many there are; subwords of blanks alone don't count."""
    total, count = np.zeros((len(bounds) - 1, weights.shape[1])), np.zeros(len(bounds) - 1, np.int64)
    for lo in range(0, len(buf), piece):
        hi = min(len(buf), lo + piece + max(ORDERS) - 1)
        text = folded(buf[max(lo - 1, 0) : hi])[min(lo, 1) :]  # a capital's first byte may lie in the piece before
        for order in ORDERS:
            n = min(piece, len(buf) - lo, len(text) - order + 1)
            if n <= 0:
                continue
            index = subwords(text, order)[:n]
            ink = np.cumsum(np.concatenate([[0], text != 32]))
            good = ink[order : order + n] > ink[:n]
            first, last = np.searchsorted(bounds, lo, "right") - 1, np.searchsorted(bounds, lo + n, "left")
            edges = np.clip(bounds[first : last + 1] - lo, 0, n)
            for back in range(1, order):
                cross = bounds[1:-1] - back - lo
                good[cross[(cross >= 0) & (cross < n)]] = False
            add = np.zeros((n + 1, weights.shape[1]))
            np.cumsum(np.where(good[:, None], weights[index], 0), axis=0, out=add[1:])
            total[first:last] += np.diff(add[edges], axis=0)
            count[first:last] += np.diff(np.concatenate([[0], np.cumsum(good)])[edges])
    return total, count


class Model:
    """weights: buckets x classes, the product of embeddings and softmax; the last class is text of no learned language. temperature and threshold: calibration."""

    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray):
        self.langs, self.weights, self.bias, self.temperature, self.threshold = langs, weights, bias, 1.0, 0.0

    def logits(self, buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total, count = sums(buf, bounds, self.weights)
        return total / np.maximum(count, 1)[:, None] + self.bias

    def predict(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The likeliest language of each text, and its share; what is left belongs to the other languages and to none."""
        p = softmax(self.logits(buf, bounds) / self.temperature)[:, :-1]
        return p.argmax(1), p.max(1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)


def fit(rows: list[tuple[str, str]], dim: int = 16, epochs: int = 6, rate: float = 4.0, reject: float = 0.001, admit: float = 0.005, seed: int = 5) -> Model | None:
    """Train by stochastic gradient descent on random stretches of the texts; calibrate on a fifth that is held out.

    Stretches with their letters in random order stand for text of no learned language, one for each language's share of the
    texts; so subwords that no language has speak against all of them. The temperature minimises the log loss of held-out texts
    and stretches, disordered ones too. The threshold lies halfway (in logarithms) between the confidence that all but ``admit``
    of the disordered held-out texts stay below and the one that all but ``reject`` of the held-out texts and stretches reach when
    their prediction is right; where these cross, it is the latter.
    """
    rng = np.random.default_rng(seed)
    langs = sorted({lang for _, lang in rows})
    if not langs:
        return None
    data = [(text.encode(), langs.index(lang)) for text, lang in rows if text.strip()]
    order = rng.permutation(len(data))
    held, train = order[: len(data) // 5], order[len(data) // 5 :]
    freq = np.bincount([data[i][1] for i in train], minlength=len(langs)) if len(train) else np.ones(len(langs))
    balance = (len(train) / np.maximum(freq, 1) / len(langs)) ** 0.5
    none, balance = len(langs), np.append(balance, 1.0)
    emb, out, bias = rng.normal(0, 0.1, (1 << BUCKET_BITS, dim)), rng.normal(0, 0.3, (dim, none + 1)), np.zeros(none + 1)

    def stretch(text: bytes) -> bytes:
        size = int(rng.integers(6, 60) if rng.random() < 0.5 else rng.integers(60, 400))
        at = int(rng.integers(0, max(1, len(text) - size)))
        return text[at : at + size]

    def disordered(text: bytes) -> bytes:
        return rng.permutation(np.frombuffer(text.decode(errors="ignore").encode("utf-32-le"), np.uint32)).tobytes().decode("utf-32-le").encode()

    def features(text: bytes) -> np.ndarray:
        t = folded(np.frombuffer(text, np.uint8))
        parts = [subwords(t, k)[(np.lib.stride_tricks.sliding_window_view(t, k) != 32).any(1)] for k in ORDERS if len(t) >= k]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    steps, step = max(1, epochs * len(train)), 0
    for _ in range(epochs):
        for i in rng.permutation(train):
            text, lang = data[i]
            parts = [(stretch(text), lang), (stretch(text), lang)]
            if rng.random() < 2 / none:
                parts.append((disordered(stretch(text)), none))
            for part, kind in parts:
                index = features(part)
                if not len(index):
                    continue
                lr = rate * (1 - step / steps) + 1e-3
                mean = emb[index].mean(0)
                p = softmax((mean @ out + bias)[None])[0]
                p[kind] -= 1
                p *= balance[kind]
                back = out @ p
                out -= lr * 0.1 * np.outer(mean, p)
                bias -= lr * 0.01 * p
                np.add.at(emb, index, -lr * back / len(index) * 4)
            step += 1
    model = Model(langs, (emb @ out).astype(np.float32), bias)
    if len(held):
        odd = [disordered(data[i][0]) for i in held]
        texts = [data[i][0] for i in held] + [stretch(data[i][0]) for i in held] + odd
        truth = np.array([data[i][1] for i in held] * 2 + [none] * len(odd))
        logits = model.logits(*joined(texts))
        loss = {t: -np.log(np.maximum(softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in np.geomspace(0.1, 4, 30)}
        model.temperature = float(min(loss, key=loss.get))
        p = softmax(logits / model.temperature)[:, :-1]
        right, outside = p.max(1)[p.argmax(1) == truth], p.max(1)[truth == none]
        if len(right):
            high = np.quantile(right, reject)
            model.threshold = float(np.sqrt(high * min(high, np.quantile(outside, 1 - admit))))
    return model


def learned(docs: DataFrame, rows: Column, id_col: str, text_col: str, lang_col: str, per_lang: int, most_bytes: int) -> list[tuple[str, str]]:
    """A bounded sample to learn from: of each language the ``per_lang`` rows with the least hash of the id, of at most ``most_bytes`` of text each."""
    named = docs.filter(rows & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    chosen = hash_sample(named, lang_col, id_col, per_lang).select(id_col)
    texts = docs.join(F.broadcast(chosen.distinct()), id_col, "left_semi").filter(rows & F.col(lang_col).isNotNull() & (F.octet_length(text_col) <= most_bytes))
    one = texts.groupBy(F.col(id_col).cast("string").alias("i")).agg(F.min(F.struct(F.col(text_col).alias("t"), F.col(lang_col).alias("l"))).alias("s"))
    return [(r["s"]["t"], r["s"]["l"]) for r in sorted(one.collect(), key=lambda r: r["i"])]


def _predict(model: Model | None, text_col: str, carry: list[str], schema: pa.Schema) -> Callable:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            buf, bounds = utf8(batch.column(batch.schema.get_field_index(text_col)))
            plain = (buf | 0x20) - 97 < 26
            inked, beyond = (np.diff(np.concatenate([[0], np.cumsum(x)])[bounds]) > 0 for x in (plain, buf >= 128))
            for k in np.flatnonzero(beyond & ~inked):
                inked[k] = any(map(str.isalpha, buf[bounds[k] : bounds[k + 1]].tobytes().decode()))
            columns = {c: batch.column(batch.schema.get_field_index(c)) for c in carry}
            if model is None:
                lang, score = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
            else:
                best, score = model.predict(buf, bounds)
                lang, score = np.where(inked, np.array(model.langs, object)[best], "und"), np.where(inked, score, 0.0)
            threshold = model.threshold if model else 1.0
            yield batch_of(schema, columns | {"lang_pred": lang.tolist(), "score": score, "rejected": (score < threshold) | ~inked})

    return predict


def identify(docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", carry: list[str] | None = None, per_lang: int = 600, most_bytes: int = 1 << 16) -> DataFrame:
    """Predict the language of every whole text.

    The model is fitted on the driver from a bounded sample: of the rows that ``learn`` allows, at most ``per_lang`` of each
    language with at most ``most_bytes`` of text each. Only text and language are used, the language only to learn.
    Returns ``carry`` with lang_pred, score (calibrated, 0 to 1) and rejected (below the calibrated threshold). Null texts
    and texts without a letter are ``und`` with score 0 and rejected; so are all texts if nothing could be learned.
    Repeated rows each get a row, an empty table gives none; a carried column with the name of a result gives way to it. No row is
    shuffled; a text is read in pieces, so its length does not matter.
    """
    carry = carried(docs, carry, text_col, ("lang_pred", "score", "rejected"))
    model = fit(learned(docs, F.lit(True) if learn is None else learn, id_col, text_col, lang_col, per_lang, most_bytes))
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return arrow(docs.select(*dict.fromkeys([*carry, text_col])), _predict(model, text_col, carry, arrow_schema(schema)), schema)


def fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, fold("doc_id", 3) != 1, carry=["doc_id"])
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")
