"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import hashlib
import math
import uuid
from array import array
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import arrow, arrow_schema, batch_of, carried, cut, slices, table, utf8
from tessella.llm.words import ALNUM_LOWERED, grams, inside, words

FILTER_BITS = 22
#: A token of no item.
LOST = (1 << 31) - 1


class Automaton:
    """A suffix automaton of many token sequences that knows which windows of which items end in each state.

    States lie in arrays: link, length, and the first token that leads on with where it leads; only further ones are in a dictionary. A window
    of ``window`` tokens is a state of its own, so its items are pairs (state, item) in one sorted array.
    """

    def __init__(self, items: list[tuple[str | None, list[int]]], window: int):
        self.link, self.length, self.token, self.to = (array("i", [x]) for x in (-1, 0, -1, -1))
        self.more: dict[int, int] = {}
        self.fan: dict[int, list[int]] = {}
        for _, tokens in items:
            last = 0
            for t in tokens:
                last = self._extend(last, t)
        link, length = np.frombuffer(self.link, np.int32), np.frombuffer(self.length, np.int32)
        ends = (length >= window) & (length[np.maximum(link, 0)] < window)
        ends[0] = False
        #: Windows of whole items that are shorter: by state, size and items.
        self.short: dict[int, dict[int, set[int]]] = {}
        pairs = []
        for k, (_, tokens) in enumerate(items):
            v = 0
            if 0 < len(tokens) < window:
                for t in tokens:
                    v = self._next(v, t)
                self.short.setdefault(v, {}).setdefault(len(tokens), set()).add(k)
                continue
            found = []
            for i, t in enumerate(tokens):
                v = self._next(v, t)
                while self.length[self.link[v]] >= window:  # the state of the last ``window`` tokens alone
                    v = self.link[v]
                if i + 1 >= window:
                    found.append(v)
            pairs.append(np.unique(np.array(found, np.int64)) << 32 | k)
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *pairs]))
        self.names, self.window = [name for name, _ in items], window
        #: The nearest state up the suffix links, itself included, at which a window ends.
        ends[list(self.short)] = True
        up = np.where(ends, np.arange(len(ends)), -1).astype(np.int32)
        up[0] = 0
        todo = np.flatnonzero(up < 0)
        above = link.copy()
        while len(todo):  # links are followed by ever longer jumps
            up[todo] = up[above[todo]]
            above[todo] = above[above[todo]]
            todo = todo[up[todo] < 0]
        self.up, self.ends = array("i", up.tobytes()), ends
        self._known: dict[int, list[tuple[int, frozenset]]] = {}

    def _next(self, v: int, t: int) -> int:
        return self.to[v] if self.token[v] == t else self.more.get(v << 32 | t, -1)

    def _lead(self, v: int, t: int, to: int) -> None:
        if self.token[v] in (-1, t):
            self.token[v], self.to[v] = t, to
        else:
            if v << 32 | t not in self.more:
                self.fan.setdefault(v, []).append(t)
            self.more[v << 32 | t] = to

    def _state(self, length: int) -> int:
        for x, value in ((self.link, 0), (self.length, length), (self.token, -1), (self.to, -1)):
            x.append(value)
        return len(self.link) - 1

    def _split(self, p: int, q: int, t: int) -> int:
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1)
        self.token[copy], self.to[copy], self.link[copy] = self.token[q], self.to[q], self.link[q]
        if q in self.fan:
            self.fan[copy] = list(self.fan[q])
            for x in self.fan[q]:
                self.more[copy << 32 | x] = self.more[q << 32 | x]
        self.link[q] = copy
        while p >= 0 and self._next(p, t) == q:
            self._lead(p, t, copy)
            p = self.link[p]
        return copy

    def _extend(self, last: int, t: int) -> int:
        if (q := self._next(last, t)) >= 0:
            return self._split(last, q, t)
        new, p = self._state(self.length[last] + 1), last
        while p >= 0 and self._next(p, t) < 0:
            self._lead(p, t, new)
            p = self.link[p]
        self.link[new] = 0 if p < 0 else self._split(p, self._next(p, t), t)
        return new

    def windows(self, v: int) -> list[tuple[int, frozenset]]:
        """(size, items) of the windows that end in a state."""
        if v not in self._known:
            a, b = np.searchsorted(self.pairs, [v << 32, v + 1 << 32])
            full = [(self.window, frozenset(self.names[k] for k in (self.pairs[a:b] & 0xFFFFFFFF).tolist()))] if b > a else []
            self._known[v] = full + [(size, frozenset(self.names[k] for k in who)) for size, who in self.short.get(v, {}).items()]
        return self._known[v]

    def hits(self, tokens: list[int]) -> Iterator[tuple[int, int, frozenset]]:
        """(first token, end, items) of every window in a stream of tokens."""
        v = matched = 0
        for i, t in enumerate(tokens):
            w = self._next(v, t)
            while v and w < 0:
                v = self.link[v]
                matched = self.length[v]
                w = self._next(v, t)
            if w >= 0:
                v, matched = w, matched + 1
            u = self.up[v]
            while u:
                for size, items in self.windows(u):
                    if size <= matched:
                        yield i + 1 - size, i + 1, items
                u = self.up[self.link[u]]


class Scanner:
    """The automaton behind a filter of hashed grams: only stretches whose grams all occur in items are streamed."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        data = pa.array([text for _, text in items], pa.large_string())
        _, _, hashes, at = words(*utf8(data), ALNUM_LOWERED)
        vocabulary, ids = np.unique(hashes, return_inverse=True)
        sequences = [(item, ids[at[k] : at[k + 1]].tolist()) for k, (item, _) in enumerate(items)]
        sizes = [min(len(s), window) for _, s in sequences if s]
        self.least = min(sizes, default=0)
        self.gram = min(self.least, 4)
        self.vocabulary, self.automaton = vocabulary, Automaton(sequences, window)
        self.known = np.zeros(1 << FILTER_BITS, bool)
        if self.gram:
            found = grams(hashes, self.gram)
            self.known[found[inside(at, self.gram, len(found))] >> np.uint64(64 - FILTER_BITS)] = True

    def __call__(self, hashes: np.ndarray, at: np.ndarray) -> dict[int, tuple[list, set]]:
        """For each text with hits: [first word, end) of its windows, and the items."""
        out: dict[int, tuple[list, set]] = {}
        if not self.gram or len(hashes) < self.least:
            return out
        found = grams(hashes, self.gram)
        known = self.known[found >> np.uint64(64 - FILTER_BITS)] & inside(at, self.gram, len(found))
        edge = np.zeros(len(known) + 1, bool)  # grams of one word of two texts stand next to each other
        edge[at[at <= len(known)]] = True
        first = np.flatnonzero(known & (edge[:-1] | ~np.concatenate([[False], known[:-1]])))
        end = np.flatnonzero(known & (edge[1:] | ~np.concatenate([known[1:], [False]]))) + 1
        long = end - first >= self.least - self.gram + 1
        for a, b in zip(first[long].tolist(), (end[long] + self.gram - 1).tolist(), strict=True):
            doc = int(np.searchsorted(at, a, "right")) - 1
            place = np.searchsorted(self.vocabulary, hashes[a:b])
            place[place == len(self.vocabulary)] = 0
            tokens = np.where(self.vocabulary[place] == hashes[a:b], place, LOST).tolist()
            for lo, hi, items in self.automaton.hits(tokens):
                spans, names = out.setdefault(doc, ([], set()))
                spans.append((a - int(at[doc]) + lo, a - int(at[doc]) + hi))
                names.update(items)
        return out


_built: dict[tuple, Scanner] = {}


def scanner(key: str, items: list[tuple[str | None, str]], window: int) -> Scanner:
    """The scanner of a block of items, built once a worker and kept for its further tasks."""
    if key not in _built:
        _built.clear()
        _built[key] = Scanner(items, window)
    return _built[key]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _scan(key: str, items: list[tuple[str | None, str]], window: int, text_col: str, carry: list[str], schema: pa.Schema, last: bool, percent: int, clean: bool) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = scanner(key, items, window)
        for batch in slices(batches, text_col):
            at_text = batch.schema.get_field_index(text_col)
            buf, bounds = utf8(batch.column(at_text))
            start, end, hashes, at = words(buf, bounds, ALNUM_LOWERED)
            found = search(hashes, at)
            if not last:
                hit = sorted(found)
                columns = {c: batch.column(batch.schema.get_field_index(c)).take(pa.array(hit, pa.int64())) for c in carry}
                yield batch_of(schema, columns | {"_spans": [[x for s in merged(found[k][0]) for x in s] for k in hit], "_items": [sorted(found[k][1] - {None}) for k in hit]})
                continue
            spans = [merged(list(map(tuple, np.reshape(x or [], (-1, 2)).tolist()))) for x in batch.column(batch.schema.get_field_index("_spans")).to_pylist()]
            names = [set(x or ()) for x in batch.column(batch.schema.get_field_index("_items")).to_pylist()]
            for k, (more, who) in found.items():
                spans[k] = merged(spans[k] + more)
                names[k] |= who - {None}
            columns = {c: batch.column(batch.schema.get_field_index(c)) for c in carry}
            columns |= {"_spans": [[x for s in y for x in s] for y in spans], "_items": [sorted(x) for x in names]}
            n_words, n_hit = np.diff(at), np.array([sum(b - a for a, b in s) for s in spans], np.int64)
            bad = (n_hit > 0) & (100 * n_hit >= percent * n_words)
            columns |= {"n_words": n_words, "n_hit": n_hit, "contaminated": bad, "longest": np.array([max((b - a for a, b in s), default=0) for s in spans], np.int64)}
            if clean:
                texts = batch.column(at_text).to_pylist()
                for k in np.flatnonzero(bad).tolist():
                    raw, kept, here = buf[bounds[k] : bounds[k + 1]].tobytes(), [], 0
                    for a, b in spans[k]:
                        kept.append(raw[here : start[at[k] + a] - bounds[k]])
                        here = int(end[at[k] + b - 1] - bounds[k])
                    texts[k] = b"".join([*kept, raw[here:]]).decode()
                columns["clean_text"] = texts
            yield batch_of(schema, columns)

    return scan


def decontaminate(docs: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text", text_col: str = "text", carry: list[str] | None = None, window: int = 13, percent: int = 5, clean: bool = False, block_mb: float = 8, broadcast_mb: int = 64) -> DataFrame:
    """Find the words of ``docs`` that lie in a window of ``window`` item words (or in a whole item of fewer).

    Returns ``carry`` with n_words, n_hit, longest (words of the longest stretch of hits), items (ids as strings),
    contaminated (hits, and at least ``percent`` in a hundred words hit) and, if ``clean``, clean_text: the text without
    its hit stretches where contaminated, else as it was. Null and empty texts have no words and are clean; items
    without words match nothing; repeated items count by id, and those with a null id make hits but are not listed. Repeated documents each get a row.
    No items, or no documents, gives no hits. A carried column with the name of a result gives way to it.

    The items are the stated query set. They go out in blocks of at most about ``block_mb`` of text, one pass over the
    documents a block, so that an automaton's size is bounded whatever the number of items (some 45 bytes a byte of items, built once a worker). With several blocks
    the rows are written once with numbers, and each pass but the last writes the spans and items of the rows with hits alone, so a task holds one automaton; these hits meet the rows again in the last pass.
    Documents are not shuffled unless the hits of the earlier blocks are more than ``broadcast_mb`` (counted).
    """
    carry = carried(docs, carry, text_col, ("n_words", "n_hit", "longest", "items", "contaminated", "clean_text"))
    items = items.select(F.col(item_id).cast("string").alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / (block_mb * (1 << 20))))
    found = [T.StructField("_spans", T.ArrayType(T.IntegerType())), T.StructField("_items", T.ArrayType(T.StringType()))]

    def scanned(df: DataFrame, b: int, keep: list[str], results: list[T.StructField], last: bool) -> DataFrame:
        block = [(r["id"], r["t"]) for r in items.filter(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == b).collect()]
        schema = T.StructType([*(df.schema[c] for c in keep), *found, *results])
        return arrow(df, _scan(uuid.uuid4().hex, block, window, text_col, keep, arrow_schema(schema), last, percent, clean), schema)

    df = docs.select(*dict.fromkeys([*carry, text_col]), *(F.lit(None).cast(f.dataType).alias(f.name) for f in found))
    if blocks > 1:
        rows = cut(docs.select(*dict.fromkeys([*carry, text_col]), F.monotonically_increasing_id().alias("_row")), "decontamination-rows")
        hits = [cut(scanned(rows.select("_row", text_col), b, ["_row"], [], False), "decontamination-hits") for b in range(blocks - 1)]
        together = [F.flatten(F.collect_list(f.name)).alias(f.name) for f in found]
        earlier = cut(reduce(DataFrame.unionByName, hits).groupBy("_row").agg(*together), "decontamination-earlier")
        size = earlier.agg(F.coalesce(F.sum(64 + 4 * F.size("_spans") + F.octet_length(F.concat_ws("", "_items")) + 16 * F.size("_items")), F.lit(0))).first()[0]
        df = rows.join(F.broadcast(earlier) if size <= broadcast_mb << 20 else earlier, "_row", "left")
    results = [T.StructField(c, T.LongType()) for c in ("n_words", "n_hit", "longest")] + [T.StructField("contaminated", T.BooleanType())] + [T.StructField("clean_text", T.StringType())] * clean
    df = scanned(df, blocks - 1, carry, results, True)
    return df.withColumnRenamed("_items", "items").drop("_spans")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), "contaminated")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bi AS (SELECT item, ws, least(len(ws), 13) AS size, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item, size, array_to_string(ws[i:i + size - 1], ' ') AS g FROM bi),
di AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
dw AS (SELECT doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS g FROM di, (SELECT DISTINCT size FROM bw) WHERE i + size - 1 <= len(ws)),
h AS (SELECT doc_id, i, size, item FROM dw JOIN bw USING (size, g)),
n AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def brute_force(docs: list[tuple], items: list[tuple], window: int = 13) -> list[tuple]:
    """The contract, window by window: for tests on small tables."""
    import re

    split = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), s or ""))
    known: dict[tuple, set] = {}
    for item, text in items:
        w = split(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            known.setdefault(tuple(w[k : k + window]), set()).add(item)
    sizes, out = {len(k) for k in known}, []
    for doc, text in docs:
        w = split(text)
        hit, who = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if x := known.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    who |= {str(i) for i in x if i is not None}
        out.append((doc, len(w), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out
