"""N-gram Jaccard join by universe partition: segments, one-deletion neighbourhoods, exact verification."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import arrow, arrow_schema, batch_of, bounded, cut, slices, table, text_or_empty, utf8
from tessella.llm.words import LOWERED, grams, inside, mixed, rows_of, words
from tessella.operators.graph import components

SALT = 0xA0761D6478BD642F
RATIO = 1.35
#: Bytes of a shingle's hash in a signature and in a set that is sent to be compared.
SHORT = 5


def shingles(buf: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and hashes of the distinct shingles, sorted by both, and how many each text has."""
    _, _, hashes, at = words(buf, bounds, LOWERED)
    found = grams(hashes, k)
    keep = np.flatnonzero(inside(at, k, len(found)))
    rows, out = [rows_of(at)[keep]], [found[keep]]
    count = np.diff(at)
    for c in range(1, k):  # fewer words than k: the whole sequence is the one shingle
        short = np.flatnonzero(count == c)
        if len(short):
            rows.append(short)
            out.append(mixed(grams(hashes, c)[at[short]] + np.uint64(c)))
    row, h = np.concatenate(rows), np.concatenate(out)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    row, h = row[new], h[new]
    return row, h, np.bincount(row, minlength=len(bounds) - 1)


def fingerprints(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(h + np.uint64(SALT)))])
    edges = np.concatenate([[0], np.cumsum(n)])
    return mixed((total[edges[1:]] - total[edges[:-1]]) ^ mixed(n.astype(np.uint64)))


@lru_cache(1 << 12)
def bands(percent: int, upto: int) -> np.ndarray:
    """Least size of each size band; a set's partners are in its own band and its neighbours'."""
    out, ratio = [1], max(RATIO, 102 / percent)
    while out[-1] <= upto:
        out.append(max(out[-1] + 1, int(out[-1] * ratio)))
    return np.array(out)


@lru_cache(1 << 12)
def allocation(percent: int, largest: int, common: float = 0.1, weight: float = 1e4) -> tuple[int, int, int, int]:
    """(exact segments, one-deletion segments, slack, most differences) for pairs whose larger set has at most ``largest`` shingles.

    A pair of that similarity differs in at most ``most`` shingles, so of segments that tolerate 0 or 1 differences, counted 1
    and 2, most + 1 suffice for one to be within its tolerance; the slack makes up for segments that are empty on both sides. The cost of a choice is the signatures it writes
    plus ``weight`` times the chance that unrelated sets agree in one, if they share a shingle with chance ``common``.
    """
    most = 2 * (100 - percent) * largest // (100 + percent)
    slack = 4 if most >= 8 else 2 if most >= 2 else 1
    need, best = most + 1 + slack, None
    for double in sorted({*range(0, min(need // 2, 8) + 1), need // 8, need // 4, need // 2}):
        exact = need - 2 * double
        size = largest / (exact + double)
        cost = exact + double * (1 + size) + weight * (exact * common**size + double * (1 + 2 * size) * common ** max(size - 1, 0))
        if best is None or cost < best[0]:
            best = (cost, exact, double)
    return best[1], best[2], slack, most


def signatures(h: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) for each segment subset and one-deletion neighbour, in the set's own band and, where it may be the smaller partner, in the next."""
    sigs, sets = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if not len(n):
        return sigs[0], sets[0]
    low = bands(percent, int(n.max()) + 1)
    own = np.searchsorted(low, n, "right") - 1
    edges = np.concatenate([[0], np.cumsum(n)])
    value = mixed(h + np.uint64(SALT))
    for up in (0, 1):
        band = own + up
        low = bands(percent, int(n.max() * 2) + 4)
        for b in np.unique(band):
            member = np.flatnonzero((band == b) & (n > 0) & ((up == 0) | (100 * n >= percent * low[b])))
            exact, double, slack, most = allocation(percent, int(low[b + 1]) - 1)
            if not most or not len(member):
                continue
            m = exact + double
            size = n[member]
            local = np.repeat(np.arange(len(member)), size)
            index = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(edges[member], size)
            v = value[index]
            segment = (mixed(v ^ np.uint64(b + 1)) % np.uint64(m)).astype(np.int64)
            cell = local * m + segment
            order = np.argsort(cell, kind="stable")
            filled, first, count = np.unique(cell[order], return_index=True, return_counts=True)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(v[order])])
            total = total[first + count] - total[first]
            salt = mixed(np.arange(m, dtype=np.uint64) + np.uint64(int(b) << 32))
            sigs.append(mixed(total + salt[filled % m]))
            sets.append(member[filled // m])
            if double:
                two = filled % m >= exact
                inner = np.repeat(two, count)
                left = np.repeat(total, count)[inner] - v[order][inner]
                where = np.repeat(filled, count)[inner]
                big = np.repeat(count, count)[inner] > 1
                sigs.append(mixed(left[big] + salt[where[big] % m]))
                sets.append(member[where[big] // m])
            # Empty segments tell nothing, unless a set has more of them than the slack covers.
            sizes = np.zeros(len(member) * m, np.int32)
            sizes[filled] = count
            hollow = sizes.reshape(len(member), m) <= np.where(np.arange(m) < exact, 0, 1)
            lost = hollow @ np.where(np.arange(m) < exact, 1, 2)
            poor, empty = np.nonzero(hollow & (lost > slack)[:, None])
            sigs.append(mixed(salt[empty]))
            sets.append(member[poor])
    return np.concatenate(sigs), np.concatenate(sets)


def short(values: np.ndarray) -> bytes:
    return (values >> np.uint64(64 - 8 * SHORT)).astype("<u8").view("<u1").reshape(-1, 8)[:, :SHORT].tobytes()


def long(raw: bytes | pa.Buffer, count: int, at: int = 0) -> np.ndarray:
    out = np.zeros((count, 8), np.uint8)
    out[:, :SHORT] = np.frombuffer(raw, np.uint8, SHORT * count, at).reshape(-1, SHORT)
    return out.view("<u8")[:, 0]


def by_part(key: np.ndarray, parts: int, pack: Callable[[np.ndarray], bytes]) -> tuple[list[int], list[bytes]]:
    """The rows of each part, packed."""
    part = key % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    filled = [p for p in range(parts) if edges[p] < edges[p + 1]]
    return filled, [pack(order[edges[p] : edges[p + 1]]) for p in filled]


def each_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.Buffer], list[pa.RecordBatch]]]:
    """The blobs of one part after the other, from batches sorted by part; rows without a blob as they come."""
    held, part = [], None
    for batch in batches:
        has = pc.is_valid(batch.column("blob"))
        asks, others = batch.filter(has), batch.filter(pc.invert(has))
        if others.num_rows:
            yield [], [others]
        for p, blob in zip(asks.column("part").to_pylist(), asks.column("blob"), strict=True):
            if p != part and held:
                yield held, []
                held = []
            part = p
            held.append(blob.as_buffer())
    if held:
        yield held, []


ROW = "part bigint, key bigint, n bigint, fp bigint, blob binary"
FOUND = "key bigint, n bigint, fp bigint, x bigint, p bigint, shared bigint, many boolean"


def _index(k: int, percent: int, parts: int, schema: pa.Schema) -> Callable:
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 4 << 20):
            keys = batch.column("_key").to_numpy(zero_copy_only=False)
            _, h, n = shingles(*utf8(batch.column("_text")), k)
            fp = fingerprints(h, n)
            none = [None] * len(n)
            yield batch_of(schema, {"part": (keys % parts).astype(np.int64), "key": keys, "n": n, "fp": fp.view(np.int64), "blob": none})
            # A set that is here twice is filed once.
            _, once = np.unique(fp, return_index=True)
            once = np.sort(once[n[once] > 0])
            keep = np.zeros(len(n), bool)
            keep[once] = True
            sig, owner = signatures(h[np.repeat(keep, n)], n[keep], percent)
            node = fp[once][owner]
            filled, blobs = by_part(sig, parts, lambda i, sig=sig, node=node: short(sig[i]) + node[i].tobytes())
            none = [None] * len(filled)
            yield batch_of(schema, {"part": filled, "key": none, "n": none, "fp": none, "blob": blobs})

    return index


def groups(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, node) sorted, and for each the first place of its key and how many nodes the key has; keys with one node are left out."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node = key[new], node[new]
    _, start, count = np.unique(key, return_index=True, return_counts=True)
    first, many = np.repeat(start, count), np.repeat(count, count)
    keep = many > 1
    place = np.cumsum(keep) - 1
    return node[keep], place[first[keep]], many[keep]


def _stars(schema: pa.Schema) -> Callable:
    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every set of a signature's bucket with the bucket's least set, counted; not all pairs."""
        for blobs, others in each_part(batches):
            for rows in others:
                none = [None] * rows.num_rows
                yield batch_of(schema, {"key": rows.column("key"), "n": rows.column("n"), "fp": rows.column("fp"), "x": none, "p": none, "shared": none, "many": none})
            if not blobs:
                continue
            counts = [b.size // (SHORT + 8) for b in blobs]
            key = np.concatenate([long(b, c) for b, c in zip(blobs, counts, strict=True)])
            node = np.concatenate([np.frombuffer(b, "<i8", c, SHORT * c) for b, c in zip(blobs, counts, strict=True)])
            node, first, many = groups(key, node)
            pivot = node[first]
            spoke = node != pivot
            pair = np.stack([node[spoke], pivot[spoke]], 1)
            order = np.lexsort((pair[:, 0], pair[:, 1]))
            pair, big = pair[order], many[spoke][order] > 2
            new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]).any(1)])) if len(pair) else np.zeros(0, np.int64)
            shared = np.diff(np.concatenate([new, [len(pair)]]))
            big = np.maximum.reduceat(big, new) if len(new) else big
            none = [None] * len(new)
            yield batch_of(schema, {"key": none, "n": none, "fp": none, "x": pair[new, 0], "p": pair[new, 1], "shared": shared, "many": big})

    return stars


def _compare(k: int, percent: int, schema: pa.Schema) -> Callable:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by group, its pivot first: how many shingles each other row has in common with it."""
        group, pivot = None, np.zeros(0, np.uint64)
        for batch in batches:
            x, p, ok = [], [], []
            for g, fp, pv, raw in zip(*(batch.column(c).to_pylist() for c in ("_group", "_fp", "_pivot", "_set")), strict=True):
                own = long(raw, len(raw) // SHORT)
                if g != group:
                    group, pivot = g, own
                if fp == pv:
                    continue
                both = len(np.intersect1d(own, pivot, assume_unique=True))
                x.append(fp)
                p.append(pv)
                ok.append(100 * both >= percent * (len(own) + len(pivot) - both))
            yield batch_of(schema, {"x": x, "p": p, "linked": ok})

    return compare


def _sets(k: int, carry: list[str], schema: pa.Schema) -> Callable:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 4 << 20):
            _, h, n = shingles(*utf8(batch.column("_text")), k)
            edges = np.concatenate([[0], np.cumsum(n)])
            yield batch_of(schema, {c: batch.column(c) for c in carry} | {"_set": [short(np.sort(h[a:b])) for a, b in zip(edges, edges[1:], strict=False)]})

    return sets


class Texts:
    """The sets of some documents, made again from their texts."""

    def __init__(self, texts: DataFrame, reps: DataFrame, k: int, percent: int, bound_mb: int):
        self.texts, self.reps, self.k, self.percent, self.bound_mb = texts, reps, k, percent, bound_mb

    def of(self, wanted: DataFrame, carry: dict[str, T.DataType]) -> DataFrame:
        """``wanted`` (_fp and ``carry``) with the set of each _fp; the text goes by once, whatever the number of wanted rows of a document."""
        reps = wanted.select("_fp").distinct().join(self.reps, "_fp")
        near = bounded(cut(reps, "near-wanted"), 64, self.bound_mb)
        schema = T.StructType([T.StructField("_fp", T.LongType()), T.StructField("_set", T.BinaryType())])
        found = self.texts.join(near, "_key").select("_fp", "_text")
        sets = arrow(found, _sets(self.k, ["_fp"], arrow_schema(schema)), schema)
        return sets.join(bounded(wanted, 64, self.bound_mb), "_fp").select("_fp", *carry, "_set")

    def shared(self, docs: DataFrame) -> DataFrame:
        """(_fp, n, r) of ``docs`` (_fp, _root): how many of each set's n shingles any other set of ``docs`` has too."""
        width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sent, counted = T._parse_datatype_string("part bigint, blob binary"), T._parse_datatype_string("_fp bigint, n bigint, r bigint")
        listed = arrow(self.of(docs, {"_root": T.LongType()}), _spread(4 * width, arrow_schema(sent)), sent).repartition(2 * width, "part").sortWithinPartitions("part")
        summed = arrow(listed, _shared(width, arrow_schema(sent)), sent).repartition(width, "part").sortWithinPartitions("part")
        return arrow(summed, _summed(arrow_schema(counted)), counted)

    def verify(self, pairs: DataFrame) -> DataFrame:
        """(x, p, linked) of pairs (x, p), each compared with p's whole set; a pivot of many is sent to several tasks."""
        pairs = cut(pairs.select("x", "p").distinct(), "near-pairs")
        fans = pairs.groupBy("p").agg(F.count("*").alias("_c")).withColumn("_fan", F.expr("1 + _c div 500"))
        spokes = pairs.join(fans, "p").select(F.col("x").alias("_fp"), F.col("p").alias("_pivot"), F.expr("pmod(xxhash64(x), _fan)").alias("_salt"))
        hubs = fans.select(F.col("p").alias("_fp"), F.col("p").alias("_pivot"), F.explode(F.expr("sequence(0L, _fan - 1)")).alias("_salt"))
        wanted = cut(spokes.union(hubs).withColumn("_group", F.xxhash64("_pivot", "_salt")), "near-spokes")
        width = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = self.of(wanted, {c: T.LongType() for c in ("_pivot", "_group")}).repartition(width, "_group").sortWithinPartitions("_group", F.col("_fp") != F.col("_pivot"))
        schema = T.StructType([T.StructField("x", T.LongType()), T.StructField("p", T.LongType()), T.StructField("linked", T.BooleanType())])
        return cut(arrow(rows, _compare(self.k, self.percent, arrow_schema(schema)), schema), "near-verified")

    def prefix_pairs(self, docs: DataFrame) -> DataFrame:
        """Candidate pairs (x, p) of ``docs`` (_fp, root) in different components, by prefix filtering with exact bounds."""
        spark = docs.sparkSession
        width = int(spark.conf.get("spark.sql.shuffle.partitions"))
        sets = self.of(docs, {"_root": T.LongType()})
        s1, s2, s3, s4 = (T._parse_datatype_string(x) for x in ("part bigint, blob binary", "_fp bigint, _root bigint, n bigint, h bigint, df bigint", "part bigint, h bigint, _fp bigint, _root bigint, n bigint, r bigint, pos bigint", "x bigint, p bigint"))
        listed = arrow(sets, _scatter(width, arrow_schema(s1)), s1).repartition(width, "part").sortWithinPartitions("part")
        common = arrow(listed, _frequencies(arrow_schema(s2)), s2).repartition(width, "_fp").sortWithinPartitions("_fp", "df", "h")
        prefix = arrow(common, _prefixes(self.percent, width, arrow_schema(s3)), s3).repartition(width, "part").sortWithinPartitions("part", "h")
        return arrow(prefix, _partners(self.percent, arrow_schema(s4)), s4).distinct()


def _spread(parts: int, schema: pa.Schema) -> Callable:
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shingles by part of their hash, packed by set."""
        for batch in batches:
            fp = batch.column("_fp").to_numpy(zero_copy_only=False)
            raw = batch.column("_set").to_pylist()
            n = np.array([len(b) // SHORT for b in raw], np.int64)
            h = long(b"".join(raw), int(n.sum()))
            owner = np.repeat(np.arange(len(n)), n)

            def pack(i: np.ndarray, h: np.ndarray = h, owner: np.ndarray = owner, fp: np.ndarray = fp, n: np.ndarray = n) -> bytes:
                sets, per = np.unique(owner[i], return_counts=True)
                return b"".join([np.array([len(sets)], "<i8").tobytes(), fp[sets].astype("<i8").tobytes(), n[sets].astype("<u4").tobytes(), per.astype("<u4").tobytes(), short(h[i] << np.uint64(64 - 8 * SHORT))])

            filled, blobs = by_part(mixed(h), parts, pack)
            yield batch_of(schema, {"part": filled, "blob": blobs})

    return spread


def _shared(parts: int, schema: pa.Schema) -> Callable:
    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs, _ in each_part(batches):
            fps, ns, pers, hs = [], [], [], []
            for b in blobs:
                m = int(np.frombuffer(b, "<i8", 1)[0])
                fps.append(np.frombuffer(b, "<i8", m, 8))
                ns.append(np.frombuffer(b, "<u4", m, 8 + 8 * m))
                pers.append(np.frombuffer(b, "<u4", m, 8 + 12 * m))
                hs.append(long(b, int(pers[-1].sum(dtype=np.int64)), 8 + 16 * m))
            fp, n, per, h = map(np.concatenate, (fps, ns, pers, hs))
            del fps, ns, pers, hs
            order = np.argsort(h)
            h = h[order]
            twin = np.zeros(len(h) + 1, bool)
            twin[1:-1] = h[1:] == h[:-1]
            flag = np.zeros(len(h), bool)
            flag[order] = twin[1:] | twin[:-1]
            total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
            edges = np.concatenate([[0], np.cumsum(per, dtype=np.int64)])
            rows = np.stack([fp, n.astype(np.int64), total[edges[1:]] - total[edges[:-1]]], 1)
            filled, packed = by_part(mixed(fp.view(np.uint64)), parts, lambda i, rows=rows: rows[i].tobytes())
            yield batch_of(schema, {"part": filled, "blob": packed})

    return shared


def _summed(schema: pa.Schema) -> Callable:
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs, _ in each_part(batches):
            rows = np.concatenate([np.frombuffer(b, "<i8").reshape(-1, 3) for b in blobs])
            fp, first, inverse = np.unique(rows[:, 0], return_index=True, return_inverse=True)
            yield batch_of(schema, {"_fp": fp, "n": rows[first, 1], "r": np.bincount(inverse, rows[:, 2]).astype(np.int64)})

    return summed


def _scatter(parts: int, schema: pa.Schema) -> Callable:
    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, root = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_fp", "_root"))
            raw = batch.column("_set").to_pylist()
            n = np.array([len(b) // SHORT for b in raw], np.int64)
            h = long(b"".join(raw), int(n.sum()))
            owner = np.repeat(np.arange(len(n)), n)
            filled, blobs = by_part(mixed(h), parts, lambda i, h=h, o=owner, fp=fp, root=root, n=n: np.stack([h[i].view(np.int64), fp[o[i]], root[o[i]], n[o[i]]], 1).tobytes())
            yield batch_of(schema, {"part": filled, "blob": blobs})

    return scatter


def _frequencies(schema: pa.Schema) -> Callable:
    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many sets have each shingle; a shingle of one set can be in no intersection."""
        for blobs, _ in each_part(batches):
            rows = np.concatenate([np.frombuffer(b, "<i8").reshape(-1, 4) for b in blobs])
            _, inverse, count = np.unique(rows[:, 0], return_inverse=True, return_counts=True)
            df = count[inverse]
            rows, df = rows[df > 1], df[df > 1]
            for at in range(0, len(rows), 1 << 16):
                h, fp, root, n = rows[at : at + (1 << 16)].T
                yield batch_of(schema, {"_fp": fp, "_root": root, "n": n, "h": h, "df": df[at : at + (1 << 16)]})

    return frequencies


def _prefixes(percent: int, parts: int, schema: pa.Schema) -> Callable:
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rarest shared shingles of each set: as many as it may lack of a partner, and one more. Rows come by set, rarest first."""

        def settle(rows: np.ndarray) -> pa.RecordBatch | None:
            fp, root, n = rows[0, :3].tolist()
            shared = len(rows)
            if 100 * shared < percent * n:
                return None
            keep = n - (percent * n + 99) // 100 + 1 - (n - shared)  # the shingles of one set are the rarest
            h = rows[: max(keep, 0), 3]
            m = len(h)
            return batch_of(schema, {"part": (mixed(h.view(np.uint64)) % np.uint64(parts)).astype(np.int64), "h": h, "_fp": [fp] * m, "_root": [root] * m, "n": [n] * m, "r": [shared] * m, "pos": np.arange(m) + n - shared})

        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("_fp", "_root", "n", "h")], 1)
            cuts = np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1
            for piece in np.split(rows, cuts):
                if held and len(piece) and held[-1][0, 0] != piece[0, 0]:
                    out = settle(np.concatenate(held))
                    held = []
                    if out is not None:
                        yield out
                if len(piece):
                    held.append(piece)
        if held and (out := settle(np.concatenate(held))) is not None:
            yield out

    return prefixes


def _partners(percent: int, schema: pa.Schema) -> Callable:
    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each prefix shingle the pairs of its list whose sizes and shared counts allow the similarity, in different components."""

        def settle(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(rows) < 2 or (rows[:, 1] == rows[0, 1]).all():
                return
            rows = rows[np.argsort(rows[:, 2], kind="stable")]
            fp, root, n, r, pos = rows.T
            # With at most r shingles in common, a partner has at most r (100 + percent) / percent - n of them.
            low, high = (percent * n + 99) // 100, np.minimum(100 * n // percent, r * (100 + percent) // percent - n)
            lo, hi = np.maximum(np.searchsorted(n, low, "left"), np.arange(len(n)) + 1), np.searchsorted(n, high, "right")
            for a in range(0, len(n), 256):
                counts = np.maximum(hi[a : a + 256] - lo[a : a + 256], 0)
                x = np.repeat(np.arange(a, min(a + 256, len(n))), counts)
                y = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lo[a : a + 256], counts)
                most = np.minimum(r[x], r[y])
                need = (percent * (n[x] + n[y]) + 99 + percent) // (100 + percent)
                # At their first common shingle, a pair has no more in common than what either set has from there on.
                ok = (root[x] != root[y]) & (most >= need) & (np.minimum(n[x] - pos[x], n[y] - pos[y]) >= need)
                if ok.any():
                    u, v = fp[x[ok]], fp[y[ok]]
                    yield batch_of(schema, {"x": np.maximum(u, v), "p": np.minimum(u, v)})

        held: list[np.ndarray] = []
        last = None
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("_fp", "_root", "n", "r", "pos")], 1)
            h = batch.column("h").to_numpy(zero_copy_only=False)
            for a, b in zip(edges := [0, *(np.flatnonzero(h[1:] != h[:-1]) + 1).tolist(), len(h)], edges[1:], strict=False):
                if a == b:
                    continue
                if held and h[a] != last:
                    yield from settle(np.concatenate(held))
                    held = []
                last = h[a]
                held.append(rows[a:b])
        if held:
            yield from settle(np.concatenate(held))

    return partners


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), text_or_empty(text_col))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", bound_mb: int = 32) -> DataFrame:
    """(id, key, n_shingles, component_id, stays) of every row: its component under links of Jaccard similarity ``percent`` or more.

    A row's set: its distinct shingles of ``k`` words, A-Z in lower case; with fewer words the whole sequence as one; null and
    empty texts and texts of blanks have none and link with nothing, so that each is its own component. component_id is the smallest id in the
    component. Equal sets, repeated rows among them, are one class from the start and travel once a batch. ``key`` is ``row_key`` of the row; ``stays`` marks the rows of one key in each component. Rows with a null id
    take part; a component of such rows alone has a null component_id. An empty table gives none. Only the two columns named are read.

    1. Each set is cut into segments by the hash of its shingles, as many as its size band needs by ``allocation``; signatures of the segments (and of
       their one-deletion neighbours) meet by hash. A bucket gives only the pairs of each member with its least member.
    2. Each set is compared exactly with the one that it shares most signatures with. Linked sets form components.
    3. Where a bucket's members are not all in one component, all sets that met its least member are open. Open sets whose
       shingles are too few in other open sets are done. The others are compared with the most central set they met; where that
       leaves several components, they are joined exactly by prefix filtering, leaving out pairs that are in one component already or whose shared shingles cannot suffice.
    Sets are hashed to 64 bits, shingles within a comparison to 40.
    """
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(row_key(id_col, text_col).alias("_key"), text_or_empty(text_col).alias("_text"))
    index_schema, found_schema = T._parse_datatype_string(ROW), T._parse_datatype_string(FOUND)
    filed = arrow(texts, _index(k, percent, 4 * width, arrow_schema(index_schema)), index_schema).repartition(2 * width, "part").sortWithinPartitions("part")
    found = cut(arrow(filed, _stars(arrow_schema(found_schema)), found_schema), "near-found")
    rows = found.filter("fp IS NOT NULL").select("key", "n", "fp")
    reps = rows.groupBy(F.col("fp").alias("_fp")).agg(F.min("key").alias("_key"))
    sets = Texts(texts, reps, k, percent, bound_mb)

    stars = cut(found.filter("x IS NOT NULL").groupBy("x", "p").agg(F.sum("shared").alias("shared"), F.max("many").alias("many")), "near-stars")
    best = stars.groupBy("x").agg(F.max(F.struct("shared", (-F.col("p")).alias("q"), "p")).alias("b")).select("x", F.col("b.p").alias("p"))
    tested = sets.verify(best)
    roots = cut(components(tested.filter("linked").select(F.col("x").alias("u"), F.col("p").alias("v"))), "near-roots")

    def rooted(df: DataFrame, node: str, to: str) -> DataFrame:
        return df.join(roots.select(F.col("node").alias(node), F.col("root").alias(to)), node, "left").withColumn(to, F.coalesce(to, node))

    apart = rooted(rooted(stars, "x", "rx"), "p", "rp").filter("rx <> rp").join(tested.select("x", "p", F.lit(True).alias("t")), ["x", "p"], "left").filter("many OR t IS NULL")
    hubs = apart.select("p").distinct()
    open_sets = cut(rooted(stars.join(hubs, "p", "left_semi").select(F.col("x").alias("_fp")).union(hubs.select(F.col("p").alias("_fp"))).distinct(), "_fp", "_root"), "near-open")
    # A set most of whose shingles no other open set has links with none of them; families left with one component are settled.
    # The others are compared with their most central set, the one with the least share of shingles of its own, before the exact join.
    alive = cut(sets.shared(open_sets).filter(100 * F.col("r") >= percent * F.col("n")).join(open_sets, "_fp").select("_fp", "_root", (F.col("r") / F.col("n")).alias("_central")), "near-alive")
    family = cut(stars.join(hubs, "p", "left_semi").select("p", F.col("x").alias("_fp")).union(hubs.select("p", F.col("p").alias("_fp"))).join(alive, "_fp"), "near-family")
    centres = family.groupBy("p").agg(F.max(F.struct("_central", (-F.col("_fp")).alias("q"), "_fp", "_root")).alias("c"), F.min("_root").alias("a"), F.max("_root").alias("b")).filter("a <> b").select("p", F.col("c._fp").alias("centre"), F.col("c._root").alias("cr"))
    central = sets.verify(family.join(centres, "p").filter("_root <> cr").select(F.col("_fp").alias("x"), F.col("centre").alias("p")))
    first = cut(rooted(rooted(central.filter("linked"), "x", "u"), "p", "v").select("u", "v"), "near-central")
    merged = cut(components(first).select(F.col("node").alias("_root"), F.col("root").alias("_top")), "near-merged")
    family = family.join(merged, "_root", "left").withColumn("_root", F.coalesce("_top", "_root")).drop("_top")
    unsettled = family.groupBy("p").agg(F.min("_root").alias("a"), F.max("_root").alias("b")).filter("a <> b").select("p")
    doubtful = cut(family.join(unsettled, "p", "left_semi").select("_fp", "_root").distinct(), "near-doubtful")
    again = sets.verify(sets.prefix_pairs(doubtful))
    bridges = rooted(rooted(again.filter("linked"), "x", "u"), "p", "v").select("u", "v").union(first)
    tops = components(bridges).select(F.col("node").alias("root"), F.col("root").alias("top"))

    named = rooted(_named(docs, id_col, text_col, rows), "fp", "root").join(tops, "root", "left").withColumn("top", F.coalesce("top", "root"))
    named = cut(named.select("id", "key", "n", "top"), "near-named")
    least = cut(named.filter("n > 0").groupBy("top").agg(F.min(F.struct("id", "key")).alias("least")), "near-least")
    full = named.filter("n > 0").join(least, "top").select("id", "key", F.col("n").alias("n_shingles"), F.col("least.id").alias("component_id"), (F.col("least.key") == F.col("key")).alias("stays"))
    return full.union(named.filter("n = 0").select("id", "key", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(True).alias("stays")))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", bound_mb: int = 32) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the least id (and key), of wholly repeated rows one.

    Rows without words are in no component and all stay. Returns the columns of ``docs``.
    """
    found = cut(near_duplicates(docs, k, percent, id_col, text_col, bound_mb), "near-result")
    stays = bounded(found.filter("stays").groupBy(F.col("key").alias("_key")).agg((F.count("*") > 1).alias("_twice"), F.max("n_shingles").alias("_n")), 48, bound_mb)
    rows = docs.withColumn("_key", row_key(id_col, text_col)).join(stays, "_key")
    names = docs.columns
    again = F.col("_twice") & (F.col("_n") > 0)
    return rows.filter(~again).select(*names).union(rows.filter(again).dropDuplicates(["_key"]).select(*names))


def _named(docs: DataFrame, id_col: str, text_col: str, rows: DataFrame) -> DataFrame:
    """Rows with their ids: keys stand for id and text, so a key's rows agree in both."""
    ids = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"))
    return ids.join(rows.groupBy("key").agg(F.first("n").alias("n"), F.first("fp").alias("fp")), "key")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), k=4, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


OP4_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM d WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:least(i + 3, len(ws))], ' ') AS s FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 85 * (a.n + b.n - c)),
l AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
r(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.v, r.root FROM r JOIN l ON r.node = l.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node AS doc_id, min(root) AS component_id FROM r GROUP BY node) c USING (doc_id)
"""


def brute_force(docs: list[tuple], k: int, percent: int) -> list[tuple]:
    """The contract over all pairs that share a shingle: for tests on small tables."""
    import re

    sets: dict[int, frozenset] = {}
    for d, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[d] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    parent = {d: d for d in sets}

    def top(d: int) -> int:
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets, key=lambda d: len(sets[d]))
    lists: dict[tuple, list] = {}
    for d in ids:
        seen: dict[int, int] = {}
        for s in sets[d]:
            for e in lists.get(s, ()):
                seen[e] = seen.get(e, 0) + 1
            lists.setdefault(s, []).append(d)
        for e, both in seen.items():
            if 100 * both >= percent * (len(sets[d]) + len(sets[e]) - both):
                a, b = sorted((top(d), top(e)))
                parent[b] = a
    return [(d, len(sets[d]), top(d)) for d in sets]
