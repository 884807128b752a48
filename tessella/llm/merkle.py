"""A manifest of a data set as trees of hashes, with a proof of every row."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import bounded, cut, table
from tessella.session import ship

#: Nodes of a run, and levels of a superblock if not told otherwise.
FANOUT, HEIGHT = 16, 2
PATH = "array<struct<before:string,after:string>>"
Step = tuple[str, str]


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(columns: list[Column]) -> Column:
    """The digest of a row: of each value's UTF-8 byte count, a colon and the value; of a hyphen for null."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


def levels(digests: list[str], n: int, height: int) -> list[list[str]]:
    """The digests and the levels above them: until one is left if all ``n`` of the list are in one superblock, else ``height`` of them."""
    out = [digests]
    while len(out[-1]) > 1 if n <= FANOUT**height else len(out) <= height:
        below = out[-1]
        out.append([sha256("".join(below[k : k + FANOUT])) for k in range(0, len(below), FANOUT)])
    return out


def steps(tree: list[list[str]]) -> list[list[Step]]:
    """For each level but the last, what stands before and after each node in its run."""
    out = []
    for nodes in tree[:-1]:
        runs = [nodes[k : k + FANOUT] for k in range(0, len(nodes), FANOUT)]
        out.append([("".join(run[:j]), "".join(run[j + 1 :])) for run in runs for j in range(len(run))])
    return out


def fold(digest: str, path: list[Step]) -> str:
    for before, after in path:
        digest = sha256(before + digest + after)
    return digest


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"at div {FANOUT**height}"))


def _roots(nodes: DataFrame, height: int) -> DataFrame:
    """(list, at, n, digest): the superblocks of ``nodes`` (list, at, n, digest) as the nodes of a list that much shorter."""

    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        top = levels(rows.sort_values("at")["digest"].tolist(), rows["n"].iloc[0], height)[-1]
        return pd.DataFrame({"list": [key[0]], "at": [key[1]], "n": [-(-rows["n"].iloc[0] // FANOUT**height)], "digest": top})

    return _blocks(nodes, height).groupBy("list", "block").applyInPandas(reduce, "list bigint, at bigint, n bigint, digest string")


def paths(nodes: DataFrame, height: int) -> DataFrame:
    """(list, at, path, root): for every node of ``nodes`` (list, at, n, digest) the steps from it to the root of its list of ``n`` nodes, numbered from 0.

    A list of more than a superblock is reduced by superblocks first; the paths of their roots, found in the same way, are then cogrouped with
    the nodes. Every pass leaves one node of a superblock, so a few passes reach any size.
    """
    longest = nodes.agg(F.max("n")).first()[0] or 0
    none = nodes.select("list", F.col("at").alias("block"), F.lit(None).cast(PATH).alias("path"), F.lit(None).cast("string").alias("root")).limit(0)
    outer = none if longest <= FANOUT**height else paths(cut(_roots(nodes, height), "merkle-roots"), height).withColumnRenamed("at", "block")

    def join(key: tuple, inner: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        inner = inner.sort_values("at")
        tree = levels(inner["digest"].tolist(), inner["n"].iloc[0], height)
        own, above = steps(tree), [] if outer.empty else [(s["before"], s["after"]) for s in outer["path"].iloc[0]]
        found = [[own[k][i // FANOUT**k] for k in range(len(own))] + above for i in range(len(inner))]
        return pd.DataFrame({"list": key[0], "at": inner["at"], "path": [[{"before": b, "after": a} for b, a in p] for p in found], "root": tree[-1][0] if outer.empty else outer["root"].iloc[0]})

    return _blocks(nodes, height).groupBy("list", "block").cogroup(outer.groupBy("list", "block")).applyInPandas(join, f"list bigint, at bigint, path {PATH}, root string")


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``list`` (the number of the group, ascending, null first), ``at`` (the number in the group, by ``order``) and ``n`` (rows of the group).

    Rows are sorted by ranges of group and order together, so a group with a third of all rows is spread like any other; what is counted for each
    range and group then turns places in a range into numbers. Rows that agree in group and order take numbers in any order.
    """
    spread = rows.repartitionByRange(F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order])
    # The id of a row is its partition's number and, in the lower 33 bits, its place there.
    spread = cut(spread.withColumn("_seq", F.monotonically_increasing_id()), "merkle-sorted").withColumns({"_range": F.expr("shiftright(_seq, 33)"), "_place": F.expr(f"_seq & {(1 << 33) - 1}")})
    counts = cut(spread.groupBy("_range", F.col(group).alias("_group")).agg(F.count("*").alias("_n"), F.min("_place").alias("_first")), "merkle-ranges")
    groups = counts.groupBy("_group").agg(F.min("_range").alias("_range"), F.sum("_n").alias("n"))
    before = groups.groupBy("_range").count().select("_range", F.expr("sum(count) OVER (ORDER BY _range) - count").alias("_before"))
    groups = groups.join(before, "_range").select("_group", "n", (F.col("_before") + F.expr("row_number() OVER (PARTITION BY _range ORDER BY _group ASC NULLS FIRST)") - 1).alias("list"))
    starts = counts.withColumn("_base", F.expr("sum(_n) OVER (PARTITION BY _group ORDER BY _range) - _n - _first")).select("_range", F.col("_group").alias("_g"), "_base")
    starts = starts.join(groups, F.col("_g").eqNullSafe(F.col("_group"))).select(F.col("_range").alias("_r"), "_g", "_base", "list", "n")
    starts = bounded(starts, 256, 8)
    return spread.join(starts, (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_g"))).withColumn("at", F.col("_place") + F.col("_base")).drop("_seq", "_range", "_place", "_r", "_g", "_base")


def manifest(rows: DataFrame, id_col: str = "doc_id", group_col: str = "source", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), candidate: Column | None = None, proofs: bool = False, height: int = HEIGHT) -> DataFrame:
    """Every row as a leaf of its group's tree, the groups' roots as leaves of one tree, and what proves each row.

    A row's leaf is the digest of ``columns`` (see ``leaf``). In each group leaves ascend by id (null first; of one id, by leaf), and while there are
    several nodes, each run of 16 becomes the digest of their hexadecimal texts; a lone leaf is its group's root. The roots, by group (null first, by
    bytes), make the root of all in the same way. Returns id, leaf, subroot, root, proof_sha256 (digest of all siblings, from the leaf's run
    to the root, left to right), folded_root (from ``candidate``, a leaf of perhaps altered columns, by default the own one, and the siblings) and
    verified (whether this is the root); with ``proofs`` also ``proof``, the siblings before and after the node of each level.

    Nulls are hyphens in a leaf; the candidate is a leaf like any other. Repeated rows are leaves of their own. Other columns are not read. A table
    without rows has no rows here, and no root. Texts stay where they are: only ids, groups and digests are shuffled. A superblock of ``height`` levels (256 leaves) is
    one task's group; what it needs from outside, one path, meets it there, and siblings, proofs and folding are found together.
    """
    spark = rows.sparkSession
    ship(spark)
    own = leaf([F.col(c) for c in columns])
    leaves = rows.select(F.col(id_col).alias("_id"), F.col(group_col).alias("_key"), own.alias("digest"), (own if candidate is None else candidate).alias("other"))
    leaves = cut(numbered(leaves, "_key", ["_id", "digest", "other"]).select("list", "at", "n", F.col("_id").cast("string").alias("id"), "digest", "other"), "merkle-leaves")

    outer = cut(paths(cut(_roots(leaves.select("list", "at", "n", "digest"), height), "merkle-roots"), height), "merkle-paths")
    subroots = outer.filter("at = 0").select(F.lit(0).cast("bigint").alias("list"), F.col("list").alias("at"), F.lit(outer.filter("at = 0").count()).cast("bigint").alias("n"), F.col("root").alias("digest"))
    top = paths(subroots, height).select(F.col("at").alias("list"), F.col("path").alias("rest"), F.col("root").alias("top"))
    outer = outer.join(top, "list").select("list", F.col("at").alias("block"), F.concat("path", "rest").alias("path"), F.col("root").alias("subroot"), F.col("top").alias("root"))

    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", *(["proof"] if proofs else [])]

    def finish(key: tuple, inner: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        inner = inner.sort_values("at")
        digests = inner["digest"].tolist()
        own = steps(levels(digests, inner["n"].iloc[0], height))
        above, subroot, root = [(s["before"], s["after"]) for s in outer["path"].iloc[0]], outer["subroot"].iloc[0], outer["root"].iloc[0]
        found = [[own[k][i // FANOUT**k] for k in range(len(own))] + above for i in range(len(digests))]
        proved = [sha256("".join(b + a for b, a in p)) for p in found]
        folded = [fold(other, p) for other, p in zip(inner["other"], found, strict=True)]
        out = {"id": inner["id"].tolist(), "leaf": digests, "subroot": subroot, "root": root, "proof_sha256": proved, "folded_root": folded}
        if proofs:
            out["proof"] = [[{"before": b, "after": a} for b, a in p] for p in found]
        return pd.DataFrame(out)[names]

    schema = ", ".join(f"{c} {PATH if c == 'proof' else 'string'}" for c in names)
    done = _blocks(leaves, height).groupBy("list", "block").cogroup(outer.groupBy("list", "block")).applyInPandas(finish, schema)
    return done.select(F.col("id").cast(rows.schema[id_col].dataType).alias(id_col), *names[1:6], F.expr("folded_root = root").alias("verified"), *names[6:])


def lowered(text: Column) -> Column:
    """A to Z in lower case, nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    text = F.when(tampered, lowered(F.col("text"))).otherwise(F.col("text"))
    return manifest(table(spark, sf_dir, "documents").select(*FIELDS), columns=FIELDS, candidate=leaf([*map(F.col, FIELDS[:-1]), text]))


def _tree_sql(name: str, rows: str, depth: int) -> str:
    """Common table expressions that lift ``rows`` (g, i, m, id, d, cur, proof) ``depth`` levels: nodes d0, d1, ..., and each id's folded digest and proof."""
    out = [f"{name}n0 AS (SELECT g, i, any_value(d) AS d, any_value(m) AS m FROM {rows} GROUP BY g, i)", f"{name}p0 AS (SELECT g, i, id, cur, proof FROM {rows})"]
    for k in range(depth):
        out.append(f"{name}r{k} AS (SELECT g, i // 16 AS r, any_value(m) AS m, array_agg(d ORDER BY i) AS ds FROM {name}n{k} GROUP BY g, r)")
        out.append(f"{name}n{k + 1} AS (SELECT g, r AS i, CASE WHEN m > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d, (m + 15) // 16 AS m FROM {name}r{k})")
        before, after = "coalesce(array_to_string(ds[1 : p.i % 16], ''), '')", "coalesce(array_to_string(ds[p.i % 16 + 2 : 16], ''), '')"
        out.append(f"{name}p{k + 1} AS (SELECT p.g, r AS i, id, CASE WHEN m > 1 THEN sha256({before} || cur || {after}) ELSE cur END AS cur, CASE WHEN m > 1 THEN proof || {before} || {after} ELSE proof END AS proof FROM {name}p{k} p JOIN {name}r{k} ON p.g = {name}r{k}.g AND p.i // 16 = r)")
    return ",\n".join(out)


def _leaf_sql(text: str) -> str:
    part = "coalesce(CAST(octet_length(encode({0})) AS VARCHAR) || ':' || {0}, '-')"
    return f"sha256({' || '.join(part.format(c) for c in ('CAST(doc_id AS VARCHAR)', 'source', 'lang', 'CAST(n_chars AS VARCHAR)', text))})"


#: Bit by bit, since DuckDB has no crc32: bytes of the id's digits, eight shifts each.
_CRC = "xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, (a & 1) * 3988292384))))"

#: Up to 16 ** 5 rows of a source and 16 ** 3 sources.
OP12_SQL = f"""WITH s AS (SELECT key, row_number() OVER (ORDER BY key NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT source AS key FROM documents)),
l AS (SELECT g, doc_id AS id, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST) - 1 AS i, count(*) OVER (PARTITION BY g) AS m, {_leaf_sql('text')} AS d,
{_leaf_sql(f"CASE WHEN {_CRC} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END")} AS cur, '' AS proof FROM documents JOIN s ON source IS NOT DISTINCT FROM key),
{_tree_sql('a', 'l', 5)},
t AS (SELECT 0 AS g, g AS i, (SELECT count(*) FROM s) AS m, g AS id, d, d AS cur, '' AS proof FROM an5),
{_tree_sql('b', 't', 3)},
c AS (SELECT 0 AS g, a.g AS i, (SELECT count(*) FROM s) AS m, a.id, b.d, a.cur, a.proof FROM ap5 a JOIN t b ON b.i = a.g),
{_tree_sql('c', 'c', 3)}
SELECT l.id AS doc_id, l.d AS leaf, an5.d AS subroot, bn3.d AS root, sha256(cp3.proof) AS proof_sha256, cp3.cur AS folded_root, cp3.cur = bn3.d AS verified
FROM l JOIN an5 ON l.g = an5.g JOIN cp3 ON cp3.id = l.id CROSS JOIN bn3"""


def brute_force(rows: list[tuple], change: list[bool]) -> list[tuple]:
    """The query's rows for (doc_id, source, lang, n_chars, text) with ids that differ, by plain recursion."""

    def digest(values: tuple) -> str:
        return sha256("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def climb(nodes: list[str]) -> Iterator[list[str]]:
        yield nodes
        if len(nodes) > 1:
            yield from climb([sha256("".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)])

    def siblings(tree: list[list[str]], i: int) -> list[Step]:
        out = []
        for nodes in tree[:-1]:
            run = nodes[i // 16 * 16 :][:16]
            out.append(("".join(run[: i % 16]), "".join(run[i % 16 + 1 :])))
            i //= 16
        return out

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    marked = sorted(zip(rows, change, strict=True), key=lambda x: (x[0][0] is not None, x[0][0] or 0))
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    members = {s: [(r, c) for r, c in marked if r[1] == s] for s in sources}
    trees = {s: list(climb([digest(r) for r, _ in members[s]])) for s in sources}
    top = list(climb([trees[s][-1][0] for s in sources]))
    out = []
    for k, s in enumerate(sources):
        for i, (r, c) in enumerate(members[s]):
            path = siblings(trees[s], i) + siblings(top, k)
            seen = digest((*r[:4], r[4].translate(lower))) if c and r[4] is not None else digest(r)
            folded = fold(seen, path)
            out.append((r[0], digest(r), trees[s][-1][0], top[-1][0], sha256("".join(b + a for b, a in path)), folded, folded == top[-1][0]))
    return out
