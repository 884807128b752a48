"""Sinks: immutable generations with the manifest last, tiles, and review packs."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.java_gateway import JavaClass
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.functions.grid import tile_cover
from tessella.operators.gates import differences, must_be_empty
from tessella.session import cut


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file by Spark's file system and put it in its place in one step, so that a reader sees the old or the new one, and never none."""
    jvm = spark._jvm
    target, staged = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    conf = spark._jsc.hadoopConfiguration()
    out = target.getFileSystem(conf).create(staged, True)
    out.write(bytearray(text.encode()))
    out.close()
    gateway = spark.sparkContext._gateway
    mode = JavaClass("org.apache.hadoop.fs.Options$Rename", gateway._gateway_client)
    modes = gateway.new_array(mode, 1)
    modes[0] = mode.valueOf("OVERWRITE")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(staged, target, modes)


def manifest(spark: SparkSession, folder: str) -> dict:
    """What the manifest says; nothing where none was published yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest.json")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return {}
    return json.loads(spark.read.text(path.toString(), wholetext=True).first()[0])


def _digest(df: DataFrame) -> list[int]:
    """A digest of a table's rows, whatever their order."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    parts = [F.conv(F.substring(row, at, 15), 16, 10).cast("bigint") for at in (1, 16, 31)]
    return [int(x or 0) for x in df.agg(F.count("*"), *map(F.bit_xor, parts), *[F.sum(p % 1_000_000_007) for p in parts]).first()]


def stage(tables: dict[str, tuple[DataFrame, list[str]]], folder: str, gates: list[tuple[str, DataFrame]] = ()) -> str:
    """Write tables (with partition columns) as a new generation that no manifest names yet; its name.

    The gates run first: a violation raises. Every table is read back and compared with what was to be written. The generation's name begins with
    a digest of the rows, whatever their order. Content that is published already is not written again, and every other generation gets a folder of its own,
    so nothing that a manifest names is ever overwritten. A receipt beside it keeps the digests.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    for what, found in gates:
        must_be_empty(found, what)
    sums = {name: _digest(df) for name, (df, _) in sorted(tables.items())}
    digest = spark.range(1).select(F.sha2(F.lit(json.dumps(sums)), 256)).first()[0][:16]
    live = manifest(spark, folder).get("generation", "")
    if live.startswith(digest):
        return live
    generation = f"{digest}-{uuid.uuid4().hex[:8]}"
    for name, (df, by) in tables.items():
        path = f"{folder}/generation={generation}/{name}"
        df.write.partitionBy(*by).parquet(path)
        must_be_empty(differences(df, spark.read.schema(df.schema).parquet(path)), f"{name} read back")
    _put(spark, f"{folder}/receipt-{generation}.json", json.dumps({"digests": sums, "schemas": {name: df.schema.json() for name, (df, _) in tables.items()}}))
    return generation


def publish(tables: dict[str, tuple[DataFrame, list[str]]], folder: str, gates: list[tuple[str, DataFrame]] = (), owner: str = "publish") -> str:
    """Stage tables as a new generation and promote it over the one that the manifest names now; its name. See ``stage`` and ``promote``."""
    spark = next(iter(tables.values()))[0].sparkSession
    base = manifest(spark, folder).get("generation", "")
    generation = stage(tables, folder, gates)
    promote(spark, folder, generation, base, owner)
    return generation


class ConflictError(RuntimeError):
    """Another publisher holds the lock or has published, or what was staged has changed; what the manifest names stays."""


def _create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file if there is none of that name, in one step of the file system; whether it was created.

    Object stores and distributed file systems create exclusively themselves; the local one does through Java's own call.
    """
    jvm, target = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    try:
        if fs.getScheme() == "file":
            local = jvm.java.io.File(target.toUri().getPath()).toPath()
            staged = jvm.java.nio.file.Files.write(jvm.java.io.File(f"{target.toUri().getPath()}.{uuid.uuid4().hex}").toPath(), bytearray(text.encode()), spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 0))
            try:
                jvm.java.nio.file.Files.createLink(local, staged)  # with its content, and only if the name is free
            finally:
                jvm.java.nio.file.Files.delete(staged)
        else:
            out = fs.create(target, False)
            out.write(bytearray(text.encode()))
            out.close()
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _terms(spark: SparkSession, folder: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    return sorted(int(n.removeprefix(LOCK)) for n in names if n.startswith(LOCK) and n.removeprefix(LOCK).isdigit())


#: Names of locks, before their number.
LOCK = "release-lock-"


@contextmanager
def locked(spark: SparkSession, folder: str, owner: str, lease_s: float = 900.0) -> Iterator[Callable[[], None]]:
    """The only release of a folder in progress, or ``ConflictError``. Yields a function that raises if the lock is no longer this one's.

    Locks are numbered files, created only if their name is free. A lock says who holds it and until when; one that was given back or whose time is over is followed
    by the next number, which again one publisher alone can create, so a lost driver blocks releases for its lease and no longer. Numbers only grow: whoever still
    holds an old one sees a larger and stops. Earlier files are deleted, all but the last.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(fs_path(folder))
    terms = _terms(spark, folder)
    if terms and not fs.exists(fs_path(f"{folder}/{LOCK}{terms[-1]}.released")):
        said = spark.read.text(f"{folder}/{LOCK}{terms[-1]}", wholetext=True).first()
        begun = fs.getFileStatus(fs_path(f"{folder}/{LOCK}{terms[-1]}")).getModificationTime() / 1000
        held = json.loads(said[0]) if said and said[0] else {"owner": "another publisher", "until": begun + lease_s}  # it is just being written
        if time.time() < held["until"]:
            raise ConflictError(f"{held['owner']} is releasing")
    mine, until = (terms[-1] if terms else 0) + 1, time.time() + lease_s
    if not _create_new(spark, f"{folder}/{LOCK}{mine}", json.dumps({"owner": owner, "until": until})):
        raise ConflictError("another release has just begun")

    def check() -> None:
        if time.time() >= until or _terms(spark, folder)[-1] != mine:
            raise ConflictError(f"the lease of {owner} has ended")

    try:
        yield check
    finally:
        _create_new(spark, f"{folder}/{LOCK}{mine}.released", "")
        for old in terms:
            for name in (f"{LOCK}{old}", f"{LOCK}{old}.released"):
                fs.delete(fs_path(f"{folder}/{name}"), False)


def promote(spark: SparkSession, folder: str, generation: str, base: str, owner: str, lease_s: float = 900.0, approved: dict[str, list[int]] | None = None) -> None:
    """Point the manifest at a staged generation, if it still names ``base`` (nothing: the empty text) and nobody else is at it.

    Under the lock the staged tables are read and their digests compared with the receipt's, and with those that the owner ``approved`` if given; the manifest
    is compared once more and replaced last, in one step. Anything amiss raises ``ConflictError`` before that. Promoting what is live already does nothing.
    """
    with locked(spark, folder, owner, lease_s) as check:
        live = manifest(spark, folder).get("generation", "")
        if live == generation:
            return
        if live != base:
            raise ConflictError(f"{live or 'nothing'} is published, not {base or 'nothing'}")
        receipt = json.loads(spark.read.text(f"{folder}/receipt-{generation}.json", wholetext=True).first()[0])
        for name, want in receipt["digests"].items():
            schema = T.StructType.fromJson(json.loads(receipt["schemas"][name]))
            if _digest(spark.read.schema(schema).parquet(f"{folder}/generation={generation}/{name}")) != want:
                raise ConflictError(f"{name} has changed since it was staged")
            if approved is not None and approved.get(name) != want:
                raise ConflictError(f"{name} is not what its owner approved")
        check()
        if manifest(spark, folder).get("generation", "") != base:
            raise ConflictError("the manifest has changed meanwhile")
        _put(spark, f"{folder}/manifest.json", json.dumps({"generation": generation, "owner": owner, "tables": {k: v[0] for k, v in receipt["digests"].items()}}))


def current(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the generation that the manifest names."""
    return spark.read.parquet(f"{folder}/generation={manifest(spark, folder)['generation']}/{name}")


def tiled(features: DataFrame, most: int = 10_000) -> DataFrame:
    """Features (west, south, east, north) once for each tile they touch; one that touches more than ``most`` fails the batch."""
    cover = tile_cover(F.col("west"), F.col("south"), F.col("east"), F.col("north"), most)
    checked = F.when(F.size(cover) > 0, cover).otherwise(F.raise_error(F.lit("a feature covers too many tiles")).cast("array<struct<tx:bigint,ty:bigint>>"))
    return features.withColumn("_t", F.explode(checked)).select("*", F.concat_ws("_", "_t.tx", "_t.ty").alias("tile")).drop("_t")


def review_packs(rows: DataFrame, done: DataFrame, key: str, size: int = 30) -> DataFrame:
    """Rows not ``done``, in batches of at most ``size`` (1 to 200) in key order.

    Positions come from counts of ranges of keys and positions within them, so no task sees all rows.
    """
    size = min(max(size, 1), 200)
    pending = rows.join(done, key, "left_anti").repartitionByRange(key).sortWithinPartitions(key).withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id())
    pending = cut(pending, "review-pending")  # ranges are drawn from samples, so they must be drawn once
    starts = pending.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first")).withColumn("_before", F.expr("sum(_n) OVER (ORDER BY _part) - _n"))
    return pending.join(F.broadcast(starts), "_part").withColumn("batch", F.floor((F.col("_before") + F.col("_seq") - F.col("_first")) / size)).drop("_part", "_seq", "_n", "_first", "_before")
