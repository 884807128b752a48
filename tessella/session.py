"""Making this package importable in Python workers, and tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors through Spark's own file server, once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent
    folder = Path(tempfile.mkdtemp())
    with zipfile.ZipFile(folder / "tessella.zip", "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(folder / "tessella.zip"))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, on one machine (tests) a folder in the warehouse is used; a cluster must set it. Tables that are cut lie under the
    application's id and stay until whoever owns the folder clears it: a later query may still read them.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/tessella-checkpoints"


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tessella/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again, so that what follows neither recomputes it nor depends on an executor's disk."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
