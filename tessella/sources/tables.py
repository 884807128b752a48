"""Readers, and the announcements, places and reports that the driver's tables stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.functions.grid import plane

PRECISIONS = ("point", "street", "place", "address", "district")
MAPPABLE = ("point", "street", "place", "address")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def decisions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Line-delimited JSON of a closed contract: a malformed line, or a key that the schema does not name, fails the batch."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    known = F.array(*map(F.lit, schema.fieldNames()))
    extra = F.array_except(F.map_keys(F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})), known)
    checked = lines.withColumn("value", F.when(F.size(extra) == 0, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("unknown keys: "), F.concat_ws(", ", extra)))))
    return checked.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def placed(df: DataFrame, key: str) -> DataFrame:
    """Coordinates from a key by whole-number arithmetic, so that any engine gets the same."""
    df = df.withColumns({"lon": 13.1 + F.col(key) * 37 % 1000 * 0.0005, "lat": 52.35 + F.col(key) * 91 % 1000 * 0.0003})
    x, y = plane(F.col("lon"), F.col("lat"))
    return df.withColumns({"x": x, "y": y})


def announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, month, day, category, precision, k, lon, lat, x, y of every event."""
    e = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.date_format("ts", "yyyy-MM").alias("month"), F.to_date("ts").alias("day"), F.col("event_type").alias("category"),
        F.element_at(F.array(*map(F.lit, PRECISIONS)), (F.col("event_id") % 5 + 1).cast("int")).alias("precision"), F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
    return placed(e, "id")


#: The same in DuckDB, as the start of a query.
ANNOUNCED = """WITH base AS (SELECT event_id AS id, strftime(ts, '%Y-%m') AS month, CAST(ts AS DATE) AS day, event_type AS category,
 list_extract(['point','street','place','address','district'], CAST(event_id % 5 + 1 AS INT)) AS precision, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k,
 13.1::DOUBLE + (event_id * 37 % 1000) * 0.0005::DOUBLE AS lon, 52.35::DOUBLE + (event_id * 91 % 1000) * 0.0003::DOUBLE AS lat FROM events),
ann AS (SELECT *, (lon - 13.0::DOUBLE) * 67800 AS x, (lat - 52.0::DOUBLE) * 111200 AS y FROM base)"""


def placed_sql(name: str, table_sql: str, key: str) -> str:
    return f"""{name}_0 AS (SELECT *, 13.1::DOUBLE + ({key} * 37 % 1000) * 0.0005::DOUBLE AS lon, 52.35::DOUBLE + ({key} * 91 % 1000) * 0.0003::DOUBLE AS lat FROM {table_sql}),
{name} AS (SELECT *, (lon - 13.0::DOUBLE) * 67800 AS x, (lat - 52.0::DOUBLE) * 111200 AS y FROM {name}_0)"""


def cells_sql(name: str, rows: str, edge: float, dx: float = 0) -> str:
    """A table of ``rows`` with the cell (i, j) that grid.hex_cell gives."""
    h = f"(sqrt(3::DOUBLE) * {edge}::DOUBLE)"
    return f"""{name}_a AS (SELECT *, x + {dx} AS hx FROM {rows}),
{name}_b AS (SELECT *, CAST(round_even(hx / {1.5 * edge}::DOUBLE, 0) AS BIGINT) + unnest([-1, 0, 1]) AS ci FROM {name}_a),
{name}_c AS (SELECT *, ((ci % 2 + 2) % 2) / 2.0::DOUBLE AS odd FROM {name}_b),
{name}_d AS (SELECT *, CAST(round_even(y / {h} - odd, 0) AS BIGINT) + unnest([-1, 0, 1]) AS cj FROM {name}_c),
{name}_e AS (SELECT *, (hx - {1.5 * edge}::DOUBLE * ci) * (hx - {1.5 * edge}::DOUBLE * ci) + (y - {h} * (cj + odd)) * (y - {h} * (cj + odd)) AS d2 FROM {name}_d),
{name} AS (SELECT *, ci AS i, cj AS j FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, ci, cj) AS rn FROM {name}_e) WHERE rn = 1)"""
