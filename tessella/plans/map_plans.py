"""Grid, tile, scene and coverage queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import grid
from tessella.operators import gates, statistics
from tessella.sources.tables import ANNOUNCED, MAPPABLE, PRECISIONS, announcements, cells_sql, placed, placed_sql, table

UNCERTAIN = ("district", "borough", "street", "route", "area", "point", "address", "place", "unknown")


def month_hex(edge: float):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return statistics.hexagons(announcements(spark, sf_dir), edge, "month")

    sql = f"{ANNOUNCED}, {cells_sql('c', 'ann', edge)} SELECT month, i, j, count(*) AS count, count(*) FILTER (precision <> 'point') AS approximate_count, min(id) AS first_id FROM c GROUP BY ALL"
    return query, sql


def hex_category_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.hexagons(announcements(spark, sf_dir), 1100.0, "category").select("i", "j", "category", "count")


def hex_filtered_first_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published cells list some ids twice; of the ids that urgent orders choose each counts in its first cell alone."""
    chosen = table(spark, sf_dir, "orders").filter("o_orderpriority LIKE '1-%'").select(F.col("o_orderkey").alias("id"))
    rows = announcements(spark, sf_dir).join(chosen, "id", "left_semi")
    listed = rows.select("id", F.lit(0).alias("seq"), grid.hex_cell(F.col("x"), F.col("y"), 1100.0).alias("c")).union(rows.select("id", F.lit(1), grid.hex_cell(F.col("x") + 600, F.col("y"), 1100.0)))
    first = listed.groupBy("id").agg(F.min(F.struct("seq", "c.i", "c.j")).alias("f"))
    return first.groupBy("f.i", "f.j").agg(F.count("*").alias("count"))


def tile_cover_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx, ty = grid.tile(F.col("lon"), F.col("lat"))
    return announcements(spark, sf_dir).groupBy(tx.alias("tx"), ty.alias("ty")).agg(F.count("*").alias("count"), F.min("id").alias("first_id"))


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = placed(table(spark, sf_dir, "supplier"), "s_suppkey")
    return s.withColumns({"east": F.col("lon") + F.col("s_suppkey") % 7 * 0.01, "north": F.col("lat") + F.col("s_suppkey") % 5 * 0.01})


def tile_cover_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    cover = _boxes(spark, sf_dir).withColumn("t", F.explode(grid.tile_cover(F.col("lon"), F.col("lat"), F.col("east"), F.col("north"))))
    return cover.groupBy("t.tx", "t.ty").agg(F.count("*").alias("count"), F.min("s_suppkey").alias("first_id"))


def viewport_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each viewport the existing tiles it shows; none if it would show more than the bound."""
    n = F.col("n_nationkey")
    views = table(spark, sf_dir, "nation").select(n, (13.1 + n * 0.01).alias("w"), (52.35 + n * 0.005).alias("s"), (13.1 + n * 0.01 + (0.1 + n % 4 * 0.2)).alias("e"), (52.35 + n * 0.005 + 0.1).alias("n"))
    wanted = views.select("n_nationkey", F.explode(grid.tile_cover(F.col("w"), F.col("s"), F.col("e"), F.col("n"), grid.VIEWPORT_TILES)).alias("t")).select("n_nationkey", "t.tx", "t.ty")
    tx, ty = grid.tile(F.col("lon"), F.col("lat"))
    return wanted.join(announcements(spark, sf_dir).select(tx.alias("tx"), ty.alias("ty")).distinct(), ["tx", "ty"], "left_semi").select("n_nationkey", "tx", "ty")


def month_category_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return announcements(spark, sf_dir).filter("month = '2024-01' AND category = 'error'").select("id", "month", "category")


def scenes(rows: DataFrame) -> Column:
    """The scenes of an announcement: role, precision and whether it is the primary one."""
    role = F.array(*map(F.lit, ("incident", "arrest", "accident")))
    precision = F.array(*map(F.lit, PRECISIONS))
    return F.transform(F.sequence(F.lit(0), F.col("k") % 4), lambda n: F.struct(
        F.element_at(role, ((F.col("k") + n) % 3 + 1).cast("int")).alias("role"), F.element_at(precision, ((F.col("id") + n) % 5 + 1).cast("int")).alias("precision"), (n == F.col("k") % 5).alias("main")))


def countable(all_scenes: Column) -> Column:
    """At least one primary scene of an incident or accident with a precision that maps: an announcement counts once or not at all."""
    return F.exists(all_scenes, lambda s: s.main & s.role.isin("incident", "accident") & s.precision.isin(*MAPPABLE))


def countable_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = announcements(spark, sf_dir).withColumn("s", scenes(announcements(spark, sf_dir)))
    rows = rows.withColumns({"ok": countable(F.col("s")), "shown": F.exists("s", lambda s: s.precision.isin(*MAPPABLE))})
    return rows.groupBy("month").agg(F.count("*").alias("records"), F.count_if("ok").alias("countable"), F.count_if(~F.col("ok")).alias("without_point"), F.count_if(~F.col("ok") & F.col("shown")).alias("without_point_but_shown"))


COVERAGE_SQL = f"""{ANNOUNCED}, s AS (SELECT id, month, k, unnest(range(0, k % 4 + 1)) AS n FROM ann),
t AS (SELECT id, month, list_extract(['incident','arrest','accident'], CAST((k + n) % 3 + 1 AS INT)) AS role, list_extract(['point','street','place','address','district'], CAST((id + n) % 5 + 1 AS INT)) AS precision, n = k % 5 AS main FROM s),
a AS (SELECT id, month, bool_or(main AND role <> 'arrest' AND precision <> 'district') AS ok, bool_or(precision <> 'district') AS shown FROM t GROUP BY id, month)
SELECT month, count(*) AS records, count(*) FILTER (ok) AS countable, count(*) FILTER (NOT ok) AS without_point, count(*) FILTER (NOT ok AND shown) AS without_point_but_shown FROM a GROUP BY month"""


def uncertainty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, index, kind) of scenes that are not precise."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.posexplode(F.sequence(F.lit(0), F.col("doc_id") % 3)).alias("index", "n"))
    p = F.element_at(F.array(*map(F.lit, UNCERTAIN)), ((F.col("id") + F.col("n")) % 9 + 1).cast("int"))
    kind = F.when(p.isin("district", "borough", "city"), "district").when(p.isin("street", "route", "road", "line"), "street").when(p.isin("area", "region"), "area").when(p.isin("point", "address", "exact", "place"), "venue_reference").otherwise("no_location")
    return d.select("id", F.col("index").cast("bigint").alias("index"), kind.alias("kind")).filter("kind <> 'venue_reference'")


UNCERTAIN_SQL = """WITH d AS (SELECT doc_id AS id, unnest(range(0, doc_id % 3 + 1)) AS "index" FROM documents),
p AS (SELECT id, "index", list_extract(['district','borough','street','route','area','point','address','place','unknown'], CAST((id + "index") % 9 + 1 AS INT)) AS p FROM d),
u AS (SELECT id, "index", CASE WHEN p IN ('district','borough') THEN 'district' WHEN p IN ('street','route') THEN 'street' WHEN p = 'area' THEN 'area' WHEN p = 'unknown' THEN 'no_location' ELSE 'venue_reference' END AS kind FROM p)"""


def uncertainty_kind_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uncertainty(spark, sf_dir).groupBy("kind").agg(F.countDistinct("id").alias("announcements"), F.count("*").alias("scenes"))


def page_of(rows: DataFrame, order: list[str], page: int, size: int = 20) -> DataFrame:
    """One page in a total order: a top-k of the pages so far, then its tail."""
    size = min(max(size, 1), 50)
    return rows.orderBy(*order).offset((page - 1) * size).limit(size)


def uncertainty_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_of(uncertainty(spark, sf_dir).filter("kind = 'street'"), ["id", "index"], 2)


def publication_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = announcements(spark, sf_dir)
    coverage = a.agg(F.count("*").alias("fetched"), F.count_if(F.expr("k = 0")).alias("pending"), F.lit(0).alias("failed"), F.count_if(F.expr("precision <> 'district'")).alias("mapped"), F.count_if(F.expr("precision = 'district' AND k > 0")).alias("unlocated"), F.count("month").alias("monthly"), (F.count("*") + 1).alias("previous_fetched"))
    return gates.publication_problems(coverage)


def location_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announcements whose point moved by more than 100 m."""
    old = announcements(spark, sf_dir).select("id", "x", "y")
    new = old.select("id", (F.col("x") + F.col("id") % 10 * 20).alias("nx"), (F.col("y") + F.col("id") % 7 * 20).alias("ny")).filter("id % 13 <> 0")
    d2 = (F.col("nx") - F.col("x")) * (F.col("nx") - F.col("x")) + (F.col("ny") - F.col("y")) * (F.col("ny") - F.col("y"))
    return old.join(new, "id", "left").select("id", F.when(F.col("nx").isNull(), "withdrawn").when(d2 > 10000, "moved").alias("change")).filter("change IS NOT NULL")


OVERVIEW, OVERVIEW_SQL = month_hex(grid.HEX_EDGES["overview"])
DETAIL, DETAIL_SQL = month_hex(grid.HEX_EDGES["detail"])
_TILE = "CAST(floor(lon / 0.04::DOUBLE) AS BIGINT) AS tx, CAST(floor(lat / 0.025::DOUBLE) AS BIGINT) AS ty"

QUERIES = {
    "month_hex_overview": (OVERVIEW, OVERVIEW_SQL),
    "month_hex_detail": (DETAIL, DETAIL_SQL),
    "hex_category_histogram": (hex_category_histogram, f"{ANNOUNCED}, {cells_sql('c', 'ann', 1100.0)} SELECT i, j, category, count(*) AS count FROM c GROUP BY ALL"),
    "hex_filtered_first_cell": (hex_filtered_first_cell, f"{ANNOUNCED}, {cells_sql('c', 'ann', 1100.0)} SELECT i, j, count(*) AS count FROM c WHERE id IN (SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '1-%') GROUP BY ALL"),
    "tile_cover_points": (tile_cover_points, f"{ANNOUNCED} SELECT {_TILE}, count(*) AS count, min(id) AS first_id FROM ann GROUP BY ALL"),
    "tile_cover_bbox": (tile_cover_bbox, f"""WITH {placed_sql('s', 'supplier', 's_suppkey')}, b AS (SELECT *, lon + s_suppkey % 7 * 0.01::DOUBLE AS east, lat + s_suppkey % 5 * 0.01::DOUBLE AS north FROM s),
a AS (SELECT *, unnest(range(CAST(floor(lon / 0.04::DOUBLE) AS BIGINT), CAST(floor(east / 0.04::DOUBLE) AS BIGINT) + 1)) AS tx FROM b), t AS (SELECT *, unnest(range(CAST(floor(lat / 0.025::DOUBLE) AS BIGINT), CAST(floor(north / 0.025::DOUBLE) AS BIGINT) + 1)) AS ty FROM a)
SELECT tx, ty, count(*) AS count, min(s_suppkey) AS first_id FROM t GROUP BY ALL"""),
    "viewport_tiles": (viewport_tiles, f"""{ANNOUNCED}, v AS (SELECT n_nationkey, 13.1::DOUBLE + n_nationkey * 0.01::DOUBLE AS w, 52.35::DOUBLE + n_nationkey * 0.005::DOUBLE AS s, 13.1::DOUBLE + n_nationkey * 0.01::DOUBLE + (0.1::DOUBLE + n_nationkey % 4 * 0.2::DOUBLE) AS e, 52.35::DOUBLE + n_nationkey * 0.005::DOUBLE + 0.1::DOUBLE AS n FROM nation),
q AS (SELECT n_nationkey, CAST(floor(w / 0.04::DOUBLE) AS BIGINT) AS x0, CAST(floor(e / 0.04::DOUBLE) AS BIGINT) AS x1, CAST(floor(s / 0.025::DOUBLE) AS BIGINT) AS y0, CAST(floor(n / 0.025::DOUBLE) AS BIGINT) AS y1 FROM v),
a AS (SELECT DISTINCT {_TILE} FROM ann) SELECT n_nationkey, tx, ty FROM q JOIN a ON tx BETWEEN x0 AND x1 AND ty BETWEEN y0 AND y1 WHERE (x1 - x0 + 1) * (y1 - y0 + 1) <= 64"""),
    "month_category_filter": (month_category_filter, f"{ANNOUNCED} SELECT id, month, category FROM ann WHERE month = '2024-01' AND category = 'error'"),
    "countable_coverage": (countable_coverage, COVERAGE_SQL),
    "uncertainty_kind_stats": (uncertainty_kind_stats, UNCERTAIN_SQL + " SELECT kind, count(DISTINCT id) AS announcements, count(*) AS scenes FROM u WHERE kind <> 'venue_reference' GROUP BY kind"),
    "uncertainty_page": (uncertainty_page, UNCERTAIN_SQL + """ SELECT id, "index", kind FROM u WHERE kind = 'street' ORDER BY id, "index" LIMIT 20 OFFSET 20"""),
    "publication_gate": (publication_gate, f"""{ANNOUNCED}, c AS (SELECT count(*) AS fetched, count(*) FILTER (k = 0) AS pending, count(*) FILTER (precision <> 'district') AS mapped, count(*) FILTER (precision = 'district' AND k > 0) AS unlocated, count(month) AS monthly FROM ann)
SELECT 'source backlog or errors' AS problem FROM c WHERE pending > 0 UNION ALL SELECT 'mapped and unlocated do not add up to fetched' FROM c WHERE mapped + unlocated <> fetched UNION ALL SELECT 'months do not add up to fetched' FROM c WHERE monthly <> fetched UNION ALL SELECT 'fewer reports than published before' FROM c WHERE fetched < fetched + 1"""),
    "location_changes": (location_changes, f"""{ANNOUNCED}, n AS (SELECT id, x + id % 10 * 20 AS nx, y + id % 7 * 20 AS ny FROM ann WHERE id % 13 <> 0),
c AS (SELECT a.id, CASE WHEN nx IS NULL THEN 'withdrawn' WHEN (nx - x) * (nx - x) + (ny - y) * (ny - y) > 10000 THEN 'moved' END AS change FROM ann a LEFT JOIN n ON a.id = n.id) SELECT id, change FROM c WHERE change IS NOT NULL"""),
}
