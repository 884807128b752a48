"""Places from map objects: what they are, how they are drawn, and why others are left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.operators import lines
from tessella.session import cut

#: Kinds whose outline is their footprint, and those of them that a point can't stand for.
FOOTPRINTS, NO_CIRCLE = ("station", "airport", "park", "parking", "marketplace", "shop", "attraction", "context"), ("station", "airport")


def drawn(objects: DataFrame) -> DataFrame:
    """``objects`` (kind, shape, context_line) with ``mode``, how an object is drawn, or ``rejected``, why it isn't.

    ``shape`` is point, area, line or null (no usable geometry). An object without a kind is no place: both are null. A line is drawn only if it is a
    reviewed context line. An area of a kind with a footprint is its own; stations and airports without one stay without; everything else is a circle of 50 m.
    """
    area = F.col("shape") == "area"
    reason = F.when(F.col("shape").isNull(), "missing_or_unsupported_geometry").when((F.col("shape") == "line") & ~F.coalesce("context_line", F.lit(False)), "unsupported_native_line")
    mode = F.when(F.col("shape") == "line", "native_line_reference").when(F.col("kind").isin(*FOOTPRINTS) & area, "osm_footprint").when(F.col("kind").isin(*NO_CIRCLE), "footprint_missing").otherwise("50m_circle")
    known = F.col("kind").isNotNull()
    return objects.withColumn("rejected", F.when(known, reason)).withColumn("mode", F.when(known & F.col("rejected").isNull(), mode))


def built(objects: DataFrame, edges: DataFrame, side: float) -> tuple[DataFrame, DataFrame]:
    """(places, rejections) of ``objects`` (id, seq, node, kind, name, variant, shape, context_line, x, y) and the ``edges`` (id, x1, y1, x2, y2) of areas.

    A node within a footprint of its kind, name and variant (nulls are equal) is an alias of the first such area by ``seq`` and no place of its own. places: id, kind, name, mode, x, y
    and the sorted ``aliases``. rejections: (rejected, objects), counts by reason. Ids are unique; objects without coordinates are places where they have a mode, but no node's duplicate.
    """
    all_drawn = cut(drawn(objects), "build-drawn")
    areas = all_drawn.filter("mode = 'osm_footprint'").select(F.col("id").alias("area"), F.col("seq").alias("area_seq"), F.col("kind").alias("_k"), F.col("name").alias("_n"), F.col("variant").alias("_v"))
    nodes = all_drawn.filter("node AND mode IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL")
    outlines = edges.withColumnRenamed("id", "area").join(areas.select("area"), "area", "left_semi")
    # Nodes at one spot that are alike have one answer; only a node that is an area itself is asked for alone.
    alike = ["x", "y", "kind", "name", "variant", "own"]
    nodes = nodes.withColumn("own", F.when(F.col("mode") == "osm_footprint", F.col("id")))
    spots = nodes.groupBy(*alike).agg(F.min("id").alias("spot"))
    same = F.col("kind").eqNullSafe(F.col("_k")) & F.col("name").eqNullSafe(F.col("_n")) & F.col("variant").eqNullSafe(F.col("_v")) & ~F.col("own").eqNullSafe(F.col("area"))
    first = lines.inside(spots, outlines, "spot", "area", side).join(spots, "spot").join(areas, "area").filter(same).groupBy(*alike).agg(F.min(F.struct("area_seq", "area")).alias("first"))
    first = first.select(*[F.col(c).alias(f"_{c}") for c in alike], "first.area")
    meets = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in alike]
    twins = nodes.join(first, meets).select("id", "area")
    twins = cut(twins, "build-twins")
    aliases = twins.groupBy(F.col("area").alias("id")).agg(F.array_sort(F.collect_list("id")).alias("aliases"))
    places = all_drawn.filter("mode IS NOT NULL").join(twins, "id", "left_anti").join(aliases, "id", "left").select("id", "kind", "name", "mode", "x", "y", F.coalesce("aliases", F.array().cast(aliases.schema["aliases"].dataType)).alias("aliases"))
    reasons = all_drawn.filter("rejected IS NOT NULL").select("rejected").unionByName(twins.select(F.lit("duplicate_node_in_way").alias("rejected")))
    return places, reasons.groupBy("rejected").agg(F.count("*").alias("objects"))
