"""From the text of a report to one point: mentions, the scene among them, and the ladder of outcomes, as joins.

What names stand for (roads, junctions, places, addresses) is worked out once for the whole gazetteer; a report then only joins it. Nothing is guessed: a report
without one scene, or whose scene has no one place, gets the name of the reason and no point.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import mentions as m
from tessella.functions import text as tx
from tessella.operators import names
from tessella.session import cut

#: Metres beyond which two scenes are in conflict.
APART = 250.0


def mentioned(reports: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """(id, nr, start, name, kind, rest, role, locative, headed, act): names of the gazetteer (name, kind) in the sentences of reports (id, body), with their role and tests.

    ``name`` in the gazetteer is in normal form, words with blanks between; of one name, kinds may be several. ``rest`` is what follows the mention.
    """
    sentences = reports.select("id", F.posexplode(tx.sentences(F.col("body"))).alias("nr", "sentence")).withColumn("_key", F.concat_ws("|", "nr", "id"))
    sentences = cut(sentences, "locate-sentences")
    hits = names.dictionary_matches(sentences, "_key", "sentence", gazetteer.select("name").distinct()).withColumnRenamed("id", "_key")
    # The matcher's words are joined by blanks; their places are those of the sentence, which is in normal form already.
    found = hits.join(sentences, "_key").join(gazetteer.select("name", "kind").distinct(), "name")
    start, end = F.col("start").cast("int"), F.col("end").cast("int")
    told = m.told(F.col("sentence"), start, end)
    return found.select("id", "nr", "start", "name", "kind", F.substr("sentence", end + 1).alias("rest"), told.alias("t")).select("id", "nr", "start", "name", "kind", "rest", "t.*")


def scenes(mentions: DataFrame) -> DataFrame:
    """The mentions of each report's scene: those of its first sentence of the best sort. Headings come first, then sentences that tell of an act, then others.

    Only mentions with the role of a scene that say where something is count. ``conflict`` tells whether another sentence of the same sort, heading or act, names something else.
    """
    candidates = mentions.filter("role = 'primary' AND locative").withColumn("sort", F.when(F.col("headed"), 0).when(F.col("act"), 1).otherwise(2))
    best = candidates.groupBy("id").agg(F.min(F.struct("sort", "nr")).alias("b")).select("id", "b.sort", F.col("b.nr").alias("scene"))
    same = candidates.join(best, ["id", "sort"])
    here = same.filter("nr = scene").groupBy("id").agg(F.collect_set("name").alias("named"))
    other = same.filter("nr <> scene AND sort < 2").select("id", "name").distinct().join(here, "id").filter(~F.array_contains("named", F.col("name"))).select("id", F.col("name").alias("other")).distinct()
    return same.filter("nr = scene").select("id", "nr", "start", "name", "kind", "rest").join(other.groupBy("id").agg(F.collect_list("other").alias("others")), "id", "left")


def located(reports: DataFrame, gazetteer: DataFrame, roads: DataFrame, junctions: Callable[[DataFrame], DataFrame], places: DataFrame, addresses: DataFrame) -> DataFrame:
    """(id, method, label, x, y): for every report (id, title, body) the first outcome of the ladder that applies, with a point where there is one.

    ``gazetteer``: name, kind ("street" or "place"). ``roads``: name, outcome ("located", "long", "disconnected"), x, y. ``junctions``: a function of pairs of
    roads (road, other: names, road < other; each once) that gives those with a junction, with x and y, so that only pairs that reports name are worked out.
    ``places``: name, outcome ("place", "ambiguous", "wide"), x, y. ``addresses``: name, number, x, y, with one row each.

    In turn: a report of totals is ``multi_event_summary``; of several official headings, ``multiple_official_scenes``; without a known name, ``unmatched``; with names but no
    scene among them, ``no_scene_mention``; with another scene more than 250 m off (or of unknown place), ``conflicting_explicit_scenes``. A scene with a place is that place
    (``named_place_representative``), or ``ambiguous_place_review`` or ``wide_place_review``; with two to four roads, their one junction (``named_street_intersection``), or
    ``junction_geometry_review``; with more, ``multiple_roads_review``; with one road and a number after it, its address (``address_point``); else the road's point
    (``street_representative``), ``long_or_ambiguous_street_review`` or ``disconnected_street_review``. Ids are expected to be unique; null texts are empty.
    """
    title, body = tx.normalised(F.coalesce("title", F.lit(""))), tx.normalised(F.coalesce("body", F.lit("")))
    heads = F.regexp_count(body, F.lit(rf"(?U)\b{m.either(*m.LABELS)}:"))
    early = F.when(m.tells_totals(title, body), "multi_event_summary").when(heads > 1, "multiple_official_scenes")
    told = cut(mentioned(reports.select("id", F.coalesce("body", F.lit("")).alias("body")), gazetteer), "locate-mentions")
    scene = cut(scenes(told), "locate-scenes")

    points = roads.select("name", "x", "y").filter("x IS NOT NULL").unionByName(places.select("name", "x", "y").filter("x IS NOT NULL"))
    streets, sites = scene.filter("kind = 'street'"), scene.filter("kind = 'place'")
    one_site = sites.groupBy("id").agg(F.min(F.struct("start", "name")).alias("s")).select("id", F.col("s.name").alias("name")).join(places.select("name", F.col("outcome").alias("place"), F.col("x").alias("px"), F.col("y").alias("py")), "name").withColumnRenamed("name", "site")

    rows = streets.groupBy("id").agg(F.array_sort(F.collect_set("name")).alias("streets"), F.min(F.struct("start", "name", "rest")).alias("s"))
    pairs = rows.filter("size(streets) BETWEEN 2 AND 4").select("id", "streets", F.explode(F.expr("flatten(transform(streets, (a, i) -> transform(slice(streets, i + 2, 4), b -> named_struct('road', a, 'other', b))))")).alias("p")).select("id", "streets", "p.*")
    pairs = cut(pairs, "locate-pairs")
    met = pairs.join(junctions(pairs.select("road", "other").distinct()), ["road", "other"], "left").groupBy("id").agg(F.bool_and(F.col("x").isNotNull()).alias("all_meet"), (F.max("x") - F.min("x")).alias("dx"), (F.max("y") - F.min("y")).alias("dy"), F.min(F.struct("road", "other", "x", "y")).alias("j"))
    met = met.select("id", (F.col("all_meet") & (F.greatest("dx", "dy") <= 75)).alias("meet"), F.col("j.x").alias("jx"), F.col("j.y").alias("jy"))
    single = rows.filter("size(streets) = 1").select("id", F.col("s.name").alias("name"), F.regexp_extract("s.rest", r"^ (?:nr\. |nummer )?(\d+)", 1).alias("number"))
    single = single.join(roads.select("name", F.col("outcome").alias("road"), F.col("x").alias("rx"), F.col("y").alias("ry")), "name", "left").join(addresses.select("name", F.col("number").cast("string").alias("number"), F.col("x").alias("ax"), F.col("y").alias("ay")), ["name", "number"], "left").drop("number").withColumnRenamed("name", "street")

    everything = reports.select("id", early.alias("early")).join(told.select("id").distinct().withColumn("known", F.lit(True)), "id", "left").join(scene.groupBy("id").agg(F.first("others").alias("others")).withColumn("scene", F.lit(True)), "id", "left")
    for part in (one_site, rows.select("id", "streets"), met, single):
        everything = everything.join(part, "id", "left")
    placed = F.col("place").isNotNull()
    many = F.coalesce(F.size("streets"), F.lit(0))
    many = F.when(many < 0, 0).otherwise(many)
    own = (
        F.when(F.col("place") == "place", F.struct(F.lit("named_place_representative").alias("method"), F.col("site").alias("label"), F.col("px").alias("x"), F.col("py").alias("y")))
        .when(placed, _review(F.concat("place", F.lit("_place_review")), F.col("site")))
        .when(many > 4, _review(F.lit("multiple_roads_review"), F.array_join("streets", " / ")))
        .when((many > 1) & F.col("meet"), F.struct(F.lit("named_street_intersection").alias("method"), F.array_join("streets", " / ").alias("label"), F.col("jx").alias("x"), F.col("jy").alias("y")))
        .when(many > 1, _review(F.lit("junction_geometry_review"), F.array_join("streets", " / ")))
        .when(F.col("ax").isNotNull(), F.struct(F.lit("address_point").alias("method"), F.col("street").alias("label"), F.col("ax").alias("x"), F.col("ay").alias("y")))
        .when(F.col("road") == "located", F.struct(F.lit("street_representative").alias("method"), F.col("street").alias("label"), F.col("rx").alias("x"), F.col("ry").alias("y")))
        .when(F.col("road") == "disconnected", _review(F.lit("disconnected_street_review"), F.col("street")))
        .otherwise(_review(F.lit("long_or_ambiguous_street_review"), F.col("street")))
    )
    settled = cut(everything.select("id", "early", "known", "scene", "others", F.when(F.col("scene"), own).alias("o")), "locate-own")
    # Other scenes are in conflict unless they are known to lie near.
    apart = settled.filter("others IS NOT NULL").select("id", "o.x", "o.y", F.explode("others").alias("name")).join(points.select("name", F.col("x").alias("ox"), F.col("y").alias("oy")), "name", "left")
    near = F.coalesce((F.col("x") - F.col("ox")) ** 2 + (F.col("y") - F.col("oy")) ** 2 <= APART**2, F.lit(False))
    conflict = apart.groupBy("id").agg((~F.bool_and(near)).alias("conflict"))
    method = F.coalesce("early", F.when(F.col("known").isNull(), "unmatched"), F.when(F.col("scene").isNull(), "no_scene_mention"), F.when(F.col("conflict"), "conflicting_explicit_scenes"))
    final = settled.join(conflict, "id", "left").withColumn("method", method)
    kept = F.col("method").isNull()
    return final.select("id", F.coalesce("method", "o.method").alias("method"), F.when(kept, F.col("o.label")).alias("label"), F.when(kept, F.col("o.x")).alias("x"), F.when(kept, F.col("o.y")).alias("y"))


def _review(method: Column, label: Column) -> Column:
    """An outcome without a point."""
    nothing = F.lit(None).cast("double")
    return F.struct(method.alias("method"), label.alias("label"), nothing.alias("x"), nothing.alias("y"))
