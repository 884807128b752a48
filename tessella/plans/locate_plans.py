"""Reports located: texts that name roads, places and numbers, and the ladder of outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import mentions as m
from tessella.functions import text as tx
from tessella.operators import followups as fu
from tessella.operators import locate
from tessella.plans import geometry_plans as g
from tessella.plans import mention_plans as mp
from tessella.sources.tables import placed, placed_sql, table

#: Bodies of reports: A and B are roads, P is a place, N a number.
BODIES = (
    "tatort: A. später floh er.", "ein mann wurde in der A und in der B beraubt.", "am P wurde eingebrochen.", "in der A N kam es zu einem raub.", "hinweise nimmt die wache in der A entgegen.", "in der A überprüften beamte viele fahrzeuge bei kontrollen. man leitete strafverfahren ein.",
    "tatort: A. tatort: B.", "es war ein ruhiger abend.", "in der A wurde er beraubt. in der B wurde sie geschlagen.", "tatort: A / B. danach nahmen beamte ihn in der A fest.", "in der A und am P wurde gestohlen.", "er lief zur wache. am P sass er.",
)
TITLE = "bilanz der verkehrswoche"


def _filled(template: F.Column) -> F.Column:
    parts = {"A": F.concat(F.lit("ringweg "), F.col("a")), "B": F.concat(F.lit("ringweg "), F.col("b")), "P": F.concat(F.lit("haus "), F.col("p")), "N": F.col("n").cast("string")}
    for mark, value in parts.items():
        template = F.replace(template, F.lit(mark), value)
    return template


def located_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where reports, one for each order, take place: their roads and places are those of the order's customer, and a road near by."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.expr("o_custkey div 2").alias("r"), F.expr("o_custkey div 3").alias("p"), (k % 9).alias("n"))
    near = (k % 24 < 16).cast("int")
    o = o.withColumns({"a": F.when(near == 1, F.col("r") - F.col("r") % 5 + 3).otherwise(F.col("r")), "b": F.when(near == 1, F.col("r") - F.col("r") % 5 + 4).otherwise(F.col("r") + 7)})
    body = _filled(F.element_at(F.array(*map(F.lit, BODIES)), (k % len(BODIES) + 1).cast("int")))
    reports = o.select(k.alias("id"), F.when(k % len(BODIES) == 5, TITLE).otherwise("meldung").alias("title"), body.alias("body"))

    named = lambda df, c: df.withColumn(c, F.concat(F.lit("ringweg "), c))
    roads = named(g.street_points(spark, sf_dir), "road").select(F.col("road").alias("name"), "outcome", "x", "y")

    def junctions(pairs):
        """Names are ordered as text, roads as numbers."""
        a, b = (F.replace(c, F.lit("ringweg ")).cast("bigint") for c in ("road", "other"))
        j = named(named(g.road_junctions(spark, sf_dir, pairs.select(F.least(a, b).alias("road"), F.greatest(a, b).alias("other"))), "road"), "other")
        return j.select(F.least("road", "other").alias("road"), F.greatest("road", "other").alias("other"), "x", "y")

    members = table(spark, sf_dir, "customer").select("c_custkey")
    places = g.place_groups(spark, sf_dir).join(placed(members, "c_custkey").select(F.col("c_custkey").alias("stands"), "x", "y"), "stands", "left").select(F.concat(F.lit("haus "), "name").alias("name"), "outcome", "x", "y")
    addresses = placed(members, "c_custkey").groupBy(F.concat(F.lit("ringweg "), F.expr("c_custkey div 2")).alias("name"), (F.col("c_custkey") % 9).alias("number")).agg(F.min(F.struct("x", "y")).alias("q")).select("name", "number", "q.x", "q.y")
    gazetteer = roads.select("name", F.lit("street").alias("kind")).union(places.select("name", F.lit("place").alias("kind")))
    found = locate.located(reports, gazetteer, roads, junctions, places, addresses)
    return found.select("id", "method", "label", *[F.round(c, 3).alias(c) for c in "xy"])


_TESTS = m.TESTS["locative"]

_SQL = f"""WITH {placed_sql('cu', 'customer', 'c_custkey')},
rd AS (SELECT 'ringweg ' || road AS name, outcome, x, y FROM ({g.QUERIES['street_points'][1]})),
jn AS (SELECT least('ringweg ' || road, 'ringweg ' || other) AS road, greatest('ringweg ' || road, 'ringweg ' || other) AS other, x, y FROM ({g.QUERIES['road_junctions'][1]})),
pl AS (SELECT 'haus ' || pg.name AS name, outcome, x, y FROM ({g.QUERIES['place_groups'][1]}) pg LEFT JOIN cu ON c_custkey = stands),
ad AS (SELECT 'ringweg ' || (c_custkey // 2) AS name, CAST(c_custkey % 9 AS VARCHAR) AS number, min(struct_pack(x := x, y := y)) AS q FROM cu GROUP BY ALL),
ga AS (SELECT name, 'street' AS kind FROM rd UNION ALL SELECT name, 'place' FROM pl),
od AS (SELECT o_orderkey AS id, o_custkey // 2 AS r, o_custkey // 3 AS p, o_orderkey % 9 AS n, o_orderkey % 24 < 16 AS near FROM orders),
bo AS (SELECT id, CASE WHEN id % {len(BODIES)} = 5 THEN '{TITLE}' ELSE 'meldung' END AS title, replace(replace(replace(replace(list_extract({mp._list(BODIES)}, CAST(id % {len(BODIES)} + 1 AS INT)), 'A', 'ringweg ' || CASE WHEN near THEN r - r % 5 + 3 ELSE r END), 'B', 'ringweg ' || CASE WHEN near THEN r - r % 5 + 4 ELSE r + 7 END), 'P', 'haus ' || p), 'N', CAST(n AS VARCHAR)) AS body FROM od),
se AS (SELECT id, nr, s || CASE WHEN s LIKE '%.' THEN '' ELSE '.' END AS s FROM (SELECT id, unnest(string_split(body, '. ')) AS s, unnest(range(len(string_split(body, '. ')))) AS nr FROM bo)),
sp AS (SELECT id, nr, s, string_split_regex(s, '(ringweg|haus) [0-9]+') AS gaps, regexp_extract_all(s, '(ringweg|haus) [0-9]+') AS ns FROM se),
me AS (SELECT id, nr, s, ns[k] AS name, length(array_to_string(gaps[1 : k], '')) + length(array_to_string(ns[1 : k - 1], '')) AS start FROM (SELECT *, unnest(range(1, len(ns) + 1)) AS k FROM sp)),
mg AS (SELECT me.*, kind FROM me JOIN ga USING (name)),
h AS (SELECT id, nr, start, kind, {mp.replaced('substr(s, 1, start)')} AS lead, name, {mp.replaced('substr(s, start + length(name) + 1)')} AS rest FROM mg),
{mp.CLAUSES_SQL}, {mp.CUES_SQL},
ca AS (SELECT *, CASE WHEN headed THEN 0 WHEN act THEN 1 ELSE 2 END AS sort FROM (SELECT *, {mp.ROLE_SQL} AS role FROM q) WHERE role = 'primary' AND ({mp.condition_sql(_TESTS)})),
be AS (SELECT id, min(struct_pack(sort := sort, nr := nr)) AS b FROM ca GROUP BY id),
sc AS (SELECT ca.* FROM ca JOIN be ON ca.id = be.id AND ca.sort = b.sort AND ca.nr = b.nr),
ot AS (SELECT DISTINCT ca.id, ca.name FROM ca JOIN be ON ca.id = be.id AND ca.sort = b.sort AND ca.nr <> b.nr WHERE ca.sort < 2 AND NOT EXISTS (SELECT 1 FROM sc WHERE sc.id = ca.id AND sc.name = ca.name)),
si AS (SELECT id, min(struct_pack(start := start, name := name)).name AS site FROM sc WHERE kind = 'place' GROUP BY id),
st AS (SELECT id, count(DISTINCT name) AS many, string_agg(DISTINCT name, ' / ' ORDER BY name) AS streets, min(struct_pack(start := start, name := name, rest := rest)) AS s FROM sc WHERE kind = 'street' GROUP BY id),
jp AS (SELECT DISTINCT a.id, a.name AS road, b.name AS other FROM sc a JOIN sc b ON a.id = b.id AND a.kind = 'street' AND b.kind = 'street' AND a.name < b.name),
jm AS (SELECT id, bool_and(x IS NOT NULL) AND greatest(max(x) - min(x), max(y) - min(y)) <= 75 AS meet, min(struct_pack(road := road, other := other, x := x, y := y)) AS j FROM jp LEFT JOIN jn USING (road, other) GROUP BY id),
ow AS (SELECT st.id AS sid, si.id AS pid, coalesce(st.id, si.id) AS id, site, pl.outcome AS place, pl.x AS px, pl.y AS py, many, streets, meet, j, s.name AS street, rd.outcome AS road, rd.x AS rx, rd.y AS ry, q FROM st FULL JOIN si ON st.id = si.id LEFT JOIN pl ON pl.name = site LEFT JOIN jm ON jm.id = st.id LEFT JOIN rd ON many = 1 AND rd.name = s.name LEFT JOIN ad ON many = 1 AND ad.name = s.name AND ad.number = regexp_extract(s.rest, '^ ([0-9]+)', 1)),
o1 AS (SELECT id, CASE WHEN place = 'place' THEN 'named_place_representative' WHEN place IS NOT NULL THEN place || '_place_review' WHEN many > 4 THEN 'multiple_roads_review' WHEN many > 1 AND meet THEN 'named_street_intersection' WHEN many > 1 THEN 'junction_geometry_review' WHEN q IS NOT NULL THEN 'address_point' WHEN road = 'located' THEN 'street_representative' WHEN road = 'disconnected' THEN 'disconnected_street_review' ELSE 'long_or_ambiguous_street_review' END AS method,
 CASE WHEN place IS NOT NULL THEN site WHEN many > 1 THEN streets ELSE street END AS label, CASE WHEN place = 'place' THEN px WHEN place IS NOT NULL THEN NULL WHEN many > 1 THEN CASE WHEN meet THEN j.x END WHEN q IS NOT NULL THEN q.x WHEN road = 'located' THEN rx END AS x, CASE WHEN place = 'place' THEN py WHEN place IS NOT NULL THEN NULL WHEN many > 1 THEN CASE WHEN meet THEN j.y END WHEN q IS NOT NULL THEN q.y WHEN road = 'located' THEN ry END AS y FROM ow),
pt AS (SELECT name, x, y FROM rd WHERE x IS NOT NULL UNION ALL SELECT name, x, y FROM pl WHERE x IS NOT NULL),
cf AS (SELECT ot.id, NOT bool_and(coalesce((o1.x - pt.x) ** 2 + (o1.y - pt.y) ** 2 <= 62500, false)) AS conflict FROM ot JOIN o1 ON ot.id = o1.id LEFT JOIN pt ON pt.name = ot.name GROUP BY ot.id),
fi AS (SELECT bo.id, CASE WHEN {mp._like('title', m.REVIEW)} AND {mp._like('title', m.THEMES)} AND {mp._like(mp.replaced('body'), m.COUNTED)} AND {mp._like('body', m.CONTROLS)} AND {mp._like('body', m.OFFENCES)} THEN 'multi_event_summary' WHEN len(regexp_extract_all(body, '\\b(tatort|unfallort|ort):')) > 1 THEN 'multiple_official_scenes' WHEN NOT EXISTS (SELECT 1 FROM mg WHERE mg.id = bo.id) THEN 'unmatched' WHEN o1.id IS NULL THEN 'no_scene_mention' WHEN conflict THEN 'conflicting_explicit_scenes' END AS early, o1.method, label, x, y FROM bo LEFT JOIN o1 ON o1.id = bo.id LEFT JOIN cf ON cf.id = bo.id)
SELECT id, coalesce(early, method) AS method, CASE WHEN early IS NULL THEN label END AS label, round(CASE WHEN early IS NULL THEN x END, 3) AS x, round(CASE WHEN early IS NULL THEN y END, 3) AS y FROM fi"""

#: Titles and bodies of reports on cases; T is a time.
CASE_TITLES = ("mord in der nacht", "festnahme nach mord", "vermisstenfahndung nach einem kind", "erledigung der vermisstenfahndung", "unfall auf der brücke", "mann verstirbt nach verkehrsunfall", "haftbefehl nach schussabgabe", "schussabgabe auf ein haus", "polizei nimmt räuber nach tötungsdelikt fest", "fest im park")
CASE_BODIES = ("tatzeit: T uhr.", "hinweise auf straftaten liegen nicht vor.", "er erlag seinen wunden.", "tatzeit: T uhr, 02.02.2024, 11:00 uhr.", "verstoss gegen das waffengesetz, T uhr.", "es gab verdacht auf illegalen aufenthalt.", "")


def case_followups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as reports, each linked to earlier ones of its customer: which only carry on a case, and why."""
    k = F.col("o_orderkey")
    pick = lambda values, by: F.element_at(F.array(*map(F.lit, values)), F.expr(f"int({by} % {len(values)}) + 1"))
    time = F.concat(F.lit("01.01.2024, 1"), (k % 4).cast("string"), F.lit(":00"))
    reports = table(spark, sf_dir, "orders").select(k.alias("id"), "o_custkey", pick(CASE_TITLES, "(o_orderkey * 7 + o_custkey)").alias("title"), F.replace(pick(CASE_BODIES, "(o_orderkey * 5 + o_custkey)"), F.lit("T"), time).alias("body"), F.when(k % 3 > 0, F.col("o_orderpriority")).alias("district"))
    # A report refers to the last three of the same customer: places in order, not all pairs.
    order = "OVER (PARTITION BY o_custkey ORDER BY id)"
    links = reports.select("id", F.array(*[F.expr(f"lag(id, {n}) {order}") for n in (1, 2, 3)]).alias("refs")).select("id", F.explode("refs").alias("ref")).filter("ref IS NOT NULL")
    return fu.followups(reports.drop("o_custkey"), links)


def _case_sql() -> str:
    has = lambda column, pattern: mp._like(column, pattern)
    plain = mp.replaced
    signatures = "list_filter([" + ", ".join(f"CASE WHEN {has('title', p)} THEN '{n}' END" for n, p in tx.SIGNATURES) + "], lambda x: x IS NOT NULL)"
    return rf"""WITH o AS (SELECT o_orderkey AS id, o_custkey AS c, {plain(mp._pick_sql(CASE_TITLES, 'o_orderkey * 7 + o_custkey'))} AS title, {plain(f"replace({mp._pick_sql(CASE_BODIES, 'o_orderkey * 5 + o_custkey')}, 'T', '01.01.2024, 1' || o_orderkey % 4 || ':00')")} AS body, CASE WHEN o_orderkey % 3 > 0 THEN lower(o_orderpriority) ELSE '' END AS area FROM orders),
g AS (SELECT id, c, area, {has('title', fu.SEARCH)} AS search, {has('title', fu.SEARCH_OVER)} AND {has('body', fu.NO_OFFENCE)} AS search_over, {has('title', fu.ACCIDENT)} AS accident, {has('title', fu.DEATH_AFTER)} AND {has('body', fu.DIED)} AS died, {has('title', fu.UPDATE)} AND NOT {has('body', fu.OTHER_OFFENCE)} AS upd, {signatures} AS sg, list_distinct(regexp_extract_all(body, '\b(\d{{2}}\.\d{{2}}\.\d{{4}},?\s*\d{{1,2}}:\d{{2}})\b', 1)) AS tm FROM o),
l AS (SELECT id, unnest([lag(id, 1) OVER w, lag(id, 2) OVER w, lag(id, 3) OVER w]) AS ref FROM o WINDOW w AS (PARTITION BY c ORDER BY id)),
j AS (SELECT l.id, l.ref, CASE WHEN n.search_over AND b.search THEN 'missing_search' WHEN n.died AND b.accident THEN 'traffic_death' WHEN n.upd AND list_has_any(n.sg, b.sg) AND NOT (len(b.tm) > 0 AND len(n.tm) > len(b.tm) AND NOT list_has_all(b.tm, n.tm)) AND (list_has_any(n.tm, b.tm) OR (n.area <> '' AND n.area = b.area)) THEN 'case_update' END AS kind FROM (SELECT DISTINCT * FROM l WHERE ref IS NOT NULL) l JOIN g n ON n.id = l.id JOIN g b ON b.id = l.ref)
SELECT * FROM j WHERE kind IS NOT NULL"""


QUERIES = {"located_reports": (located_reports, _SQL), "case_followups": (case_followups, _case_sql())}
