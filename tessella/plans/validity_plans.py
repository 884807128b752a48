"""Predicates, dates, page scans and set operations as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import geo, predicates
from tessella.functions.text import escaped_xml, fingerprint
from tessella.sources.tables import ANNOUNCED, PRECISIONS, announcements, table

KINDS = ("Point", "LineString", "Polygon", "Blob")
CITIES, SCOPES = ("berlin", "hamburg", "koeln"), ("in_city", "mixed", "outside", "uncertain")
HEADINGS = ("Tatort: Hamburg-Altona, Weg 1", "Unfallort: Hamburg-Mitte", "Tatorte: Hamburg-Altona, Weg; Hamburg-ALTONA, Platz", "Orte: Hamburg-Altona; Hamburg-Harburg", "Zeit: gestern")


def _pick(values: tuple[str, ...], by: F.Column) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), (by % len(values) + 1).cast("int"))


def _sql_pick(values: tuple[str, ...], by: str) -> str:
    return f"list_extract([{', '.join(repr(v) for v in values)}], CAST({by} % {len(values)} + 1 AS INT))"


def _spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announcements, some with coordinates that no map has."""
    n = F.col("id")
    return announcements(spark, sf_dir).select("id", F.when(n % 11 == 0, float("nan")).when(n % 13 == 0, 190.0).when(n % 17 != 0, F.col("lon")).alias("lon"), F.when(n % 19 == 0, 90.0).when(n % 23 == 0, float("inf")).otherwise(F.col("lat")).alias("lat"))


SPOILED_SQL = f"{ANNOUNCED}, sp AS (SELECT id, CASE WHEN id % 11 = 0 THEN 'NaN'::DOUBLE WHEN id % 13 = 0 THEN 190 WHEN id % 17 <> 0 THEN lon END AS lon, CASE WHEN id % 19 = 0 THEN 90 WHEN id % 23 = 0 THEN 'Infinity'::DOUBLE ELSE lat END AS lat FROM ann)"
VALID_SQL = "(id % 11 <> 0 AND id % 13 <> 0 AND id % 17 <> 0 AND id % 19 <> 0 AND id % 23 <> 0)"


def coordinate_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spoiled(spark, sf_dir).select("id", predicates.valid_point(F.col("lon"), F.col("lat")).alias("valid"))


def geometry_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geometries of one to six points, some closed, by their kind."""
    n = F.col("id")
    rows = _spoiled(spark, sf_dir).withColumn("n", (n % 6 + 1).cast("int"))
    points = F.transform(F.sequence(F.lit(1), F.col("n")), lambda k: F.struct(F.when((k == F.col("n")) & (n % 4 != 0), F.col("lon")).otherwise(F.col("lon") + (k - 1) * 0.001).alias("lon"), F.col("lat").alias("lat")))
    return rows.select("id", _pick(KINDS, F.floor(n / 6)).alias("kind"), predicates.valid_geometry(_pick(KINDS, F.floor(n / 6)), points).alias("valid"))


def report_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    context = F.when(F.col("p_size") % 3 == 0, F.array("p_type", "p_brand"))
    return p.filter(predicates.of_kinds(F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(F.col("p_brand")), context, ("ECONOMY", "Brand#1"))).select("p_partkey")


def city_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles of three cities, by whether they belong to their city's map."""
    n = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id", _pick(CITIES, n).alias("city"), F.when(n % 7 != 0, _pick(SCOPES, F.floor(n / 3))).alias("scope"))
    return rows.filter(predicates.in_scope(F.col("scope"), F.col("city")))


def candidate_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announcements without a point whose reviewed candidate road may be drawn."""
    n = F.col("id")
    method = _pick((*predicates.ROAD_METHODS, "geocoded"), n)
    line = F.transform(F.sequence(F.lit(0), (n % 4).cast("int")), lambda k: F.struct((F.col("lon") + k * 0.001).alias("lon"), F.col("lat").alias("lat")))
    rows = _spoiled(spark, sf_dir).filter(method.isin(*predicates.ROAD_METHODS) & (n % 2 == 1) & predicates.valid_geometry(F.lit("LineString"), line))
    return rows.select("id", method.alias("method"), F.size(line).cast("bigint").alias("points"))


def public_stats_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each segment's figures by group of nations may be published (some are rounded up): every one 20 or more and a multiple of ten, no code twice, and no more in all than the total."""
    c = table(spark, sf_dir, "customer").groupBy("c_mktsegment", F.expr("c_nationkey div 5").alias("c_nationkey")).agg(F.count("*").alias("n"))
    shown = c.select("c_mktsegment", "c_nationkey", "n", F.when(F.col("c_mktsegment") < "C", F.ceil(F.col("n") / 10) * 10).otherwise(F.floor(F.col("n") / 10) * 10).alias("pv"))
    tests = [F.bool_and((F.col("pv") >= 20) & (F.col("pv") % 10 == 0)), F.count("*") == F.count_distinct("c_nationkey"), F.sum("pv") <= F.floor(F.sum("n") / 10) * 10]
    return shown.groupBy("c_mktsegment").agg(predicates.every(*tests).alias("public"), F.sum("pv").cast("bigint").alias("shown"))


def safe_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of pages, some with a user or a port."""
    n, u = F.col("page_id"), F.col("url")
    varied = F.when(n % 5 == 0, F.regexp_replace(u, "://", "://reader@")).when(n % 5 == 1, F.regexp_replace(u, "^(https?://[^/?]*)", "$1:443")).when(n % 5 == 2, F.regexp_replace(u, "^(https?://[^/?]*)", "$1:8443")).otherwise(u)
    return table(spark, sf_dir, "pages").select("page_id", predicates.safe_url(varied).alias("safe"))


def event_time_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report's month is that of its incidents where all of them have the same known day, else that of its publication."""
    days = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min(F.to_date("l_shipdate")).alias("first"), F.max(F.to_date("l_shipdate")).alias("last"), F.bool_and(F.col("l_quantity") <= 45).alias("known"))
    agreed = F.when((F.col("first") == F.col("last")) & F.col("known"), F.col("first"))
    orders = table(spark, sf_dir, "orders").join(days, "o_orderkey", "left")
    return orders.select("o_orderkey", F.date_format(F.coalesce(agreed, F.to_date("o_orderdate")), "yyyy-MM").alias("month"), F.when(agreed.isNotNull(), "incidents").otherwise("publication").alias("basis"))


def occurrence_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written with an offset, some marked as dates of a page's data; one without an offset is no time."""
    n = F.col("event_id")
    text = F.concat(F.when(n % 2 == 0, "$D").otherwise(""), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(n % 7 == 0, "").otherwise(_pick(("+00:00", "+01:00", "-02:30"), n)))
    at = F.try_to_timestamp(F.regexp_replace(text, r"^\$D", ""), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
    return table(spark, sf_dir, "events").select("event_id", F.unix_timestamp(at).alias("seconds"))


def publication_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.when(n % 3 == 0, "").when(n % 3 == 1, "T10:00:00+01:00").otherwise("T10:00:00"))
    kind = F.when((F.length(text) == 10) & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), "date").when(text.rlike(r"T\d\d:\d\d(:\d\d)?(Z|[+-]\d\d:\d\d)$"), "time").otherwise("unknown")
    return table(spark, sf_dir, "events").groupBy(kind.alias("published_as")).agg(F.count("*").alias("reports"))


def year_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of one year: the year's first letters as a range of the column, so that the filter reaches the scan."""
    day = F.col("o_orderdate")
    found = table(spark, sf_dir, "orders").filter((day >= F.expr("timestamp_ntz'1998-01-01'")) & (day < F.expr("timestamp_ntz'1999-01-01'")))
    return found.groupBy("o_orderpriority").agg(F.count("*").alias("reports"))


def distinct_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("bigint").alias("year")).distinct()


def distinct_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official addresses, a query aside, by host."""
    bare = F.regexp_replace("url", "[?#].*$", "")
    return table(spark, sf_dir, "pages").groupBy(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1).alias("host")).agg(F.count_distinct(bare).alias("urls"), F.count("*").alias("pages"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pages a listing has: the largest number that its links name, one at least."""
    n = F.col("page_id")
    html = F.concat("html", F.when(n % 3 > 0, F.concat(F.lit('<a href="?page_at_1_0='), n % 40, F.lit('">next</a><a href="?page_at_1_0='), n % 7, F.lit('">'))).otherwise(""))
    numbers = F.regexp_extract_all(html, F.lit(r"page_at_1_0=(\d+)"), F.lit(1)).cast("array<bigint>")
    return table(spark, sf_dir, "pages").select("page_id", F.greatest(F.lit(1), F.array_max(numbers)).cast("bigint").alias("pages"))


def embedded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that a page carries as JSON in one of its scripts."""
    n = F.col("page_id")
    rows = F.transform(F.sequence(F.lit(0), n % 4), lambda k: F.struct((n * 10 + k).alias("id"), (F.lit(48.0) + k / 8).alias("lat"), F.concat(F.lit("a ] b "), k).alias("label")))
    page = F.concat(F.regexp_replace("html", "</html>$", ""), F.lit("<script>self.next=1</script><script>var mapEvents = "), F.to_json(rows), F.lit(";</script></html>"))
    found = F.from_json(F.regexp_extract(page, r"(?s)<script>var mapEvents = (\[.*?\]);</script>", 1), "array<struct<id:bigint,lat:double,label:string>>")
    return table(spark, sf_dir, "pages").select("page_id", F.explode(found).alias("e")).select("page_id", "e.id", "e.lat", "e.label")


def _with_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("\n", F.coalesce("text", F.lit("")), _pick(HEADINGS, n)).alias("body"), F.when(n % 4 == 0, "").when(n % 4 > 1, "given").alias("district"))


def heading_district(body: F.Column) -> F.Column:
    """The district that a heading of the scene names; several count only if they agree."""
    lines = F.regexp_extract_all(body, F.lit(r"(?m)^((?:Tatort|Unfallort|Feststellort|Ort)e?: ?[^\n]*)$"), F.lit(1))
    named = F.flatten(F.transform(lines, lambda x: F.regexp_extract_all(x, F.lit(r"Hamburg-([^,;\n]+)"), F.lit(1))))
    lower = F.array_distinct(F.transform(named, lambda x: F.lower(F.trim(x))))
    return F.when(F.size(lower) == 1, F.trim(F.element_at(named, 1)))


def district_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_headings(spark, sf_dir).select("doc_id", heading_district(F.col("body")).alias("district"))


def district_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank districts are filled from the text, others never touched."""
    return _with_headings(spark, sf_dir).select("doc_id", F.coalesce(F.nullif(F.trim("district"), F.lit("")), heading_district(F.col("body"))).alias("district"))


def tile_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of two overlapping tiles, each once, from the first tile that has it."""
    p = table(spark, sf_dir, "part")
    both = p.filter("p_size <= 30").select("p_partkey", F.lit(1).alias("tile")).union(p.filter("p_size >= 20").select("p_partkey", F.lit(2)))
    return both.groupBy("p_partkey").agg(F.min("tile").cast("bigint").alias("tile"))


def signature_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures that a report shares with the one before it."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.split(F.concat_ws(" ", "p_name", "p_type"), " ").alias("s"))
    before = p.select((F.col("p_partkey") + 1).alias("p_partkey"), F.col("s").alias("t"))
    return p.join(before, "p_partkey").select("p_partkey", F.concat_ws(",", F.array_sort(F.array_intersect("s", "t"))).alias("shared")).filter("shared <> ''")


def existence_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether there is any row at all of some kinds; each probe stops at its first."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    probes = {"pending_order": orders.filter("o_orderstatus = 'P'"), "free_order": orders.filter("o_totalprice <= 0"), "returned_line": lines.filter("l_returnflag = 'R'"), "huge_line": lines.filter("l_quantity > 1000")}
    rows = [df.limit(1).agg(F.count("*").alias("n")).select(F.lit(name).alias("probe"), (F.col("n") > 0).alias("present")) for name, df in probes.items()]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3])


def locale_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations in the order of a locale, not of code points: case only breaks ties."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("name"))
    return n.select("name", F.expr("row_number() OVER (ORDER BY collate(name, 'UNICODE'), n_nationkey)").cast("bigint").alias("place"))


def merged_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed metadata fill the tags that an object lacks and never replace one."""
    tags = F.map_filter(F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("kind"), F.when(F.col("p_size") % 2 == 0, F.col("p_type"))), lambda _, v: v.isNotNull())
    merged = predicates.merged_absent(tags, F.create_map(F.lit("kind"), F.lit("reviewed"), F.lit("note"), F.col("p_name")))
    return table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(";", F.array_sort(F.transform(F.map_entries(merged), lambda e: F.concat_ws("=", e.key, e.value)))).alias("tags"))


def changed_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose list of line statuses, in order, differs from the list of the lines' return flags read as statuses."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_linestatus", "l_returnflag"))).alias("x"))
    return lines.select("l_orderkey", (F.transform("x", lambda e: e.l_linestatus) == F.transform("x", lambda e: F.when(e.l_returnflag == "N", "O").otherwise("F"))).alias("same"))


def xml_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat(F.lit("<b title='"), "p_name", F.lit("'>R&D \""), "p_brand", F.lit('"</b>'))
    return table(spark, sf_dir, "part").select("p_partkey", escaped_xml(label).alias("label"))


def row_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical hashes of rows: equal for equal rows, nulls told from empty texts."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("priority"))
    return o.select("o_orderkey", fingerprint("o_orderkey", "priority").alias("sha256"))


def utm_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announcements in UTM zone 33, to a millimetre."""
    east, north = geo.utm(F.col("lon"), F.col("lat"), 33)
    return announcements(spark, sf_dir).select("id", F.round(east, 3).alias("east"), F.round(north, 3).alias("north"))


def _utm_sql() -> str:
    """Krüger's series written out for the other engine, which has no hyperbolic functions of its own."""
    radius, c = geo._series(False)
    e = (geo.F84 * (2 - geo.F84)) ** 0.5
    sinh, cosh = (lambda x: f"((exp({x}) - exp(-({x}))) / 2)"), (lambda x: f"((exp({x}) + exp(-({x}))) / 2)")
    atanh = lambda x: f"(0.5::DOUBLE * ln((1 + {x}) / (1 - {x})))"
    east = "eta" + "".join(f" + {v!r}::DOUBLE * cos({2 * k} * xi) * {sinh(f'{2 * k} * eta')}" for k, v in enumerate(c, 1))
    north = "xi" + "".join(f" + {v!r}::DOUBLE * sin({2 * k} * xi) * {cosh(f'{2 * k} * eta')}" for k, v in enumerate(c, 1))
    return f"""{ANNOUNCED}, a1 AS (SELECT id, sin(radians(lat)) AS s, radians(lon - 15) AS lam FROM ann), a2 AS (SELECT id, lam, {atanh('s')} - {e!r}::DOUBLE * {atanh(f'({e!r}::DOUBLE * s)')} AS q FROM a1), a3 AS (SELECT id, lam, {sinh('q')} AS t FROM a2),
a4 AS (SELECT id, atan2(t, cos(lam)) AS xi, {atanh('(sin(lam) / sqrt(1 + t * t))')} AS eta FROM a3) SELECT id, round(500000 + 0.9996::DOUBLE * {radius!r}::DOUBLE * ({east}), 3) AS east, round(0.9996::DOUBLE * {radius!r}::DOUBLE * ({north}), 3) AS north FROM a4"""


def circle_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Circles of 50 m about announcements: corners, and the box of the ring to a millimetre."""
    ring = geo.circle(F.col("x"), F.col("y"))
    box = lambda f, axis: F.round(f(F.transform("ring", lambda p: p[axis])), 3)
    rows = announcements(spark, sf_dir).select("id", "x", "y", ring.alias("ring"))
    return rows.select("id", F.size("ring").cast("bigint").alias("corners"), (F.element_at("ring", 1) == F.element_at("ring", -1)).alias("closed"), box(F.array_min, "x").alias("west"), box(F.array_max, "x").alias("east"), box(F.array_min, "y").alias("south"), box(F.array_max, "y").alias("north"))


def centre_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Great-circle distance of announcements to a town's centre, to a centimetre, and the pixels of 50 m there."""
    return announcements(spark, sf_dir).select("id", F.round(geo.haversine(F.col("lon"), F.col("lat"), F.lit(13.4), F.lit(52.52)), 2).alias("metres"), F.round(geo.radius_pixels(F.col("lat")), 9).alias("pixels"))


def road_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of roads: the least and largest coordinates of an order's lines as points."""
    p = F.struct((13.1 + F.col("l_partkey") % 1000 * 0.0005).alias("lon"), (52.35 + F.col("l_suppkey") % 1000 * 0.0003).alias("lat"))
    roads = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(p).alias("line"))
    side = lambda f, axis: F.round(f(F.transform("line", lambda q: q[axis])), 6)
    return roads.select("l_orderkey", side(F.array_min, "lon").alias("west"), side(F.array_min, "lat").alias("south"), side(F.array_max, "lon").alias("east"), side(F.array_max, "lat").alias("north"))


def precision_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many announcements of each precision may be drawn."""
    from tessella.sources.tables import MAPPABLE

    return announcements(spark, sf_dir).groupBy("precision").agg(F.count_if(F.col("precision").isin(*MAPPABLE)).alias("mappable"), F.count("*").alias("all"))


_HEAD_CASE = "CASE doc_id % 5 WHEN 0 THEN 'Altona' WHEN 1 THEN 'Mitte' WHEN 2 THEN 'Altona' END"
QUERIES = {
    "coordinate_validity": (coordinate_validity, f"{ANNOUNCED} SELECT id, {VALID_SQL} AS valid FROM ann"),
    "geometry_validity": (geometry_validity, f"""{ANNOUNCED}, g AS (SELECT id, id % 6 + 1 AS n, {_sql_pick(KINDS, '(id // 6)')} AS kind FROM ann)
SELECT id, kind, {VALID_SQL} AND CASE kind WHEN 'Point' THEN n = 1 WHEN 'LineString' THEN n >= 2 WHEN 'Polygon' THEN n >= 4 AND id % 4 <> 0 ELSE false END AS valid FROM g"""),
    "report_kinds": (report_kinds, "SELECT p_partkey FROM part WHERE list_has_any(CASE WHEN p_size % 3 = 0 THEN [p_type, p_brand] WHEN p_size % 2 = 0 THEN [p_type] ELSE [p_brand] END, ['ECONOMY', 'Brand#1'])"),
    "city_scopes": (city_scopes, f"WITH a AS (SELECT doc_id, {_sql_pick(CITIES, 'doc_id')} AS city, CASE WHEN doc_id % 7 <> 0 THEN {_sql_pick(SCOPES, '(doc_id // 3)')} END AS scope FROM documents) SELECT * FROM a WHERE scope IN ('in_city', 'mixed') OR city = 'berlin' AND scope = 'uncertain'"),
    "candidate_roads": (candidate_roads, f"{ANNOUNCED} SELECT id, {_sql_pick((*predicates.ROAD_METHODS, 'geocoded'), 'id')} AS method, id % 4 + 1 AS points FROM ann WHERE id % 3 < 2 AND id % 2 = 1 AND id % 4 > 0 AND {VALID_SQL}"),
    "public_stats_gate": (public_stats_gate, """WITH c AS (SELECT c_mktsegment, c_nationkey // 5 AS c_nationkey, count(*) AS n FROM customer GROUP BY ALL), s AS (SELECT *, CAST(CASE WHEN c_mktsegment < 'C' THEN (n + 9) // 10 * 10 ELSE n // 10 * 10 END AS BIGINT) AS pv FROM c)
SELECT c_mktsegment, bool_and(pv >= 20 AND pv % 10 = 0) AND count(*) = count(DISTINCT c_nationkey) AND sum(pv) <= sum(n) // 10 * 10 AS public, CAST(sum(pv) AS BIGINT) AS shown FROM s GROUP BY 1"""),
    "safe_urls": (safe_urls, "SELECT page_id, regexp_matches(url, '^https://') AND page_id % 5 NOT IN (0, 2) AS safe FROM pages"),
    "event_time_basis": (event_time_basis, """WITH d AS (SELECT l_orderkey, CASE WHEN count(DISTINCT CAST(l_shipdate AS DATE)) = 1 AND max(l_quantity) <= 45 THEN min(l_shipdate) END AS day FROM lineitem GROUP BY 1)
SELECT o_orderkey, strftime(coalesce(day, o_orderdate), '%Y-%m') AS month, CASE WHEN day IS NULL THEN 'publication' ELSE 'incidents' END AS basis FROM orders LEFT JOIN d ON o_orderkey = l_orderkey"""),
    "occurrence_times": (occurrence_times, "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(epoch(date_trunc('second', ts)) AS BIGINT) + CASE event_id % 3 WHEN 1 THEN -3600 WHEN 2 THEN 9000 ELSE 0 END END AS seconds FROM events"),
    "publication_precision": (publication_precision, "SELECT CASE event_id % 3 WHEN 0 THEN 'date' WHEN 1 THEN 'time' ELSE 'unknown' END AS published_as, count(*) AS reports FROM events GROUP BY 1"),
    "year_reports": (year_reports, "SELECT o_orderpriority, count(*) AS reports FROM orders WHERE CAST(o_orderdate AS VARCHAR) LIKE '1998-%' GROUP BY 1"),
    "distinct_years": (distinct_years, "SELECT DISTINCT CAST(substr(CAST(o_orderdate AS VARCHAR), 1, 4) AS BIGINT) AS year FROM orders"),
    "distinct_urls": (distinct_urls, "SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, count(DISTINCT regexp_replace(url, '[?#].*$', '')) AS urls, count(*) AS pages FROM pages GROUP BY 1"),
    "listing_pages": (listing_pages, "SELECT page_id, CASE WHEN page_id % 3 > 0 THEN greatest(1, page_id % 40, page_id % 7) ELSE 1 END AS pages FROM pages"),
    "embedded_events": (embedded_events, "SELECT page_id, page_id * 10 + k AS id, 48 + k / 8.0::DOUBLE AS lat, 'a ] b ' || k AS label FROM (SELECT page_id, unnest(range(0, page_id % 4 + 1)) AS k FROM pages)"),
    "district_headings": (district_headings, f"SELECT doc_id, {_HEAD_CASE} AS district FROM documents"),
    "district_repair": (district_repair, f"SELECT doc_id, CASE WHEN doc_id % 4 > 1 THEN 'given' ELSE {_HEAD_CASE} END AS district FROM documents"),
    "tile_union": (tile_union, "SELECT p_partkey, CAST(CASE WHEN p_size <= 30 THEN 1 ELSE 2 END AS BIGINT) AS tile FROM part"),
    "signature_overlap": (signature_overlap, """WITH s AS (SELECT p_partkey, unnest(string_split(p_name || ' ' || p_type, ' ')) AS s FROM part) SELECT a.p_partkey, string_agg(DISTINCT a.s, ',' ORDER BY a.s) AS shared FROM s a JOIN s b ON b.p_partkey + 1 = a.p_partkey AND a.s = b.s GROUP BY 1"""),
    "existence_probes": (existence_probes, "SELECT 'pending_order' AS probe, EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P') AS present UNION ALL SELECT 'free_order', EXISTS (SELECT 1 FROM orders WHERE o_totalprice <= 0) UNION ALL SELECT 'returned_line', EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'R') UNION ALL SELECT 'huge_line', EXISTS (SELECT 1 FROM lineitem WHERE l_quantity > 1000)"),
    "locale_order": (locale_order, "SELECT CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) ELSE n_name END AS name, row_number() OVER (ORDER BY lower(n_name), n_nationkey) AS place FROM nation"),
    "merged_tags": (merged_tags, "SELECT p_partkey, 'brand=' || p_brand || ';kind=' || CASE WHEN p_size % 2 = 0 THEN p_type ELSE 'reviewed' END || ';note=' || p_name AS tags FROM part"),
    "changed_roles": (changed_roles, "SELECT l_orderkey, bool_and(l_linestatus = CASE WHEN l_returnflag = 'N' THEN 'O' ELSE 'F' END) AS same FROM lineitem GROUP BY 1"),
    "xml_labels": (xml_labels, "SELECT p_partkey, '&lt;b title=&#39;' || p_name || '&#39;&gt;R&amp;D &quot;' || p_brand || '&quot;&lt;/b&gt;' AS label FROM part"),
    "row_hashes": (row_hashes, """SELECT o_orderkey, sha256('{"o_orderkey":' || o_orderkey || ',"priority":' || CASE WHEN o_orderkey % 3 <> 0 THEN '"' || o_orderpriority || '"' ELSE 'null' END || '}') AS sha256 FROM orders"""),
    "utm_points": (utm_points, _utm_sql()),
    "circle_corners": (circle_corners, f"{ANNOUNCED} SELECT id, 33 AS corners, true AS closed, round(x - 50, 3) AS west, round(x + 50, 3) AS east, round(y - 50, 3) AS south, round(y + 50, 3) AS north FROM ann"),
    "centre_distances": (centre_distances, f"{ANNOUNCED}, h AS (SELECT id, lat, pow(sin(radians(52.52 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(52.52)) * pow(sin(radians(13.4 - lon) / 2), 2) AS h FROM ann) SELECT id, round(2 * 6378137::DOUBLE * asin(sqrt(h)), 2) AS metres, round(50 * 512 / (2 * pi() * 6378137::DOUBLE * cos(radians(lat))), 9) AS pixels FROM h"),
    "road_bounds": (road_bounds, """WITH p AS (SELECT l_orderkey, 13.1::DOUBLE + l_partkey % 1000 * 0.0005::DOUBLE AS lon, 52.35::DOUBLE + l_suppkey % 1000 * 0.0003::DOUBLE AS lat FROM lineitem) SELECT l_orderkey, round(min(lon), 6) AS west, round(min(lat), 6) AS south, round(max(lon), 6) AS east, round(max(lat), 6) AS north FROM p GROUP BY 1"""),
    "precision_domain": (precision_domain, f"""{ANNOUNCED} SELECT precision, count(*) FILTER (precision IN ({', '.join(repr(p) for p in PRECISIONS[:4])})) AS mappable, count(*) AS "all" FROM ann GROUP BY 1"""),
}
