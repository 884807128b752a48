"""Functions and operators on small literal rows."""

import math
import os
import random
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella import session
from tessella.functions import geo, grid, rules, text
from tessella.operators import changes, gates, graph, names, places, statistics
from tessella.sources import publish
from tessella.sources.tables import decisions
from tessella.streaming.revisions import drained, revisions, source


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_projection_round_trip(spark):
    lon, lat = F.lit(13.4), F.lit(52.5)
    east, north = geo.utm(lon, lat, 33)
    back = geo.from_utm(east, north, 33)
    row = one(spark, e=east, n=north, lon=back[0], lat=back[1])
    assert (row.e, row.n) == (pytest.approx(391390.731, abs=0.01), pytest.approx(5817855.241, abs=0.01))
    assert (row.lon, row.lat) == (pytest.approx(13.4, abs=1e-10), pytest.approx(52.5, abs=1e-10))


def test_rings_and_distance(spark):
    ring = geo.circle(F.lit(0.0), F.lit(0.0))
    row = one(spark, n=F.size(ring), inside=geo.in_ring(F.lit(10.0), F.lit(5.0), ring), outside=geo.in_ring(F.lit(51.0), F.lit(0.0), ring), d=geo.haversine(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0)), px=geo.radius_pixels(F.lit(0.0)))
    assert row.n == 33 and row.inside and not row.outside
    assert row.d == pytest.approx(math.radians(1) * geo.A84) and row.px > 0


def test_hex_cell_area_and_ties(spark):
    ring = one(spark, r=grid.hex_ring(F.lit(2), F.lit(-1), 275.0)).r
    area = abs(sum(a.x * b.y - b.x * a.y for a, b in zip(ring, [*ring[1:], ring[0]], strict=True))) / 2
    assert area == pytest.approx(3 * math.sqrt(3) / 2 * 275**2, rel=1e-9)
    cell = one(spark, c=grid.hex_cell(F.lit(0.0), F.lit(math.sqrt(3) * 275 / 2), 275.0)).c
    assert (cell.i, cell.j) == (0, 0)


def test_line_over_tile_corner_covers_four(spark):
    assert one(spark, n=F.size(grid.tile_cover(F.lit(13.399), F.lit(52.499), F.lit(13.401), F.lit(52.501)))).n == 4
    assert one(spark, n=F.size(grid.tile_cover(F.lit(0.0), F.lit(0.0), F.lit(10.0), F.lit(10.0), 64))).n == 0
    assert one(spark, n=F.size(grid.tile_cover(F.lit(None).cast("double"), F.lit(0.0), F.lit(1.0), F.lit(1.0)))).n == 0


def test_german_rules(spark):
    rows = spark.createDataFrame([("Raub in der Bar",), ("Freiheitsberaubung",), ("Gäste geladen",), ("Einbruch in Laden",), (None,)], "t string")
    got = [(r.c, r.m) for r in rows.select(text.category(F.col("t")).alias("c"), text.place_mentions(F.col("t")).alias("m")).collect()]
    assert got == [("Raub", ["bar"]), ("Sonstiges", []), ("Sonstiges", []), ("Diebstahl", ["shop"]), ("Sonstiges", [])]


def test_dates_quotes_normal_forms(spark):
    row = one(spark, d=text.weekday_date(F.lit("Montag, 3. März 2026")), bad=text.weekday_date(F.lit("31. Februar 2026")), q=text.quoted(F.lit("ein  langer\nText mit Beleg"), F.lit("langer Text mit")), short=text.quoted(F.lit("kurz"), F.lit("kurz")), x=text.escaped_xml(F.lit("<a & b>")))
    assert row.d.isoformat() == "2026-03-03" and row.bad is None and row.q and not row.short and row.x == "&lt;a &amp; b&gt;"
    forms = {
        "Torstr.  am  S- und U-Bahnhofs – GROẞE": "torstrasse am s+u-bahnhof-grosse", "S-U-Bahnhof": "s+u-bahnhof", "am S-/U-Bahnhof": "am s+u-bahnhof", "des U-Bahnhofs": "des u-bahnhof", "Ｔｏｒ　１": "tor 1",
        "Ka\u0308the-Str. , x": "käthe-strasse , x", "ﬁn": "fin", "Instr.5": "instr.5", "": "", " \n": "",
    }
    rows = spark.createDataFrame([(k,) for k in forms], "t string")
    assert {r.t: r.n for r in rows.select("t", text.normalised(F.col("t")).alias("n")).collect()} == forms
    row = one(spark, a=text.name_aliases(F.lit("Alte Platz")), b=text.name_aliases(F.lit("Kleiner Weg")), c=text.name_aliases(F.lit("Deutsche Oper")), d=text.name_aliases(F.lit("Ring")), none=text.normalised(F.lit(None).cast("string")))
    assert row.a == ["alte platz", "alte platzes", "alten platz", "alten platzes"] and row.b == ["kleinen weg", "kleinen wegs", "kleiner weg", "kleiner wegs"]
    assert row.c == ["deutsche oper", "deutschen oper"] and row.d == ["ring", "rings"] and row.none is None
    texts = {
        "Am 3. März kam Dr. Ott. Er ging.": ["am 3. märz kam dr. ott.", "er ging."], "Die 5. Mordkommission ermittelt! Wer sah es? 3 Zeugen.": ["die 5. mordkommission ermittelt!", "wer sah es? 3 zeugen."],
        "Um 3. Dann z. B. hier.": ["um 3.", "dann z. b. hier."], "": [], "ohne Ende": ["ohne ende"], "Er rief: Halt! „Nein.“ Ende": ["er rief: halt!", "„nein.“ ende"],
    }
    rows = spark.createDataFrame([(k,) for k in texts], "t string")
    assert {r.t: r.s for r in rows.select("t", text.sentences(F.col("t")).alias("s")).collect()} == texts


def longest_from_left(text, names):
    """Names as lists of words in a text of words and blanks, by plain search."""
    words, out, k = text.split(), [], 0
    while k < len(words):
        hit = max((n for n in names if words[k : k + len(n)] == n), key=len, default=None)
        if hit:
            start = len(" ".join(words[:k])) + (k > 0)
            out.append((" ".join(hit), start, start + len(" ".join(hit))))
        k += len(hit) if hit else 1
    return out


def test_dictionary_by_brute_force(spark, sf):
    docs = [(k, t) for k, t in enumerate(["Der Alte Platz am Ring, alte platz!", "alte", None, "", "ring ring-weg alter Platz", "Alte Platz Nord und Alte Platz"])]
    known = ["Alte Platz", "Ring", "alte Platz Nord", "Ring Weg", None, "", "ring"]
    df, words = spark.createDataFrame(docs, "id int, t string"), spark.createDataFrame([(n,) for n in known], "n string")
    want = {(0, "alte platz", 4, 14), (0, "ring", 18, 22), (0, "alte platz", 24, 34), (4, "ring", 0, 4), (4, "ring weg", 5, 13), (5, "alte platz nord", 0, 15), (5, "alte platz", 20, 30)}
    assert {tuple(r) for r in names.dictionary_matches(df, "id", "t", words).collect()} == want
    assert names.dictionary_matches(df.union(df), "id", "t", words).count() == 2 * len(want)  # repeated rows each for themselves
    assert names.dictionary_matches(df, "id", "t", words.limit(0)).count() == 0 == names.dictionary_matches(df.limit(0), "id", "t", words).count()
    rng = random.Random(9)
    texts = [(k, " ".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for k in range(40)]
    some = [[rng.choice("ab") for _ in range(rng.randrange(1, 6))] for _ in range(9)]
    found = names.dictionary_matches(spark.createDataFrame(texts, "id int, t string"), "id", "t", spark.createDataFrame([(" ".join(n),) for n in some], "n string")).collect()
    assert sorted(map(tuple, found)) == sorted((k, *h) for k, t in texts for h in longest_from_left(t, some))


def test_place_kinds(spark):
    rows = [({"amenity": "pub"}, "bar"), ({"shop": "vacant"}, None), ({"shop": "x", "tourism": "hotel"}, "shop"), ({"public_transport": "platform", "tram": "yes"}, "station"), ({}, None)]
    df = spark.createDataFrame([(t,) for t, _ in rows], "tags map<string,string>")
    assert [r.k for r in df.select(rules.place_kind(F.col("tags")).alias("k")).collect()] == [k for _, k in rows]


def test_revisions(spark):
    body = "der selbe lange Text einer Meldung."
    rows = [("a", 1, body), ("a", 2, f" {body} "), ("a", 3, body + " Korrektur."), ("a", 4, "kurz"), ("a", 5, body + " Korrektur."), ("b", 1, None)]
    got = changes.accepted(spark.createDataFrame(rows, "id string, seq int, body string"), "id", "seq", "body").orderBy("id", "seq").collect()
    assert [(r.status, r.revision) for r in got] == [("new", 1), ("unchanged", 1), ("revised", 2), ("rejected", None), ("unchanged", 2), ("rejected", None)]


def test_blank_district_never_erases(spark):
    old = spark.createDataFrame([(1, "Mitte", "x"), (2, None, "y")], "id int, district string, url string")
    new = spark.createDataFrame([(1, "", "z"), (3, "Pankow", "w")], "id int, district string, url string")
    assert {tuple(r) for r in changes.discovered(old, new, "id", "district").collect()} == {(1, "Mitte", "z"), (2, None, "y"), (3, "Pankow", "w")}


def test_backoff(spark):
    got = spark.range(1, 13).select(changes.backoff(F.col("id")).alias("d")).collect()
    assert [r.d for r in got][:3] == [300, 600, 1200] and got[-1].d == 76800


def test_components_and_reach(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (7, 8), (6, 6)], "u bigint, v bigint")
    assert {tuple(r) for r in graph.components(edges).collect()} == {(3, 3), (4, 3), (5, 3), (9, 3), (7, 7), (8, 7)}
    cycle = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (9, 1)], "u bigint, v bigint")
    assert {r.node for r in graph.reachable(spark.createDataFrame([(1,)], "start bigint"), cycle).collect()} == {1, 2, 3}
    assert graph.components(edges.filter("u > 99")).count() == 0


def test_radius_join_crosses_cells(spark):
    points = spark.createDataFrame([(1, 49.0, 0.0), (2, 200.0, 0.0)], "id int, x double, y double")
    sites = spark.createDataFrame([(7, 51.0, 0.0), (8, 99.5, 0.0)], "pid int, px double, py double")
    assert {(r.id, r.pid) for r in places.within(points, sites, F.lit(50.0), 50.0).collect()} == {(1, 7)}


def test_nearest_by_brute_force(spark):
    rng = random.Random(3)
    points = [(k, k % 3, float(rng.randrange(4000)), float(rng.randrange(100))) for k in range(60)] + [(99, 7, 0.0, 0.0)]
    sites = [(k, k % 3, float(rng.randrange(4000)), float(rng.randrange(100))) for k in range(20)] + [(50, 0, points[0][2] + 5, points[0][3]), (51, 0, points[0][2] - 5, points[0][3])]
    want = set()
    for i, g, x, y in points:
        near = [((x - a) ** 2 + (y - b) ** 2, j) for j, h, a, b in sites if h == g]
        want |= {(i, j) for d, j in near if d == min(near)[0]}
    found = places.nearest_within(spark.createDataFrame(points, "id int, g int, x double, y double"), spark.createDataFrame(sites, "pid int, g int, px double, py double"), "id", "g", 10.0)
    assert {(r.id, r.pid) for r in found.collect()} == want


def test_stream_revisions_over_batches(spark, tmp_path):
    """Several micro-batches, one of them out of order: a late version is told and changes nothing."""
    body = "der selbe lange Text einer Meldung."
    files = [[("a", 1, body), ("b", 2, body)], [("a", 3, body + " Neu."), ("a", 4, "kurz"), ("b", 1, body + " Alt.")], [("a", 2, body + " Spät."), ("a", 5, body + " Neu."), ("a", 6, body), ("b", 3, body)]]
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, "id string, seq int, body string").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        for f in (tmp_path / "in").glob("part-*"):
            if not f.name.startswith("part-9"):
                f.rename(f.with_name(f"part-9{k}.parquet"))
                os.utime(tmp_path / "in" / f"part-9{k}.parquet", (k, k))
    for f in (tmp_path / "in").glob(".*crc"):
        f.unlink()
    out = drained(revisions(source(spark, f"file://{tmp_path}/in/part-9?.parquet", 1), "id", "seq", "body"), "stream-test")
    got = {(r.key, r.seq): (r.status, r.revision) for r in spark.read.parquet(out).collect()}
    assert got == {("a", 1): ("new", 1), ("b", 2): ("new", 1), ("a", 3): ("revised", 2), ("a", 4): ("rejected", None), ("b", 1): ("late", None), ("a", 2): ("late", None), ("a", 5): ("unchanged", 2), ("a", 6): ("revised", 3), ("b", 3): ("unchanged", 1)}


def test_shared_folder_must_be_named_on_a_cluster():
    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError):
        session.shared_dir(Cluster)


def test_suppression(spark):
    rows = spark.createDataFrame([("JP", 33), ("HK", 21), ("DE", 19), ("ZZ", 4)], "code string, pv int")
    assert {tuple(r) for r in statistics.suppressed(rows, "code", "pv").collect()} == {("JP", 30), ("HK", 20), ("OTHER", 20)}


def test_no_records_give_null_not_zero(spark):
    counts = spark.createDataFrame([("t", 0, 0, 0, 0, 0)], "tag string, supported bigint, no_support bigint, uncertain bigint, not_evaluated bigint, records bigint")
    found = statistics.indices(counts)
    assert found.first().content_index is None and statistics.composite(found, {"t": 1.0}).first().composite is None
    with pytest.raises(ValueError):
        statistics.composite(found, {"t": 0.0})


def test_publish_keeps_last_good(spark, tmp_path):
    folder, rows = f"file://{tmp_path}", spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "id bigint, month string")
    first = publish.publish({"events": (rows, ["month"])}, folder, [("ids", gates.repeated(rows, "id"))])
    assert publish.publish({"events": (rows.orderBy(F.desc("id")), ["month"])}, folder) == first
    with pytest.raises(gates.GateError):
        twice = rows.union(rows)
        publish.publish({"events": (twice, ["month"])}, folder, [("ids", gates.repeated(twice, "id"))])
    assert publish.current(spark, folder, "events").count() == 2 and len(list(tmp_path.glob("generation=*"))) == 1
    more = publish.publish({"events": (rows.union(spark.createDataFrame([(3, "2024-02")], rows.schema)), ["month"])}, folder)
    assert more != first and publish.current(spark, folder, "events").count() == 3 and publish.manifest(spark, folder)["generation"] == more
    assert len(list(tmp_path.glob("generation=*"))) == 2 and len(list(tmp_path.glob("*manifest.json*"))) <= 2  # the manifest, and its checksum
    assert publish.publish({"events": (rows, ["month"])}, folder) != first and publish.current(spark, folder, "events").count() == 2


def test_promotion_is_one_publishers(spark, tmp_path):
    folder = f"file://{tmp_path}"
    tables = lambda k: {"events": (spark.createDataFrame([(n, "2024-01") for n in range(k)], "id bigint, month string"), ["month"])}
    base = publish.publish(tables(1), folder)
    staged = [publish.stage(tables(k), folder) for k in (2, 3, 4)]
    assert publish.manifest(spark, folder)["generation"] == base  # staging publishes nothing
    won, lost = [], []

    def go(generation):
        try:
            publish.promote(spark, folder, generation, base, generation)
            won.append(generation)
        except publish.ConflictError:
            lost.append(generation)

    threads = [threading.Thread(target=go, args=(g,)) for g in staged]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and len(lost) == 2 and publish.manifest(spark, folder)["generation"] == won[0]
    assert all((tmp_path / f"generation={g}").is_dir() for g in [base, *staged])  # nothing is lost
    live = won[0]
    with pytest.raises(publish.ConflictError, match="published, not"):
        publish.promote(spark, folder, lost[0], base, "late")
    publish.promote(spark, folder, live, "whatever", "again")  # live already
    with publish.locked(spark, folder, "first", 60) as check:
        with pytest.raises(publish.ConflictError, match="first is releasing"):
            publish.promote(spark, folder, lost[0], live, "second")
        check()
    with publish.locked(spark, folder, "dead", 0.01) as check:  # a driver that is lost holds its lease only
        time.sleep(0.05)
        publish.promote(spark, folder, lost[0], live, "next")
        with pytest.raises(publish.ConflictError, match="lease"):
            check()
    assert publish.manifest(spark, folder) | {"tables": 0} == {"generation": lost[0], "owner": "next", "tables": 0}
    file = next(p for p in (tmp_path / f"generation={lost[1]}").rglob("*.parquet"))
    file.unlink()
    with pytest.raises(publish.ConflictError, match="changed since"):
        publish.promote(spark, folder, lost[1], lost[0], "damaged")
    with pytest.raises(publish.ConflictError, match="approved"):
        publish.promote(spark, folder, publish.stage(tables(7), folder), lost[0], "x", approved={"events": [0]})
    assert publish.manifest(spark, folder)["generation"] == lost[0] and len([p for p in tmp_path.iterdir() if p.name.startswith("release-lock")]) <= 4


def test_review_packs_and_tiles(spark):
    packs = publish.review_packs(spark.range(100), spark.range(10), "id", 20)
    assert [tuple(r) for r in packs.groupBy("batch").agg(F.count("*"), F.min("id")).orderBy("batch").collect()] == [(0, 20, 10), (1, 20, 30), (2, 20, 50), (3, 20, 70), (4, 10, 90)]
    box = spark.createDataFrame([(13.399, 52.499, 13.401, 52.501)], "west double, south double, east double, north double")
    assert publish.tiled(box).count() == 4
    with pytest.raises(Exception, match="too many tiles"):
        publish.tiled(box.withColumn("east", F.lit(170.0)).withColumn("north", F.lit(80.0)), 64).collect()


def test_closed_decisions(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("verdict", T.StringType())])
    (tmp_path / "a.ndjson").write_text('{"id": "1", "verdict": "supported"}\n\n')
    assert [tuple(r) for r in decisions(spark, f"file://{tmp_path}/a.ndjson", schema).collect()] == [("1", "supported")]
    (tmp_path / "b.ndjson").write_text('{"id": "1", "guess": "x"}\n')
    with pytest.raises(Exception, match="unknown keys"):
        decisions(spark, f"file://{tmp_path}/b.ndjson", schema).collect()


def test_order_of_input_does_not_matter(spark, sf):
    from tessella.plans import catalogue, map_plans

    rows = map_plans.announcements(spark, sf)
    shuffled = rows.repartition(7, F.rand(3))
    assert gates.differences(statistics.hexagons(rows, 275.0), statistics.hexagons(shuffled, 275.0)).isEmpty()
    assert "month_hex_overview" in catalogue.QUERIES
