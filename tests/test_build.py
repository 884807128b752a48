"""Places built from map objects, case by case."""

from tessella.operators import build

OBJECTS = [
    # id, seq, node, kind, name, variant, shape, context_line, x, y
    ("way/1", 1, False, "park", "a", None, "area", None, 50.0, 50.0),
    ("way/2", 2, False, "park", "a", None, "area", None, 50.0, 50.0),
    ("way/3", 3, False, "station", "s", None, "area", None, 500.0, 500.0),
    ("way/4", 4, False, "cafe", "c", None, "area", None, 900.0, 900.0),
    ("way/5", 5, False, "context", "l", None, "line", True, 0.0, 0.0),
    ("way/6", 6, False, "context", "l", None, "line", None, 0.0, 0.0),
    ("way/7", 7, False, "shop", "x", "books", None, None, None, None),
    ("way/8", 8, False, None, "x", None, "area", None, 0.0, 0.0),
    ("node/1", 11, True, "park", "a", None, "point", None, 10.0, 10.0),
    ("node/2", 12, True, "park", "a", None, "point", None, 0.0, 60.0),  # on the edge
    ("node/3", 13, True, "park", "b", None, "point", None, 10.0, 10.0),
    ("node/4", 14, True, "park", "a", "books", "point", None, 10.0, 10.0),
    ("node/5", 15, True, "park", "a", None, "point", None, 300.0, 10.0),
    ("node/6", 16, True, "airport", "p", None, "point", None, 1.0, 1.0),
    ("node/7", 17, True, "cafe", "c", None, "point", None, 900.0, 900.0),  # a cafe's outline is no footprint
]


def square(name, x, y, size):
    corners = [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]
    return [(name, *map(float, a), *map(float, b)) for a, b in zip(corners, corners[1:])]


def test_places_and_rejections(spark):
    objects = spark.createDataFrame(OBJECTS, "id string, seq int, node boolean, kind string, name string, variant string, shape string, context_line boolean, x double, y double")
    edges = spark.createDataFrame(square("way/1", 0, 0, 100) + square("way/2", 0, 0, 200) + square("way/3", 400, 400, 200) + square("way/4", 850, 850, 100), "id string, x1 double, y1 double, x2 double, y2 double")
    places, rejections = build.built(objects, edges, 80.0)
    found = {r.id: (r.mode, r.aliases) for r in places.collect()}
    circle = ("50m_circle", [])
    assert found == {
        "way/1": ("osm_footprint", ["node/1", "node/2"]), "way/2": ("osm_footprint", []), "way/3": ("osm_footprint", []), "way/4": circle, "way/5": ("native_line_reference", []),
        "node/3": circle, "node/4": circle, "node/5": circle, "node/6": ("footprint_missing", []), "node/7": circle,
    }
    assert {r.rejected: r.objects for r in rejections.collect()} == {"unsupported_native_line": 1, "missing_or_unsupported_geometry": 1, "duplicate_node_in_way": 2}
    places, rejections = build.built(objects.limit(0), edges, 80.0)
    assert places.count() == 0 and rejections.count() == 0
