"""Mentions of places in sentences: every role, every kind of heading and every word of the locative test, one case each."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessella.functions import mentions as m
from tessella.plans import mention_plans as mp

NAME = "lindengasse"
#: Before and after the name, and the role that the name then has.
ROLES = [
    ("tatort: berlin-mitte, ", ", danach wurde ein mann festgenommen", "primary"),
    ("hinweise nimmt die wache in der ", " entgegen", "contact"),
    ("sie sind telefonisch unter 123 in der ", "", "contact"),
    ("der vorfall geschah nahe der ", " am abend", "proximity"),
    ("tatort: am tor, nahe der ", " am abend", "primary"),
    ("sie wurden in das kommissariat ", " gebracht", "destination"),
    ("man brachten ihn über die ", " ins krankenhaus", "destination"),
    ("zeugen brachten den verletzten mann zur ", ", wo sie den rettungsdienst riefen", "response"),
    ("er ging in richtung ", " weiter", "direction"),
    ("er ging in fahrtrichtung des s-bahnhof ", " weiter", "direction"),
    ("ein auto, aus der ", " kommend, prallte gegen einen baum", "travel_origin"),
    ("für die unfallaufnahme war die ", " zwei stunden lang zu", "restriction"),
    ("die sperrung wurde aufgehoben, ein haus brannte und war in der ", " gesperrt", "primary"),
    ("ein mann wurde geschlagen, als der täter über die ", " floh", "escape"),
    ("beamte nahmen ihn in der ", " fest", "response"),
    ("eine frau hörte an der ", " einen lauten knall", "witness"),
    ("er war aus der ", " unterwegs", "travel_origin"),
    ("er war vom gehweg der ", " gekommen", "travel_origin"),
    ("trotz einer schussabgabe setzte er die fahrt in der ", " fort", "followup"),
    ("trotz einer schussabgabe setzte er die fahrt in der ", " fort, prallte gegen einen baum", "primary"),
    ("daraufhin fuhr er zur ", " hin", "followup"),
    ("der verkehr staute sich zwischen ", " und dem tor", "restriction_endpoint"),
    ("ein fahrrad wurde in der ", " gestohlen und der täter floh", "primary"),
    ("ein ruhiger abend in der ", "", "primary"),
]
HEADINGS = ["tatort: ", "unfallort: ", "ort:", "tatort: hamburg-altona, ", "ort: berlin-mitte, ", "tatort: am bahnsteig des u-bahnhofs ", "tatort: am bahnsteig des s+u-bahnhofes ", "ort: hamburg-mitte, u-bahn-linie u3 (u3), haltestelle ", "unfallort: alte gasse / ", "unfallort: alte gasse-", "tatort: altona, s-bahnhof ", "tatort: altona, "]
NO_HEADINGS = ["ort ", "tatorte: ", "tatort: eins zwei drei vier fünf sechs sieben acht / ", "tatort: altona, der ", "sport: ", f"tatort: {'x' * 181}/ "]
#: Clauses around the mention: before, after and the clause that results.
CLAUSES = [
    ("er ging dann in die ", " weiter", f" in die {NAME} weiter"),
    ("er kam; sie blieb in der ", ", als es regnete", f" sie blieb in der {NAME}"),
    ("sie standen in der ", " und er floh", f"sie standen in der {NAME} "),
    ("sie standen in der ", " und sangen", f"sie standen in der {NAME} und sangen"),
    ("sie standen in der ", ", wobei er stürzte. ende", f"sie standen in der {NAME}, wobei er stürzte. ende"),
    ("sie standen in der ", ", wobei er sang", f"sie standen in der {NAME}"),
    ("es war der, der zuvor da war; die, die bereits ", " sah", f" sah"),
    ("und die täter flohen dann, und er rannte durch die ", "", f"er rannte durch die {NAME}"),
]


def evaluated(spark, cases, expression):
    rows = [(k, f"{left}{NAME}{right}", len(left), len(left) + len(NAME)) for k, (left, right) in enumerate(cases)]
    df = spark.createDataFrame(rows, "k int, s string, a int, b int")
    return [r.out for r in df.select("k", expression(F.col("s"), F.col("a"), F.col("b")).alias("out")).orderBy("k").collect()]


def test_roles(spark):
    assert evaluated(spark, [(a, b) for a, b, _ in ROLES], m.role) == [r for _, _, r in ROLES]
    assert {r for r, _ in m.ROLES} == {r for _, _, r in ROLES}
    assert spark.range(1).select(m.role(F.lit(None).cast("string"), F.lit(1), F.lit(2)).alias("r")).first().r is None


def test_headings(spark):
    found = evaluated(spark, [(h, "") for h in HEADINGS + NO_HEADINGS], m.tests)
    assert [t.heading for t in found] == [True] * len(HEADINGS) + [False] * len(NO_HEADINGS)
    assert all(t.locative and t.scene for t in found[: len(HEADINGS)])
    # What lies more than 180 characters back is no heading for the role either.
    far = [(f"tatort: {'a' * 90}, {'b' * 90}, beamte nahmen ihn nach langer zeit bei der ", " fest")]
    assert evaluated(spark, far, m.role) == ["response"]


def test_locative_words(spark):
    kinds = ["bahnhof", "u-bahnhof", "s+u-bahnhof", "haltestelle", "bushaltestelle", "gehweg der", "fahrbahn des", "mittelstreifen zur", "eingang zum", "zufahrt der", "einkaufscenter", "einkaufszentrum", "restaurant", "cafe", "bar", "hotel", "park", "grünanlage", "grünanlagen von", "strasse namens"]
    at = [f"ein mann {w} " for w in (*m.PREPOSITIONS, *m.MOTIONS, *m.SPOTS)] + [f"ein mann in {a} " for a in m.ARTICLES] + [f"ein mann vor dem {k} {q}" for k in kinds for q in ("", "„", "'")]
    along = [f"ein mann {w} eilig gegen abend die " for w in m.ALONG] + ["ein mann lief später den "]
    # Inside a longer word none of them counts: the word boundary holds for prepositions, motions and places alike.
    inside = [f"ein mann x{w} " for w in (*m.PREPOSITIONS, *m.MOTIONS, *m.SPOTS)]
    none = ["ein mann nach ", "ein mann in vielen ", "ein mann lief die gasse ", "wir umbefuhren ", "sie verpassierte ", f"ein mann in{' ' * 66}"]
    found = [t.locative for t in evaluated(spark, [(s, "") for s in (*at, *along, *inside, *none)], m.tests)]
    assert all(found[: len(at) + len(along)]), [s for s, f in zip((*at, *along), found, strict=False) if not f]
    assert not any(found[len(at) + len(along) :]), [s for s, f in zip((*inside, *none), found[len(at) + len(along) :], strict=True) if f]


def test_other_tests(spark):
    cases = {
        "locality": (["das geschah im ortsteil ", "sie wohnt in berlin-", "in den stadtteilen ", "im bezirk hamburg-"], ["im haus ", "das kind-", "drin "]),
        "station": (["sie warteten am u-bahnhof ", "die s- ", "am u+u-bahnhof", "an der haltestelle ", "des bahnhofs ", "am u bhf. "], ["am hof ", "bus ", f"haltestelle{' ' * 46}x"]),
        "venue": (["gäste im restaurant „", "im nachtclub ", "im museum namens ", "vor grünanlagen von »", "er rief „"], ["im haus ", "barbar ", "restaurants "]),
        "preparatory": (["zwei frauen befuhren die ", "bei einer verkehrskontrolle in der "], ["bei einem unfall befuhren sie die ", "ein mann sass in der "]),
        "scene": (["ein haus brannte in der ", "er fuhr mit dem rad gegen die "], ["er fuhr gegen 12:30 uhr in die ", "es war still in der ", "man schlug zu; es war still in der "]),
    }
    for name, (yes, no) in cases.items():
        found = [t[name] for t in evaluated(spark, [(s, "") for s in (*yes, *no)], m.tests)]
        assert found == [True] * len(yes) + [False] * len(no), (name, found)
    assert [t.station for t in evaluated(spark, [("es war still, ", "")], lambda s, a, b: m.tests(F.replace(s, F.lit(NAME), F.lit("bahnhofweg")), a, b))] == [True]


def test_clauses(spark):
    found = evaluated(spark, [(a, b) for a, b, _ in CLAUSES], m.clause)
    joined = [c.before + c["name"] + c.after for c in found]
    want = [w if NAME in w else NAME + w for *_, w in CLAUSES]
    assert [j.strip() for j in joined] == [w.strip() for w in want]


def test_totals(spark):
    cases = [
        ("verbundeinsatz in der stadt", "es gab stationäre und mobile verkehrskontrollen", True),
        ("verbundeinsatz in der stadt", "es gab nur mobile verkehrskontrollen", False),
        ("bilanz der verkehrswoche", "bei den kontrollen überprüften beamte viele fahrzeuge und leiteten strafverfahren ein", True),
        ("bilanz der woche", "bei den kontrollen überprüften beamte viele fahrzeuge und leiteten strafverfahren ein", False),
        ("thementag wasserschutz", "bei kontrollen kontrollierten sie viele wasserfahrzeuge", False),
        ("ergebnisse der bundesweiten verkehrssicherheitsaktion", "eine kontrolle, viele ordnungswidrigkeiten", True),
        ("ergebnisse der verkehrssicherheitsaktion", "viele ordnungswidrigkeiten", False),
        ("raub in der nacht", "kontrollen blieben ohne straftaten", False),
        (None, "kontrollen", False),
    ]
    rows = spark.createDataFrame([(k, t, b) for k, (t, b, _) in enumerate(cases)], "k int, t string, b string").select("k", m.tells_totals(F.col("t"), F.col("b")).alias("x")).orderBy("k").collect()
    assert [r.x for r in rows] == [x for *_, x in cases]


def test_bounds(spark):
    cases = [
        ("im bereich zwischen dem uferweg und der ringstrasse kam es zum unfall", ["uferweg", "ringstrasse"]),
        ("im bereich zwischen der alten allee und dem neuen damm.", ["alten allee", "neuen damm"]),
        ("im bereich zwischen der alten allee und dem alten tor, hiess es", []),
        ("er ging zwischen der alten allee und dem ring", []),
        (None, []),
    ]
    rows = spark.createDataFrame([(k, s) for k, (s, _) in enumerate(cases)], "k int, s string").select("k", m.section_bounds(F.col("s")).alias("x")).orderBy("k").collect()
    assert [r.x or [] for r in rows] == [x for _, x in cases]


#: Sentences with letters, blanks, digits and ends of lines beyond ASCII: query, sentence, column and its value.
ODD = [
    ("mention_contexts", "ein brand\u0161 war da", "scene", False),
    ("mention_contexts", "ein brand\u0308 war da", "scene", False),
    ("mention_contexts", "ein brand\u200b war da", "scene", True),
    ("mention_contexts", "er stqrzte da", "scene", False),
    ("mention_contexts", "es kam\u00a0es zum raub da", "scene", True),
    ("mention_contexts", "es kam\x0bes zum raub da", "scene", True),
    ("mention_contexts", "er fuhr\u2028schnell an, so da", "scene", True),
    ("mention_contexts", "er fuhr an\u0085 so da", "scene", False),
    ("mention_roles", "er wurde zur polizeidirektion \u0663 gebracht da", "role", "destination"),
    ("mention_roles", "er \u00f8floh hier da", "role", "primary"),
    ("mention_roles", "er hat\u2003gerufen: kontakt\u2003unter da", "role", "contact"),
    ("mention_clauses", "d\u0130e wache war da", "before", 5),
    ("mention_clauses", "die wache \u017eund\u3000er lief da", "length", 28),
]


@pytest.mark.parametrize("name", ["mention_roles", "mention_contexts", "mention_clauses"])
def test_odd_letters(spark, tmp_path, name):
    # These numbers of documents put nothing before the first sentence's name but its first word, and nothing right after it.
    texts = [s for _, s, _, _ in ODD]
    ids = [380 + 627 * k for k in range(len(texts))]
    every = [(i, s) for i, s in zip(ids, texts, strict=True)] + [(10**6 + 40 * k + n, f"{s}. {s}") for k, s in enumerate(texts) for n in range(33)]
    pq.write_table(pa.table({"doc_id": [i for i, _ in every], "text": [s for _, s in every]}), tmp_path / "documents.parquet")
    query, sql = mp.QUERIES[name]
    df = query(spark, str(tmp_path))
    ours = {(r.doc_id, r.nr): r for r in df.collect()}
    for i, (of, s, column, value) in zip(ids, ODD, strict=True):
        assert of != name or ours[i, 0][column] == value, (s, ours[i, 0])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    theirs = con.execute(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall()
    assert sorted(map(tuple, ours.values())) == sorted(theirs)


@pytest.mark.parametrize("name", ["mention_roles", "mention_contexts", "mention_clauses"])
def test_odd_numbers(spark, tmp_path, name):
    # Documents below zero take the phrases in turn too, and one without a number the first of each.
    every = [(i, f"Ein Mann lief {i} Mal fort. Er blieb hier") for i in (*range(-40, 3), None)]
    pq.write_table(pa.table({"doc_id": pa.array([i for i, _ in every], pa.int64()), "text": [s for _, s in every]}), tmp_path / "documents.parquet")
    query, sql = mp.QUERIES[name]
    df = query(spark, str(tmp_path))
    ours = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    theirs = con.execute(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall()
    assert sorted(ours, key=repr) == sorted(theirs, key=repr)
    assert len(ours) == 2 * len(every)
    assert name != "mention_roles" or (None, 0, "primary") in ours
