"""What makes a report a follow-up, case by case."""

from tessella.operators import followups

#: Title, body and district of the earlier report and of the later one, and what the later one is.
CASES = [
    (("Vermisstenfahndung nach einem Kind", "", "Mitte"), ("Erledigung der Vermisstenfahndung", "Hinweise auf Straftaten liegen nicht vor.", ""), "missing_search"),
    (("Vermisstenfahndung nach einem Kind", "", "Mitte"), ("Erledigung der Vermisstenfahndung", "Es wird ermittelt.", ""), None),
    (("Schwere Unfälle", "", ""), ("Mann verstirbt nach Verkehrsunfall", "Er erlag seinen Wunden.", ""), "traffic_death"),
    (("Raub", "", ""), ("Mann verstirbt nach Verkehrsunfall", "Er erlag seinen Wunden.", ""), None),
    (("Mord im Park", "Tatzeit: 01.01.2024, 10:00 Uhr", "Mitte"), ("Festnahme nach Mord", "Zeit: 01.01.2024, 10:00 Uhr", "Altona"), "case_update"),
    (("Mord im Park", "Tatzeit: 01.01.2024, 10:00 Uhr", "Mitte"), ("Festnahme nach Mord", "", "MITTE"), "case_update"),
    (("Mord im Park", "Tatzeit: 01.01.2024, 10:00 Uhr", "Mitte"), ("Festnahme nach Mord", "", "Altona"), None),
    (("Mord im Park", "", ""), ("Festnahme nach Mord", "", ""), None),  # no district is not the same district
    (("Mord im Park", "Tatzeit: 01.01.2024, 10:00 Uhr", "Mitte"), ("Festnahme nach Mord", "01.01.2024, 10:00 und 02.01.2024, 11:00 Uhr", "Mitte"), None),  # a time of its own
    (("Mord im Park", "", "Mitte"), ("Mord am See", "", "Mitte"), None),  # no update
    (("Raub im Park", "", "Mitte"), ("Festnahme nach Mord", "", "Mitte"), None),  # another case
    (("Mord im Park", "", "Mitte"), ("Polizei nimmt Mann nach Tötungsdelikt fest", "Verstoßes gegen das Waffengesetz", "Mitte"), None),  # an offence of its own
    (("Mord im Park", "", "Mitte"), ("Polizei nimmt Mann nach Tötungsdelikt fest", None, "Mitte"), "case_update"),
    ((None, None, None), (None, None, None), None),
]


def test_kinds_of_followups(spark):
    rows = [(2 * k + n, *report) for k, case in enumerate(CASES) for n, report in enumerate(case[:2])]
    reports = spark.createDataFrame(rows, "id int, title string, body string, district string")
    links = spark.createDataFrame([(2 * k + 1, 2 * k) for k in range(len(CASES))] * 2 + [(1, 999), (999, 1)], "id int, ref int")
    found = followups.followups(reports, links).collect()
    assert {r.id: r.kind for r in found} == {2 * k + 1: kind for k, (*_, kind) in enumerate(CASES) if kind} and len(found) == len({r.id for r in found})
