"""Reports that only carry on the case of an earlier one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import text as tx

#: What titles and bodies of follow-ups say, in normal form.
SEARCH, SEARCH_OVER, NO_OFFENCE = r"\bvermisstenfahndung\b", r"\berledigung der vermisstenfahndung\b", r"\bhinweise auf straftaten liegen nicht vor\b"
ACCIDENT, DEATH_AFTER, DIED = r"\b(?:verkehrs)?unf(?:all|äll)\w*", r"\bverstirbt nach (?:verkehrs)?unfall\b", r"\b(?:verstarb|starb|erlag)\b"
UPDATES = (
    "tataufklärung", r"festnahm\w*", r"verhaft\w*", r"zuführung\w*", r"haftbefehl\w*", "öffentlichkeitsfahndung", r"ermittelt\w*\s+tatverdächtig\w*", r"tatverdächtig\w*\s+stellt\s+sich", r"veröffentlicht\s+foto",
)
UPDATE = rf"\b(?:{'|'.join(UPDATES)})\b|\bnimmt\b.{{0,80}}\bfest\b"
#: An offence that stands for itself.
OTHER_OFFENCE = r"\bverstoss(?:es)? gegen das waffengesetz\b|\bverdacht\w*.{0,80}\billegal\w*\s+aufenthalt\w*"


def signs(reports: DataFrame) -> DataFrame:
    """(id, district, and yes-or-no signs, signatures and header times): what tells follow-ups, found once for each report (id, title, body, district)."""
    title, body = tx.normalised(F.coalesce("title", F.lit(""))), tx.normalised(F.coalesce("body", F.lit("")))
    said = lambda text, pattern: F.regexp_like(text, F.lit(f"(?U){pattern}"))
    found = {
        "search": said(title, SEARCH), "search_over": said(title, SEARCH_OVER) & said(body, NO_OFFENCE), "accident": said(title, ACCIDENT), "died": said(title, DEATH_AFTER) & said(body, DIED),
        "update": said(title, UPDATE) & ~said(body, OTHER_OFFENCE), "signatures": tx.case_signatures(title), "times": tx.header_times(body), "area": tx.normalised(F.coalesce("district", F.lit(""))),
    }
    return reports.select("id", *[c.alias(name) for name, c in found.items()])


def kind(now: Column, before: Column) -> Column:
    """What makes a report (struct of signs) a follow-up of an earlier one: ``missing_search``, ``traffic_death``, ``case_update`` or null.

    An update shares a sign of a serious case with the earlier report and a time or the district, and names no more times than that one unless all of its own are among them.
    """
    new_times = (F.size(before["times"]) > 0) & (F.size(now["times"]) > F.size(before["times"])) & (F.size(F.array_except(now["times"], before["times"])) > 0)
    same = F.arrays_overlap(now["times"], before["times"]) | ((now["area"] != "") & (now["area"] == before["area"]))
    update = now["update"] & F.arrays_overlap(now["signatures"], before["signatures"]) & ~new_times & same
    return F.when(now["search_over"] & before["search"], "missing_search").when(now["died"] & before["accident"], "traffic_death").when(update, "case_update")


def followups(reports: DataFrame, links: DataFrame) -> DataFrame:
    """(id, ref, kind): the links (id, ref) from a report to an earlier one that make it a follow-up, and why.

    Both sides join the signs by id: the texts are searched once for each report, whatever its links. Links of unknown reports give nothing; repeated links count once.
    """
    found = signs(reports)
    packed = F.struct(*[c for c in found.columns if c != "id"])
    now, before = found.select("id", packed.alias("now")), found.select(F.col("id").alias("ref"), packed.alias("before"))
    rows = links.select("id", "ref").distinct().join(now, "id").join(before, "ref")
    return rows.select("id", "ref", kind(F.col("now"), F.col("before")).alias("kind")).filter("kind IS NOT NULL")
