"""Rule tables over tag maps, compiled to ladders of expressions."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds of places in the order in which they are tried; each alternative wants all its keys to have one of its values.
PLACE_KINDS = [
    ("bar", [{"amenity": ["bar", "pub"]}]),
    ("nightclub", [{"amenity": ["nightclub"]}]),
    ("restaurant", [{"amenity": ["restaurant"]}]),
    ("cafe", [{"amenity": ["cafe"]}]),
    ("fast_food", [{"amenity": ["fast_food"]}]),
    ("marketplace", [{"amenity": ["marketplace"]}]),
    ("parking", [{"amenity": ["parking"]}]),
    ("station", [{"amenity": ["bus_station"]}, {"railway": ["station", "halt", "tram_stop"]}, {"building": ["train_station"]}, {"highway": ["bus_stop"]}, {"public_transport": ["platform"], "bus": ["yes"]}, {"public_transport": ["platform"], "tram": ["yes"]}]),
    ("airport", [{"aeroway": ["terminal"]}]),
    ("shop", [{"shop": None}]),
    ("attraction", [{"tourism": ["attraction", "museum"]}]),
    ("hotel", [{"tourism": ["hotel"]}]),
    ("park", [{"leisure": ["park"]}]),
]
#: Tag values of shops that are none.
NO_SHOP = ["no", "vacant", "closed", "abandoned", "demolished"]


def meets(tags: Column, wanted: dict[str, list[str] | None]) -> Column:
    """All keys have one of their values; None stands for any that is not blank and not a closed shop's."""
    def one(key: str, values: list[str] | None) -> Column:
        value = F.try_element_at(tags, F.lit(key))
        test = value.isin(values) if values else (F.trim(value) != "") & ~value.isin(NO_SHOP)
        return F.coalesce(test, F.lit(False))

    return reduce(and_, [one(k, v) for k, v in wanted.items()])


def place_kind(tags: Column, rules: list[tuple[str, list[dict]]] = PLACE_KINDS) -> Column:
    """The kind of the first rule with an alternative that the tags meet; null if there is none."""
    return F.coalesce(*[F.when(reduce(or_, [meets(tags, a) for a in alternatives]), F.lit(kind)) for kind, alternatives in rules])


def tag_names(tags: Column, keys: tuple[str, ...] = ("name", "alt_name", "official_name", "short_name", "loc_name", "old_name")) -> Column:
    """Names of an object, sorted: what its name keys hold, split at semicolons."""
    parts = F.flatten(F.array(*[F.split(F.coalesce(F.try_element_at(tags, F.lit(k)), F.lit("")), ";") for k in keys]))
    return F.array_sort(F.array_distinct(F.filter(F.transform(parts, F.trim), lambda x: x != "")))
