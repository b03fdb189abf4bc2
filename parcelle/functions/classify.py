"""Keyword classifiers and type dictionaries as folded ``when`` chains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelle.functions._util import col_of

# Housing-type keywords of the cleaning step, tested in this
# order; the first substring match wins.
HOUSING_KEYWORDS: dict[str, list[str]] = {
    "maison": ["maison", "mas", "chalet", "villa"],
    "appartement": ["appartement", "studio", "duplex", "triplex", "loft"],
}
UNCLASSIFIED = "autre"

# Keywords searched in a result-card description, in this order.
CARD_TYPE_KEYWORDS: list[str] = ["maison", "appartement", "terrain", "studio", "villa", "loft"]

# Property types of the JSON ads, mapped to display names;
# unknown types pass through unchanged.
AD_TYPE_NAMES: dict[str, str] = {
    "house": "maison",
    "flat": "appartement",
    "programme": "programme",
    "loft": "loft",
    "castle": "château",
    "townhouse": "maison de ville",
}


def classify(c, keyword_map: Mapping[str, Sequence[str]] = HOUSING_KEYWORDS,
             default: str = UNCLASSIFIED) -> Column:
    """First keyword (in map order) contained in ``c`` decides the class.

    A null input matches nothing and gets ``default``.
    """
    name = col_of(c)
    expr = None
    for label, keywords in keyword_map.items():
        for kw in keywords:
            cond = name.contains(kw)
            expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.lit(default) if expr is None else expr.otherwise(default)


def studio_rooms(name, rooms) -> Column:
    """A studio has one room whatever the stated count."""
    return F.when(col_of(name).contains("studio"), F.lit(1)).otherwise(col_of(rooms))


def type_by_first_keyword(text, keywords: Sequence[str] = CARD_TYPE_KEYWORDS) -> Column:
    """First keyword of ``keywords`` found in the lower-cased text, capitalised."""
    t = F.lower(col_of(text))
    expr = None
    for kw in keywords:
        cond = t.contains(kw)
        value = F.lit(kw[:1].upper() + kw[1:])
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr


def map_or_keep(c, mapping: Mapping[str, str] = AD_TYPE_NAMES) -> Column:
    """Dictionary lookup; keys without an entry pass through unchanged."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col_of(c)), col_of(c))


def two_way_type(c, house_value: str = "Maison") -> Column:
    """``Maison`` gives ``maison``, anything else ``appartement``."""
    return F.when(col_of(c) == house_value, F.lit("maison")).otherwise(F.lit("appartement"))
