"""Cleaning of raw listings into the clean listing table.

``clean_listings`` is one projection over the raw rows that computes every
output column and a ``reason`` column naming the first failed check; the
clean and rejected outputs are two filters of that projection. Everything is
a native column expression, so the whole step runs as one codegen stage with
no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from parcelle.functions.classify import HOUSING_KEYWORDS, UNCLASSIFIED, classify, studio_rooms
from parcelle.functions.dates import to_date_lenient
from parcelle.functions.text import remove_whitespace

# Fields read from the raw collection by the cleaning step (plus the
# last-seen timestamp, used when the scrape date is missing).
CLEAN_INPUT_FIELDS = ["_id", "price", "surface_m2", "city", "property_type", "rooms",
                      "scraped_at", "postal_code"]
CLEAN_COLUMNS = ["Name", "Price", "M2", "City", "Logement", "Rooms", "Date", "ZipCode"]

# Cleaning thresholds (price strictly above, surface at least).
MIN_PRICE_EXCLUSIVE = 10000
MIN_SURFACE = 9


class Cleaned(NamedTuple):
    clean: DataFrame
    rejected: DataFrame


def unprocessed(raw: DataFrame, limit: int | None = None,
                order_by: Sequence[str] = ("_id",)) -> DataFrame:
    """Rows not yet processed (a missing flag or column means not processed), then an
    optional batch limit over a total order, then the cleaning fields."""
    df = raw.filter(~F.coalesce(F.col("processed"), F.lit(False))) if "processed" in raw.columns else raw
    if limit is not None:
        # ordered limit: a deterministic batch, planned as a distributed top-k
        df = df.orderBy(*order_by).limit(limit)
    cols = [c for c in CLEAN_INPUT_FIELDS + ["last_seen_at"] if c in df.columns]
    return df.select(*cols)


def _rooms_int(c: Column, is_string: bool) -> Column:
    # strings go through double so "3.0" reads as 3, as numbers would
    return (c.try_cast("double") if is_string else c).try_cast("int")


def project_listing(df: DataFrame) -> DataFrame:
    """Rename and cast: Id, Price, M2, City, Name, Rooms, ZipCode, Date."""
    types = dict(df.dtypes)
    date = to_date_lenient(F.col("scraped_at"), df.schema["scraped_at"].dataType)
    if "last_seen_at" in types:
        date = F.coalesce(date, F.to_date("last_seen_at"))
    return df.select(
        F.col("_id").alias("Id"),
        F.col("price").try_cast("double").alias("Price"),
        F.col("surface_m2").try_cast("double").alias("M2"),
        F.col("city").cast("string").alias("City"),
        F.col("property_type").cast("string").alias("Name"),
        _rooms_int(F.col("rooms"), isinstance(df.schema["rooms"].dataType, StringType)).alias("Rooms"),
        F.col("postal_code").cast("string").alias("ZipCode"),
        date.alias("Date"),
    )


def _stage(projected: DataFrame, keyword_map: Mapping[str, Sequence[str]]) -> DataFrame:
    """Cleaned postal code, lower-cased name and housing type, computed once
    in one projection that the checks read."""
    return projected.select(
        "Id", "Price", "M2", "City", "Rooms", "Date",
        F.col("ZipCode").isNotNull().alias("_has_zip"),
        remove_whitespace(F.col("ZipCode")).alias("ZipCode"),
        F.lower(F.col("Name")).alias("Name"),
    ).withColumn("Logement", classify(F.col("Name"), keyword_map))


def _checks(min_price: float, min_surface: float) -> list[tuple[str, Column]]:
    """Named checks over the staged columns, in the order that names a
    rejected row's reason. Each check is false (never null) when it fails."""
    zc = F.col("ZipCode")
    price, m2 = F.col("Price"), F.col("M2")
    return [
        ("postal_code", F.col("_has_zip") & (F.length(zc) == 5) & zc.rlike(r"^[0-9]{5}$")),
        ("price", price.isNotNull() & ~F.isnan(price) & (price > min_price)),
        ("surface", m2.isNotNull() & ~F.isnan(m2) & (m2 >= min_surface)),
        ("type", F.col("Logement") != UNCLASSIFIED),
    ]


def _reason(checks: list[tuple[str, Column]]) -> Column:
    """Name of the first failed check (null when every check passes)."""
    expr = None
    for name, ok in checks:
        expr = F.when(~ok, F.lit(name)) if expr is None else expr.when(~ok, F.lit(name))
    return expr


def _all_pass(checks: list[tuple[str, Column]]) -> Column:
    """Conjunction of the checks, cheapest first: the price and surface
    ranges are plain comparisons on source columns, which Catalyst can push to
    the scan (Parquet row-group filters); the string checks run only on rows
    that passed them. A CASE over the same checks could not be split like this."""
    by_name = dict(checks)
    out = None
    for name in ("price", "surface", "postal_code", "type"):
        out = by_name[name] if out is None else out & by_name[name]
    return out


def with_checks(projected: DataFrame,
                keyword_map: Mapping[str, Sequence[str]] = HOUSING_KEYWORDS,
                min_price: float = MIN_PRICE_EXCLUSIVE,
                min_surface: float = MIN_SURFACE) -> DataFrame:
    """Add cleaned columns and ``reason`` (null when the row is kept).

    For a job that writes both outputs from one persisted frame; the
    registered queries use ``clean_listings``, whose clean side is a
    pushable conjunction instead of a test on ``reason``."""
    staged = _stage(projected, keyword_map)
    return staged.select(
        "Id", "Name", "Price", "M2", "City", "Logement",
        studio_rooms(F.col("Name"), F.col("Rooms")).alias("Rooms"),
        "Date", "ZipCode",
        _reason(_checks(min_price, min_surface)).alias("reason"),
    )


def clean_listings(raw: DataFrame, limit: int | None = None,
                   keyword_map: Mapping[str, Sequence[str]] = HOUSING_KEYWORDS,
                   min_price: float = MIN_PRICE_EXCLUSIVE,
                   min_surface: float = MIN_SURFACE) -> Cleaned:
    """Unprocessed raw rows to ``(clean, rejected)``.

    ``clean`` has ``Id`` plus the 8 output columns; ``rejected`` has ``Id`` and
    the first failed check. A job writing both should use ``with_checks`` and
    persist it (or write it once) so the source is scanned a single time.
    """
    staged = _stage(project_listing(unprocessed(raw, limit)), keyword_map)
    checks = _checks(min_price, min_surface)
    passed = _all_pass(checks)
    clean = staged.filter(passed).select(
        "Id", "Name", "Price", "M2", "City", "Logement",
        studio_rooms(F.col("Name"), F.col("Rooms")).alias("Rooms"), "Date", "ZipCode")
    rejected = staged.filter(~passed).select("Id", _reason(checks).alias("reason"))
    return Cleaned(clean, rejected)


def output_projection(clean: DataFrame) -> DataFrame:
    """The 8 columns written to the clean table."""
    return clean.select(*CLEAN_COLUMNS)
