"""Predicate builders and filters for listings and statistics tables.

Every filter is a ``Column`` predicate applied with ``DataFrame.filter``, so
Catalyst pushes it as far down as it can go (into the Parquet scan when the
column comes straight from storage).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.functions.geo import department_code
from parcelle.operators.stats import LEVEL_KEYS

# Fixed value: the "all types" choice that disables the type filter.
ALL_TYPES = "Tous"


@dataclass(frozen=True)
class SearchFilters:
    """Optional search settings; a filter applies only when its value is set
    (a range only when both ends are set and non-zero)."""
    city: str | None = None
    property_type: str | None = None
    price_min: float | None = None
    price_max: float | None = None
    start_date: str | None = None
    end_date: str | None = None


@dataclass(frozen=True)
class SearchColumns:
    city: str = "City"
    property_type: str = "Logement"
    price: str = "Price"
    date: str = "Date"


def _lit_as(df: DataFrame, column: str, value) -> Column:
    return F.lit(value).cast(df.schema[column].dataType)


def search_predicates(df: DataFrame, filters: SearchFilters,
                      cols: SearchColumns = SearchColumns()) -> list[Column]:
    """The predicates that apply: city substring (case-insensitive, ``%`` and
    ``_`` act as wildcards), type equality (case-insensitive, ``Tous``
    disables it), inclusive price and date ranges."""
    preds: list[Column] = []
    if filters.city:
        pattern = filters.city.lower().replace("\\", "\\\\")  # a backslash stands for itself
        preds.append(F.lower(F.col(cols.city)).like(f"%{pattern}%"))
    if filters.property_type and filters.property_type != ALL_TYPES:
        preds.append(F.lower(F.col(cols.property_type)) == F.lit(filters.property_type.lower()))
    if filters.price_min and filters.price_max:
        preds.append(F.col(cols.price).between(filters.price_min, filters.price_max))
    if filters.start_date and filters.end_date:
        preds.append(F.col(cols.date).between(_lit_as(df, cols.date, filters.start_date),
                                              _lit_as(df, cols.date, filters.end_date)))
    return preds


def and_all(preds: Iterable[Column]) -> Column | None:
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else None


def apply_filters(df: DataFrame, filters: SearchFilters, cols: SearchColumns = SearchColumns(),
                  limit: int | None = None, order_by: Sequence[str] | None = None) -> DataFrame:
    """AND of the applicable predicates; an optional row cap is taken after a
    total order (``order_by``, default all columns) so it is reproducible."""
    pred = and_all(search_predicates(df, filters, cols))
    out = df if pred is None else df.filter(pred)
    if limit is not None:
        out = out.orderBy(*(order_by or out.columns)).limit(limit)
    return out


# ---------------------------------------------------------------- statistics tables
# Labels of the levels on the pages.
LEVEL_LABELS = {"département": "department", "région": "region", "code postal": "zipcode",
                "department": "department", "region": "region", "zipcode": "zipcode"}
LEVEL_NAME_COLUMN = {"department": "department_name", "region": "region_name", "zipcode": "zipcode_name"}


def stats_lookup(stats: DataFrame, level: str, name, logement_type: str = "total") -> DataFrame:
    """Rows of one geography name and housing type (exact, case-sensitive)."""
    return stats.filter((F.col(LEVEL_NAME_COLUMN[level]) == F.lit(name))
                        & (F.col("logement_type") == F.lit(logement_type)))


def stats_by_type(stats: DataFrame, logement_type: str = "total") -> DataFrame:
    return stats.filter(F.col("logement_type") == F.lit(logement_type))


def normalise_level(level: str) -> str:
    """Level of a name or of a page's label; unknown ones raise."""
    try:
        return LEVEL_LABELS[level.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown level {level!r}") from None


def stats_threshold(stats: DataFrame, level: str, logement_type: str, min_count: int,
                    zipcodes: DataFrame | None = None) -> DataFrame:
    """Rows of one type with at least ``min_count`` listings, projected as the
    map pages read them. Department ids are padded and repaired; postal codes
    are joined (left) to their department and town group."""
    level = normalise_level(level)
    rows = stats.filter((F.col("logement_type") == F.lit(logement_type))
                        & (F.col("nb_annonces") >= F.lit(min_count)))
    if level == "department":
        return rows.select(department_code(F.col("department_id")).alias("department_id"),
                           "department_name", "avg_price", "nb_annonces")
    if level == "region":
        return rows.select("region_name", "avg_price", "nb_annonces")
    if zipcodes is None:
        raise ValueError("the postal-code level needs the zipcode table")
    z = zipcodes.select(F.col("ZipCode").alias("_zc"), "Department", "GroupCitys")
    return (rows.join(z, rows["zipcode_name"] == z["_zc"], "left")
                .select("zipcode_name", "avg_price", "nb_annonces", "Department", "GroupCitys"))


def range_filter(df: DataFrame, ranges: Mapping[str, tuple[float, float]],
                 min_count: int | None = None, count_col: str = "nb_annonces") -> DataFrame:
    """Inclusive ``between`` on every ranged column, plus ``count >= min``;
    a null value fails its range."""
    preds = [F.col(c).between(lo, hi) for c, (lo, hi) in ranges.items()]
    if min_count is not None:
        preds.append(F.col(count_col) >= F.lit(min_count))
    pred = and_all(preds)
    return df if pred is None else df.filter(pred)


def in_filter(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """``column IN values``; an empty selection filters nothing."""
    return df.filter(F.col(column).isin(list(values))) if values else df


def drop_missing_coordinates(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Keep rows with both coordinates; skipped when the columns are absent."""
    if lat in df.columns and lon in df.columns:
        return df.dropna(subset=[lat, lon])
    return df


def price_window(df: DataFrame, min_price: float, max_price: float, min_count: int,
                 price_col: str = "avg_price", count_col: str = "nb_annonces") -> DataFrame:
    """``min <= avg_price <= max`` and ``nb_annonces >= n``."""
    return df.filter((F.col(price_col) >= F.lit(min_price)) & (F.col(price_col) <= F.lit(max_price))
                     & (F.col(count_col) >= F.lit(min_count)))


def existing_columns(df: DataFrame, wanted: Sequence[str], required: str = "avg_price",
                     min_features: int = 1) -> list[str]:
    """Wanted columns present in ``df``; raise when ``required`` is missing or
    fewer than ``min_features`` others are present."""
    present = [c for c in wanted if c in df.columns]
    others = [c for c in present if c != required]
    if required not in df.columns or len(others) < min_features:
        raise ValueError("not enough columns to compare")
    return present


__all__ = ["SearchFilters", "SearchColumns", "search_predicates", "apply_filters", "stats_lookup",
           "stats_by_type", "normalise_level", "stats_threshold", "range_filter", "in_filter",
           "drop_missing_coordinates", "price_window", "existing_columns", "LEVEL_KEYS"]
