"""Aggregations over clean listings and over statistics tables.

Scale notes
-----------
* Every aggregate here is partial-aggregatable (sum, count, min, max,
  covariance moments), so hot keys are combined map-side before the shuffle.
* ``geo_stats`` aggregates the fact rows once by (postal code, type) and only
  then joins the small partial result to the geography dimensions and rolls it
  up: the large table is never shuffled for the dimension join.
* Means of prices, ratios and surfaces are exact sums (whole numbers taken from
  the doubles, nothing rounded) divided by a count, so results do not depend on
  partitioning or task retries, and partial sums can be kept and corrected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.functions.dates import month_start, timestamp_lit
from parcelle.functions.numbers import LIMBS, exact_avg, exact_mean, exact_sums, safe_ratio, stable_round

LEVEL_KEYS: dict[str, list[str]] = {
    "zipcode": ["zipcode_name"],
    "department": ["department_id", "department_name"],
    "region": ["region_name"],
}
# Fixed value: label of the all-types row of a statistics table.
TOTAL = "total"
# Label of listings whose postal code or department is not in the dimensions.
UNKNOWN = "unknown"
STAT_COLUMNS = ["avg_price", "avg_price_m2", "avg_m2", "avg_rooms", "nb_annonces"]
# Features ranked against the average price.
INFLUENCE_FEATURES = ["nb_annonces", "avg_m2", "avg_rooms"]


# --------------------------------------------------------------------------- partial sums
def partial_sums(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Exact sums and counts of price, price per m2 (ratio of each row; a zero surface gives none), surface and
    rooms, and the number of rows, per ``keys``.

    Such rows can be added up to any coarser key, and added to or taken from each other, without a
    rounding, so statistics kept as partial sums stay equal to a recomputation."""
    return df.groupBy(*keys).agg(
        *exact_sums("Price", "_p"), *exact_sums(safe_ratio("Price", "M2"), "_r"), *exact_sums("M2", "_m"),
        F.sum(F.col("Rooms").cast("bigint")).alias("_so"), F.count("Rooms").alias("_no"),
        F.count(F.lit(1)).alias("_n"))


SUM_COLUMNS = [f"{m}_{k}" for m in ("_p", "_r", "_m") for k in (*LIMBS, "n")] + ["_so", "_no", "_n"]


def merge_sums(parts: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Partial sums added up per ``keys``; groups that hold no row any more are gone."""
    added = [F.coalesce(F.sum(c), F.lit(0)).cast(t).alias(c) for c, t in parts.dtypes if c in SUM_COLUMNS]
    return parts.groupBy(*keys).agg(*added).filter(F.col("_n") > 0)


def negated(parts: DataFrame) -> DataFrame:
    """Partial sums to be taken away."""
    return parts.select(*[(-F.col(c)).cast(t).alias(c) if c in SUM_COLUMNS else F.col(c) for c, t in parts.dtypes])


def _merge_sums() -> list[Column]:
    return [
        exact_mean("_p").alias("avg_price"), exact_mean("_r").alias("avg_price_m2"), exact_mean("_m").alias("avg_m2"),
        F.try_divide(F.sum("_so").cast("double"), F.sum("_no").cast("double")).alias("avg_rooms"),
        F.sum("_n").cast("bigint").alias("nb_annonces"),
    ]


# --------------------------------------------------------------------------- E1
def timeseries(clean: DataFrame, city: str | None = None, start=None, end=None) -> DataFrame:
    """Monthly mean of price per square metre (mean of ratios; a zero surface
    gives a null ratio that the mean ignores), ordered by month.

    ``city`` matches case-insensitively; without it the series is computed for
    every city at once (keyed by the lower-cased city). The date range applies
    only when both ends are given, inclusive.
    """
    df = clean
    keys: list[Column] = []
    if city is not None:
        df = df.filter(F.lower(F.col("City")) == F.lower(F.lit(city)))
    else:
        keys.append(F.lower(F.col("City")).alias("city"))
    if start and end:
        df = df.filter(F.col("Date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    keys.append(month_start(F.col("Date")).alias("month"))
    out = df.groupBy(*keys).agg(exact_avg(safe_ratio("Price", "M2")).alias("price_m2"))
    return out.orderBy(*[k for k in ("city", "month") if k in out.columns])


def timeseries_of(sums: DataFrame) -> DataFrame:
    """The monthly series of every city from partial sums keyed by ``City`` and ``month``."""
    return (sums.groupBy(F.lower(F.col("City")).alias("city"), "month").agg(exact_mean("_r").alias("price_m2"))
            .orderBy("city", "month"))


# --------------------------------------------------------------------------- E8
def attach_geography(df: DataFrame, zipcodes: DataFrame, departments: DataFrame,
                     level: str) -> DataFrame:
    """Add the level's key columns to rows keyed by ``ZipCode``.

    Listings whose code is unknown stay, under the group ``unknown``. A code
    that a dimension holds twice would double listings, so it raises.
    """
    if level == "zipcode":
        return df.withColumn("zipcode_name", F.col("ZipCode"))
    z = _one_per_code(zipcodes.select(F.col("ZipCode").alias("_zc"), F.col("Department").alias("department_id")), "_zc")
    d = _one_per_code(departments.select(F.col("ID").alias("_id_dep"), F.col("Name").alias("department_name"),
                                         F.col("Region").alias("region_name")), "_id_dep")
    out = (df.join(z, df["ZipCode"] == z["_zc"], "left")
             .join(d, F.col("department_id") == F.col("_id_dep"), "left"))
    keys = ("department_id", "department_name", "region_name")
    return out.drop("_zc", "_id_dep").withColumns({k: F.coalesce(k, F.lit(UNKNOWN)) for k in keys})


def _one_per_code(dim: DataFrame, code: str) -> DataFrame:
    """A dimension with its codes checked to be unique (null codes match nothing)."""
    twice = F.raise_error(F.concat(F.lit(f"repeated code in {code}: "), F.col(code).cast("string")))
    return (dim.filter(F.col(code).isNotNull()).groupBy(code)
            .agg(*[F.when(F.count(F.lit(1)) > 1, twice.cast("string")).otherwise(F.min(c)).alias(c) for c in dim.columns if c != code]))


def geo_stats(clean: DataFrame, level: str, zipcodes: DataFrame | None = None,
              departments: DataFrame | None = None) -> DataFrame:
    """Statistics per (geography, housing type) plus a ``total`` row per
    geography: ``avg_price``, ``avg_price_m2``, ``avg_m2``, ``avg_rooms``,
    ``nb_annonces``."""
    return geo_stats_of(partial_sums(clean, ["ZipCode", "Logement"]), level, zipcodes, departments)


def geo_stats_of(sums: DataFrame, level: str, zipcodes: DataFrame | None = None,
                 departments: DataFrame | None = None) -> DataFrame:
    """``geo_stats`` from partial sums keyed by ``ZipCode``, ``Logement`` and any further columns."""
    if level not in LEVEL_KEYS:
        raise ValueError(f"level must be one of {sorted(LEVEL_KEYS)}")
    keys = LEVEL_KEYS[level]
    if level != "zipcode" and (zipcodes is None or departments is None):
        raise ValueError("department and region levels need the zipcode and department tables")
    located = attach_geography(sums, zipcodes, departments, level)
    grouped = located.groupingSets([[*keys, "Logement"], keys], *keys, "Logement")
    out = grouped.agg(*_merge_sums(), F.grouping("Logement").alias("_g"))
    return out.select(
        *keys,
        F.when(F.col("_g") == 1, F.lit(TOTAL)).otherwise(F.col("Logement")).alias("logement_type"),
        *STAT_COLUMNS,
    )


# --------------------------------------------------------------------------- E3 / E4
def bounds(df: DataFrame, columns: Sequence[str] = ("avg_price", "avg_m2", "avg_rooms", "nb_annonces")
           ) -> DataFrame:
    """One row of ``<c>_min`` / ``<c>_max`` truncated toward zero (display
    bounds; filter with exact values, truncation would drop a fractional max)."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).cast("bigint").alias(f"{c}_min"), F.max(c).cast("bigint").alias(f"{c}_max")]
    return df.agg(*aggs)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null distinct values, ascending."""
    return df.select(column).dropna().distinct().orderBy(column)


# --------------------------------------------------------------------------- E5
def pearson(a, b) -> Column:
    """Pearson r over complete pairs; null (not an error) for a constant
    column or fewer than two pairs."""
    a = (F.col(a) if isinstance(a, str) else a).cast("double")
    b = (F.col(b) if isinstance(b, str) else b).cast("double")
    both = a.isNotNull() & b.isNotNull()
    a2, b2 = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(a2, b2), F.stddev_pop(a2) * F.stddev_pop(b2))


def influence(df: DataFrame, features: Sequence[str] = INFLUENCE_FEATURES,
              target: str = "avg_price", decimals: int = 6) -> DataFrame:
    """``feature, correlation``: |r| of each present feature with ``target``,
    descending, undefined last. Raises when the target or every feature is
    missing."""
    present = [f for f in features if f in df.columns]
    if target not in df.columns or not present:
        raise ValueError("need the target column and at least one feature column")
    wide = df.agg(*[pearson(f, target).alias(f) for f in present])
    long = wide.unpivot([], present, "feature", "r")
    return (long.select("feature", stable_round(F.abs("r"), decimals).alias("correlation"))
                .orderBy(F.desc_nulls_last("correlation"), "feature"))


# --------------------------------------------------------------------------- E9 / E10
def run_metrics(log: DataFrame, run_col: str = "run_id", items_col: str = "items",
                ts_col: str = "fetched_at") -> DataFrame:
    """Per run: start, duration, totals, items per page and time per item;
    pages count only when they returned items, denominators are at least 1."""
    duration = F.timestamp_diff("MICROSECOND", F.min(ts_col), F.max(ts_col)) / F.lit(1e6)
    agg = log.groupBy(run_col).agg(
        F.min(ts_col).alias("started_at"),
        duration.alias("duration_seconds"),
        F.sum(F.col(items_col).cast("bigint")).alias("total_properties"),
        F.count_if(F.col(items_col) > 0).alias("total_pages"),
    )
    one = F.lit(1)
    return agg.select(
        run_col, "started_at", "duration_seconds", "total_properties", "total_pages",
        (F.col("total_properties") / F.greatest(one, F.col("total_pages"))).alias("properties_per_page"),
        (F.col("duration_seconds") / F.greatest(one, F.col("total_properties"))).alias("time_per_property"),
    )


def run_statistics(log: DataFrame, counters: DataFrame, now, reason: str, run_col: str = "run_id") -> DataFrame:
    """One statistics row per run of the log: its metrics, the new and updated
    listings that ``counters`` gives for it (0 when absent), the time of
    recording and the reason it ended."""
    m = run_metrics(log, run_col).join(counters, run_col, "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return m.select(run_col, timestamp_lit(now).alias("timestamp"), "duration_seconds", "total_properties",
                    n("new_properties"), n("updated_properties"), "total_pages", "properties_per_page",
                    "time_per_property", F.lit(reason).alias("reason"))


def intake_counts(cards: DataFrame, source_col: str = "source", department_col: str = "department",
                  page_col: str = "page_id") -> DataFrame:
    """Cards (or ads) and distinct pages per (source, department)."""
    return cards.groupBy(source_col, department_col).agg(
        F.count(F.lit(1)).alias("cards"), F.count_distinct(page_col).alias("pages"))


# --------------------------------------------------------------------------- M1-M5
def zone_stats(clean: DataFrame, level: str, zipcodes: DataFrame | None = None,
               departments: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Statistics per geography (and extra keys ``by``), all types together.

    Same plan as ``geo_stats``: partial sums per postal code first, then the
    small partial result meets the dimensions."""
    keys = LEVEL_KEYS[level]
    located = attach_geography(partial_sums(clean, ["ZipCode", *by]), zipcodes, departments, level)
    return located.groupBy(*keys, *by).agg(*_merge_sums())


def with_surface_band(df: DataFrame, bands: Sequence[float] = (20, 35), col: str = "M2") -> DataFrame:
    """Band label from ascending upper bounds: ``<20``, ``20-35``, ``>=35``."""
    expr = None
    lower = None
    for b in bands:
        label = f"<{b:g}" if lower is None else f"{lower:g}-{b:g}"
        cond = F.col(col) < F.lit(b)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        lower = b
    return df.withColumn("surface_band", expr.otherwise(F.lit(f">={lower:g}")))


def surface_price(clean: DataFrame, bands: Sequence[float] = (20, 35)) -> DataFrame:
    """Average surface against average price per commune and surface band."""
    banded = with_surface_band(clean, bands)
    return banded.groupBy(F.col("City").alias("commune"), "surface_band").agg(
        exact_avg("M2").alias("avg_m2"), exact_avg("Price").alias("avg_price"),
        F.count(F.lit(1)).alias("nb_annonces"))


# Drill-down level names by grouping id of (region, department, commune).
DRILL_LEVELS = {0: "commune", 1: "department", 3: "region", 7: "national"}


def drilldown(clean: DataFrame, zipcodes: DataFrame, departments: DataFrame) -> DataFrame:
    """National / region / department / commune rows of one ROLLUP, computed
    from per-(postal code, commune) partial sums."""
    return drilldown_of(partial_sums(clean, ["ZipCode", "City"]), zipcodes, departments)


def drilldown_of(sums: DataFrame, zipcodes: DataFrame, departments: DataFrame) -> DataFrame:
    """``drilldown`` from partial sums keyed by ``ZipCode``, ``City`` and any further columns."""
    located = attach_geography(sums, zipcodes, departments, "department")
    rolled = located.rollup("region_name", "department_name", "City").agg(
        *_merge_sums(), F.grouping_id().alias("_gid"))
    level = None
    for gid, name in DRILL_LEVELS.items():
        cond = F.col("_gid") == gid
        level = F.when(cond, F.lit(name)) if level is None else level.when(cond, F.lit(name))
    return rolled.select("region_name", "department_name", F.col("City").alias("commune"),
                         level.alias("level"), "avg_price", "nb_annonces")


def word_frequencies(docs: DataFrame, text_col: str = "text", top: int | None = None) -> DataFrame:
    """Lower-cased letter runs counted over whole texts, most frequent
    first (ties by word); ``top`` keeps the first for a word cloud. Counting is a partial
    aggregate, so frequent words are combined map-side."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text_col)), r"[^\p{L}]+")).alias("word"))
    counts = words.filter(F.length("word") > 0).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), "word")
    return ordered.limit(top) if top else ordered
