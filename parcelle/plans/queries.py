"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the whole driver tables through the adapter in
``parcelle.sources.testdata`` and composes the library operators; names and
column aliases match ``parcelle.plans.oracle_sql.ORACLE``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.functions import numbers as num
from parcelle.functions.arrays import list_mean
from parcelle.functions.numbers import stable_round
from parcelle.functions.text import popup_text
from parcelle.operators import buckets
from parcelle.operators import clean as clean_ops
from parcelle.operators import filters as flt
from parcelle.operators import geo as geo_ops
from parcelle.operators import normalise as nz
from parcelle.operators import state as st
from parcelle.operators import stats as stats_ops
from parcelle.plans import jobs, queue
from parcelle.session import ensure_checkpoint_dir
from parcelle.sources import files, testdata
from parcelle.sources.tables import read_table
from parcelle.streaming import intake

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ shared inputs
def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.listings_raw(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str) -> clean_ops.Cleaned:
    return clean_ops.clean_listings(raw(spark, sf_dir))


def bucket_count(spark: SparkSession, sf_dir: str) -> int:
    """Buckets for the state of all listings, of which there is one for each line item."""
    return buckets.buckets_for(read_table(spark, sf_dir, "lineitem").count())


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).clean


def stats(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    return stats_ops.geo_stats(clean(spark, sf_dir), level,
                               testdata.zipcode_dim(spark, sf_dir),
                               testdata.department_dim(spark, sf_dir))


# ------------------------------------------------------------------ cleaning
@register("clean_listings")
def q_clean_listings(spark, sf_dir):
    return clean(spark, sf_dir)


@register("rejected_listings")
def q_rejected_listings(spark, sf_dir):
    return cleaned(spark, sf_dir).rejected


# ------------------------------------------------------------------ aggregates
@register("timeseries_month")
def q_timeseries_month(spark, sf_dir):
    return stats_ops.timeseries(clean(spark, sf_dir))


@register("stats_region")
def q_stats_region(spark, sf_dir):
    return stats(spark, sf_dir, "region")


@register("stats_department")
def q_stats_department(spark, sf_dir):
    return stats(spark, sf_dir, "department")


@register("stats_zipcode")
def q_stats_zipcode(spark, sf_dir):
    return stats(spark, sf_dir, "zipcode")


# ------------------------------------------------------------------ filters and lookups

SEARCH = flt.SearchFilters(city="Customer#000001", property_type="Appartement",
                           price_min=20000, price_max=80000,
                           start_date="1996-01-01", end_date="2000-12-31")
DEPT_MIN_COUNT = 400
REGION_MIN_COUNT = 1000
ZIP_MIN_COUNT = 3
RANGES = {"avg_price": (20000, 60000), "avg_m2": (10, 40), "avg_rooms": (1, 5)}
SELECTED_DEPARTMENTS = ["1", "3", "5", "7", "20"]


def zip_merged(spark, sf_dir):
    """Postal-code totals LEFT JOIN the postal-code table (explorer input)."""
    return geo_ops.zip_left_join(flt.stats_by_type(stats(spark, sf_dir, "zipcode"), "total"),
                                 testdata.zipcode_dim(spark, sf_dir))


@register("filter_search")
def q_filter_search(spark, sf_dir):
    return flt.apply_filters(clean(spark, sf_dir), SEARCH)


@register("stats_lookup")
def q_stats_lookup(spark, sf_dir):
    return flt.stats_lookup(stats(spark, sf_dir, "department"), "department", "NATION_7", "maison")


@register("stats_by_type")
def q_stats_by_type(spark, sf_dir):
    return flt.stats_by_type(stats(spark, sf_dir, "zipcode"), "appartement")


@register("stats_threshold")
def q_stats_threshold(spark, sf_dir):
    return flt.stats_threshold(stats(spark, sf_dir, "department"), "department", "total", DEPT_MIN_COUNT)


@register("range_filter")
def q_range_filter(spark, sf_dir):
    return flt.range_filter(zip_merged(spark, sf_dir), RANGES, min_count=5)


@register("in_filter")
def q_in_filter(spark, sf_dir):
    return flt.drop_missing_coordinates(flt.in_filter(zip_merged(spark, sf_dir), "Department",
                                                      SELECTED_DEPARTMENTS))


@register("price_window")
def q_price_window(spark, sf_dir):
    return flt.price_window(flt.stats_by_type(stats(spark, sf_dir, "department"), "total"),
                            56000, 58000, 400)


@register("bounds")
def q_bounds(spark, sf_dir):
    return stats_ops.bounds(zip_merged(spark, sf_dir))


@register("distinct_values")
def q_distinct_values(spark, sf_dir):
    return stats_ops.distinct_values(zip_merged(spark, sf_dir), "Department")


@register("influence_rank")
def q_influence_rank(spark, sf_dir):
    level = flt.normalise_level("Code postal")
    rows = flt.stats_by_type(stats(spark, sf_dir, level), "total").dropna(subset=["avg_price"])  # the window is the data's own bounds
    cols = flt.existing_columns(rows, stats_ops.INFLUENCE_FEATURES + ["avg_price"])
    return stats_ops.influence(rows.select(*cols))


# ------------------------------------------------------------------ joins
def dept_joined(spark, sf_dir):
    thr = flt.stats_threshold(stats(spark, sf_dir, "department"), "department", "total", DEPT_MIN_COUNT)
    return geo_ops.dept_stats_join(thr, testdata.department_dim(spark, sf_dir))


@register("dept_stats_join")
def q_dept_stats_join(spark, sf_dir):
    return dept_joined(spark, sf_dir)


@register("geo_inner_join")
def q_geo_inner_join(spark, sf_dir):
    j = geo_ops.geo_inner_join(testdata.department_features(spark, sf_dir), dept_joined(spark, sf_dir))
    return j.drop("geometry", "ID")


@register("region_ci_join")
def q_region_ci_join(spark, sf_dir):
    thr = flt.stats_threshold(stats(spark, sf_dir, "region"), "region", "total", REGION_MIN_COUNT)
    return geo_ops.region_ci_join(testdata.region_features(spark, sf_dir), thr).drop("geometry")


@register("zip_left_join")
def q_zip_left_join(spark, sf_dir):
    return flt.stats_threshold(stats(spark, sf_dir, "zipcode"), "zipcode", "maison", ZIP_MIN_COUNT,
                               testdata.zipcode_dim(spark, sf_dir))


# ------------------------------------------------------------------ keyed state

NOW = "2001-06-01 00:00:00"
LEDGER_BEFORE = "1998-01-01"
BATCH_SOURCE = "collector_n"


def state_inputs(spark, sf_dir):
    """Initial state from two collectors' rows, and the third collector's rows
    as the next batch."""
    r = raw(spark, sf_dir)
    initial = st.upsert(None, r.filter(F.col("source") != BATCH_SOURCE), keyed=True)
    batch = r.filter(F.col("source") == BATCH_SOURCE)
    return initial, batch


@register("upsert_state")
def q_upsert_state(spark, sf_dir):
    initial, batch = state_inputs(spark, sf_dir)
    return st.upsert(initial, batch).withColumn("features", F.array_join("features", "|"))


@register("upsert_buckets")
def q_upsert_buckets(spark, sf_dir):
    """The same two upserts on a state kept in hash buckets, read back from its files."""
    r = raw(spark, sf_dir)
    base = scratch(spark, "state")
    buckets.apply_batch(spark, base, r.filter(F.col("source") != BATCH_SOURCE), 0, buckets=bucket_count(spark, sf_dir))
    buckets.apply_batch(spark, base, r.filter(F.col("source") == BATCH_SOURCE), 1)
    return buckets.read_state(spark, base, 1).withColumn("features", F.array_join("features", "|"))


def maintained(spark, sf_dir):
    """Partial sums carried along by two upserts."""
    r = raw(spark, sf_dir)
    base, n = scratch(spark, "maintained"), bucket_count(spark, sf_dir)
    for version, batch in enumerate((r.filter(F.col("source") != BATCH_SOURCE), r.filter(F.col("source") == BATCH_SOURCE))):
        jobs.maintained_run(spark, base, batch, version, bucket_count=n)
    return jobs.kept_sums(spark, base, 1)


@register("stats_maintained")
def q_stats_maintained(spark, sf_dir):
    return stats_ops.geo_stats_of(maintained(spark, sf_dir), "region", *dims(spark, sf_dir))


@register("timeseries_maintained")
def q_timeseries_maintained(spark, sf_dir):
    return stats_ops.timeseries_of(maintained(spark, sf_dir))


@register("upsert_counters")
def q_upsert_counters(spark, sf_dir):
    initial, batch = state_inputs(spark, sf_dir)
    return st.upsert_counters(initial, batch)


@register("deactivate_stale")
def q_deactivate_stale(spark, sf_dir):
    return st.deactivate(raw(spark, sf_dir), NOW).select("_id", "listing_url", "last_seen_at", "is_active")


@register("dedupe_first")
def q_dedupe_first(spark, sf_dir):
    return st.dedupe(raw(spark, sf_dir)).select("_id", "listing_url", "source", "price", "last_seen_at")


@register("duplicate_groups")
def q_duplicate_groups(spark, sf_dir):
    return st.duplicate_groups(raw(spark, sf_dir))


@register("delete_candidates")
def q_delete_candidates(spark, sf_dir):
    return st.delete_candidates(raw(spark, sf_dir)).select("_id", "listing_url")


@register("mark_processed")
def q_mark_processed(spark, sf_dir):
    return st.mark_processed(raw(spark, sf_dir), clean(spark, sf_dir)).select("_id", "processed")


@register("unprocessed_batch")
def q_unprocessed_batch(spark, sf_dir):
    r = raw(spark, sf_dir)
    first_run = clean_ops.clean_listings(r.filter(F.col("first_seen_at") < F.lit(LEDGER_BEFORE).cast("timestamp_ntz")))
    return st.incremental_batch(r, first_run.clean)


@register("intake_once")
def q_intake_once(spark, sf_dir):
    """Listings landed in two turns, some of them twice, through the stream: each id once."""
    r = raw(spark, sf_dir)
    base = scratch(spark, "intake")
    # the second turn lands the listings of up to three rooms and those of the last collector: both, where both hold
    times = sum(F.when(c, 1).otherwise(0) for c in (F.col("rooms") <= 3, F.col("source") == BATCH_SOURCE))
    second = r.select("*", F.explode(F.array_repeat(F.lit(True), times)).alias("_again")).drop("_again")
    r.persist(StorageLevel.DISK_ONLY)  # joined once for both turns
    try:
        for part in (r.filter(F.col("source") != BATCH_SOURCE), second):
            part.write.mode("append").parquet(f"{base}/landing")
            intake.run_intake(spark, f"{base}/landing", f"{base}/out", f"{base}/stream")
    finally:
        r.unpersist()
    return intake.read_intake(spark, f"{base}/out").select("Id", *clean_ops.CLEAN_COLUMNS)


@register("queue_runs")
def q_queue_runs(spark, sf_dir):
    """Listings landed by day (the first of the year they were first seen in), cleaned in two runs of the queue."""
    base = scratch(spark, "queue")
    day = F.date_trunc("year", "first_seen_at").cast("date")
    raw(spark, sf_dir).withColumn(queue.DAY, day).write.partitionBy(queue.DAY).parquet(f"{base}/raw")
    paths = queue.QueuePaths(f"{base}/raw", f"{base}/done", f"{base}/closed")
    queue.queue_run(spark, paths, "first", limit=1000, before="1994-01-01")
    queue.queue_run(spark, paths, "second", before="2030-01-01")
    return spark.read.parquet(paths.done).select("Id", "reason", F.col(queue.DAY).cast("string").alias("landed"))


# ------------------------------------------------------------------ source normalisers

RUN_AT = "2024-06-01 12:00:00"


@register("dvf_normalise")
def q_dvf_normalise(spark, sf_dir):
    sales = nz.normalise_sales(testdata.sale_rows(spark, sf_dir), RUN_AT).listings
    return sales.withColumn("features", F.array_join("features", "|"))


@register("dvf_files")
def q_dvf_files(spark, sf_dir):
    """The same rows landed as CSV files of two formats in one folder, found by each file's header."""
    folder = scratch(spark, "sales")
    testdata.land_sales(testdata.sale_rows(spark, sf_dir), folder)
    sales = nz.normalise_sales(files.read_sales(spark, folder), RUN_AT).listings
    return sales.withColumn("features", F.array_join("features", "|"))


@register("dvf_rejected")
def q_dvf_rejected(spark, sf_dir):
    return nz.normalise_sales(testdata.sale_rows(spark, sf_dir), RUN_AT).rejected


def payload_fields(ad):
    """Three fields read back from an ad kept as JSON text."""
    return F.concat_ws("|", *[F.get_json_object(ad, f"$.{f}") for f in ("id", "city", "propertyType")])


@register("ads_normalise")
def q_ads_normalise(spark, sf_dir):
    ads = nz.read_ads(testdata.ad_payloads(spark, sf_dir))
    return nz.normalise_ads(ads, RUN_AT).withColumn("features", payload_fields(F.col("features")[0]))


@register("list_mean")
def q_list_mean(spark, sf_dir):
    """Null-tolerant list mean over whole vectors, over whole vectors whose
    negative components are null, and over lists that are empty or null for
    some labels."""
    e = read_table(spark, sf_dir, "embeddings")
    part = F.transform("embedding", lambda x: F.when(x >= 0, x))
    odd = F.when(F.col("label") == 0, F.array().cast("array<float>")).when(F.col("label") > 1, F.col("embedding"))
    return e.select("vec_id", stable_round(list_mean("embedding"), 6).alias("mean_all"),
                    stable_round(list_mean(part), 6).alias("mean_positive"),
                    stable_round(list_mean(odd), 6).alias("mean_odd"))


def cards(spark, sf_dir):
    return nz.read_cards(testdata.result_pages(raw(spark, sf_dir)))


@register("card_extract")
def q_card_extract(spark, sf_dir):
    return nz.normalise_cards(cards(spark, sf_dir), RUN_AT).withColumn("features", F.array_join("features", "|"))


@register("intake_counts")
def q_intake_counts(spark, sf_dir):
    ads = nz.read_ads(testdata.ad_payloads(spark, sf_dir)).select(F.lit("ads_api").alias("source"), "department", "page_id")
    found = cards(spark, sf_dir).select(F.lit("result_cards").alias("source"), "department", "page_id")
    return stats_ops.intake_counts(found.unionByName(ads))


@register("decimals_to_double")
def q_decimals_to_double(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    money = "decimal(18,2)"
    return nz.decimals_to_double(li.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast(money).alias("price"),
                                           F.col("l_quantity").cast(money).alias("surface_m2")))


# ------------------------------------------------------------------ scalar helpers


@register("keyfacts")
def q_keyfacts(spark, sf_dir):
    out = nz.normalise_keyfacts(testdata.card_facts(raw(spark, sf_dir)))
    return out.select("_id", "n_facts", "price", "rooms", "bedrooms", "surface_m2", "price_per_m2",
                      "city", "postal_code", "description", "property_type")


@register("number_clean")
def q_number_clean(spark, sf_dir):
    t = testdata.number_texts(spark, sf_dir)
    return t.select(
        "l_orderkey", "l_linenumber",
        num.clean_number("t_currency").alias("n_currency"),
        num.clean_price_text("t_comma").alias("n_comma"),
        num.clean_number("t_comma").alias("n_comma_generic"),
        num.clean_number("t_unit").alias("n_unit"),
        num.clean_number("t_dotted").alias("n_dotted"),
        num.clean_number("t_blank").alias("n_blank"),
        num.clean_price_text("t_nbsp").alias("n_nbsp"),
        num.digits_to_long("t_comma").alias("n_digits"),
    )


@register("run_metrics")
def q_run_metrics(spark, sf_dir):
    return stats_ops.run_metrics(testdata.run_log(spark, sf_dir))


@register("popup_text")
def q_popup_text(spark, sf_dir):
    z = q_zip_left_join(spark, sf_dir)
    return z.select("zipcode_name", popup_text(z).alias("popup"))


# ------------------------------------------------------------------ documented analyses (M1-M5)
PRICE_BAND = (20000, 90000)
DENSITY_BAND = (30000, 70000)


def dims(spark, sf_dir):
    return testdata.zipcode_dim(spark, sf_dir), testdata.department_dim(spark, sf_dir)


@register("price_zone_year")
def q_price_zone_year(spark, sf_dir):
    c = clean(spark, sf_dir).filter(F.col("Price").between(*PRICE_BAND)).withColumn("year", F.year("Date"))
    z, d = dims(spark, sf_dir)
    s = stats_ops.zone_stats(c, "region", z, d, by=["year"])
    return s.select("region_name", "year", "avg_price_m2", "nb_annonces")


@register("density")
def q_density(spark, sf_dir):
    c = clean(spark, sf_dir).filter((F.col("Logement") == "maison") & F.col("Price").between(*DENSITY_BAND))
    z, d = dims(spark, sf_dir)
    return stats_ops.zone_stats(c, "department", z, d).select("department_id", "department_name", "nb_annonces")


@register("surface_price")
def q_surface_price(spark, sf_dir):
    return stats_ops.surface_price(clean(spark, sf_dir))


@register("drilldown")
def q_drilldown(spark, sf_dir):
    z, d = dims(spark, sf_dir)
    return stats_ops.drilldown(clean(spark, sf_dir), z, d)


@register("word_freq")
def q_word_freq(spark, sf_dir):
    return stats_ops.word_frequencies(read_table(spark, sf_dir, "documents"))


@register("merged_state")
def q_merged_state(spark, sf_dir):
    """Two normalised sources merged under one schema, then loaded as keyed
    state (repeated sale keys collapse, sightings are counted)."""
    sales = nz.normalise_sales(testdata.sale_rows(spark, sf_dir), RUN_AT).listings
    ads = nz.normalise_ads(nz.read_ads(testdata.ad_payloads(spark, sf_dir)), RUN_AT)
    state = st.upsert(None, nz.merge_sources(sales, ads))
    return state.select("listing_url", "source", "price", "surface_m2", "rooms", "update_count")


@register("three_source_state")
def q_three_source_state(spark, sf_dir):
    """Sales, then ads, then cards upserted one after the other; every column of the state."""
    state = st.upsert(None, nz.normalise_sales(testdata.sale_rows(spark, sf_dir), RUN_AT).listings, keyed=True)
    state = st.upsert(state, nz.normalise_ads(nz.read_ads(testdata.ad_payloads(spark, sf_dir)), RUN_AT))
    state = st.upsert(state, nz.normalise_cards(cards(spark, sf_dir), RUN_AT))
    kept = F.when(F.col("source") == "ads_api", payload_fields(F.get("features", 0))).otherwise(F.array_join("features", "|"))
    return state.withColumn("features", kept)


# ------------------------------------------------------------------ every level, order, small forms
def _register_levels() -> None:
    for level in ("region", "zipcode"):
        def lookup(spark, sf_dir, level=level):
            s = stats(spark, sf_dir, level)
            return flt.stats_lookup(s, level, LOOKUP_NAMES[level], "appartement")

        register(f"stats_lookup_{level}")(lookup)
    for level in ("region", "department"):
        register(f"stats_by_type_{level}")(lambda spark, sf_dir, level=level: flt.stats_by_type(stats(spark, sf_dir, level), "maison"))
    for label, level in (("Région", "region"), ("Code postal", "zipcode")):
        register(f"stats_threshold_{level}")(lambda spark, sf_dir, label=label, level=level: flt.stats_threshold(
            stats(spark, sf_dir, level), label, "total", LEVEL_MIN_COUNT[level], testdata.zipcode_dim(spark, sf_dir)))


LOOKUP_NAMES = {"region": "ASIA", "zipcode": "00003"}
LEVEL_MIN_COUNT = {"region": REGION_MIN_COUNT, "zipcode": 10}
_register_levels()


def in_order(df: DataFrame) -> DataFrame:
    """A small ordered result with each row's place."""
    return df.coalesce(1).withColumn("place", F.monotonically_increasing_id())


@register("timeseries_city")
def q_timeseries_city(spark, sf_dir):
    return in_order(stats_ops.timeseries(clean(spark, sf_dir), city="customer#000000015"))


@register("influence_order")
def q_influence_order(spark, sf_dir):
    return in_order(q_influence_rank(spark, sf_dir))


@register("distinct_order")
def q_distinct_order(spark, sf_dir):
    return in_order(q_distinct_values(spark, sf_dir))


@register("clean_projection")
def q_clean_projection(spark, sf_dir):
    return clean_ops.output_projection(clean(spark, sf_dir))


@register("key_violations")
def q_key_violations(spark, sf_dir):
    return st.key_violations(raw(spark, sf_dir))


@register("batch_limit")
def q_batch_limit(spark, sf_dir):
    """The ordered batch of the first 500 unprocessed rows (the limit is the feature)."""
    return clean_ops.unprocessed(raw(spark, sf_dir), limit=500).select("_id", "price", "city", "last_seen_at")


@register("search_capped")
def q_search_capped(spark, sf_dir):
    """The first 100 hits in a total order (the cap is the feature)."""
    return flt.apply_filters(clean(spark, sf_dir), flt.SearchFilters(property_type="Maison"), limit=100)


@register("features_preview")
def q_features_preview(spark, sf_dir):
    return geo_ops.drop_geometry_preview(testdata.department_features(spark, sf_dir), order_by=["code"])


@register("geojson_features")
def q_geojson_features(spark, sf_dir):
    """Department features landed as one GeoJSON file and read back."""
    folder = scratch(spark, "features")
    testdata.land_features(testdata.department_features(spark, sf_dir), folder)
    point = lambda i: F.get_json_object("geometry", f"$.coordinates[{i}]").cast("double")
    return files.read_geojson(spark, folder).select("code", "nom", point(0).alias("x"), point(1).alias("y"))


@register("query_source")
def q_query_source(spark, sf_dir):
    clean(spark, sf_dir).createOrReplaceTempView("listings_clean")
    return files.read_query(spark, "SELECT Id, City, Price FROM listings_clean WHERE lower(Logement) = lower(:kind) AND Price >= :low",
                            args={"kind": "Appartement", "low": 60000})


@register("dimension_scan")
def q_dimension_scan(spark, sf_dir):
    return files.read_dimension(spark, f"{sf_dir}/nation.parquet")


@register("run_statistics")
def q_run_statistics(spark, sf_dir):
    """Each collector's run after the ledger date, against the state before it."""
    r = raw(spark, sf_dir)
    cut = F.lit(LEDGER_BEFORE).cast("timestamp_ntz")
    before = st.upsert(None, r.filter(F.col("first_seen_at") < cut))
    batch = r.filter(F.col("first_seen_at") >= cut).withColumnRenamed("source", "run_id")
    page = F.substring_index("listing_url", "_", 1)
    log = batch.groupBy("run_id", page.alias("page")).agg(F.count(F.lit(1)).alias("items"), F.min("last_seen_at").alias("fetched_at"))
    return stats_ops.run_statistics(log, st.run_counters(before, batch), RUN_AT, "finished")
