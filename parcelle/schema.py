"""Explicit schemas of the listing data model (no inference at scan time)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampNTZType)

LISTINGS_RAW = StructType([
    StructField("_id", StringType()),
    StructField("listing_url", StringType()),
    StructField("source", StringType()),
    StructField("department", StringType()),
    StructField("price", DoubleType()),
    StructField("price_per_m2", DoubleType()),
    StructField("surface_m2", DoubleType()),
    StructField("rooms", IntegerType()),
    StructField("bedrooms", IntegerType()),
    StructField("address", StringType()),
    StructField("city", StringType()),
    StructField("postal_code", StringType()),
    StructField("property_type", StringType()),
    StructField("features", ArrayType(StringType())),
    StructField("description", StringType()),
    StructField("first_seen_at", TimestampNTZType()),
    StructField("last_seen_at", TimestampNTZType()),
    StructField("is_active", BooleanType()),
    StructField("update_count", LongType()),
    StructField("processed", BooleanType()),
    StructField("scraped_at", StringType()),
])

LISTINGS_CLEAN = StructType([
    StructField("Name", StringType()),
    StructField("Price", DoubleType()),
    StructField("M2", DoubleType()),
    StructField("City", StringType()),
    StructField("Logement", StringType()),
    StructField("Rooms", IntegerType()),
    StructField("Date", DateType()),
    StructField("ZipCode", StringType()),
])

# Columns of the yearly open-data sale files that the normaliser reads; every
# column arrives as a string.
SALE_COLUMNS = [
    "id_mutation", "date_mutation", "numero_disposition", "nature_mutation", "valeur_fonciere",
    "adresse_numero", "adresse_suffixe", "adresse_nom_voie", "code_postal", "nom_commune",
    "code_departement", "lot1_surface_carrez", "lot2_surface_carrez", "lot3_surface_carrez",
    "lot4_surface_carrez", "lot5_surface_carrez", "type_local", "surface_reelle_bati",
    "nombre_pieces_principales",
]
SALE_ROWS = StructType([StructField(c, StringType()) for c in SALE_COLUMNS])

GEOJSON = StructType([
    StructField("type", StringType()),
    StructField("features", ArrayType(StructType([
        StructField("properties", StructType([StructField("code", StringType()),
                                              StructField("nom", StringType())])),
        # a string field keeps the raw JSON text of the geometry object
        StructField("geometry", StringType()),
    ]))),
])

RUN_STATS = StructType([
    StructField("run_id", StringType()),
    StructField("timestamp", TimestampNTZType()),
    StructField("duration_seconds", DoubleType()),
    StructField("total_properties", LongType()),
    StructField("new_properties", LongType()),
    StructField("updated_properties", LongType()),
    StructField("total_pages", LongType()),
    StructField("properties_per_page", DoubleType()),
    StructField("time_per_property", DoubleType()),
    StructField("reason", StringType()),
])
