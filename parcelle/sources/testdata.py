"""Adapter from the driver's star-schema tables to the listing data model.

The driver ships no real-estate data, so a listing collection, its dimension
tables and the landed raw formats (open-data CSV rows, JSON ad payloads,
result pages) are derived from the given tables with column expressions and
joins only. Each derived frame grows with the inputs; nothing is generated.

Mapping (one listing per ``lineitem`` row):

* ``_id`` unique row id; ``listing_url`` = order key + line number, which is
  *not* unique, so upserts and duplicate removal see real duplicates;
* price / surface / rooms = extended price / quantity / line number;
* property type = a listing-type word chosen by the part noun plus the part
  adjective, so the housing classifier sees real keywords;
* postal code = zero-padded customer key, written with an inner space for one
  market segment and with a trailing letter for another (cleaning rejects it);
* city = customer name, department = nation key, region = region name;
* first/last seen = order date / ship date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.functions.geo import pad_code
from parcelle.sources.tables import read_table

# Fixed adapter values: listing-type word for each part noun.
PART_NOUN_TYPES: dict[str, str] = {
    "widget": "Maison",
    "gizmo": "Villa",
    "rod": "Chalet",
    "ring": "Appartement",
    "plate": "Studio",
    "gear": "Duplex",
    "bolt": "Terrain",
    "anvil": "Château",
}


def postal_code_of(custkey) -> F.Column:
    return pad_code(custkey, 5)


def _property_type(p_name, p_size) -> F.Column:
    noun = F.get(F.split(p_name, " "), 1)
    adjective = F.get(F.split(p_name, " "), 0)
    pairs = []
    for k, v in PART_NOUN_TYPES.items():
        pairs += [F.lit(k), F.lit(v)]
    word = F.coalesce(F.try_element_at(F.create_map(*pairs), noun), noun)
    # parts of the largest size carry no type at all (null name case)
    return F.when(p_size < 50, F.concat(word, F.lit(" "), adjective))


def _postal_code(custkey, segment) -> F.Column:
    p = postal_code_of(custkey)
    return (F.when(segment == "BUILDING", F.concat(F.substring(p, 1, 2), F.lit(" "), F.substring(p, 3, 100)))
            .when(segment == "MACHINERY", F.concat(p, F.lit("A")))
            .otherwise(p))


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing documents (schema ``parcelle.schema.LISTINGS_RAW``).

    Attributes that depend only on a dimension row (property type from the
    part, postal code / city / department from the customer) are derived on
    the dimension before the join, so they are computed once per dimension row
    rather than once per line item."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_name").alias("city"),
        pad_code("c_nationkey", 2).alias("department"),
        _postal_code(F.col("c_custkey"), F.col("c_mktsegment")).alias("postal_code"))
    # an order meets its customer before its line items, which are several times as many: they move once less
    orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand",
        _property_type(F.col("p_name"), F.col("p_size")).alias("property_type"),
        F.split("p_name", " ").alias("features"))

    j = (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(part, F.col("l_partkey") == F.col("p_partkey")))

    order_day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.date_format("l_shipdate", "yyyyMMdd")).alias("_id"),
        F.concat(F.lit("L"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_linenumber").cast("string")).alias("listing_url"),
        F.concat(F.lit("collector_"), F.lower("l_returnflag")).alias("source"),
        "department",
        F.col("l_extendedprice").alias("price"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price_per_m2"),
        F.col("l_quantity").alias("surface_m2"),
        F.col("l_linenumber").alias("rooms"),
        (F.col("l_linenumber") - 1).alias("bedrooms"),
        F.concat(F.col("l_suppkey").cast("string"), F.lit(" rue "), F.col("p_brand")).alias("address"),
        "city",
        "postal_code",
        "property_type",
        "features",
        F.concat("p_name", F.lit(" - "), "o_orderpriority").alias("description"),
        F.col("o_orderdate").alias("first_seen_at"),
        F.col("l_shipdate").alias("last_seen_at"),
        (F.col("l_linestatus") == "O").alias("is_active"),
        F.lit(1).cast("bigint").alias("update_count"),
        F.when(F.col("l_discount") != 0, F.col("l_discount") >= 0.05).alias("processed"),
        (F.when(F.col("o_orderstatus") == "F", order_day)
          .when(F.col("o_orderstatus") == "O", F.concat(order_day, F.lit("T08:30:00")))
         ).alias("scraped_at"),
    )


def zipcode_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``zipcode(ZipCode, Department, GroupCitys, lat, lon)``; department codes
    are left unpadded as a numeric key would arrive."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    return c.select(
        postal_code_of(F.col("c_custkey")).alias("ZipCode"),
        F.col("c_nationkey").cast("string").alias("Department"),
        F.col("c_name").alias("GroupCitys"),
        F.when(F.col("c_acctbal") >= 0, F.lit(42.0) + F.col("c_acctbal") / 2000.0).alias("lat"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey") / 5.0 - 2.0).alias("lon"),
    )


def department_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``department(ID, Name, Region)``; ID unpadded."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("n_nationkey").cast("string").alias("ID"),
                     F.col("n_name").alias("Name"),
                     F.col("r_name").alias("Region")))


def region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "region").select(F.col("r_name").alias("region_name"))


def department_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature-collection rows ``code, nom, geometry`` for departments, one per
    nation (geometry kept opaque as a JSON string)."""
    n = read_table(spark, sf_dir, "nation")
    geom = F.to_json(F.struct(F.lit("Point").alias("type"),
                              F.array(F.col("n_nationkey").cast("double"),
                                      F.col("n_regionkey").cast("double")).alias("coordinates")))
    return n.select(pad_code("n_nationkey", 2).alias("code"), F.col("n_name").alias("nom"),
                    geom.alias("geometry"))


def land_features(features: DataFrame, folder: str) -> None:
    """Feature rows as one landed GeoJSON file."""
    one = F.concat(F.lit('{ "type": "Feature",\n "properties": '), F.to_json(F.struct("code", "nom")), F.lit(', "geometry": '), F.col("geometry"), F.lit(" }"))
    body = F.array_join(F.sort_array(F.collect_list(one)), ",\n")
    whole = F.concat(F.lit('{"type":"FeatureCollection","name":"areas","features":[\n'), body, F.lit("\n],\"bbox\":[0,0,1,1]}"))
    features.agg(whole.alias("value")).write.text(folder)


def region_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region features with mixed-case names (joined case-insensitively)."""
    r = read_table(spark, sf_dir, "region")
    geom = F.to_json(F.struct(F.lit("Point").alias("type"),
                              F.array(F.col("r_regionkey").cast("double"), F.lit(0.0)).alias("coordinates")))
    return r.select(F.col("r_regionkey").cast("string").alias("code"),
                    F.initcap("r_name").alias("nom"), geom.alias("geometry"))


# ----------------------------------------------------------------- landed raw formats
def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def sale_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open-data sale rows as the yearly CSV would land them: every column a
    string, with blanks, malformed numbers, non-sales and repeated
    (sale, disposition) pairs.

    The normaliser's row checks parse these cells, and Catalyst pushes them
    into the line-item scan; landed CSV files arrive in many splits at scale,
    so the single-row-group test file is split into parallel scans here."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                         "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(part, F.col("l_partkey") == F.col("p_partkey")))
    noun = F.get(F.split("p_name", " "), 1)
    qty = F.col("l_quantity")
    blank = F.lit("")
    return j.select(
        F.concat(F.lit("M"), _s("l_orderkey")).alias("id_mutation"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_mutation"),
        F.when(F.col("l_linenumber") <= 2, F.lit("1")).otherwise(F.lit("2")).alias("numero_disposition"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Echange")).otherwise(F.lit("Vente")).alias("nature_mutation"),
        F.when(F.col("l_discount") == 0.1, blank).otherwise(_s("l_extendedprice")).alias("valeur_fonciere"),
        _s("l_suppkey").alias("adresse_numero"),
        F.when(F.col("l_tax") == 0, F.lit("B")).otherwise(blank).alias("adresse_suffixe"),
        F.concat(F.lit("RUE "), F.upper(noun)).alias("adresse_nom_voie"),
        postal_code_of(F.col("c_custkey")).alias("code_postal"),
        F.col("c_name").alias("nom_commune"),
        pad_code("c_nationkey", 2).alias("code_departement"),
        F.when(F.col("l_linestatus") == "F", _s(qty)).otherwise(blank).alias("lot1_surface_carrez"),
        (F.when(F.col("l_tax") >= 0.07, F.replace(_s(qty / 2), F.lit("."), F.lit(",")))
          .when(F.col("l_tax") >= 0.04, _s(qty / 2)).otherwise(blank)).alias("lot2_surface_carrez"),
        blank.alias("lot3_surface_carrez"),
        blank.alias("lot4_surface_carrez"),
        blank.alias("lot5_surface_carrez"),
        (F.when(noun.isin("widget", "gizmo", "rod"), F.lit("Maison"))
          .when(noun.isin("ring", "plate", "gear"), F.lit("Appartement"))
          .otherwise(F.lit("Dépendance"))).alias("type_local"),
        F.when(F.col("l_returnflag") == "R", blank).otherwise(_s(qty * 2)).alias("surface_reelle_bati"),
        (F.when(F.col("l_linenumber") == 7, blank).when(F.col("l_linenumber") == 6, F.lit("6.0"))
          .otherwise(_s("l_linenumber"))).alias("nombre_pieces_principales"),
    )


def land_sales(rows: DataFrame, folder: str) -> None:
    """Sale rows as landed CSV files in one folder: sales of houses in the usual
    column order, the others with a further column and the reverse order."""
    houses = F.col("type_local") == "Maison"
    swapped = rows.filter(~houses).select(F.lit("48.85").alias("latitude"), *reversed(rows.columns))
    for part in (rows.filter(houses), swapped):
        part.write.mode("append").option("header", True).csv(folder)


def _json_num(c) -> F.Column:
    return F.coalesce(_s(c), F.lit("null"))


def ad_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON ads page per event (``page_id``, ``department``, ``payload``).

    Scalar or list numbers, explicit-null versus missing price per m2, missing
    district, a ``programme`` type, unknown types, pages without ``total`` and
    non-object payloads all occur, decided by the event's fields.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    et = F.col("event_type")
    price = F.col("value") * 1000
    price_json = F.when(et == "click", F.concat(F.lit("["), _json_num(price), F.lit(",null,"),
                                                _json_num(price * 1.1), F.lit("]"))).otherwise(_json_num(price))
    beds_json = F.when(et == "view", F.concat(F.lit("["), _json_num(F.floor(k / 20)), F.lit(",null]"))) \
                 .otherwise(_json_num(F.floor(k / 25)))
    ppm2 = (F.when(et == "signup", F.lit('"pricePerSquareMeter":null,'))
             .when(et == "purchase", F.lit(""))
             .otherwise(F.concat(F.lit('"pricePerSquareMeter":'), _json_num(F.col("value") * 10), F.lit(","))))
    district = F.when(et == "error", F.lit("")).otherwise(
        F.concat(F.lit('"district":{"name":"District '), _s("user_id"), F.lit('"},')))
    ptype = (F.when(et == "view", F.lit("house")).when(et == "click", F.lit("flat"))
              .when(et == "purchase", F.lit("programme")).when(et == "signup", F.lit("castle"))
              .otherwise(F.lit("bungalow")))
    surface = F.when(et == "view", F.concat(F.lit("["), _json_num(k), F.lit(","), _json_num(k + 10), F.lit("]"))) \
               .otherwise(_json_num(k))
    ad = F.concat(
        F.lit('{"id":"ad-'), _s("event_id"), F.lit('","price":'), price_json,
        F.lit(',"roomsQuantity":'), _json_num(F.floor(k / 10)),
        F.lit(',"surfaceArea":'), surface,
        F.lit(',"bedroomsQuantity":'), beds_json, F.lit(","),
        ppm2, district,
        F.lit('"city":"Ville '), _s("user_id"),
        F.lit('","postalCode":"'), pad_code("user_id", 5),
        F.lit('","description":"'), et, F.lit(" "), F.date_format("ts", "yyyy-MM-dd"),
        F.lit('","propertyType":"'), ptype, F.lit('"}'))
    page = F.concat(F.lit('{"total":'), _s(F.col("user_id") + 100), F.lit(',"from":0,"perPage":24,"realEstateAds":['),
                    ad, F.lit("]}"))
    payload = (F.when(F.col("value") < 1, F.lit('{"error":"blocked"}'))
                .when(F.col("value") > 400, F.lit("[]"))
                .otherwise(page))
    return ev.select(F.col("event_id").alias("page_id"),
                     pad_code(F.col("user_id") % 95 + 1, 2).alias("department"),
                     payload.alias("payload"))


def card_facts(raw: DataFrame, *keep: str) -> DataFrame:
    """Result-card boxes built from raw listings: key-fact list (separators,
    no-break spaces, a land-surface fact, sometimes first), price text with
    thousands separators, address with or without ``(postal code)``,
    description fragments and type text."""
    nb = "\u00a0"
    sep = F.when(F.col("source") == "collector_r", F.lit(nb)).otherwise(F.lit(" "))
    f_rooms = F.concat(_s("rooms"), sep, F.lit("pièces"))
    f_beds = F.concat(_s("bedrooms"), sep, F.lit("chambres"))
    f_surf = F.concat(F.replace(_s("surface_m2"), F.lit("."), F.lit(",")), sep, F.lit("m²"))
    f_land = F.concat(_s(F.col("rooms") * 100), F.lit(" m² terrain"))
    dot = F.lit("·")
    facts = F.when(F.col("source") == "collector_a", F.array(f_land, dot, f_surf, dot, f_rooms, dot, f_beds)) \
             .otherwise(F.array(f_rooms, dot, f_beds, dot, f_surf, dot, f_land))
    price_text = F.concat(F.format_number(F.floor("price").cast("bigint"), 0), F.lit(" €"))
    address = F.when(F.col("is_active"), F.concat(F.col("city"), F.lit(" ("), F.col("postal_code"), F.lit(")"))) \
               .otherwise(F.col("city"))
    parts = F.array(F.lit(" "), F.col("description"), F.lit(" "))
    return raw.select(*keep, "_id", "listing_url", "department", facts.alias("facts"), price_text.alias("price_text"), address.alias("address"),
                      parts.alias("text_parts"), F.col("property_type").alias("type_text"))


def result_pages(raw: DataFrame) -> DataFrame:
    """HTML result pages (``page_id``, ``url``, ``department``, ``html``), one
    per order, a card per line item (at most a few dozen). Some cards have a
    zero price, some no price element; texts have inner tags, comments, references
    and attributes with markup around them, and the footer has a number and a price element of its own."""
    def div(test_id, inside):
        return F.concat(F.lit(f'<div class="a > b" data-testid="{test_id}">'), inside, F.lit("</div>"))

    def nested(texts, before=""):
        return F.array_join(F.transform(texts, lambda t: F.concat(F.lit(f"<div>{before}"), t, F.lit("</div>"))), "")

    page = F.substring_index(F.substring("listing_url", 2, 40), "_", 1).cast("bigint")
    rooms = F.substring_index("listing_url", "_", -1)
    price = F.when(rooms == "7", F.lit("0 &euro;")).otherwise(F.replace("price_text", F.lit("€"), F.lit("&#8364;")))
    # a description breaks after its dash; what a box shows besides stands in elements of its own
    lines = F.transform("text_parts", lambda t: F.replace(t, F.lit(" - "), F.lit(" -<br><b title='</div>'></b> ")))
    card = div("serp-core-classified-card-testid", F.concat(
        F.lit('<!-- <div data-testid="cardmfe-price-testid">1 €</div> --><img alt="<div>"><a data-testid="card-mfe-covering-link-testid" href="'),
        F.col("listing_url"), F.lit('"></a>'),
        F.when(rooms == "6", F.lit("")).otherwise(div("cardmfe-price-testid", F.concat(F.lit("<span></span>"), price, F.lit("<span>12 €/m²</span>")))),
        div("cardmfe-keyfacts-testid", nested(F.col("facts"), "<i title='9 pièces'></i>")),
        div("cardmfe-description-box-address", F.concat(F.lit("<span>à </span>"), F.col("address"))),
        div("cardmfe-description-box-text-test-id", nested(F.array(F.coalesce("type_text", F.lit(""))))),
        div("cardmfe-description-text-test-id", nested(lines))))
    # listings are dealt to their pages as they are, several times smaller than their cards
    raw = raw.withColumn("page_id", page).repartition("page_id", "department")
    cards = card_facts(raw, "page_id").select("page_id", "department", F.struct("_id", card.alias("card")).alias("c"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda c: c["card"]), "\n")
    footer = '<footer><div>42 annonces</div><div data-testid="cardmfe-price-testid">999 €</div></footer></body></html>'
    return (cards.groupBy("page_id", "department").agg(body.alias("_body"))
            .select("page_id", F.concat(F.lit("/annonces/"), F.col("page_id").cast("string")).alias("url"), "department",
                    F.concat(F.lit('<html lang="fr"><body><div>'), F.col("_body"), F.lit("</div>"), F.lit(footer)).alias("html")))


def number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number strings as collectors meet them, built from line items: prices
    with currency text, comma decimals, units, no-break thousands separators,
    dotted ids (malformed) and blanks."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_suppkey")
    price = _s("l_extendedprice")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("EUR "), price, F.lit(" TTC")).alias("t_currency"),
        F.concat(F.replace(price, F.lit("."), F.lit(",")), F.lit(" €")).alias("t_comma"),
        F.concat(_s("l_quantity"), F.lit(" m²")).alias("t_unit"),
        F.concat_ws(".", _s("l_orderkey"), _s("l_linenumber"), _s("l_suppkey")).alias("t_dotted"),
        F.when(F.col("l_discount") == 0, F.lit("")).otherwise(_s("l_tax")).alias("t_blank"),
        F.concat(F.replace(F.format_number(F.floor("l_extendedprice").cast("bigint"), 0), F.lit(","), F.lit("\u00a0")),
                 F.lit(" €/m²")).alias("t_nbsp"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collector run log: one row per fetched page (run = event type, items =
    the event's ``k`` property, fetch time = event time)."""
    ev = read_table(spark, sf_dir, "events").select("event_type", "ts", "props")
    return ev.select(F.col("event_type").alias("run_id"),
                     F.get_json_object("props", "$.k").cast("int").alias("items"),
                     F.col("ts").alias("fetched_at"))
