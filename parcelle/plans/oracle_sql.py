"""Independent ANSI-SQL (DuckDB dialect) statements of every registered query.

They read the driver's tables directly (views ``lineitem``, ``orders`` ...)
and restate each operator's semantics in SQL, so the Spark implementation
is checked against a second engine. Shared building blocks are CTE texts.
"""

from __future__ import annotations

# ---------------------------------------------------------------- adapter
_PAD2_NATION = ("CASE WHEN length(CAST(c_nationkey AS VARCHAR)) < 2 "
                "THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0') ELSE CAST(c_nationkey AS VARCHAR) END")
_PC = ("CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 5 "
       "THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') ELSE CAST(c_custkey AS VARCHAR) END")

LISTINGS_RAW = f"""
listings_raw AS (
  SELECT
    concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
              CAST(l_suppkey AS VARCHAR), strftime(l_shipdate, '%Y%m%d')) AS _id,
    'L' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS listing_url,
    'collector_' || lower(l_returnflag) AS source,
    {_PAD2_NATION} AS department,
    l_extendedprice AS price,
    CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS price_per_m2,
    l_quantity AS surface_m2,
    l_linenumber AS rooms,
    l_linenumber - 1 AS bedrooms,
    CAST(l_suppkey AS VARCHAR) || ' rue ' || p_brand AS address,
    c_name AS city,
    CASE c_mktsegment
      WHEN 'BUILDING' THEN substr({_PC}, 1, 2) || ' ' || substr({_PC}, 3)
      WHEN 'MACHINERY' THEN {_PC} || 'A'
      ELSE {_PC} END AS postal_code,
    CASE WHEN p_size < 50 THEN
      CASE split_part(p_name, ' ', 2)
        WHEN 'widget' THEN 'Maison' WHEN 'gizmo' THEN 'Villa' WHEN 'rod' THEN 'Chalet'
        WHEN 'ring' THEN 'Appartement' WHEN 'plate' THEN 'Studio' WHEN 'gear' THEN 'Duplex'
        WHEN 'bolt' THEN 'Terrain' WHEN 'anvil' THEN 'Château'
        ELSE split_part(p_name, ' ', 2) END || ' ' || split_part(p_name, ' ', 1)
    END AS property_type,
    string_split(p_name, ' ') AS features,
    p_name || ' - ' || o_orderpriority AS description,
    o_orderdate AS first_seen_at,
    l_shipdate AS last_seen_at,
    l_linestatus = 'O' AS is_active,
    CAST(1 AS BIGINT) AS update_count,
    CASE WHEN l_discount <> 0 THEN l_discount >= 0.05 END AS processed,
    CASE o_orderstatus
      WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') || 'T08:30:00' END AS scraped_at
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
)"""

ZIPCODE_DIM = f"""
zipcode_dim AS (
  SELECT {_PC} AS ZipCode, CAST(c_nationkey AS VARCHAR) AS Department, c_name AS GroupCitys,
         CASE WHEN c_acctbal >= 0 THEN 42.0 + c_acctbal / 2000.0 END AS lat,
         CASE WHEN c_acctbal >= 0 THEN c_nationkey / 5.0 - 2.0 END AS lon
  FROM customer
)"""

DEPARTMENT_DIM = """
department_dim AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS ID, n_name AS Name, r_name AS Region
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_CLASSIFY = """CASE
      WHEN contains(lower(property_type), 'maison') THEN 'maison'
      WHEN contains(lower(property_type), 'mas') THEN 'maison'
      WHEN contains(lower(property_type), 'chalet') THEN 'maison'
      WHEN contains(lower(property_type), 'villa') THEN 'maison'
      WHEN contains(lower(property_type), 'appartement') THEN 'appartement'
      WHEN contains(lower(property_type), 'studio') THEN 'appartement'
      WHEN contains(lower(property_type), 'duplex') THEN 'appartement'
      WHEN contains(lower(property_type), 'triplex') THEN 'appartement'
      WHEN contains(lower(property_type), 'loft') THEN 'appartement'
      ELSE 'autre' END"""

CLEAN_CHECKED = f"""
clean_input AS (
  SELECT *, regexp_replace(postal_code, '\\s+', '', 'g') AS zc, {_CLASSIFY} AS logement
  FROM listings_raw WHERE NOT coalesce(processed, false)
),
clean_checked AS (
  SELECT _id AS Id, lower(property_type) AS Name, CAST(price AS DOUBLE) AS Price,
         CAST(surface_m2 AS DOUBLE) AS M2, city AS City, logement AS Logement,
         CASE WHEN contains(lower(property_type), 'studio') THEN 1 ELSE CAST(rooms AS INTEGER) END AS Rooms,
         coalesce(TRY_CAST(scraped_at AS DATE), CAST(last_seen_at AS DATE)) AS Date,
         zc AS ZipCode,
         CASE
           WHEN postal_code IS NULL OR length(zc) <> 5 OR NOT regexp_full_match(zc, '[0-9]{{5}}') THEN 'postal_code'
           WHEN price IS NULL OR isnan(price) OR NOT (price > 10000) THEN 'price'
           WHEN surface_m2 IS NULL OR isnan(surface_m2) OR NOT (surface_m2 >= 9) THEN 'surface'
           WHEN logement = 'autre' THEN 'type'
         END AS reason
  FROM clean_input
),
clean AS (SELECT Id, Name, Price, M2, City, Logement, Rooms, Date, ZipCode FROM clean_checked WHERE reason IS NULL)"""


def sround(expr: str, decimals: int = 4) -> str:
    """SQL twin of ``parcelle.functions.numbers.stable_round``."""
    return (f"floor(floor(({expr}) * 16777216.0 + 0.5) / 16777216.0 * {10 ** decimals}.0 + 0.5)"
            f" / {10 ** decimals}.0")


def xavg(x: str) -> str:
    """SQL twin of ``parcelle.functions.numbers.exact_avg`` for values from 2^-10 to 2^62: exact sums of the whole
    parts and of the fractions in units of 2^-62."""
    unit = 2**62
    whole, part = f"SUM(CAST(trunc({x}) AS HUGEINT))", f"SUM(CAST(trunc(({x} - trunc({x})) * {unit}.0) AS HUGEINT))"
    return f"(CAST({part} % {unit} AS DOUBLE) / {unit}.0 + CAST({whole} + {part} // {unit} AS DOUBLE)) / COUNT({x})"


RATIO = "(CASE WHEN M2 = 0 THEN NULL ELSE Price / M2 END)"


def round_half_even(expr: str, decimals: int = 2) -> str:
    """Half-even rounding of a double's shortest decimal form, which is what
    Spark's ``bround`` does (DuckDB's ``round_even`` rounds the scaled double
    product instead, which can differ near ties)."""
    d = f"CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,20))"
    p = 10 ** decimals
    f = f"floor({d} * {p})"
    return (f"CAST(CASE WHEN {d} * {p} - {f} = 0.5 THEN ({f} + ({f} % 2)) / {p} "
            f"ELSE round({d}, {decimals}) END AS DOUBLE)")


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


BASE = (LISTINGS_RAW, CLEAN_CHECKED)
GEO = (LISTINGS_RAW, CLEAN_CHECKED, ZIPCODE_DIM, DEPARTMENT_DIM)

_STAT_AGGS = f"""
    {xavg("Price")} AS avg_price,
    {xavg(RATIO)} AS avg_price_m2,
    {xavg("M2")} AS avg_m2,
    CAST(SUM(CAST(Rooms AS BIGINT)) AS DOUBLE) / COUNT(Rooms) AS avg_rooms,
    CAST(COUNT(*) AS BIGINT) AS nb_annonces"""


_LOCATED = """
located AS (
  SELECT c.*, coalesce(z.Department, 'unknown') AS department_id, coalesce(d.Name, 'unknown') AS department_name,
         coalesce(d.Region, 'unknown') AS region_name
  FROM clean c LEFT JOIN zipcode_dim z ON c.ZipCode = z.ZipCode LEFT JOIN department_dim d ON z.Department = d.ID
)"""

_CLEAN_ZIP = """
clean_zip AS (SELECT *, ZipCode AS zipcode_name FROM clean)"""

LEVEL_KEYS = {"zipcode": ["zipcode_name"], "department": ["department_id", "department_name"],
              "region": ["region_name"]}


def _stats_cte(level: str) -> str:
    k = ", ".join(LEVEL_KEYS[level])
    src = "clean_zip" if level == "zipcode" else "located"
    return f"""
stats_{level} AS (
  SELECT {k}, CASE WHEN GROUPING(Logement) = 1 THEN 'total' ELSE Logement END AS logement_type, {_STAT_AGGS}
  FROM {src}
  GROUP BY GROUPING SETS (({k}, Logement), ({k}))
)"""


def stats_ctes(level: str) -> tuple[str, ...]:
    """CTEs ending in ``stats_<level>``."""
    geo = _CLEAN_ZIP if level == "zipcode" else _LOCATED
    return (*GEO, geo, _stats_cte(level))


ORACLE: dict[str, str] = {}

ORACLE["clean_listings"] = with_ctes(*BASE, body="SELECT * FROM clean")
ORACLE["rejected_listings"] = with_ctes(*BASE, body="SELECT Id, reason FROM clean_checked WHERE reason IS NOT NULL")
ORACLE["timeseries_month"] = with_ctes(*BASE, body=f"""
SELECT lower(City) AS city, CAST(date_trunc('month', Date) AS DATE) AS month,
       {xavg(RATIO)} AS price_m2
FROM clean GROUP BY 1, 2 ORDER BY 1, 2""")
for _lvl in ("region", "department", "zipcode"):
    ORACLE[f"stats_{_lvl}"] = with_ctes(*stats_ctes(_lvl), body=f"SELECT * FROM stats_{_lvl}")


def _pad(expr: str, width: int = 2) -> str:
    return (f"CASE WHEN length(CAST({expr} AS VARCHAR)) < {width} "
            f"THEN lpad(CAST({expr} AS VARCHAR), {width}, '0') ELSE CAST({expr} AS VARCHAR) END")


def _dept_code(expr: str) -> str:
    p = _pad(expr)
    return f"CASE WHEN {p} IN ('20', '201') THEN '2A' WHEN {p} = '202' THEN '2B' ELSE {p} END"


ZIP_MERGED = """
zip_merged AS (
  SELECT s.*, z.* FROM stats_zipcode s LEFT JOIN zipcode_dim z ON s.zipcode_name = z.ZipCode
  WHERE s.logement_type = 'total'
)"""

DEPT_THRESHOLD = f"""
dept_threshold AS (
  SELECT {_dept_code('department_id')} AS department_id, department_name, avg_price, nb_annonces
  FROM stats_department WHERE logement_type = 'total' AND nb_annonces >= 400
),
dept_joined AS (
  SELECT t.*, d.ID, d.Region, t.department_name || ' - ' || d.Region AS department_label
  FROM dept_threshold t
  LEFT JOIN (SELECT {_pad('ID')} AS ID, Region FROM department_dim) d ON {_pad('t.department_id')} = d.ID
)"""

ORACLE["filter_search"] = with_ctes(*BASE, body="""
SELECT * FROM clean
WHERE lower(City) LIKE '%customer#000001%' AND lower(Logement) = 'appartement'
  AND Price BETWEEN 20000 AND 80000 AND Date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""")
ORACLE["stats_lookup"] = with_ctes(*stats_ctes("department"), body="""
SELECT * FROM stats_department WHERE department_name = 'NATION_7' AND logement_type = 'maison'""")
ORACLE["stats_by_type"] = with_ctes(*stats_ctes("zipcode"), body="""
SELECT * FROM stats_zipcode WHERE logement_type = 'appartement'""")
ORACLE["stats_threshold"] = with_ctes(*stats_ctes("department"), DEPT_THRESHOLD,
                                      body="SELECT * FROM dept_threshold")
ORACLE["range_filter"] = with_ctes(*stats_ctes("zipcode"), ZIP_MERGED, body="""
SELECT * FROM zip_merged
WHERE avg_price BETWEEN 20000 AND 60000 AND avg_m2 BETWEEN 10 AND 40 AND avg_rooms BETWEEN 1 AND 5
  AND nb_annonces >= 5""")
ORACLE["in_filter"] = with_ctes(*stats_ctes("zipcode"), ZIP_MERGED, body="""
SELECT * FROM zip_merged
WHERE Department IN ('1', '3', '5', '7', '20') AND lat IS NOT NULL AND lon IS NOT NULL""")
ORACLE["price_window"] = with_ctes(*stats_ctes("department"), body="""
SELECT * FROM stats_department
WHERE logement_type = 'total' AND avg_price >= 56000 AND avg_price <= 58000 AND nb_annonces >= 400""")
ORACLE["bounds"] = with_ctes(*stats_ctes("zipcode"), ZIP_MERGED, body="""
SELECT CAST(trunc(min(avg_price)) AS BIGINT) AS avg_price_min, CAST(trunc(max(avg_price)) AS BIGINT) AS avg_price_max,
       CAST(trunc(min(avg_m2)) AS BIGINT) AS avg_m2_min, CAST(trunc(max(avg_m2)) AS BIGINT) AS avg_m2_max,
       CAST(trunc(min(avg_rooms)) AS BIGINT) AS avg_rooms_min, CAST(trunc(max(avg_rooms)) AS BIGINT) AS avg_rooms_max,
       min(nb_annonces) AS nb_annonces_min, max(nb_annonces) AS nb_annonces_max
FROM zip_merged""")
ORACLE["distinct_values"] = with_ctes(*stats_ctes("zipcode"), ZIP_MERGED, body="""
SELECT DISTINCT Department FROM zip_merged WHERE Department IS NOT NULL ORDER BY Department""")


def _pearson_sql(a: str, b: str) -> str:
    a2 = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
    b2 = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
    return (f"CASE WHEN stddev_pop({a2}) * stddev_pop({b2}) = 0 THEN NULL "
            f"ELSE covar_pop({a2}, {b2}) / (stddev_pop({a2}) * stddev_pop({b2})) END")


ORACLE["influence_rank"] = with_ctes(*stats_ctes("zipcode"), f"""
win AS (SELECT * FROM stats_zipcode WHERE logement_type = 'total' AND avg_price IS NOT NULL),
wide AS (SELECT {_pearson_sql('nb_annonces', 'avg_price')} AS nb_annonces,
                {_pearson_sql('avg_m2', 'avg_price')} AS avg_m2,
                {_pearson_sql('avg_rooms', 'avg_price')} AS avg_rooms FROM win)""", body=f"""
SELECT feature, {sround('abs(r)', 6)} AS correlation FROM (
  SELECT 'nb_annonces' AS feature, nb_annonces AS r FROM wide UNION ALL
  SELECT 'avg_m2', avg_m2 FROM wide UNION ALL
  SELECT 'avg_rooms', avg_rooms FROM wide)
ORDER BY correlation DESC NULLS LAST, feature""")

ORACLE["dept_stats_join"] = with_ctes(*stats_ctes("department"), DEPT_THRESHOLD, body="SELECT * FROM dept_joined")
ORACLE["geo_inner_join"] = with_ctes(*stats_ctes("department"), DEPT_THRESHOLD, f"""
dept_features AS (SELECT {_pad('n_nationkey')} AS code, n_name AS nom FROM nation)""", body="""
SELECT f.code, f.nom, j.department_id, j.department_name, j.avg_price, j.nb_annonces, j.Region, j.department_label
FROM dept_features f JOIN dept_joined j ON f.code = j.department_id""")
ORACLE["geojson_features"] = f"""
SELECT {_pad('n_nationkey')} AS code, n_name AS nom, CAST(n_nationkey AS DOUBLE) AS x, CAST(n_regionkey AS DOUBLE) AS y FROM nation"""
ORACLE["region_ci_join"] = with_ctes(*stats_ctes("region"), """
region_features AS (SELECT CAST(r_regionkey AS VARCHAR) AS code, lower(r_name) AS nom FROM region)""", body="""
SELECT f.code, f.nom, lower(s.region_name) AS region_name, s.avg_price, s.nb_annonces
FROM region_features f
JOIN (SELECT * FROM stats_region WHERE logement_type = 'total' AND nb_annonces >= 1000) s
  ON f.nom = lower(s.region_name)""")
ORACLE["zip_left_join"] = with_ctes(*stats_ctes("zipcode"), body="""
SELECT s.zipcode_name, s.avg_price, s.nb_annonces, z.Department, z.GroupCitys
FROM stats_zipcode s LEFT JOIN zipcode_dim z ON s.zipcode_name = z.ZipCode
WHERE s.logement_type = 'maison' AND s.nb_annonces >= 3""")

# ---------------------------------------------------------------- keyed state
_DATA = ("source, department, price, price_per_m2, surface_m2, rooms, bedrooms, address, city, "
         "postal_code, property_type, features, description, last_seen_at")


def _latest_per_key(src: str, name: str) -> str:
    return f"""
{name}_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY listing_url ORDER BY last_seen_at DESC, _id DESC) AS rn,
         count(*) OVER (PARTITION BY listing_url) AS n,
         min(first_seen_at) OVER (PARTITION BY listing_url) AS fs
  FROM {src}
),
{name} AS (SELECT * FROM {name}_ranked WHERE rn = 1)"""


STATE = f"""
init_rows AS (SELECT * FROM listings_raw WHERE source <> 'collector_n'),
batch_rows AS (SELECT * FROM listings_raw WHERE source = 'collector_n'),
{_latest_per_key('init_rows', 'init_latest')},
state0 AS (
  SELECT _id, listing_url, {_DATA}, fs AS first_seen_at, true AS is_active,
         CAST(n AS BIGINT) AS update_count, CAST(NULL AS BOOLEAN) AS processed
  FROM init_latest
),
{_latest_per_key('batch_rows', 'batch_latest')},
state1 AS (
  SELECT CASE WHEN s._id IS NOT NULL THEN s._id ELSE b._id END AS _id,
         CASE WHEN s._id IS NOT NULL THEN s.listing_url ELSE b.listing_url END AS listing_url,
         {", ".join(f"CASE WHEN b.n IS NOT NULL THEN b.{c} ELSE s.{c} END AS {c}" for c in _DATA.split(", "))},
         CASE WHEN s._id IS NOT NULL THEN s.first_seen_at ELSE b.fs END AS first_seen_at,
         CASE WHEN b.n IS NOT NULL THEN true ELSE s.is_active END AS is_active,
         CAST(coalesce(s.update_count, 0) + coalesce(b.n, 0) AS BIGINT) AS update_count,
         s.processed AS processed
  FROM state0 s FULL OUTER JOIN batch_latest b ON s.listing_url IS NOT DISTINCT FROM b.listing_url
)"""

ORACLE["upsert_state"] = with_ctes(LISTINGS_RAW, STATE, body="""
SELECT * REPLACE (array_to_string(features, '|') AS features) FROM state1""")
ORACLE["intake_once"] = ORACLE["clean_listings"]
ORACLE["queue_runs"] = with_ctes(*BASE, body="""
SELECT c.Id, c.reason, strftime(date_trunc('year', r.first_seen_at), '%Y-%m-%d') AS landed
FROM clean_checked c JOIN listings_raw r ON c.Id = r._id""")
ORACLE["upsert_buckets"] = ORACLE["upsert_state"]
# the state's listings, cleaned, in place of the collection's
STATE_CLEAN = (CLEAN_CHECKED.replace("FROM listings_raw WHERE NOT coalesce(processed, false)", "FROM state1")
               .replace("coalesce(TRY_CAST(scraped_at AS DATE), CAST(last_seen_at AS DATE))", "CAST(last_seen_at AS DATE)"))
ORACLE["stats_maintained"] = with_ctes(LISTINGS_RAW, STATE, STATE_CLEAN, ZIPCODE_DIM, DEPARTMENT_DIM, _LOCATED, _stats_cte("region"),
                                       body="SELECT * FROM stats_region")
ORACLE["timeseries_maintained"] = with_ctes(LISTINGS_RAW, STATE, STATE_CLEAN, body=f"""
SELECT lower(City) AS city, CAST(date_trunc('month', Date) AS DATE) AS month, {xavg(RATIO)} AS price_m2
FROM clean GROUP BY 1, 2 ORDER BY 1, 2""")
ORACLE["upsert_counters"] = with_ctes(LISTINGS_RAW, STATE, body="""
SELECT CAST(count(*) AS BIGINT) AS scraped,
       CAST(count(DISTINCT CASE WHEN s.listing_url IS NULL THEN b.listing_url END) AS BIGINT) AS inserted,
       CAST(count(*) - count(DISTINCT CASE WHEN s.listing_url IS NULL THEN b.listing_url END) AS BIGINT) AS modified
FROM batch_rows b LEFT JOIN (SELECT DISTINCT listing_url FROM state0) s ON b.listing_url = s.listing_url""")
ORACLE["deactivate_stale"] = with_ctes(LISTINGS_RAW, body="""
SELECT _id, listing_url, last_seen_at,
       CASE WHEN last_seen_at < TIMESTAMP '2001-06-01 00:00:00' - INTERVAL 30 DAY AND is_active THEN false
            ELSE is_active END AS is_active
FROM listings_raw""")
_FIRSTS = """
firsts AS (SELECT listing_url, min(_id) AS first_id, count(*) AS n FROM listings_raw GROUP BY listing_url)"""
ORACLE["dedupe_first"] = with_ctes(LISTINGS_RAW, _FIRSTS, body="""
SELECT r._id, r.listing_url, r.source, r.price, r.last_seen_at
FROM listings_raw r JOIN firsts f ON r.listing_url IS NOT DISTINCT FROM f.listing_url AND r._id = f.first_id""")
ORACLE["duplicate_groups"] = with_ctes(LISTINGS_RAW, _FIRSTS, body="""
SELECT listing_url, first_id AS doc_id, CAST(n AS BIGINT) AS count FROM firsts WHERE n > 1""")
ORACLE["delete_candidates"] = with_ctes(LISTINGS_RAW, _FIRSTS, body="""
SELECT r._id, r.listing_url
FROM listings_raw r JOIN firsts f ON r.listing_url IS NOT DISTINCT FROM f.listing_url AND r._id <> f.first_id""")
ORACLE["mark_processed"] = with_ctes(*BASE, body="""
SELECT r._id, CASE WHEN c.Id IS NOT NULL THEN true ELSE r.processed END AS processed
FROM listings_raw r LEFT JOIN clean c ON r._id = c.Id""")
ORACLE["unprocessed_batch"] = with_ctes(*BASE, """
first_run AS (
  SELECT Id FROM clean_checked c JOIN listings_raw r ON c.Id = r._id
  WHERE c.reason IS NULL AND r.first_seen_at < TIMESTAMP '1998-01-01 00:00:00'
)""", body="""
SELECT _id, price, surface_m2, city, property_type, rooms, scraped_at, postal_code, last_seen_at
FROM listings_raw
WHERE NOT coalesce(processed, false) AND _id NOT IN (SELECT Id FROM first_run)""")

# ---------------------------------------------------------------- source normalisers
_NOUN = "split_part(p_name, ' ', 2)"
SALE_ROWS = f"""
sale_rows AS (
  SELECT
    'M' || CAST(l_orderkey AS VARCHAR) AS id_mutation,
    strftime(o_orderdate, '%Y-%m-%d') AS date_mutation,
    CASE WHEN l_linenumber <= 2 THEN '1' ELSE '2' END AS numero_disposition,
    CASE WHEN o_orderstatus = 'P' THEN 'Echange' ELSE 'Vente' END AS nature_mutation,
    CASE WHEN l_discount = 0.1 THEN '' ELSE CAST(l_extendedprice AS VARCHAR) END AS valeur_fonciere,
    CAST(l_suppkey AS VARCHAR) AS adresse_numero,
    CASE WHEN l_tax = 0 THEN 'B' ELSE '' END AS adresse_suffixe,
    'RUE ' || upper({_NOUN}) AS adresse_nom_voie,
    {_PC} AS code_postal, c_name AS nom_commune, {_PAD2_NATION} AS code_departement,
    l_linestatus = 'F' AS has_lot1, l_quantity AS q,
    CASE WHEN l_tax >= 0.07 THEN 'bad' WHEN l_tax >= 0.04 THEN 'ok' ELSE '' END AS lot2_kind,
    CASE WHEN {_NOUN} IN ('widget', 'gizmo', 'rod') THEN 'Maison'
         WHEN {_NOUN} IN ('ring', 'plate', 'gear') THEN 'Appartement' ELSE 'Dépendance' END AS type_local,
    l_returnflag <> 'R' AS has_bati,
    l_linenumber AS ln
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
),
sale_calc AS (
  SELECT *,
    (CASE WHEN has_lot1 THEN q ELSE 0.0 END) + (CASE WHEN lot2_kind = 'ok' THEN q / 2 ELSE 0.0 END) AS carrez,
    lot2_kind = 'bad' AS lot2_bad,
    TRY_CAST(valeur_fonciere AS DOUBLE) AS price
  FROM sale_rows
  WHERE nature_mutation = 'Vente' AND valeur_fonciere <> '' AND type_local IN ('Maison', 'Appartement')
),
sale_surf AS (
  SELECT *,
    CASE WHEN carrez <> 0 THEN carrez WHEN has_bati THEN q * 2 ELSE 0.0 END AS surface
  FROM sale_calc
)"""

DVF_LISTINGS = f"""
dvf_listings AS (
SELECT 'dvf_' || id_mutation || '_' || numero_disposition AS listing_url,
       'open_data' AS source, code_departement AS department, price,
       {round_half_even('price / surface', 2)} AS price_per_m2, surface AS surface_m2,
       CASE WHEN ln IN (6, 7) THEN NULL ELSE ln END AS rooms,
       CAST(NULL AS INTEGER) AS bedrooms,
       concat_ws(' ', adresse_numero, nullif(adresse_suffixe, ''), adresse_nom_voie) AS address,
       nom_commune AS city, code_postal AS postal_code,
       CASE WHEN type_local = 'Maison' THEN 'maison' ELSE 'appartement' END AS property_type,
       '' AS features,
       'Mutation du ' || date_mutation || ' - ' || nature_mutation AS description,
       TIMESTAMP '2024-06-01 12:00:00' AS first_seen_at, TIMESTAMP '2024-06-01 12:00:00' AS last_seen_at
FROM sale_surf
WHERE NOT lot2_bad AND surface > 0 AND price > 0 AND ln <> 6
)"""
ORACLE["dvf_normalise"] = with_ctes(SALE_ROWS, DVF_LISTINGS, body="SELECT * FROM dvf_listings")
ORACLE["dvf_files"] = ORACLE["dvf_normalise"]
ORACLE["dvf_rejected"] = with_ctes(SALE_ROWS, body="""
SELECT 'dvf_' || id_mutation || '_' || numero_disposition AS listing_url,
       CASE WHEN lot2_bad THEN 'malformed_surface' ELSE 'malformed_rooms' END AS reason
FROM sale_surf WHERE lot2_bad OR (surface > 0 AND price > 0 AND ln = 6)""")

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
ADS_LISTINGS = f"""
ev AS (
  SELECT *, {_K} AS k, value * 1000 AS p FROM events WHERE value >= 1 AND value <= 400
),
ads AS (
  SELECT *,
    CASE WHEN event_type = 'click' THEN (0.0 + p + p * 1.1) / 3.0 ELSE p END AS price,
    CASE WHEN event_type = 'view' THEN (0.0 + k + (k + 10)) / 2.0 ELSE CAST(k AS DOUBLE) END AS surface
  FROM ev WHERE event_type <> 'purchase'
),
ads_listings AS (
SELECT 'ad-' || CAST(event_id AS VARCHAR) AS listing_url, 'ads_api' AS source,
       {_pad('(user_id % 95 + 1)')} AS department,
       price,
       CASE WHEN event_type = 'signup' THEN (CASE WHEN surface > 0 THEN floor(price / surface) ELSE 0.0 END)
            ELSE value * 10 END AS price_per_m2,
       surface AS surface_m2,
       CAST(k // 10 AS INTEGER) AS rooms,
       CAST(CASE WHEN event_type = 'view' THEN trunc((0.0 + k // 20) / 2.0) ELSE k // 25 END AS INTEGER) AS bedrooms,
       CASE WHEN event_type = 'error' THEN '' ELSE 'District ' || CAST(user_id AS VARCHAR) END AS address,
       'Ville ' || CAST(user_id AS VARCHAR) AS city,
       {_pad('user_id', 5)} AS postal_code,
       CASE event_type WHEN 'view' THEN 'maison' WHEN 'click' THEN 'appartement'
                       WHEN 'signup' THEN 'château' ELSE 'bungalow' END AS property_type,
       'ad-' || CAST(event_id AS VARCHAR) || '|Ville ' || CAST(user_id AS VARCHAR) || '|' ||
         CASE event_type WHEN 'view' THEN 'house' WHEN 'click' THEN 'flat' WHEN 'signup' THEN 'castle'
                         ELSE 'bungalow' END AS features,
       event_type || ' ' || strftime(ts, '%Y-%m-%d') AS description,
       TIMESTAMP '2024-06-01 12:00:00' AS first_seen_at, TIMESTAMP '2024-06-01 12:00:00' AS last_seen_at
FROM ads
)"""
ORACLE["ads_normalise"] = with_ctes(ADS_LISTINGS, body="SELECT * FROM ads_listings")


def _list_mean_sql(arr: str) -> str:
    return (f"coalesce(list_reduce(list_prepend(0.0, list_transform(list_filter({arr}, lambda x: x IS NOT NULL), "
            f"lambda x: CAST(x AS DOUBLE))), lambda a, b: a + b) / nullif(len({arr}), 0), 0.0)")


ORACLE["list_mean"] = f"""
SELECT vec_id, {sround(_list_mean_sql('embedding'), 6)} AS mean_all,
       {sround(_list_mean_sql('list_transform(embedding, lambda x: CASE WHEN x >= 0 THEN x END)'), 6)} AS mean_positive,
       {sround(_list_mean_sql('CASE WHEN label = 0 THEN CAST([] AS FLOAT[]) WHEN label > 1 THEN embedding END'), 6)} AS mean_odd
FROM embeddings"""

_WS = "[\\s\\x{00a0}]"
# ---------------------------------------------------------------- scalar helpers
_FIRST_TOK = "regexp_split_to_array(regexp_replace({f}, '^[\\s\\x{{00a0}}]+|[\\s\\x{{00a0}}]+$', '', 'g'), '[\\s\\x{{00a0}}]+')[1]"


def _tok(f: str) -> str:
    return _FIRST_TOK.format(f=f)


_FEATS = "list_filter(facts, lambda x: x IS DISTINCT FROM '·')"

def _fact_int(word: str) -> str:
    hit = (f"list_filter({_FEATS}, lambda f: contains(f, '{word}') AND "
           f"coalesce(regexp_full_match({_tok('f')}, '[0-9]+'), false))[1]")
    return f"TRY_CAST({_tok(hit)} AS INTEGER)"


def _fact_surface() -> str:
    t = f"replace({_tok('f')}, ',', '.')"
    hit = (f"list_filter({_FEATS}, lambda f: contains(f, 'm²') AND NOT contains(lower(f), 'terrain') AND "
           f"coalesce(regexp_full_match(replace({t}, '.', ''), '[0-9]+'), false))[1]")
    return f"TRY_CAST(replace({_tok(hit)}, ',', '.') AS DOUBLE)"


_CARD_TYPE = """CASE WHEN contains(lower(type_text), 'maison') THEN 'Maison'
            WHEN contains(lower(type_text), 'appartement') THEN 'Appartement'
            WHEN contains(lower(type_text), 'terrain') THEN 'Terrain'
            WHEN contains(lower(type_text), 'studio') THEN 'Studio'
            WHEN contains(lower(type_text), 'villa') THEN 'Villa'
            WHEN contains(lower(type_text), 'loft') THEN 'Loft' END"""

KEYFACTS = """
card_src AS (
  SELECT _id, listing_url, department, rooms AS line,
    CASE WHEN source = 'collector_r' THEN chr(160) ELSE ' ' END AS sep,
    CAST(rooms AS VARCHAR) AS r, CAST(bedrooms AS VARCHAR) AS b,
    replace(CAST(surface_m2 AS VARCHAR), '.', ',') AS s, CAST(rooms * 100 AS VARCHAR) AS l,
    source, price, city, postal_code, is_active, description, property_type
  FROM listings_raw
),
card_boxes AS (
  SELECT _id, listing_url, department, line,
    CASE WHEN source = 'collector_a'
      THEN [l || ' m² terrain', '·', s || sep || 'm²', '·', r || sep || 'pièces', '·', b || sep || 'chambres']
      ELSE [r || sep || 'pièces', '·', b || sep || 'chambres', '·', s || sep || 'm²', '·', l || ' m² terrain'] END AS facts,
    CAST(floor(price) AS BIGINT) AS price,
    CASE WHEN is_active THEN city || ' (' || postal_code || ')' ELSE city END AS address,
    description, property_type AS type_text
  FROM card_src
),
card_vals AS (
  SELECT *, """ + _fact_int("pièce") + " AS rooms0, " + _fact_int("chambre") + " AS beds0, " + _fact_surface() \
    + f""" AS surf0, CAST(len({_FEATS}) AS INTEGER) AS n_facts FROM card_boxes
),
card_fields AS (
SELECT _id, listing_url, department, line, address, array_to_string({_FEATS}, '|') AS features, n_facts, price, surf0,
       CASE WHEN rooms0 <> 0 THEN rooms0 END AS rooms,
       CASE WHEN beds0 <> 0 THEN beds0 END AS bedrooms,
       CASE WHEN surf0 <> 0 THEN surf0 END AS surface_m2,
       CASE WHEN surf0 <> 0 THEN floor(price / surf0) END AS price_per_m2,
       regexp_replace(split_part(address, '(', 1), '^{_WS}+|{_WS}+$', '', 'g') AS city,
       CASE WHEN contains(address, '(') THEN
         regexp_replace(replace(split_part(address, '(', 2), ')', ''), '^{_WS}+|{_WS}+$', '', 'g') END AS postal_code,
       regexp_replace(' ' || description || ' ', '^{_WS}+|{_WS}+$', '', 'g') AS description,
       {_CARD_TYPE} AS property_type
FROM card_vals)"""
ORACLE["keyfacts"] = with_ctes(LISTINGS_RAW, KEYFACTS, body="""
SELECT _id, n_facts, price, rooms, bedrooms, surface_m2, price_per_m2, city, postal_code, description, property_type
FROM card_fields""")

# what the result pages show: no price for the sixth line of an order, a zero price for the seventh
CARD_LISTINGS = """
card_listings AS (
SELECT listing_url, 'result_cards' AS source, department,
       CASE WHEN line NOT IN (6, 7) THEN CAST(nullif(price, 0) AS DOUBLE) END AS price,
       CASE WHEN line NOT IN (6, 7) AND price <> 0 THEN price_per_m2 END AS price_per_m2,
       surface_m2, rooms, bedrooms, address, city, postal_code, property_type, features, description,
       TIMESTAMP '2024-06-01 12:00:00' AS first_seen_at, TIMESTAMP '2024-06-01 12:00:00' AS last_seen_at
FROM card_fields
)"""
ORACLE["card_extract"] = with_ctes(LISTINGS_RAW, KEYFACTS, CARD_LISTINGS, body="SELECT * FROM card_listings")
ORACLE["intake_counts"] = with_ctes(LISTINGS_RAW, f"""
found AS (
  SELECT 'result_cards' AS source, department, split_part(listing_url, '_', 1) AS page FROM listings_raw
  UNION ALL
  SELECT 'ads_api', {_pad('(user_id % 95 + 1)')}, CAST(event_id AS VARCHAR) FROM events WHERE value >= 1 AND value <= 400
)""", body="""
SELECT source, department, CAST(count(*) AS BIGINT) AS cards, CAST(count(DISTINCT page) AS BIGINT) AS pages
FROM found GROUP BY source, department""")
ORACLE["decimals_to_double"] = """
SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
       CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS surface_m2 FROM lineitem"""


def _clean_num(t: str) -> str:
    kept = f"replace(regexp_replace({t}, '[^0-9.,]', '', 'g'), ',', '.')"
    return f"CASE WHEN length({t}) > 0 THEN TRY_CAST({kept} AS DOUBLE) END"


def _clean_price(t: str) -> str:
    s = f"replace(replace(replace(replace({t}, '€', ''), '/m²', ''), ' ', ''), chr(160), '')"
    s = f"replace(regexp_replace({s}, '^{_WS}+|{_WS}+$', '', 'g'), ',', '.')"
    return f"CASE WHEN length({s}) > 0 THEN TRY_CAST({s} AS DOUBLE) END"


ORACLE["number_clean"] = f"""
WITH t AS (
  SELECT l_orderkey, l_linenumber,
    'EUR ' || CAST(l_extendedprice AS VARCHAR) || ' TTC' AS t_currency,
    replace(CAST(l_extendedprice AS VARCHAR), '.', ',') || ' €' AS t_comma,
    CAST(l_quantity AS VARCHAR) || ' m²' AS t_unit,
    CAST(l_orderkey AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) || '.' || CAST(l_suppkey AS VARCHAR) AS t_dotted,
    CASE WHEN l_discount = 0 THEN '' ELSE CAST(l_tax AS VARCHAR) END AS t_blank,
    replace(format('{{:,}}', CAST(floor(l_extendedprice) AS BIGINT)), ',', chr(160)) || ' €/m²' AS t_nbsp
  FROM lineitem
)
SELECT l_orderkey, l_linenumber,
  {_clean_num('t_currency')} AS n_currency,
  {_clean_price('t_comma')} AS n_comma,
  {_clean_num('t_comma')} AS n_comma_generic,
  {_clean_num('t_unit')} AS n_unit,
  {_clean_num('t_dotted')} AS n_dotted,
  {_clean_num('t_blank')} AS n_blank,
  {_clean_price('t_nbsp')} AS n_nbsp,
  CASE WHEN regexp_replace(t_comma, '[^0-9]', '', 'g') <> ''
       THEN TRY_CAST(regexp_replace(t_comma, '[^0-9]', '', 'g') AS BIGINT) END AS n_digits
FROM t"""

ORACLE["run_metrics"] = f"""
WITH log AS (SELECT event_type AS run_id, {_K} AS items, ts AS fetched_at FROM events),
agg AS (
  SELECT run_id, min(fetched_at) AS started_at,
         date_diff('microsecond', min(fetched_at), max(fetched_at)) / 1e6 AS duration_seconds,
         CAST(sum(items) AS BIGINT) AS total_properties,
         CAST(count(*) FILTER (WHERE items > 0) AS BIGINT) AS total_pages
  FROM log GROUP BY run_id
)
SELECT *, total_properties / greatest(1, total_pages) AS properties_per_page,
       duration_seconds / greatest(1, total_properties) AS time_per_property
FROM agg"""

ORACLE["popup_text"] = with_ctes(*stats_ctes("zipcode"), body="""
SELECT s.zipcode_name,
  '<b>Code postal :</b> ' || s.zipcode_name || '<br>' ||
  '<b>Département :</b> ' || coalesce(z.Department, 'None') || '<br>' ||
  '<b>Villes :</b> ' || coalesce(z.GroupCitys, 'None') || '<br>' ||
  '<b>Prix moyen :</b> ' || format('{:,}', CAST(trunc(s.avg_price) AS BIGINT)) || ' €<br>' ||
  '<b>Annonces :</b> ' || CAST(s.nb_annonces AS VARCHAR) AS popup
FROM stats_zipcode s LEFT JOIN zipcode_dim z ON s.zipcode_name = z.ZipCode
WHERE s.logement_type = 'maison' AND s.nb_annonces >= 3""")

# ---------------------------------------------------------------- documented analyses
ORACLE["price_zone_year"] = with_ctes(*GEO, _LOCATED, body=f"""
SELECT region_name, CAST(year(Date) AS INTEGER) AS year,
       {xavg(RATIO)} AS avg_price_m2,
       CAST(count(*) AS BIGINT) AS nb_annonces
FROM located WHERE Price BETWEEN 20000 AND 90000
GROUP BY region_name, year(Date)""")
ORACLE["density"] = with_ctes(*GEO, _LOCATED, body="""
SELECT department_id, department_name, CAST(count(*) AS BIGINT) AS nb_annonces
FROM located WHERE Logement = 'maison' AND Price BETWEEN 30000 AND 70000
GROUP BY department_id, department_name""")
ORACLE["surface_price"] = with_ctes(*BASE, body=f"""
SELECT City AS commune,
       CASE WHEN M2 < 20 THEN '<20' WHEN M2 < 35 THEN '20-35' ELSE '>=35' END AS surface_band,
       {xavg("M2")} AS avg_m2,
       {xavg("Price")} AS avg_price,
       CAST(count(*) AS BIGINT) AS nb_annonces
FROM clean GROUP BY 1, 2""")
ORACLE["drilldown"] = with_ctes(*GEO, _LOCATED, body=f"""
SELECT region_name, department_name, City AS commune,
       CASE GROUPING(region_name, department_name, City)
         WHEN 0 THEN 'commune' WHEN 1 THEN 'department' WHEN 3 THEN 'region' WHEN 7 THEN 'national' END AS level,
       {xavg("Price")} AS avg_price,
       CAST(count(*) AS BIGINT) AS nb_annonces
FROM located GROUP BY ROLLUP (region_name, department_name, City)""")
ORACLE["word_freq"] = """
WITH w AS (SELECT unnest(regexp_split_to_array(lower(text), '[^\\pL]+')) AS word FROM documents)
SELECT word, CAST(count(*) AS BIGINT) AS n FROM w WHERE length(word) > 0
GROUP BY word ORDER BY n DESC, word"""

_MERGE_COLS = ("listing_url, source, department, price, price_per_m2, surface_m2, rooms, bedrooms, address, "
               "city, postal_code, property_type, features, description, first_seen_at, last_seen_at")
_TIE = ", ".join(f"{c} DESC NULLS LAST" for c in
                 ["last_seen_at", "listing_url", "source", "department", "price", "price_per_m2", "surface_m2",
                  "rooms", "bedrooms", "address", "city", "postal_code", "property_type", "description", "features"])
ORACLE["merged_state"] = with_ctes(SALE_ROWS, DVF_LISTINGS, ADS_LISTINGS, f"""
merged AS (SELECT {_MERGE_COLS} FROM dvf_listings UNION ALL SELECT {_MERGE_COLS} FROM ads_listings),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY listing_url ORDER BY {_TIE}) AS rn,
         count(*) OVER (PARTITION BY listing_url) AS n
  FROM merged
)""", body="""
SELECT listing_url, source, price, surface_m2, rooms, CAST(n AS BIGINT) AS update_count FROM ranked WHERE rn = 1""")

ORACLE["three_source_state"] = with_ctes(LISTINGS_RAW, SALE_ROWS, DVF_LISTINGS, ADS_LISTINGS, KEYFACTS, CARD_LISTINGS, f"""
merged AS (SELECT {_MERGE_COLS} FROM dvf_listings UNION ALL SELECT {_MERGE_COLS} FROM ads_listings
           UNION ALL SELECT {_MERGE_COLS} FROM card_listings),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY listing_url ORDER BY {_TIE}) AS rn,
         count(*) OVER (PARTITION BY listing_url) AS n
  FROM merged
)""", body=f"""
SELECT listing_url AS _id, {_MERGE_COLS}, true AS is_active, CAST(n AS BIGINT) AS update_count,
       CAST(NULL AS BOOLEAN) AS processed
FROM ranked WHERE rn = 1""")

# ---------------------------------------------------------------- every level, order, small forms
ORACLE["stats_lookup_region"] = with_ctes(*stats_ctes("region"), body="""
SELECT * FROM stats_region WHERE region_name = 'ASIA' AND logement_type = 'appartement'""")
ORACLE["stats_lookup_zipcode"] = with_ctes(*stats_ctes("zipcode"), body="""
SELECT * FROM stats_zipcode WHERE zipcode_name = '00003' AND logement_type = 'appartement'""")
for _lvl in ("region", "department"):
    ORACLE[f"stats_by_type_{_lvl}"] = with_ctes(*stats_ctes(_lvl), body=f"""
SELECT * FROM stats_{_lvl} WHERE logement_type = 'maison'""")
ORACLE["stats_threshold_region"] = with_ctes(*stats_ctes("region"), body="""
SELECT region_name, avg_price, nb_annonces FROM stats_region WHERE logement_type = 'total' AND nb_annonces >= 1000""")
ORACLE["stats_threshold_zipcode"] = with_ctes(*stats_ctes("zipcode"), body="""
SELECT s.zipcode_name, s.avg_price, s.nb_annonces, z.Department, z.GroupCitys
FROM stats_zipcode s LEFT JOIN zipcode_dim z ON s.zipcode_name = z.ZipCode
WHERE s.logement_type = 'total' AND s.nb_annonces >= 10""")
ORACLE["timeseries_city"] = with_ctes(*BASE, body=f"""
SELECT month, price_m2, row_number() OVER (ORDER BY month NULLS FIRST) - 1 AS place FROM (
  SELECT CAST(date_trunc('month', Date) AS DATE) AS month,
         {xavg(RATIO)} AS price_m2
  FROM clean WHERE lower(City) = 'customer#000000015' GROUP BY 1)""")
ORACLE["influence_order"] = f"""
SELECT *, row_number() OVER (ORDER BY correlation DESC NULLS LAST, feature) - 1 AS place FROM ({ORACLE["influence_rank"]})"""
ORACLE["distinct_order"] = f"""
SELECT *, row_number() OVER (ORDER BY Department) - 1 AS place FROM ({ORACLE["distinct_values"]})"""
ORACLE["clean_projection"] = with_ctes(*BASE, body="SELECT Name, Price, M2, City, Logement, Rooms, Date, ZipCode FROM clean")
ORACLE["key_violations"] = with_ctes(LISTINGS_RAW, body="""
SELECT listing_url, CAST(count(*) AS BIGINT) AS count FROM listings_raw GROUP BY listing_url HAVING count(*) > 1""")
ORACLE["batch_limit"] = with_ctes(LISTINGS_RAW, body="""
SELECT _id, price, city, last_seen_at FROM listings_raw WHERE NOT coalesce(processed, false) ORDER BY _id LIMIT 500""")
ORACLE["search_capped"] = with_ctes(*BASE, body="""
SELECT * FROM clean WHERE lower(Logement) = 'maison' ORDER BY Id LIMIT 100""")
ORACLE["features_preview"] = f"""
SELECT {_pad('n_nationkey')} AS code, n_name AS nom FROM nation ORDER BY 1 LIMIT 5"""
ORACLE["query_source"] = with_ctes(*BASE, body="""
SELECT Id, City, Price FROM clean WHERE lower(Logement) = 'appartement' AND Price >= 60000""")
ORACLE["dimension_scan"] = "SELECT * FROM nation"
ORACLE["run_statistics"] = with_ctes(LISTINGS_RAW, """
held AS (SELECT DISTINCT listing_url FROM listings_raw WHERE first_seen_at < TIMESTAMP '1998-01-01 00:00:00'),
batch AS (SELECT * FROM listings_raw WHERE first_seen_at >= TIMESTAMP '1998-01-01 00:00:00'),
log AS (SELECT source AS run_id, split_part(listing_url, '_', 1) AS page, count(*) AS items, min(last_seen_at) AS fetched_at
        FROM batch GROUP BY 1, 2),
agg AS (
  SELECT run_id, date_diff('microsecond', min(fetched_at), max(fetched_at)) / 1e6 AS duration_seconds,
         CAST(sum(items) AS BIGINT) AS total_properties, CAST(count(*) AS BIGINT) AS total_pages
  FROM log GROUP BY run_id
),
fresh AS (
  SELECT source AS run_id, CAST(count(DISTINCT listing_url) AS BIGINT) AS new_properties FROM batch
  WHERE listing_url NOT IN (SELECT listing_url FROM held) GROUP BY source
)""", body="""
SELECT a.run_id, TIMESTAMP '2024-06-01 12:00:00' AS "timestamp", duration_seconds, total_properties,
       coalesce(new_properties, 0) AS new_properties,
       total_properties - coalesce(new_properties, 0) AS updated_properties, total_pages,
       total_properties / greatest(1, total_pages) AS properties_per_page,
       duration_seconds / greatest(1, total_properties) AS time_per_property, 'finished' AS reason
FROM agg a LEFT JOIN fresh f ON a.run_id = f.run_id""")
