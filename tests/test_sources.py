"""File and database sources and sinks (fixtures F7-F10 of FIXTURES.md)."""

from __future__ import annotations

import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from parcelle.functions import html
from parcelle.operators import normalise as nz
from parcelle.operators import sinks
from parcelle.schema import SALE_COLUMNS
from parcelle.sources import files

NOW = "2024-06-01 12:00:00"


def sale(**kw):
    base = {c: "" for c in SALE_COLUMNS}
    base.update(id_mutation="2024-1", date_mutation="2024-01-05", numero_disposition="1", nature_mutation="Vente",
                valeur_fonciere="200000", adresse_numero="12", adresse_nom_voie="RUE X", code_postal="75001",
                nom_commune="Paris", code_departement="75", type_local="Maison", surface_reelle_bati="100",
                nombre_pieces_principales="4")
    base.update(kw)
    return base


def write_csv_gz(path, rows):
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(",".join(SALE_COLUMNS) + "\n")
        for r in rows:
            f.write(",".join(r[c] for c in SALE_COLUMNS) + "\n")


def test_sales_csv_normalise(spark, tmp_dir):
    year1 = [sale(), sale(nature_mutation="Echange"), sale(valeur_fonciere=""), sale(valeur_fonciere="0"),
             sale(id_mutation="2024-2", lot1_surface_carrez="30.5", lot2_surface_carrez="20"),
             sale(id_mutation="2024-3", surface_reelle_bati=""),                     # no surface: dropped
             sale(id_mutation="2024-4", lot1_surface_carrez="abc"),                  # malformed lot: rejected
             sale(id_mutation="2024-5", nombre_pieces_principales=""),
             sale(id_mutation="2024-6", nombre_pieces_principales="4.0"),            # malformed rooms
             sale(type_local="Dépendance")]
    year2 = [sale(id_mutation="2023-1", adresse_suffixe="B"), sale(id_mutation="2023-1", valeur_fonciere="250000")]
    p1, p2 = os.path.join(tmp_dir, "2024.csv.gz"), os.path.join(tmp_dir, "2023.csv.gz")
    write_csv_gz(p1, year1)
    write_csv_gz(p2, year2)
    rows = files.read_sales(spark, [p1, p2], partitions=4)
    res = nz.normalise_sales(rows, NOW)
    out = {(r.listing_url, r.price): r for r in res.listings.collect()}
    assert set(k[0] for k in out) == {"dvf_2024-1_1", "dvf_2024-2_1", "dvf_2024-5_1", "dvf_2023-1_1"}
    two_lots = out[("dvf_2024-2_1", 200000.0)]
    assert two_lots.surface_m2 == 50.5 and two_lots.price_per_m2 == round(200000 / 50.5, 2)
    assert out[("dvf_2024-5_1", 200000.0)].rooms is None
    assert out[("dvf_2023-1_1", 200000.0)].address == "12 B RUE X"
    assert out[("dvf_2024-1_1", 200000.0)].description == "Mutation du 2024-01-05 - Vente"
    assert {r.listing_url: r.reason for r in res.rejected.collect()} == {
        "dvf_2024-4_1": "malformed_surface", "dvf_2024-6_1": "malformed_rooms"}


def write_csv(path, columns, rows, first="", end="\n"):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(first + ",".join(columns) + end)
        for r in rows:
            f.write(",".join(f'"{r[c]}"' if "," in r.get(c, "") else r.get(c, "") for c in columns) + end)


def test_sales_of_a_folder_go_by_each_file_header(spark, tmp_dir):
    """Years with swapped, further, repeated and missing columns in one folder; a byte order mark; no header; no rows."""
    want = ["nature_mutation", "valeur_fonciere", "type_local", "nom_commune"]
    row = {"id_mutation": "B", "nature_mutation": "Vente", "valeur_fonciere": "200000", "type_local": "Maison", "nom_commune": "Lyon, 3e"}
    write_csv(f"{tmp_dir}/2021.csv", [*SALE_COLUMNS], [sale(id_mutation="A")])
    write_csv(f"{tmp_dir}/2022 b[2]%20+.csv", ["type_local", "valeur_fonciere", "id_mutation", "nature_mutation", "nom_commune"], [row])
    write_csv(f"{tmp_dir}/2023.csv", ["longitude", *SALE_COLUMNS, "id_mutation", ""], [sale(id_mutation="C") | {"longitude": "4.8", "": "x"}], first="\ufeff", end="\r\n")
    write_csv(f"{tmp_dir}/2024.csv", [*SALE_COLUMNS], [sale(id_mutation="D", nom_commune="id_mutation")])
    write_csv(f"{tmp_dir}/2025.csv", [*SALE_COLUMNS], [])
    write_csv(f"{tmp_dir}/notes.csv", ["a", "b"], [{"a": "1", "b": "2"}])
    open(f"{tmp_dir}/empty.csv", "w").close()
    for paths in (tmp_dir, f"{tmp_dir}/*.csv"):
        got = {r.id_mutation: r for r in files.read_sales(spark, paths).collect()}
        assert set(got) == {"A", "B", "C", "D"}
        assert [got["B"][c] for c in want] == ["Vente", "200000", "Maison", "Lyon, 3e"] and got["B"].code_postal == ""
        assert got["C"].nom_commune == "Paris" and got["D"].nom_commune == "id_mutation"
    assert files.sale_headers(spark, tmp_dir).count() == 3
    assert files.read_sales(spark, f"{tmp_dir}/notes.csv").count() == 0


def test_many_sale_files_are_few_reads(spark, tmp_dir):
    """The number of scans follows the headers, not the files, and the header scan is one job whatever the files."""
    swapped = [*reversed(SALE_COLUMNS)]
    for i in range(300):
        write_csv(f"{tmp_dir}/{i}.csv", swapped if i % 2 else SALE_COLUMNS, [sale(id_mutation=str(i))])
    df = files.read_sales(spark, tmp_dir)
    assert sorted(int(r.id_mutation) for r in df.filter("type_local = 'Maison'").collect()) == list(range(300))
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2


def test_ads_files(spark, tmp_dir):
    ad = {"id": "a1", "price": [100000, None, 200000], "roomsQuantity": [3, 4], "surfaceArea": 50,
          "bedroomsQuantity": 2, "pricePerSquareMeter": None, "district": {"name": "Centre"},
          "city": "Lyon", "postalCode": "69001", "description": "d", "propertyType": "house"}
    ad2 = {"id": "a2", "price": 300000, "surfaceArea": 0, "pricePerSquareMeter": None, "city": "X",
           "propertyType": "townhouse", "roomsQuantity": [], "bedroomsQuantity": None}
    ad3 = {"id": "a3", "price": 1, "propertyType": "programme"}
    ad4 = {"id": "a4", "price": 10, "surfaceArea": 5, "propertyType": "yurt"}   # ppm2 missing: 0, no fallback
    pages = [{"total": 4, "realEstateAds": [ad, ad2, ad3, ad4]}, {"realEstateAds": [ad]}, [ad], {"total": 0}]
    for i, p in enumerate(pages):
        with open(os.path.join(tmp_dir, f"p{i}.json"), "w") as f:
            json.dump(p, f)
    payloads = files.read_payload_files(spark, tmp_dir, department="69")
    out = {r.listing_url: r for r in nz.normalise_ads(nz.read_ads(payloads), NOW).collect()}
    assert set(out) == {"a1", "a2", "a4"}
    a1 = out["a1"]
    assert a1.price == 100000.0 and a1.rooms == 3 and a1.price_per_m2 == 2000.0 and a1.address == "Centre"
    assert a1.property_type == "maison" and a1.department == "69"
    a2 = out["a2"]
    assert a2.price_per_m2 == 0.0 and a2.rooms == 0 and a2.bedrooms == 0 and a2.address == ""
    assert a2.property_type == "maison de ville" and a2.postal_code == ""
    assert out["a4"].price_per_m2 == 0.0 and out["a4"].property_type == "yurt"


def _card(price="", link="", facts=(), address="", kind="", text=()):
    boxes = lambda xs: "".join(f"<div>{x}</div>" for x in xs)
    return (f'<div class="c" data-testid="serp-core-classified-card-testid"><a data-testid="card-mfe-covering-link-testid" href="{link}"></a>'
            + price + f'<div data-testid="cardmfe-keyfacts-testid">{boxes(facts)}</div>'
            f'<div data-testid="cardmfe-description-box-address">{address}</div>'
            f'<div data-testid="cardmfe-description-box-text-test-id">{boxes([kind])}</div>'
            f'<div data-testid="cardmfe-description-text-test-id">{boxes(text)}</div></div>')


def test_cards_from_pages(spark):
    price = '<div data-testid="cardmfe-price-testid">{}<span>2 916 €/m²</span></div>'
    first = _card(price.format("350 000 €"), "/a?x=1&amp;y=2", ["5 pièces", "·", "120 m²", "·", "2 chambres", "·", "600 m² terrain"],
                  "Lyon 3 (69003)", "Belle MAISON", ["Vue &amp; calme", " au sud "])
    zero = _card(price.format("0 €"), "/b", ["40,5 m²"], "Paris", "Studio")
    bare = _card("", "", [], "", "")
    footer = '<footer><div>42</div><div data-testid="cardmfe-price-testid">99 €</div></footer>'
    pages = spark.createDataFrame([(1, "69", f"<html><body><div>{first}{zero}{bare}</div>{footer}</body></html>"),
                                   (2, "75", "<html>none</html>"), (3, "75", None)], "page_id long, department string, html string")
    cards = nz.read_cards(pages)
    assert [(r.page_id, r.pos) for r in cards.orderBy("pos").collect()] == [(1, 1), (1, 2), (1, 3)]
    out = nz.normalise_cards(cards.orderBy("pos"), NOW)
    a, b, c = out.collect()
    assert (a.listing_url, a.department, a.price, a.price_per_m2) == ("/a?x=1&y=2", "69", 350000.0, 2916.0)
    assert (a.rooms, a.bedrooms, a.surface_m2, a.city, a.postal_code) == (5, 2, 120.0, "Lyon 3", "69003")
    assert a.property_type == "Maison" and a.description == "Vue & calme au sud"
    assert a.features == ["5 pièces", "120 m²", "2 chambres", "600 m² terrain"]
    assert (b.price, b.price_per_m2, b.surface_m2, b.property_type, b.postal_code) == (None, None, 40.5, "Studio", None)
    assert (c.listing_url, c.price, c.address, c.property_type, c.features, c.description) == (None, None, None, None, [], "")
    from parcelle.operators import state as st
    assert st.upsert(None, out).filter("listing_url = '/b'").first().is_active


def test_card_texts_are_whole(spark):
    """Texts around inner tags, comments, references and attributes with markup; elements without an end."""
    card = ('<div title="a > b" data-testid="serp-core-classified-card-testid">'
            "<script>var x = '<div data-testid=\"cardmfe-price-testid\">1</div>';</script><!-- </div></div> -->"
            "<a href='/x&amp;y' data-testid='card-mfe-covering-link-testid'></a>"
            '<div data-testid="cardmfe-price-testid"><span>about</span>250 000&nbsp;&euro;</div>'
            '<div title=\'data-testid="cardmfe-price-testid"\'>9 €</div>'
            '<div data-testid="cardmfe-keyfacts-testid">loose<div><i></i>70 m²</div><div>3 pièces<!-- c -->·</div><div><p>no</p>2 chambres</div></div>'
            '<div data-testid="cardmfe-description-box-address"><b>x</b>Évry (91000)</div>'
            '<div data-testid="cardmfe-description-text-test-id"><div>First line<br>second line<br/>3 < 4 &eacute;&#233;&#xe9;&unknown;</div><div>< 5 ></div><div>'
            "<ul><li>item</ul> end</div></div></div>")
    page = f"<html><body>{card}<div data-testid=serp-core-classified-card-testid><div data-testid='cardmfe-price-testid'>7 €<section></div></body>"
    pages = spark.createDataFrame([(1, "91", page)], "page_id long, department string, html string")
    cards = nz.read_cards(pages).orderBy("pos")
    assert cards.count() == 2
    a, b = nz.normalise_cards(cards, NOW).collect()
    assert (a.listing_url, a.price, a.surface_m2, a.price_per_m2, a.rooms, a.bedrooms) == ("/x&y", 250000.0, 70.0, 3571.0, 3, 2)
    assert a.features == ["70 m²", "3 pièces", "2 chambres"] and (a.city, a.postal_code) == ("Évry", "91000")
    assert a.description == "First linesecond line3 < 4 ééé&unknown;< 5 > end"
    assert (b.price, b.description, b.features) == (7.0, "", [])


def test_a_tag_is_read_once(spark):
    """The test id of a tag was parsed three times, once for each use of its mark."""
    pages = spark.createDataFrame([(1, "69", _card())], "page_id long, department string, html string")
    cards = nz.read_cards(pages)
    assert cards._jdf.queryExecution().optimizedPlan().toString().count("(?is)^\\sdata-testid") == 1 and cards.count() == 1


def _soup(rng, depth, marks, messy):
    """Random markup: texts, comments, scripts, marked and other elements, now and then without an end."""
    if depth == 0 or rng.random() < 0.3:
        return rng.choice(["a", " ", "x &amp; y", "3 < 4", "<", "<!-- <div> -->", "<br>", "<img alt='<div>'>", "<script>if (a<b) '</div>'</script>",
                           "<div/>", f'<i data-testid="{rng.choice(marks)}"></i>', *(["</div>", "<p>", "</p>", "<div>"] if messy else [])])
    name = rng.choice(["div"] * 6 + ["DIV", "span", "p", "div-x"])
    mark = rng.choice(marks + ["other"] * 3)
    tag = rng.choice([f" title='a > b' data-testid=\"{mark}\""] * 2 + [f" data-testid='{mark}'", f" data-testid={mark}", f' data-testid="&#{ord(mark[0])};{mark[1:]}"'] + [""] * 8)
    return f"<{name}{tag}>{''.join(_soup(rng, depth - 1, marks, messy) for _ in range(rng.randrange(4)))}</{name}>"


def test_cards_read_by_patterns_are_those_of_the_fold(spark):
    rng = random.Random(5)
    *marks, card = nz._MARKS
    pages = []
    for i in range(400):
        marked, messy = rng.choice([[], marks]), rng.random() < 0.2
        body = "".join(rng.choice([f'<div data-testid="{card}">', f"<div x data-testid='{card}'>"])
                       + "".join(f'<div data-testid="{rng.choice(marks)}">{_soup(rng, 3, marked or ["other"], messy)}</div>{_soup(rng, rng.choice([2, 14]), marks, messy)}' for _ in range(3))
                       + "</div>" + _soup(rng, 2, marked + [card] if rng.random() < 0.2 else ["other"], messy) for _ in range(rng.randrange(3)))
        pages.append((i, rng.choice(["<div>", "", f'<div data-testid="{marks[1]}">']) + body + "</div>"))
    df = spark.createDataFrame(pages, "page_id long, html string").repartition(4).cache()
    fold = F.when(F.col("html").contains(card), html.marked_texts(F.col("html"), nz._MARKS, nz._CARD))
    want = {(r.page_id, w.record): [] for r in df.select("page_id", fold.alias("said")).collect() for w in r.said or []}
    for r in df.select("page_id", fold.alias("said")).collect():
        for w in r.said or []:
            want[(r.page_id, w.record)] += [w] if w.text is not None else []
    got = [((r.page_id, r.pos), r.said) for r in nz.read_cards(df).collect()]
    assert len(got) == len(want) > 300 and dict(got) == want


def test_cards_need_no_fold(spark, monkeypatch):
    """The fold took over 0.5 ms a card. Cards whose marked boxes lie side by side do not go through it, counted ones neither."""
    price = '<p>near</p><div class="w"><div data-testid="cardmfe-price-testid"><b>1</b>350 000 €</div></div>'
    page = f"<html><p><div>{_card(price, '/a', ['5 pièces<br>x', '·'], 'Lyon (69003)', 'Villa', ['a', 'b'])}\n{_card(link='/b')}</div></html>"
    monkeypatch.setattr(html, "marked_texts", lambda *a: F.lit(None).cast("array<struct<record:int,own:int,within:int,text:string>>"))
    cards = nz.read_cards(spark.createDataFrame([(1, "69", page)], "page_id long, department string, html string"))
    a, b = sorted(nz.normalise_cards(cards, NOW).collect(), key=lambda r: r.listing_url)
    assert (a.price, a.city, a.property_type, a.description, a.features) == (350000.0, "Lyon", "Villa", "ab", ["5 pièces", "x"])
    assert b.listing_url == "/b" and cards.select("department").count() == 2


def test_key_facts_are_searched_once(spark):
    """A fact is filtered once for each field; blank and null facts, other spaces, words without a number."""
    rows = [(["\u00a0", None, "pièces", "x 3 pièces", "\t4\u00a0pièces", "5 pièces", " 1,5 m² terrain", "1,5 m²", ", m²", "7 chambres"], "1 €", "A (1)(2)", ["\u00a0a ", "b\u00a0\n"], "loft"),
            ([], "", "B", [], ""), (None, None, None, None, None), (["2 m² TERRAIN", "1.2.3 m²", "3 m²"], "x", " (9 ", None, "Villa")]
    boxes = spark.createDataFrame(rows, "facts array<string>, price_text string, address string, text_parts array<string>, type_text string").coalesce(1)
    out = nz.normalise_keyfacts(boxes).select("rooms", "bedrooms", "surface_m2", "city", "postal_code", "description", "property_type")
    assert [tuple(r) for r in out.collect()] == [(4, 7, 1.5, "A", "1", "a b", "Loft"), (None, None, None, "B", None, "", None),
                                                 (None,) * 7, (None, None, None, "", "9", None, "Villa")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("filter(") == 3


def test_geojson(spark, tmp_dir):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"code": "01", "nom": "Ain"},
         "geometry": {"type": "Polygon", "coordinates": [[[1, 2], [3, 4], [1, 2]]]}},
        {"type": "Feature", "properties": {"code": "2A", "nom": "Corse-du-Sud"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[1, 2], [3, 4], [1, 2]]]]}}]}
    path = os.path.join(tmp_dir, "d.geojson")
    with open(path, "w") as f:
        json.dump(fc, f, indent=2)
    for split in (True, False):
        rows = files.read_geojson(spark, path, split).collect()
        assert [(r.code, r.nom) for r in rows] == [("01", "Ain"), ("2A", "Corse-du-Sud")]
        assert json.loads(rows[1].geometry) == fc["features"][1]["geometry"]


def test_one_large_geojson_file_is_many_tasks(spark, tmp_dir):
    rng = random.Random(2)
    features = [{"type": "Feature", "properties": {"code": str(i), "nom": f'a "quoted" {{name}} [{i}]', "kind": "x" * rng.randrange(300)},
                 "geometry": {"type": "Polygon", "coordinates": [[[rng.random(), rng.random()] for _ in range(rng.randrange(3, 60))]]}} for i in range(600)]
    with open(f"{tmp_dir}/big.geojson", "w") as f:
        json.dump({"type": "FeatureCollection", "features": features, "bbox": [0, 0, 1, 1]}, f)
    with open(f"{tmp_dir}/one.geojson", "w") as f:
        json.dump({"type": "Feature", "properties": {"code": "alone", "nom": None}, "geometry": None}, f)
    open(f"{tmp_dir}/none.geojson", "w").write('\ufeff{"type":"FeatureCollection","features":[]}')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = files.read_geojson(spark, tmp_dir)
        got = {r.code: r for r in df.collect()}
        assert df.rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 601 and got["alone"].nom is None and got["alone"].geometry is None
    for f in features:
        r = got[f["properties"]["code"]]
        assert r.nom == f["properties"]["nom"] and json.loads(r.geometry) == f["geometry"]


def test_geojson_in_another_order_raises_or_is_read_whole(spark, tmp_dir):
    props = {"properties": {"code": "1", "nom": "n"}}
    orders = [props | {"geometry": None, "type": "Feature"}, props | {"type": "Feature", "geometry": None},
              {"type": "Feature", "properties": {"kind": "Feature", "code": "1", "nom": "n"}, "geometry": None}]
    for i, feature in enumerate(orders):
        path = f"{tmp_dir}/{i}.geojson"
        with open(path, "w") as f:
            json.dump({"features": [feature] * 2, "type": "FeatureCollection"}, f)
        with pytest.raises(Exception, match="not a feature"):
            files.read_geojson(spark, path).collect()
        assert files.read_geojson(spark, path, split=False).count() == 2


def test_query_with_bound_parameters(spark):
    spark.createDataFrame([("Paris", 1), ("Lyon", 2)], "city string, n int").createOrReplaceTempView("t_cities")
    out = files.read_query(spark, "SELECT n FROM t_cities WHERE lower(city) = lower(:c)", args={"c": "PARIS"})
    assert [r.n for r in out.collect()] == [1]


def test_jdbc_append_and_read(spark, tmp_dir):
    url = f"jdbc:derby:memory:parcelle{os.getpid()};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([("maison", 150000.0, 50.0, "Paris", "maison", 3, None, "75001")],
                               "Name string, Price double, M2 double, City string, Logement string, Rooms int, "
                               "Date date, ZipCode string")
    sinks.write_jdbc(df, url, "REAL_ESTATE", props, mode="overwrite")
    sinks.write_jdbc(df, url, "REAL_ESTATE", props)
    back = files.read_jdbc(spark, url, "SELECT * FROM REAL_ESTATE", props)
    assert back.count() == 2


def test_state_versions_and_run_stats(spark, tmp_dir):
    df = spark.createDataFrame([("u1", 1), ("u2", 2)], "listing_url string, n int")
    p = sinks.write_state_version(df, f"{tmp_dir}/state", 1, partitions=2)
    assert spark.read.parquet(p).count() == 2
    from parcelle.operators.stats import run_statistics
    log = spark.createDataFrame([("r1", 2, NOW), ("r1", 0, NOW), ("r2", 3, NOW)], "run_id string, items int, fetched_at string")
    log = log.withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz"))
    counters = spark.createDataFrame([("r1", 2, 0)], "run_id string, new_properties long, updated_properties long")
    runs = run_statistics(log, counters, NOW, "finished")
    for r in ("r1", "r2", "r1"):                       # a retried run replaces its own row
        sinks.write_run_stats(runs.filter(F.col("run_id") == r), f"{tmp_dir}/runs")
    back = {r.run_id: r for r in spark.read.parquet(f"{tmp_dir}/runs").collect()}
    assert len(back) == 2 and spark.read.parquet(f"{tmp_dir}/runs").count() == 2
    assert (back["r1"].total_pages, back["r1"].new_properties, back["r2"].new_properties, back["r2"].reason) == (1, 2, 0, "finished")
    import pytest
    with pytest.raises(ValueError):
        sinks.write_run_stats(df, f"{tmp_dir}/runs")
    cut = sinks.checkpoint_cut(spark, df)
    assert cut.count() == 2


def test_read_unprocessed_pushes_filter_and_projection(spark, tmp_dir):
    from parcelle.sources import testdata
    from tests.conftest import SF_SMALL
    path = f"{tmp_dir}/raw"
    testdata.listings_raw(spark, SF_SMALL).write.parquet(path)
    df = files.read_unprocessed(spark, path, limit=20)
    assert df.count() == 20
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "processed" in plan
    assert "ReadSchema" in plan and "features" not in plan.split("ReadSchema")[1].split("\n")[0]
