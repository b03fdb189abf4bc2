"""Column helpers (fixtures F6, F9-F11 of FIXTURES.md)."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from parcelle.functions import arrays, classify, geo, numbers, text


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("o")).first().o


def test_clean_number(spark):
    f = numbers.clean_number
    assert one(spark, f, "1 234,50 €") == 1234.50
    assert one(spark, f, "3 500 €/m²") == 3500.0
    assert one(spark, f, "") is None and one(spark, f, None) is None
    assert one(spark, f, "abc") is None and one(spark, f, "1.2.3") is None


def test_clean_price_text(spark):
    f = numbers.clean_price_text
    assert one(spark, f, "1 234,50 €") == 1234.50
    assert one(spark, f, "3\u00a0500 €/m²") == 3500.0
    assert one(spark, f, "12\u00a0500 €") == 12500.0
    assert one(spark, f, " € ") is None and one(spark, f, "abc") is None


def test_digits_to_long(spark):
    assert one(spark, numbers.digits_to_long, "350 000 €") == 350000
    assert one(spark, numbers.digits_to_long, "prix") is None
    assert one(spark, numbers.digits_to_long, None) is None


def test_ratios(spark):
    df = spark.createDataFrame([(1000.0, 3.0), (1000.0, 0.0), (None, 2.0), (308.625 * 2, 2.0)], "p double, s double")
    out = df.select(numbers.floor_ratio("p", "s").alias("f"), numbers.rounded_ratio("p", "s").alias("r")).collect()
    assert [r.f for r in out] == [333.0, None, None, 308.0]
    assert [r.r for r in out] == [333.33, None, None, 308.62]  # half-even on ties


def test_nullable_int_and_malformed(spark):
    df = spark.createDataFrame([("3",), ("",), ("3.0",), ("x",)], "v string")
    out = df.select(numbers.nullable_int("v").alias("i"), numbers.malformed("v", numbers.nullable_int("v")).alias("m"))
    assert [(r.i, r.m) for r in out.collect()] == [(3, False), (None, False), (None, True), (None, True)]


def test_stable_round_ignores_last_bit_noise(spark):
    df = spark.createDataFrame([(1358.60325,), (1358.6032500000002,), (1358.6032499999998,), (-2.5,)], "v double")
    out = [r.o for r in df.select(numbers.stable_round("v", 4).alias("o")).collect()]
    assert out[0] == out[1] == out[2] == 1358.6033
    assert out[3] == -2.5
    big = spark.createDataFrame([(1e12 + 0.25,), (float("inf"),)], "v double").select(numbers.stable_round("v", 4).alias("o")).collect()
    assert [r.o for r in big] == [1e12 + 0.25, float("inf")]


def test_exact_avg_of_fractions_large_and_non_finite_values(spark):
    avg = lambda *v: spark.createDataFrame([(x,) for x in v], "v double").agg(numbers.exact_avg("v").alias("a")).first().a
    assert avg(33.333, 33.333, 33.333) == 33.333 and avg(1e17, 1e17) == 1e17
    assert avg(float("inf"), 200000.0) == 200000.0 and avg(float("nan")) is None


@pytest.mark.parametrize("values", [
    [33.3333333] * 7, [1e-9, 3e-9, 1e9], [1e33, 1e33, 1.0], [1e33, -1e33, 33.3333333], [-0.5], [-1e-9, -2.5, 1e18 + 2.0**20], [2.0**62, 2.0**-62], [5e-324],
    [0.1, -0.1, 1e-20], [4.6e18, 4.6e18, -1.0], [2.0**-72, 1.0], [123456789.123456789, 1e22, -1e22]])
def test_exact_avg_against_fractions(spark, values):
    """Values of any size from 2e-22 to 2e37 count with all their bits."""
    from fractions import Fraction
    rows = [(v,) for v in values]
    for order in (rows, rows[::-1]):
        got = spark.createDataFrame(order, "v double").repartition(3).agg(numbers.exact_avg("v").alias("a")).first().a
        want = 0.0 if values == [5e-324] else float(sum(map(Fraction, values)) / len(values))
        assert abs(got - want) <= 2 * math.ulp(want)


def test_exact_avg_leaves_out_what_is_not_finite_or_too_large(spark):
    avg = lambda *v: spark.createDataFrame([(x,) for x in v], "v double").agg(numbers.exact_avg("v").alias("a")).first().a
    assert avg(float("inf"), float("-inf"), float("nan"), 1e38, None, 7.0) == 7.0
    assert avg(float("inf")) is None and avg(None) is None


def test_exact_sums_add_up_and_are_taken_away(spark):
    rng = random.Random(1)
    rows = [(i % 5, rng.choice([1e-9, 1.0, 1e5, 1e20]) * rng.uniform(-1, 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, v double")
    whole = df.groupBy("k").agg(*numbers.exact_sums("v", "_v"))
    part = df.filter("v > 0").groupBy("k").agg(*numbers.exact_sums("v", "_v"))
    cols = [f"_v_{k}" for k in (*numbers.LIMBS, "n")]
    minus = part.select("k", *[(-F.col(c)).cast(t).alias(c) for c, t in part.dtypes if c in cols])
    left = whole.unionByName(minus).groupBy("k").agg(numbers.exact_mean("_v").alias("m"))
    want = df.filter("v <= 0").groupBy("k").agg(numbers.exact_avg("v").alias("m"))
    assert sorted(left.collect()) == sorted(want.collect())


def test_exact_avg_is_order_independent(spark):
    vals = [(0.1,), (0.2,), (0.3,)] * 100
    a = spark.createDataFrame(vals, "v double").agg(numbers.exact_avg("v").alias("a")).first().a
    b = spark.createDataFrame(list(reversed(vals)), "v double").repartition(7).agg(numbers.exact_avg("v").alias("a")).first().a
    assert a == b == 0.2


def test_address_parts(spark):
    assert one(spark, text.address_city, "Lyon 3 (69003)") == "Lyon 3"
    assert one(spark, text.address_postal_code, "Lyon 3 (69003)") == "69003"
    assert one(spark, text.address_city, "Paris\u00a0") == "Paris"
    assert one(spark, text.address_postal_code, "Paris") is None


def test_join_helpers(spark):
    df = spark.createDataFrame([("12", "", "RUE X", "a", None)], "n string, s string, v string, x string, y string")
    r = df.select(text.join_nonempty("n", "s", "v").alias("addr"), text.label_join("x", "y").alias("lab"),
                  text.composite_key("n", "v").alias("k")).first()
    assert r.addr == "12 RUE X" and r.lab is None and r.k == "dvf_12_RUE X"


def test_thousands(spark):
    assert one(spark, text.thousands, 1234567.89, "double") == "1,234,567"


def test_key_facts(spark):
    facts = ["3 pièces", "·", "2 chambres", "·", "terrain 100 m²", "65,5 m²", "3\u00a0pièces"]
    df = spark.createDataFrame([(facts,), (["Studio", "·"],)], "f array<string>")
    clean = arrays.drop_separators(F.col("f"))
    r = df.select(F.size(clean).alias("n"), arrays.first_fact_int(clean, "pièce").alias("rooms"),
                  arrays.first_fact_int(clean, "chambre").alias("beds"),
                  arrays.first_fact_surface(clean).alias("surf")).collect()
    assert (r[0].n, r[0].rooms, r[0].beds, r[0].surf) == (5, 3, 2, 65.5)
    assert (r[1].n, r[1].rooms, r[1].beds, r[1].surf) == (1, None, None, None)


def test_list_mean_counts_nulls(spark):
    df = spark.createDataFrame([([1.0, None, 2.0],), ([],), ([4.0],)], "a array<double>")
    assert [r.m for r in df.select(arrays.list_mean("a").alias("m")).collect()] == [1.0, 0.0, 4.0]


def test_classifiers(spark):
    assert one(spark, classify.classify, "chalet") == "maison"
    assert one(spark, classify.classify, None) == "autre"
    assert one(spark, classify.type_by_first_keyword, "Beau LOFT avec terrain") == "Terrain"
    assert one(spark, classify.type_by_first_keyword, "rien") is None
    assert one(spark, classify.map_or_keep, "castle") == "château"
    assert one(spark, classify.map_or_keep, "bungalow") == "bungalow"
    assert one(spark, classify.two_way_type, "Maison") == "maison"
    assert one(spark, classify.two_way_type, "Local") == "appartement"


def test_department_codes(spark):
    df = spark.createDataFrame([("1",), ("20",), ("201",), ("202",), ("971",), ("2A",), (None,)], "c string")
    out = [r.o for r in df.select(geo.department_code("c").alias("o")).collect()]
    assert out == ["01", "2A", "2A", "2B", "971", "2A", None]
    ints = spark.createDataFrame([(7,)], "c int").select(geo.pad_code("c").alias("o")).first().o
    assert ints == "07"
