"""Column expressions against fixed vectors."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from perkline import functions as X
from perkline.functions.dates import as_date
from perkline.functions.text import hex_to_long


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


@pytest.mark.parametrize("text, expected", [
    ("0", dt.date(1899, 12, 30)), ("1", dt.date(1899, 12, 31)), ("44000", dt.date(2020, 6, 18)),
    ("44000.0", dt.date(2020, 6, 18)), ("45292", dt.date(2024, 1, 1)), ("44000.5", dt.date(2020, 6, 19)),
    ("44000.4", dt.date(2020, 6, 18)), (" 44000 ", dt.date(2020, 6, 18)),
    ("2020-06-18 00:00:00", dt.date(2020, 6, 18)), ("", None), (None, None),
])
def test_excel_serial(spark, text, expected):
    assert one(spark, X.excel_serial_to_date(F.col("x")), text) == expected


@pytest.mark.parametrize("text", ["  ", "nan"])
def test_excel_serial_rejects_bad_text(spark, text):
    with pytest.raises(Exception):
        one(spark, X.excel_serial_to_date(F.col("x")), text)
    assert one(spark, X.excel_serial_to_date(F.col("x"), strict=False), text) is None


@pytest.mark.parametrize("text, expected", [
    ("Vélo/Trottinette/Autres", "velo/trottinette/autres"), ("VÉLO", "vélo"), ("", ""), (None, "inconnu")])
def test_mode_folding(spark, text, expected):
    assert one(spark, X.normalize_text_mode(F.col("x")), text) == expected


@pytest.mark.parametrize("text, expected", [
    ("Vélo", "velo"), ("véhicule thermique/électrique", "vehicule"), (" Marche ", "marche"), ("", "inconnu"), (None, "inconnu")])
def test_mode_lookup(spark, text, expected):
    assert one(spark, X.normalize_mode_lookup(F.col("x")), text) == expected


@pytest.mark.parametrize("address, lat, lon, km", [
    ("8 Quai des Tilleuls, 34000 Montpellier", 43.5238, 3.8964, 4.63),
    ("1 Rue A, 1234567 Ville", 43.535, 3.7397, 13.57),
    ("sans code", 43.5794, 3.987, 6.96),
    (None, 43.6093, 3.943, 5.87),
])
def test_geocode_md5_and_distance(spark, address, lat, lon, km):
    a, b = X.geocode(F.col("x"))
    office = F.lit(43.5652), F.lit(3.9029)
    row = spark.createDataFrame([(address,)], "x string").select(
        a, b, X.haversine_km(a, b, *office), X.haversine_km(a, b, *office, form="asin")).first()
    assert (float(row[0]), float(row[1])) == (lat, lon)
    assert float(row[2]) == km == float(row[3])


@pytest.mark.parametrize("address, lat, lon", [
    ("8 Quai des Tilleuls, 34000 Montpellier", 43.5377, 3.8088),
    ("1 Rue A, 1234567 Ville", 43.5711, 3.9885),
    (None, 43.5652, 3.9029), ("", 43.5652, 3.9029),
])
def test_geocode_sha(spark, address, lat, lon):
    a, b = X.geocode(F.col("x"), method="sha256")
    row = spark.createDataFrame([(address,)], "x string").select(a, b).first()
    assert (float(row[0]), float(row[1])) == (lat, lon)


def test_haversine_known_distance(spark):
    for form in ("asin", "atan2"):
        c = X.haversine_km(F.lit(48.8566), F.lit(2.3522), F.lit(43.5652), F.lit(3.9029), form)
        assert one(spark, c) == Decimal("600.32")
        assert one(spark, X.haversine_km(*[F.lit(1.5)] * 4, form=form)) == 0
    assert one(spark, X.haversine_km(F.lit(None).cast("double"), F.lit(1.0), F.lit(1.0), F.lit(1.0))) is None


@pytest.mark.parametrize("address, city", [("a, 34970 Lattes", "Lattes"), ("a", ""), (None, None), ("a,  Lattes , b", "Lattes")])
def test_city(spark, address, city):
    assert one(spark, X.city_from_address(F.col("x")), address) == city


@pytest.mark.parametrize("key, marker, name", [
    ("1", 0.956, "intense"), ("42", 0.4184, "occasional"), ("59019", 0.5937, "regular"), ("abc", 0.5272, "regular")])
def test_cohort(spark, key, marker, name):
    assert one(spark, X.cohort(F.col("x")), key) == name
    assert one(spark, (hex_to_long(F.md5("x"), 1) % 10_000) / 10_000, key) == marker


@pytest.mark.parametrize("key, expected", [("10.0", "10"), ("10.05", "10.05"), ("7", "7"), (None, None)])
def test_numeric_key(spark, key, expected):
    assert one(spark, X.clean_numeric_key(F.col("x")), key) == expected


def test_row_hash_treats_null_as_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    assert df.select(X.row_hash([F.col("x"), F.col("y")])).distinct().count() == 1


def test_validity_is_never_null(spark):
    df = spark.createDataFrame(
        [("e", "2024-01-01", 1.0, 1), (None, "2024-01-01", 1.0, 1), ("e", None, 1.0, 1), ("e", "2024-01-01", -1.0, 1),
         ("e", "2024-01-01", None, 1), ("e", "2024-01-01", 1.0, 0), ("e", "2024-01-01", 1.0, None), ("e", "2024-01-01", 0.0, 1)],
        "e string, d string, k double, m int")
    flags = [r[0] for r in df.select(X.is_valid_activity(F.col("e"), F.col("d"), F.col("k"), F.col("m"))).collect()]
    assert flags == [True, False, False, False, False, False, False, True]


def test_message_skips_null(spark):
    c = X.activity_message(F.lit("run"), F.lit(None).cast("string"), as_date("2024-01-02"), F.lit(Decimal("5.00")), F.lit(30))
    assert one(spark, c) == ":runner: Activite run enregistree pour le salarie  le 2024-01-02 (5.00 km, 30 min)."


def test_strict_and_lenient_cast(spark):
    assert one(spark, X.strict_cast(F.col("x"), "int"), "") is None
    assert one(spark, X.strict_cast(F.col("x"), "int", strict=False), "25.x") is None
    with pytest.raises(Exception):
        one(spark, X.strict_cast(F.col("x"), "int"), "25.x")


def test_duration_uses_the_reference_time(spark):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    c = X.duration_seconds(start, F.lit(None).cast("timestamp"), "2024-01-01 00:01:00.5")
    assert one(spark, c) == 60.5


def test_stable_id(spark):
    assert one(spark, X.stable_id(F.col("x"), "salary"), None) is None
    assert len(one(spark, X.stable_id(F.col("x"), "salary"), "1")) == 32
