import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from martlet.functions import (
    array_first, array_nth, band, blank_to_null, default_if_blank, is_present,
    iso_to_timestamp, map_value, normalize_column_names, normalize_name,
    null_to_zero_int, positive_decimal, to_bool, trimmed, utc_to_timestamp,
    is_rejected,
)


def test_blank_rules_trim_order(spark):
    df = spark.createDataFrame([("a",), ("",), ("   ",), (" b ",), ("\tc",), (None,)], "v string")
    r = df.select(blank_to_null("v").alias("p6"), blank_to_null("v", trim=True).alias("p7"),
                  is_present("v").alias("p4"), trimmed("v").alias("p5"),
                  default_if_blank("v").alias("p9")).collect()
    assert [x.p6 for x in r] == ["a", None, "   ", " b ", "\tc", None]
    assert [x.p7 for x in r] == ["a", None, None, "b", "\tc", None]  # trim keeps tabs (T2)
    assert [x.p4 for x in r] == [True, False, False, True, True, False]
    assert [x.p9 for x in r] == ["a", "unknown", "   ", " b ", "\tc", "unknown"]


def test_null_to_zero_counts_rejects(spark):
    df = spark.createDataFrame([("5",), (None,), ("x",)], "v string")
    v = null_to_zero_int("v")
    r = df.select(v.alias("n"), is_rejected("v", v).alias("rej")).collect()
    assert [(x.n, x.rej) for x in r] == [(5, False), (0, False), (None, True)]


def test_positive_decimal_edges(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (None,), (9999.99,), (10000.0,), (10.005,)],
                               "h double")
    r = [x[0] for x in df.select(positive_decimal("h")).collect()]
    assert r == [None, None, None, Decimal("9999.99"), None, Decimal("10.01")]


def test_utc_marker_honoured_in_other_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2025-06-10T19:45:49Z",)], "s string")
        r = df.select(F.unix_timestamp(utc_to_timestamp("s")).alias("u")).first().u
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r == int(dt.datetime(2025, 6, 10, 19, 45, 49, tzinfo=dt.timezone.utc).timestamp())


def test_iso_and_bool_casts(spark):
    df = spark.createDataFrame([("2025-06-10T19:45:49.123456", "true"), ("bad", "maybe")],
                               "s string, b string")
    r = df.select(iso_to_timestamp("s").alias("t"), to_bool("b").alias("b")).collect()
    assert r[0].t == dt.datetime(2025, 6, 10, 19, 45, 49, 123456)
    assert r[1].t is None and r[0].b is True and r[1].b is None


def test_array_and_map_access_never_fail(spark):
    df = spark.createDataFrame([([],), (["Fire"],), (["Fire", "Flying"],), (None,)],
                               "types array<string>")
    r = df.select(array_first("types").alias("t1"), array_nth("types", 2).alias("t2")).collect()
    assert [(x.t1, x.t2) for x in r] == [(None, None), ("Fire", None), ("Fire", "Flying"),
                                         (None, None)]
    m = spark.createDataFrame([({"hp": 45},)], "s map<string,int>")
    assert m.select(map_value("s", "hp"), map_value("s", "spe")).first() == (45, None)


def test_bands_first_match(spark):
    vals = [None, 0.5, 9.99, 10.0, 24.9, 25.0, 49.0, 50.0, 50.01]
    df = spark.createDataFrame([(v,) for v in vals], "h double")
    r = [x[0] for x in df.select(band("h")).collect()]
    assert r == ["Sin datos", "Corto (< 10h)", "Corto (< 10h)", "Medio (10-25h)",
                 "Medio (10-25h)", "Medio (10-25h)", "Largo (25-50h)", "Largo (25-50h)",
                 "Muy Largo (> 50h)"]


def test_name_normalisation(spark):
    assert normalize_name("Día Ñ") == "d_a"
    assert normalize_name("Día Ñ", strip_accents=True) == "dia_n"
    assert normalize_name("__Total-Price($)") == "total_price"
    df = spark.createDataFrame([(1, 2)], "`A b` int, `x` int")
    assert normalize_column_names(df).columns == ["a_b", "x"]
    clash = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    with pytest.raises(ValueError):
        normalize_column_names(clash)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=20))
def test_name_rule_properties(name):
    out = normalize_name(name)
    assert set(out) <= set("abcdefghijklmnopqrstuvwxyz0123456789_")
    assert "__" not in out and not out.startswith("_") and not out.endswith("_")
    assert out.replace("_", "") == "".join(ch for ch in name.lower() if ch in
                                           "abcdefghijklmnopqrstuvwxyz0123456789")
