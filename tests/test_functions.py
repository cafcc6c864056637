"""Boundary golden rows for the Column builders (derived from the reference's thresholds)."""

import pytest
from pyspark.sql import functions as F

from hydrolake.functions import classify as C
from hydrolake.functions import coerce as X
from hydrolake.functions import dates as D


def col_values(spark, values, fn, dtype="double"):
    if dtype == "double":
        values = [None if v is None else float(v) for v in values]
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_classify_status(spark):
    assert col_values(spark, [90, 89.99, 75, 74.99, 40, 39.99], C.classify_status) == \
        ["CRITICAL", "HIGH", "HIGH", "NORMAL", "NORMAL", "LOW"]


def test_classify_filling_rate(spark):
    assert col_values(spark, [3.01, 3, 0.01, 0, -1, -1.01], C.classify_filling_rate) == \
        ["FAST", "MODERATE", "MODERATE", "STABLE", "STABLE", "DRAINING"]


def test_classify_rain(spark):
    got = col_values(spark, [0.09, 0.1, 9.9, 10, 35, 90], C.classify_rain)
    labels = ["ไม่มีฝน", "ฝนเล็กน้อย", "ฝนปานกลาง", "ฝนหนัก", "ฝนหนักมาก"]
    assert [labels.index(g) + 1 for g in got] == [1, 2, 2, 3, 4, 5]


def test_weather_and_historical_component(spark):
    assert col_values(spark, [0.9, 1, 10, 35, 90], C.weather_component) == [0, 5, 15, 25, 35]
    assert col_values(spark, [0, 1, 2, 3, 4, None], C.historical_component) == [0, 5, 10, 18, 25, 0]


def test_reservoir_row_score(spark):
    df = spark.createDataFrame([("CRITICAL", "FAST"), ("CRITICAL", "DRAINING"), ("HIGH", "MODERATE"),
                                ("LOW", "DRAINING"), ("??", "??")], "s string, f string")
    assert [r[0] for r in df.select(C.reservoir_row_score("s", "f")).collect()] == [40, 25, 23, 0, 5]


def test_alert_level(spark):
    assert col_values(spark, [24.99, 25, 50, 75], C.alert_level) == ["ปกติ", "เฝ้าระวัง", "เตือนภัย", "วิกฤต"]


def test_days_to_full(spark):
    df = spark.createDataFrame([(100.0, 90.0, 2.0), (100.0, 90.0, 0.0009), (10010.0, 10.0, -0.001),
                                (10.0, 0.0, 0.001)], "c double, v double, n double")
    assert [r[0] for r in df.select(C.days_to_full("c", "v", "n")).collect()] == [5.0, None, -365.0, 365.0]


def test_recompute_percent_and_clip(spark):
    df = spark.createDataFrame([(0.0, 50.0, 200.0), (0.0, 300.0, 200.0), (0.0, 5.0, 0.0), (12.0, 50.0, 200.0)],
                               "p double, v double, c double")
    got = [r[0] for r in df.select(X.clip(C.recompute_percent("p", "v", "c"))).collect()]
    assert got == [25.0, 100.0, 0.0, 12.0]


def test_coerce_numeric(spark):
    assert col_values(spark, ["N/A", "", None, "abc", " 12 ", "12d"], X.coerce_numeric, "string") == \
        [0.0, 0.0, 0.0, 0.0, 12.0, 0.0]


def test_parse_bool(spark):
    assert col_values(spark, ["true", "True", "1", " yes ", "t", "0", None, "no"], X.parse_bool, "string") == \
        [True, True, True, True, True, False, False, False]


def test_zero_pad_never_truncates(spark):
    assert col_values(spark, ["1234", "1234567"], lambda c: X.zero_pad(c, 6), "string") == ["001234", "1234567"]


def test_parse_code_list(spark):
    assert col_values(spark, ["63, 62,x,,60", "", None], X.parse_code_list, "string") == [[63, 62, 60], [], []]


def test_region_from_code(spark):
    codes = [9, 10, 19, 20, 27, 28, 30, 49, 50, 69, 70, 79, 80, 99]
    assert col_values(spark, codes, C.region_from_code, "int") == \
        ["Unknown", "C", "C", "E", "E", "Unknown", "NE", "NE", "N", "N", "W", "W", "S", "S"]


def test_month_start_key_invalid_month_is_null(spark):
    df = spark.createDataFrame([(2024, 0), (2024, 6)], "y int, m int")
    assert [r[0] for r in df.select(D.month_start_key("y", "m")).collect()] == [None, 20240601]


def test_dim_date_range(spark):
    from hydrolake.plans.star import dim_date
    d = dim_date(spark)
    assert d.count() == 2557
    first = d.orderBy("date_key").first()
    assert first["date_key"] == 20200101 and first["day_of_week"] == 4 and first["thai_year"] == 2563


def test_lookups_equal_their_tables(spark):
    levels = [*C.K.ALERT_LEVEL_EN, None, "", "x"]
    assert col_values(spark, levels, C.alert_level_en, "string") == [*C.K.ALERT_LEVEL_EN.values(), "NORMAL", "NORMAL", "NORMAL"]
    texts = [" N ", *C.K.REGION_TEXT_TO_CODE, None, "n", ""]
    assert col_values(spark, texts, C.normalize_region, "string") == ["N", *C.K.REGION_TEXT_TO_CODE.values(), *["Unknown"] * 3]


def test_classify_battery_is_compiled(spark):
    """The JVM interprets methods of more than 8,000 bytes: no stage of the query generates one."""
    import contextlib
    import io
    import re

    import __spark_entry__ as E
    from conftest import SF_SMALL

    out = io.StringIO()
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")       # an adaptive plan shows no code before it runs
    try:
        with contextlib.redirect_stdout(out):
            E.queries()["fn_classify_battery"](spark, SF_SMALL).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    assert sizes and max(sizes) < 8000
