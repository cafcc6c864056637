"""Relational operators: determinism, strategy equivalence, laziness."""

from pyspark.sql import functions as F

from hydrolake.operators.aggregates import pivot_counts, topk_concat, topk_concat_and_max
from hydrolake.operators.dedup import dedup_latest, flag_duplicates
from hydrolake.operators.joins import fallback_whole, substring_match_pairs
from hydrolake.operators.quality import dq_report, dq_summary
from hydrolake.streaming.ingest import watermark_filter
from hydrolake.streaming.state import backfill_dates


def test_dedup_latest_total_order(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-01-01", 2), ("a", None, 3), ("b", None, 4)],
                               "k string, ts string, off int")
    out = dedup_latest(df, ["k"], "ts", [F.col("off").desc()]).orderBy("k").collect()
    assert [(r.k, r.off) for r in out] == [("a", 2), ("b", 4)]


def test_flag_duplicates_marks_all_members(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert sorted(r.is_duplicate for r in flag_duplicates(df, ["k"]).collect()) == [False, True, True]


def test_substring_join(spark):
    texts = spark.createDataFrame([(1, "เขื่อนภูมิพล"), (2, "Bhumibol"), (3, "dam 12 of nation_1"), (4, "")],
                                  "tid int, t string")
    pats = spark.createDataFrame([(10, "ภูมิพล"), (11, "bhumibol dam"), (12, "dam 1"), (13, ""), (14, "x")],
                                 "pid int, p string")
    def got(ci):
        return sorted(tuple(r) for r in substring_match_pairs(texts, "tid", pats, "pid", [("t", "p", ci)]).collect())
    assert got(False) == [(1, 10), (3, 12)]
    assert got(True) == [(1, 10), (2, 11), (3, 12)]
    both = substring_match_pairs(texts, "tid", pats, "pid", [("t", "p", False), ("t", "p", True)])
    assert sorted(tuple(r) for r in both.collect()) == got(True)


def test_fallback_whole_is_lazy_and_correct(spark):
    prim = spark.createDataFrame([(1,)], "x int")
    sec = spark.createDataFrame([(2,), (3,)], "x int")
    assert sorted(r.x for r in fallback_whole(prim, sec).collect()) == [1]
    assert sorted(r.x for r in fallback_whole(prim.where("x > 5"), sec).collect()) == [2, 3]


def test_topk_concat_order(spark):
    df = spark.createDataFrame([("p", "b", 5.0), ("p", "a", 5.0), ("p", "c", 9.0), ("p", "d", 1.0)],
                               "g string, n string, s double")
    out = topk_concat(df, ["g"], [F.col("s").desc(), F.col("n")], 3, {"names": "n"}).first()
    assert out.names == "c,a,b"


def test_topk_and_max_in_one_pass(spark):
    """A hot group over few cells: the same top rows and maxima as by plain Python; repeated rows count once."""
    rows = [("hot" if i % 3 else f"g{i}", f"n{i * 7 % 50:02}", i, float(i * 37 % 11), None if i % 4 else float(i % 90)) for i in range(400)]
    df = spark.createDataFrame(rows + rows[:50], "g string, n string, id int, s double, pct double")
    out = topk_concat_and_max(df, ["g"], [F.col("s").desc(), F.col("n"), F.col("id")], 3, {"names": "n", "ids": "id"},
                              {"s": "s", "pct": "pct"}, ["id"], cells=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2, plan
    want = {}
    for g in {r[0] for r in rows}:
        of = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[3], r[1], r[2]))
        pct = [r[4] for r in of if r[4] is not None]
        want[g] = (",".join(r[1] for r in of[:3]), ",".join(str(r[2]) for r in of[:3]), of[0][3], max(pct) if pct else None)
    assert {r.g: (r.names, r.ids, r.s, r.pct) for r in out.collect()} == want


def test_topk_of_rows_that_count_for_several_values(spark):
    """Rows with a list of groups: the same as with a row per group, also where lists overlap and rows come twice."""
    rows = [([i % 3, 3 + i % 2], "d", f"n{i * 7 % 50:02}", i, float(i * 37 % 11), None if i % 4 else float(i % 90)) for i in range(200)]
    df = spark.createDataFrame(rows + [([9, 0], *r[1:]) for r in rows[:60]], "gs array<int>, d string, n string, id int, s double, pct double")
    args = ([F.col("s").desc(), F.col("n"), F.col("id")], 3, {"names": "n", "ids": "id"}, {"s": "s", "pct": "pct"}, ["id"])
    want = topk_concat_and_max(df.withColumn("g", F.explode("gs")).drop("gs"), ["g", "d"], *args, cells=4)
    got = topk_concat_and_max(df, ["g", "d"], *args, cells=4, each=("g", "gs"))
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect()) and got.count() == 6


def test_pivot_counts_absent_is_zero(spark):
    df = spark.createDataFrame([("A",), ("A",)], "lvl string")
    r = pivot_counts(df, [], "lvl", {"A": "a", "B": "b"}).first()
    assert (r.a, r.b) == (2, 0)


def test_dq_range_boundaries_and_pass_rate(spark):
    rows = [("r1", "2024-01-01", "dam", 100.0, 1.0, -10.0, 0.0), ("r2", "2024-01-01", "dam", 100.01, 1.0, -10.01, 0.0),
            ("r3", "2024-01-01", "dam", None, 1.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "reservoir_id string, record_date string, source string, percent_storage double, "
                                     "volume_mcm double, inflow_mcm double, outflow_mcm double")
    rep = {r.rule: r for r in dq_report(df, "t").collect()}
    assert rep["RANGE_CHECK:percent_storage[0.0,100.0]"].failed_rows == 1
    assert rep["RANGE_CHECK:percent_storage[0.0,100.0]"].status == "FAIL"
    assert rep["RANGE_CHECK:inflow_mcm[-10.0,9999.0]"].status == "WARN"
    assert rep["NULL_CHECK:percent_storage"].failed_rows == 1
    assert rep["RANGE_CHECK:percent_storage[0.0,100.0]"].pass_rate_pct == 66.67
    assert dq_summary(dq_report(df, "t")).first().overall == "FAIL"


def test_dq_empty_input_is_availability_failure(spark):
    df = spark.createDataFrame([], "reservoir_id string, record_date string, source string, percent_storage double")
    rows = dq_report(df, "t").collect()
    assert [(r.rule, r.status, r.pass_rate_pct) for r in rows] == [("DATA_AVAILABILITY", "FAIL", 0.0)]


def test_watermark_filter_is_strict(spark):
    w = "2024-01-01T00:00:00+07:00"
    df = spark.createDataFrame([(w,), ("2024-01-01T00:00:01+07:00",), (None,)], "fetched_at string")
    assert [r.fetched_at for r in watermark_filter(df, w).collect()] == ["2024-01-01T00:00:01+07:00"]


def test_backfill_dates(spark):
    first = [str(r.fetch_date) for r in backfill_dates(spark, "2024-01-08", 7).orderBy("fetch_date").collect()]
    assert first == [f"2024-01-0{i}" for i in range(1, 8)]
    ledger = spark.createDataFrame([("2024-01-07", 7)], "last_date string, processed_count long")
    later = [str(r.fetch_date) for r in backfill_dates(spark, "2024-01-08", 7, ledger).collect()]
    assert later == ["2024-01-07"]


def test_features_window_pass_equals_left_joins(spark):
    """Trend / yesterday from one window pass equal the join formulation, including the
    fan-out when two partitions carry yesterday's record date and the no-match case."""
    import datetime as dt
    from pyspark.sql import functions as F
    from hydrolake.plans.features import _prepare, reservoir_features, scan_window
    d = dt.date
    rows = [  # reservoir_id, source, record_date, dt, percent_storage, fetched_at
        ("A", "dam", d(2024, 5, 10), "2024-05-10", 50.0, "t1"),
        ("A", "dam", d(2024, 5, 9), "2024-05-09", 40.0, "t1"),
        ("A", "dam", d(2024, 5, 9), "2024-05-08", 30.0, "t1"),    # late row: second "yesterday"
        ("B", "dam", d(2024, 5, 10), "2024-05-10", 70.0, "t1"),   # no yesterday
        ("C", "reservoir", d(2024, 5, 10), "2024-05-10", 20.0, "t1"),
        ("C", "reservoir", d(2024, 5, 9), "2024-05-09", 25.0, "t1"),
        ("C", "reservoir", d(2024, 5, 1), "2024-05-01", 99.0, "t1"),   # outside the window
    ]
    silver = spark.createDataFrame(rows, "reservoir_id string, source string, record_date date, dt string, "
                                         "percent_storage double, fetched_at string").select(
        "*", F.lit("n").alias("reservoir_name"), F.lit("r").alias("region"), F.lit(100.0).alias("capacity_mcm"),
        F.lit(1.0).alias("volume_mcm"), F.lit(1.0).alias("inflow_mcm"), F.lit(0.5).alias("outflow_mcm"))
    day = "2024-05-10"
    got = reservoir_features(silver, day, run_ts="2024-05-10 00:00:00").drop("computed_at")
    # brute force: the join formulation
    w = _prepare(scan_window(silver, day))
    target = F.to_date(F.lit(day))
    today = w.where(F.col("record_date") == target)
    yest = w.where(F.col("record_date") == F.date_sub(target, 1)).select(
        "reservoir_id", "source", F.col("percent_storage").alias("_y"))
    trend = w.groupBy("reservoir_id", "source").agg(F.avg("percent_storage").alias("_t"))
    exp = (today.join(yest, ["reservoir_id", "source"], "left").join(trend, ["reservoir_id", "source"], "left")
           .select("reservoir_id", F.col("_t").alias("storage_trend_7d"),
                   F.coalesce(F.col("percent_storage") - F.col("_y"), F.lit(0.0)).alias("storage_delta_1d")))
    g = sorted(tuple(r) for r in got.select("reservoir_id", "storage_trend_7d", "storage_delta_1d").collect())
    e = sorted(tuple(r) for r in exp.collect())
    assert g == e
    assert [r[0] for r in g].count("A") == 2 and ("B", 70.0, 0.0) in g


def test_resolved_alert_keys(spark):
    from hydrolake.plans.scoring import resolve_alert_keys
    alerts = spark.createDataFrame([(1, -1, -1, 10, "d1"), (2, -1, -1, 11, "d1"), (3, -1, -1, 10, "d2"), (4, -1, -1, None, "d1")],
                                   "alert_key long, location_key int, weather_key int, prov_code int, dt string")
    places = spark.createDataFrame([(1002, 10), (1001, 10), (1200, 12)], "location_key int, prov_code int")
    weather = spark.createDataFrame([(10, 10, "d1"), (10, 10, "d1"), (11, 11, "d1")], "weather_key int, prov_code int, dt string")
    out = resolve_alert_keys(alerts, places, weather)
    assert out.columns == alerts.columns
    assert sorted(map(tuple, out.collect())) == [(1, 1001, 10, 10, "d1"), (2, -1, 11, 11, "d1"), (3, 1001, -1, 10, "d2"), (4, -1, -1, None, "d1")]
