"""Physical-plan checks for the scale properties the library relies on."""

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_rows_before_the_shuffle(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["silver_reservoir"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and ", Partial" in plan and ", Final" in plan


def test_hot_reservoirs_aggregates_before_region_join(spark):
    import __spark_entry__ as E
    lines = _plan(E.queries()["mart_hot_reservoirs"](spark, SF_SMALL)).splitlines()
    join = [i for i, l in enumerate(lines) if "Join [region" in l]
    assert join, "region join missing"
    below = "\n".join(lines[join[0] + 1: join[0] + 3])
    assert "HashAggregate(keys=[region" in below


def test_no_registered_plan_has_a_cartesian_product_or_nested_loop(spark):
    from hydrolake.registry.lake import WRITERS
    from hydrolake.registry.queries import QUERIES
    writes = set(WRITERS) | {n for n in QUERIES if n.startswith(("scan_", "sink_", "stream_", "ingest_", "insert_")) or n in ("export_csv_bom", "mart_from_lake", "watermark_state")}
    for name in sorted(set(QUERIES) - writes):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_run_date_reaches_the_scan(spark):
    """One-day queries push the range of the raw timestamp into the scans they filter by it."""
    import re
    from hydrolake.registry.queries import QUERIES
    for name, column in (("reservoir_features", "l_shipdate"), ("export_reservoirs", "l_shipdate"), ("dim_weather", "o_orderdate"),
                         ("fact_flood_risk", "o_orderdate"), ("fact_flood_alert", "l_shipdate"), ("fact_flood_alert", "o_orderdate"),
                         ("match_upstream", "l_shipdate"), ("export_alerts", "o_orderdate")):
        scans = [x for x in _plan(QUERIES[name](spark, SF_SMALL)).splitlines() if "FileScan" in x and column in x]
        assert scans and all(re.search(rf"PushedFilters: \[.*GreaterThanOrEqual\({column}", x) for x in scans), name


def test_ngram_join_uses_equi_joins_only(spark):
    from hydrolake.operators.joins import substring_match_pairs
    t = spark.createDataFrame([(1, "dam 12 of nation_1")], "tid int, t string")
    p = spark.createDataFrame([(10, "dam 1")], "pid int, p string")
    plan = _plan(substring_match_pairs(t, "tid", p, "pid", [("t", "p", False)]))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_silver_computed_once_per_plan(spark):
    """Facts derive the dimension key instead of self-joining Silver; the DQ report's second
    level is one branch: the raw fact table is scanned once."""
    import __spark_entry__ as E
    for name in ("fact_water", "dq_report_staged", "dq_report_silver"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert plan.count("lineitem.parquet") == 1, name


def test_daily_features_share_one_shuffle(spark):
    """Input spread + Silver dedup + ONE shuffle for the per-day dedup and both history windows."""
    import re
    import __spark_entry__ as E
    plan = _plan(E.queries()["reservoir_features_daily"](spark, SF_SMALL))
    assert len(re.findall(r"(?<!Broadcast)Exchange (hash|Round|range|Single)", plan)) <= 3


def test_metadata_row_is_one_aggregate_without_joins_between_summaries(spark):
    from hydrolake.plans.exports import export_meta_row
    res = spark.createDataFrame([("A", "2024-01-02"), ("B", "2024-01-03")], "reservoir_id string, record_date string")
    alerts = spark.createDataFrame([("ปกติ",), ("วิกฤต",), ("ปกติ",)], "alert_level string")
    dq = spark.createDataFrame([("PASS", 5, 5)], "overall string, passed bigint, total_checks bigint")
    df = export_meta_row("2024-01-03", res, alerts, dq)
    plan = _plan(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    r = df.first()
    assert (r.reservoir_count, r.latest_record_date, r.alert_province_count, r.alert_normal, r.alert_crisis,
            r.dq_overall, r.dq_total) == (2, "2024-01-03", 3, 2, 1, "PASS", 5)


def test_numbers_are_parsed_once_and_after_the_dedup_shuffle(spark):
    """Each cell of Silver is parsed by one cast, above the exchange: superseded rows are never parsed."""
    from hydrolake.plans import silver
    cols = [c for c, _ in silver.SILVER_RESERVOIR_COLS if c not in ("silver_loaded_at",)]
    bronze = spark.createDataFrame([(*["1"] * len(cols), 1)], ", ".join(f"{c} string" for c in cols) + ", _offset long")
    plan = silver.silver_reservoir(bronze)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Window [", 1)
    assert above.count("as double") == len(silver.RESERVOIR_NUMERIC) and "as double" not in below, plan
    wx = [*(c for c, _ in silver.SILVER_WEATHER_COLS if c != "silver_loaded_at"), "generated_at"]
    bronze = spark.createDataFrame([(*["1"] * len(wx), 1)], ", ".join(f"{c} string" for c in wx) + ", _offset long")
    below = silver.silver_weather(bronze)._jdf.queryExecution().optimizedPlan().toString().split("Window [", 1)[1]
    assert below.count("as double") == 1, below    # the key's own number


def test_bucketed_gold_needs_no_exchange_of_the_fact(spark):
    """Facts and dimension bucketed by the reservoir's key: neither the join nor the window shuffles them."""
    from hydrolake.registry.lake import bucketed_trend
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(bucketed_trend(spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Bucketed: true") == 2 and "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 0 and plan.count("Exchange rangepartitioning") <= 1, plan


def test_alert_exports_plan_the_alerts_once(spark):
    """The export reads written alerts, for the question whether there are any, too: readings and names are in no branch of it."""
    import __spark_entry__ as E
    for name in ("export_alerts", "export_alerts_csv", "export_alerts_latest"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert "lineitem.parquet" not in plan and "supplier.parquet" not in plan, name


def test_alert_scores_need_no_join_of_aggregates(spark):
    """Top triggers and maxima of a province: two shuffles, no join between them."""
    from hydrolake.plans.scoring import reservoir_component
    cols = "prov_code int, feature_date string, reservoir_id string, source string, reservoir_name string, reservoir_status string, filling_rate string, percent_storage double"
    plan = _plan(reservoir_component(spark.createDataFrame([], cols), ["prov_code", "feature_date"]))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") <= 2, plan


def test_ngram_join_broadcasts_no_grams(spark):
    """A frame of grams is many times its names: the driver gets none of them, only the key lengths (failed before: it got all)."""
    from hydrolake.operators.joins import substring_match_pairs
    t = spark.createDataFrame([(1, "dam 12 of nation_1"), (2, "da")], "tid int, t string")
    p = spark.createDataFrame([(10, "dam 1"), (11, "d")], "pid int, p string")
    pairs = substring_match_pairs(t, "tid", p, "pid", [("t", "p", False)])
    assert "BroadcastHashJoin [_tag#" in _plan(pairs) and not [x for x in _plan(pairs).splitlines() if "BroadcastHashJoin" in x and "_g#" in x]
    assert sorted(tuple(r) for r in pairs.collect()) == [(1, 10), (1, 11), (2, 10), (2, 11)]


def test_map_with_many_rows_joins_no_edges(spark):
    """The matches carry the map row's provinces: no second frame of the map is joined (failed before: by a broadcast)."""
    from hydrolake.plans.scoring import name_matches
    f = spark.createDataFrame([("dam 12 of x",), ("dam 3 of x",)], "reservoir_name string")
    m = spark.createDataFrame([("dam 1", None, "7, x,8"), ("dam 12 of", "DAM 3", "8"), (None, "X", None)],
                              "reservoir_name_th string, reservoir_name_en string, downstream_prov_codes string")
    got = name_matches(f, m)
    assert "map_id" not in _plan(got)
    assert sorted(tuple(r) for r in got.collect()) == [("dam 12 of x", 7), ("dam 12 of x", 8), ("dam 3 of x", 8)]
