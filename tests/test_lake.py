"""Streaming state, partitions by listing, whole versions, incremental Gold, gates by date."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

EPOCH = "1970-01-01T00:00:00+00:00"


def message(i, day, hour=6, volume="1"):
    return json.dumps({"source": "dam", "reservoir_id": f"R{i}", "record_date": day, "volume_mcm": volume, "fetched_at": f"{day}T{hour:02}:00:00+07:00"})


def land(path, name, lines):
    """A file a second newer than the last: those of one millisecond would be read in any order."""
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")
    at = time.time() - 1000 + len(list(path.iterdir()))
    os.utime(path / name, (at, at))


def found(spark, bronze):
    from hydrolake.streaming.ingest import MESSAGE_SCHEMA
    return sorted((r.reservoir_id, r.fetched_at) for r in spark.read.schema(MESSAGE_SCHEMA).json(bronze).collect())


def load(spark, tmp_path, **how):
    from hydrolake.streaming.ingest import file_source, incremental_load
    return incremental_load(file_source(spark, f"{tmp_path}/landing", 1), f"{tmp_path}/bronze", f"{tmp_path}/ck", f"{tmp_path}/state", "2024-01-09", **how)


def test_load_keeps_its_mark_from_the_batches(spark, tmp_path):
    from hydrolake.streaming.state import batches, current_run
    land(tmp_path / "landing", "a.json", [message(1, "2024-01-01"), message(2, "2024-01-02"), "{broken"])
    assert load(spark, tmp_path) == EPOCH
    assert current_run(spark, f"{tmp_path}/state") == (1, "2024-01-02T06:00:00+07:00")
    for f in (tmp_path / "bronze").rglob("*.txt"):
        f.chmod(0)      # no old Bronze file is opened by the next load
    land(tmp_path / "landing", "b.json", [message(3, "2024-01-02"), message(4, "2024-01-03")])
    assert load(spark, tmp_path) == "2024-01-02T06:00:00+07:00"
    for f in (tmp_path / "bronze").rglob("*.txt"):
        f.chmod(0o644)
    assert [x[0] for x in found(spark, f"{tmp_path}/bronze")] == ["R1", "R2", "R4"]     # not newer than the mark: R3
    assert load(spark, tmp_path) == "2024-01-03T06:00:00+07:00" and current_run(spark, f"{tmp_path}/state")[1] == "2024-01-03T06:00:00+07:00"
    assert batches(spark, f"{tmp_path}/state").agg(F.sum("accepted")).first()[0] == 3


@pytest.mark.parametrize("crash_at", ["before_mark", "after_mark"])
def test_a_crash_neither_loses_nor_repeats_messages(spark, tmp_path, monkeypatch, crash_at):
    """The second micro-batch breaks off after Bronze is written, before or after its state row; the next load mends it."""
    from hydrolake.streaming import ingest
    land(tmp_path / "landing", "a.json", [message(1, "2024-01-05")])
    land(tmp_path / "landing", "b.json", [message(2, "2024-01-04"), message(3, "2024-01-06")])     # older than what the first batch has
    save = ingest.save_batch

    def failing(spark_, path, run, batch, last, n):
        if batch == 1 and crash_at == "before_mark":
            raise RuntimeError("lost")
        save(spark_, path, run, batch, last, n)
        if batch == 1:
            raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "save_batch", failing)
    with pytest.raises(Exception):
        load(spark, tmp_path)
    monkeypatch.setattr(ingest, "save_batch", save)
    assert load(spark, tmp_path) == EPOCH       # the broken run goes on with its own mark
    assert [x[0] for x in found(spark, f"{tmp_path}/bronze")] == ["R1", "R2", "R3"]
    assert load(spark, tmp_path) == "2024-01-06T06:00:00+07:00"


def test_a_resent_message_lands_once_and_late_ones_are_dropped(spark, tmp_path):
    land(tmp_path / "landing", "a.json", [message(1, "2024-01-05"), message(1, "2024-01-05"), message(2, "2024-01-05")])
    land(tmp_path / "landing", "b.json", [message(1, "2024-01-05"), message(1, "2024-01-05", 7), message(9, "2024-03-01")])
    land(tmp_path / "landing", "c.json", [message(9, "2024-03-01")])       # the stream's time is up from the batch after
    land(tmp_path / "landing", "d1.json", [message(8, "2024-01-04")])      # months after its time
    land(tmp_path / "landing", "d2.json", [json.dumps({"source": "dam", "reservoir_id": "R7", "record_date": "2024-03-01", "fetched_at": "sometime"})])
    load(spark, tmp_path, dedup_within="10 days")
    got = found(spark, f"{tmp_path}/bronze")
    assert [x for x in got if x[0] in ("R1", "R2", "R9")] == got
    assert got == [("R1", "2024-01-05T06:00:00+07:00"), ("R1", "2024-01-05T07:00:00+07:00"), ("R2", "2024-01-05T06:00:00+07:00"), ("R9", "2024-03-01T06:00:00+07:00")]


@pytest.mark.parametrize("dedup", [None, "10 days"])
def test_a_small_bucket_is_one_file_a_batch(spark, tmp_path, dedup):
    """Whatever task holds a message, its bucket's one writer gets it; the stream's next batch is not adaptive."""
    from hydrolake.streaming.ingest import file_source, stream_ingest
    for f in "abcd":
        land(tmp_path / "landing", f"{f}.json", [message(f"{f}{i}", f"2024-01-0{i % 3 + 1}") for i in range(60)])
    stream_ingest(file_source(spark, f"{tmp_path}/landing", 2), f"{tmp_path}/bronze", f"{tmp_path}/ck", dedup_within=dedup)
    files = [str(f.parent.relative_to(tmp_path / "bronze")) for f in (tmp_path / "bronze").rglob("part-*")]
    want = [f"batch={b}/bucket_source=dam/bucket_date=2024-01-0{d}" for b in (0, 1) for d in (1, 2, 3)]
    assert sorted(f for f in files if "bucket_date" in f) == want
    assert len(found(spark, f"{tmp_path}/bronze")) == 240


def test_a_message_is_parsed_once(spark):
    """Filters on the fields stay above the parser; blank, broken and absent texts are skipped as before."""
    from hydrolake.streaming.ingest import bucket_columns, decode_messages, watermark_filter
    lines = [message(1, "2024-01-01"), "{broken", '{"source": "dam", "rese', "", None, "{}", "[]", '"text"', json.dumps({"date": "2024-01-02"}),
             json.dumps({"fetched_at": "2024-01-03", "volume_mcm": {"a": [1]}, "date": None}), json.dumps({"reservoir_id": "R9"})]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    assert sorted((r.reservoir_id, r.fetched_at, r.volume_mcm) for r in decode_messages(raw).na.fill("").collect()) == [
        ("", "2024-01-03", '{"a":[1]}'), ("R1", "2024-01-01T06:00:00+07:00", "1"), ("R9", "", "")]
    recs = bucket_columns(watermark_filter(decode_messages(raw)), "2024-01-09")
    timed = recs.where(F.col("fetched_at").try_cast("timestamp").isNotNull())
    assert timed._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_keys_seen_are_kept_on_disk(spark, tmp_path, monkeypatch):
    """The store of a stream that drops what was sent again is on disk, without the fields that are not written; the session keeps its own."""
    from hydrolake.streaming import ingest
    store, got = "spark.sql.streaming.stateStore.providerClass", []
    before, write = spark.conf.get(store), ingest._write_batch
    monkeypatch.setattr(ingest, "_write_batch", lambda recs, *how: (got.append(recs.columns), write(recs, *how)))
    for f in "ab":
        land(tmp_path / "landing", f"{f}.json", [message(i, "2024-01-01") for i in (1, 2, f)])
    load(spark, tmp_path, dedup_within="10 days")
    used = json.loads((tmp_path / "ck/offsets/0").read_text().split("\n")[1])["conf"][store]
    assert used.endswith("RocksDBStateStoreProvider") and spark.conf.get(store) == before != used
    assert got == [["value", "fetched_at", "bucket_source", "bucket_date"]] * 2
    assert [x[0] for x in found(spark, f"{tmp_path}/bronze")] == ["R1", "R2", "Ra", "Rb"]


def test_many_folders_are_listed_by_one_job(spark, tmp_path):
    from hydrolake.sources.lake import read_json_folders
    for b in (0, 1, 2):
        for day in range(60):
            at = tmp_path / f"bronze/batch={b}/bucket_source=dam/bucket_date=d{day}"
            at.mkdir(parents=True)
            (at / "a.txt").write_text(message(day, "2024-01-01") + "\n")
    sc, limit = spark.sparkContext, spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.threshold")
    sc.setJobGroup(str(tmp_path), "listing")
    try:
        rows = read_json_folders(spark, f"{tmp_path}/bronze", "reservoir_id STRING")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = sc.statusTracker().getJobIdsForGroup(str(tmp_path))
    assert [sc.statusTracker().getStageInfo(s).numTasks for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds] == [3]
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.threshold") == limit
    assert rows.count() == 180 and set(rows.columns) == {"reservoir_id", "batch", "bucket_source", "bucket_date"}


def test_ledger_is_upserted_by_run(spark, tmp_path):
    from hydrolake.streaming import state
    path = f"{tmp_path}/ledger"
    assert state.ledger(spark, path).first().processed_count == 0
    assert state.next_fetch_dates(spark, path, "2024-01-10", 5).count() == 5
    days = lambda *d: spark.createDataFrame([(x,) for x in d], "fetch_date string")
    state.record_run(days("2024-01-05", "2024-01-06"), path, "a")
    state.record_run(days("2024-01-07"), path, "b")
    before = state.ledger(spark, path).first()
    state.record_run(days("2024-01-07"), path, "b")
    assert state.ledger(spark, path).first() == before == ("2024-01-07", 3)
    assert [str(r.fetch_date) for r in state.next_fetch_dates(spark, path, "2024-01-10", 5).collect()] == ["2024-01-09"]


def test_partitions_by_listing(spark, tmp_path):
    from hydrolake.sources import lake
    from hydrolake.sources.io import sink_partitioned
    root = f"{tmp_path}/t"
    sink_partitioned(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-03"), (3, "nonsense")], "x int, dt string"), root)
    (tmp_path / "t" / "dt=2024-01-09").mkdir()      # an empty day
    schema = "x int, dt string"
    assert lake.partition_values(spark, root) == ["2024-01-01", "2024-01-03", "nonsense"]
    assert [r.dt for r in lake.listed_dates(spark, [root, f"{tmp_path}/absent"], include="2024-01-02").collect()] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    (tmp_path / "t" / "dt=nonsense").rename(tmp_path / "t" / "_nonsense")
    for day, want in (("2024-01-01", 1), ("2024-01-09", 2), ("2099-01-01", 2)):
        got = lake.latest_partition(spark, root, day, schema)
        assert [r.x for r in got.collect()] == [want]
        assert {f.split("dt=")[1][:10] for f in got.inputFiles()} == {"2024-01-01" if want == 1 else "2024-01-03"}
    assert lake.latest_partition(spark, f"{tmp_path}/absent", "2024-01-01", schema).count() == 0


def test_versions_are_whole(spark, tmp_path):
    from hydrolake.sources import lake
    root, schema = f"{tmp_path}/dim", "id long"
    lake.replace_table(spark.range(3), root)
    reader = lake.read_current(spark, root, schema)
    lake.replace_table(reader.unionAll(reader), root)       # reads the version that it replaces
    assert reader.count() == 3 and lake.read_current(spark, root, schema).count() == 6
    (tmp_path / "dim" / "v=99999999999999-half").mkdir()    # a write that never committed
    assert lake.read_current(spark, root, schema).count() == 6


def test_ndjson_is_split_in_one_pass(spark, tmp_path):
    from hydrolake.sources import lake
    land(tmp_path / "in", "a.json", ['{"a": 1, "b": "x"}', "", '{"a": 2', '{"a": "three"}', '{"a": 4}'])
    good, bad = lake.split_ndjson(spark, f"{tmp_path}/in", "a INT, b STRING", f"{tmp_path}/out")
    assert sorted((r.a, r.b or "") for r in good.collect()) == [(1, "x"), (4, "")]
    assert sorted(r[0] for r in bad.collect()) == ['{"a": "three"}', '{"a": 2']
    assert "InMemoryRelation" not in good._jdf.queryExecution().executedPlan().toString()


def readings(spark, rows):
    """Silver readings of (id, dt, volume) rows."""
    from hydrolake.plans import silver
    bronze = spark.createDataFrame([(i, "dam", d, d, str(v), "100", f"{d}T01") for i, d, v in rows],
                                   "reservoir_id string, source string, record_date string, dt string, volume_mcm string, capacity_mcm string, fetched_at string")
    return silver.silver_reservoir(bronze)


def test_merged_dimension_equals_a_rebuilt_one(spark, tmp_path):
    from hydrolake.plans import incremental, silver, star
    from hydrolake.plans.daily import ddl
    from hydrolake.sources.io import sink_partitioned
    root, states, schema = f"{tmp_path}/silver", f"{tmp_path}/states", ddl(silver.SILVER_RESERVOIR_COLS)
    days = [f"2024-01-0{i}" for i in range(1, 7)]
    all_days = [(f"R{k}", d, 10 * k + n) for n, d in enumerate(days) for k in range(n + 1)]

    def rebuilt(through):
        rows = spark.read.schema(schema).parquet(root).where(F.col("dt") <= through)
        return sorted(star.dim_reservoir(rows).collect()), star.dim_date_for(rows, "record_date").count()

    def merged(state):
        return sorted(star.dim_from_state(state).collect()), star.dates_from_state(state).count()

    for d in days:
        sink_partitioned(readings(spark, [r for r in all_days if r[1] == d]), root)
        state = incremental.advance_state(spark, states, root, d, schema)
        assert merged(state) == rebuilt(d)
    # one day's Silver is read, no other
    assert {f.split("dt=")[1][:10] for f in incremental.new_days(spark, root, schema, days[:-1], days[-1]).inputFiles()} == {days[-1]}
    # an old day is mended: its wrong reservoir goes, and later states follow
    sink_partitioned(readings(spark, [("R77", days[2], 1)]), root)
    incremental.advance_state(spark, states, root, days[2], schema)
    sink_partitioned(readings(spark, [r for r in all_days if r[1] == days[2]]), root)
    state = incremental.advance_state(spark, states, root, days[2], schema)
    assert merged(state) == rebuilt(days[-1]) and "R77" not in {r.reservoir_id for r in state.collect()}


def test_observed_rules_equal_the_report(spark, tmp_path):
    from hydrolake.operators.quality import dq_report, observe_rules
    from hydrolake.sources.io import sink_partitioned
    rows = readings(spark, [("A", "2024-01-01", 5), ("B", "2024-01-01", 1e9), ("C", "2024-01-01", 2e9), ("D", "2024-01-01", 7)])
    cols = ["rule", "status", "critical", "total_rows", "failed_rows", "pass_rate_pct"]
    for frame in (rows, rows.where("dt = '2000-01-01'"), rows.where("reservoir_id = 'A'")):
        watch, report = observe_rules(frame, "t")
        sink_partitioned(frame, f"{tmp_path}/out", watch=watch)
        want = dq_report(frame, "t").where(~F.col("rule").startswith("DUPLICATE")).select(*cols).collect()
        assert sorted(report().select(*cols).collect()) == sorted(want)


def test_backfill_holds_back_the_spoilt_day_and_equals_single_runs(spark, tmp_path):
    from hydrolake.operators.quality import QualityGateError
    from hydrolake.plans.daily import run_daily
    from hydrolake.plans.features import shift
    from hydrolake.plans.incremental import run_backfill
    from hydrolake.registry.domain import Domain
    d = Domain(spark, SF_SMALL)
    last = d.bronze_readings.groupBy("dt").count().orderBy(F.col("count").desc(), "dt").first()["dt"]
    first, spoilt = shift(last, -2), shift(last, -1)
    bronze = d.bronze_readings.where(F.col("dt").between(shift(first, -6), last))
    bronze = bronze.withColumn("volume_mcm", F.when(F.col("dt") == spoilt, F.lit("1e9")).otherwise(F.col("volume_mcm"))).cache()
    wx = d.bronze_weather.where(F.col("dt").between(first, last)).cache()
    p = run_backfill(spark, first, last, f"{tmp_path}/many", bronze, wx, d.hazard, d.downstream_map)
    one = f"{tmp_path}/single"
    present = {r.dt for r in bronze.select("dt").distinct().collect()}
    halted = set()
    for day in (first, spoilt, last):
        try:
            run_daily(spark, day, one, bronze, wx, d.hazard, d.downstream_map, d.provinces)
        except QualityGateError:
            halted.add(day)
    assert halted >= ({spoilt} & present) and last not in halted
    from hydrolake.plans.daily import paths
    from hydrolake.schemas import GOLD_TABLES
    for name, fmt, table in (("fact_water", "parquet", "fact_water_monitoring"), ("fact_flood_risk", "parquet", "fact_flood_risk"), ("alerts", "orc", "fact_flood_alert")):
        many, single = (spark.read.schema(GOLD_TABLES[table][0]).format(fmt).load(x[name]).where(F.col("dt").between(first, last)).drop("loaded_at") for x in (p, paths(one)))
        assert many.count() > 0 or name != "fact_water"
        assert many.exceptAll(single.select(*many.columns)).count() == 0 == single.select(*many.columns).exceptAll(many).count(), name
        assert spoilt not in {str(r.dt) for r in many.select("dt").distinct().collect()}


def test_bronze_and_landed_lines_are_compressed(spark, tmp_path):
    """Messages are repetitive text, which is written once or twice a load: as gzip files (failed before: plain text), of bounded length."""
    from hydrolake.registry.written import write_lines
    lines = spark.createDataFrame([(message(i, "2024-01-01"),) for i in range(10)], "value string").coalesce(1)
    write_lines(lines, f"{tmp_path}/landing", lines_a_file=4)
    load(spark, tmp_path)
    for folder, files in (("landing", 3), ("bronze", 3)):     # a micro-batch a file
        assert len(list((tmp_path / folder).rglob("*.txt.gz"))) == files and not list((tmp_path / folder).rglob("*.txt"))
    assert found(spark, f"{tmp_path}/bronze") == sorted((f"R{i}", "2024-01-01T06:00:00+07:00") for i in range(10))
