"""Domain views over the driver's tables.

The driver ships TPC-H-like tables; these adapters present them in the shape of
the raw inputs the pipelines expect (Bronze readings, Bronze weather, the hazard
CSV rows, the downstream map, the province catalogue).  Values are derived from
table content so the work grows with the tables; a few deterministic key
residues inject the dirt the cleaning steps exist for (blank ids, 'N/A',
unparsable dates, zero percentages, null timestamps).  Nothing is filtered out.

nation/region are bounded by the schema (25 / 5 rows) and are broadcast; the
supplier/customer joins are left to AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import classify_rain

REGION_CODES = ["C", "E", "NE", "N", "W", "S"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a lazy DataFrame.  How finely it is split is Spark's business
    (``spark.sql.files.maxPartitionBytes``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def between_days(df: DataFrame, column: str, days: tuple[str, str] | None) -> DataFrame:
    """Rows whose raw timestamp lies on one of the days lo..hi; the range reaches the scan as a pushed filter."""
    if days is None:
        return df
    lo, hi = (F.to_timestamp(F.lit(d)) for d in days)
    return df.where((F.col(column) >= lo) & (F.col(column) < hi + F.expr("INTERVAL 1 DAY")))


def _day_str(ts) -> F.Column:
    return F.to_date(ts).cast("string")


def _dbl_str(c) -> F.Column:
    return c.cast("double").cast("string")


def bronze_readings(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None) -> DataFrame:
    """Raw reservoir/dam records (all fields strings, as landed NDJSON).

    One record per lineitem: reservoir = supplier, reading day = ship date; ``days`` = (first, last) to read.
    """
    li = between_days(table(spark, sf_dir, "lineitem"), "l_shipdate", days).select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_shipdate")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (li.join(sup, li.l_suppkey == sup.s_suppkey)
         .join(F.broadcast(nat), F.col("s_nationkey") == F.col("n_nationkey")))
    ok = F.col("l_orderkey")
    day = _day_str(F.col("l_shipdate"))
    return j.select(
        (ok * 8 + F.col("l_linenumber")).alias("_offset"),
        F.when(F.col("l_returnflag") == "R", F.lit("dam")).otherwise(F.lit("reservoir")).alias("source"),
        F.when(F.pmod(ok, F.lit(97)) == 0, F.lit(" "))
         .otherwise(F.concat(F.lit("R"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0"))).alias("reservoir_id"),
        F.when(F.pmod(ok, F.lit(89)) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("dam "), F.col("s_suppkey").cast("string"), F.lit(" of "),
                             F.lower(F.col("n_name")))).alias("reservoir_name"),
        F.when(F.pmod(F.col("s_suppkey"), F.lit(7)) == 0, F.lit(None).cast("string"))
         .otherwise(F.element_at(F.array(*[F.lit(r) for r in REGION_CODES]),
                                 (F.pmod(F.col("s_nationkey"), F.lit(6)) + 1).cast("int"))).alias("region"),
        F.when(F.pmod(F.col("s_suppkey"), F.lit(5)) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("owner "), F.pmod(F.col("s_nationkey"), F.lit(3)).cast("string"))).alias("owner"),
        F.when(F.pmod(ok, F.lit(17)) == 0, F.lit("n/a"))
         .when(F.pmod(ok, F.lit(29)) == 0, F.lit(None).cast("string"))
         .otherwise(day).alias("record_date"),
        F.when(F.col("s_acctbal") < 0, F.lit("N/A")).otherwise(_dbl_str(F.col("s_acctbal"))).alias("capacity_mcm"),
        _dbl_str(F.col("l_quantity") * 100).alias("volume_mcm"),
        F.when(F.col("l_discount") == 0, F.lit("0"))
         .when(F.pmod(ok, F.lit(13)) == 0, F.lit("N/A"))
         .otherwise(_dbl_str(F.col("l_quantity") * 2)).alias("percent_storage"),
        _dbl_str(F.col("l_quantity") / 4).alias("inflow_mcm"),
        _dbl_str(F.col("l_linenumber")).alias("outflow_mcm"),
        _dbl_str(F.col("l_quantity") * 80).alias("active_storage_mcm"),
        _dbl_str(F.col("l_linenumber") * 10).alias("dead_storage_mcm"),
        F.when(F.pmod(ok, F.lit(19)) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(day, F.lit("T"), F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
                             F.lit(":00:00+07:00"))).alias("fetched_at"),
        day.alias("dt"),
    )


def bronze_weather(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None) -> DataFrame:
    """Raw province weather forecasts: one per order; province = customer nation."""
    o = between_days(table(spark, sf_dir, "orders"), "o_orderdate", days).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey)
    j = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    ok = F.col("o_orderkey")
    day = _day_str(F.col("o_orderdate"))
    rain = (F.floor(F.col("o_totalprice")).cast("bigint") % 1200).cast("double") / 10.0
    yes = F.array(F.lit("True"), F.lit("1"), F.lit(" yes "), F.lit("t"))
    no = F.array(F.lit("False"), F.lit("0"), F.lit("no"), F.lit("f"))
    idx = (F.pmod(ok, F.lit(4)) + 1).cast("int")
    return j.select(
        ok.alias("_offset"),
        F.when(F.pmod(ok, F.lit(53)) == 0, F.lit("x")).otherwise(F.col("n_nationkey").cast("string")).alias("prov_code"),
        F.concat(F.lit("prov-"), F.col("n_nationkey").cast("string")).alias("prov_th"),
        F.col("n_name").alias("prov_en"),
        F.col("r_name").alias("region"),
        (F.lit(5.0) + F.col("n_nationkey") * 0.5).alias("latitude"),
        (F.lit(97.0) + F.col("n_regionkey") * 0.5).alias("longitude"),
        F.when(F.pmod(ok, F.lit(41)) == 0, F.lit(None).cast("string")).otherwise(day).alias("forecast_date"),
        _dbl_str(F.lit(30) + F.pmod(ok, F.lit(8))).alias("temp_max_c"),
        _dbl_str(F.lit(20) + F.pmod(ok, F.lit(5))).alias("temp_min_c"),
        _dbl_str(rain).alias("rainfall_forecast_mm"),
        classify_rain(rain).alias("rain_intensity"),
        _dbl_str(F.lit(50) + F.pmod(F.col("o_custkey"), F.lit(50))).alias("humidity_pct"),
        _dbl_str(F.pmod(ok, F.lit(30)) * 3.6).alias("wind_speed_kmh"),
        F.when(F.pmod(ok, F.lit(9)) == 0, F.lit(None).cast("string"))
         .when(rain >= 35.0, F.element_at(yes, idx)).otherwise(F.element_at(no, idx)).alias("is_heavy_rain_24h"),
        F.when(F.col("o_orderstatus") == "F", F.lit("tmd_api")).otherwise(F.lit("mock_tmd")).alias("data_source"),
        F.when(F.pmod(ok, F.lit(31)) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(day, F.lit("T"), F.lpad(F.pmod(ok, F.lit(24)).cast("string"), 2, "0"),
                             F.lit(":00:00+07:00"))).alias("generated_at"),
        day.alias("dt"),
    )


RISK_BUCKETS = [(12, "เสี่ยงต่ำ"), (25, "เสี่ยงปานกลาง"), (37, "เสี่ยงสูง"), (48, "เสี่ยงสูงมาก")]


def hazard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the hazard CSV with its original headers (strings): one per part,
    three parts per sub-district (geocode = partkey div 3)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    geo = F.floor(F.col("p_partkey") / 3).cast("bigint")
    amphoe = F.floor(F.col("p_partkey") / 30).cast("bigint")
    prov = F.pmod(geo, F.lit(25))
    risk = None
    for hi, lab in RISK_BUCKETS:
        risk = F.when(F.col("p_size") <= hi, F.lit(lab)) if risk is None else risk.when(F.col("p_size") <= hi, F.lit(lab))
    return p.select(
        F.col("p_partkey").alias("_offset"),
        F.when(F.pmod(F.col("p_partkey"), F.lit(37)) == 0, F.lit(""))
         .otherwise((F.pmod(F.col("p_size"), F.lit(12)) + 1).cast("string")).alias("Month"),
        geo.cast("string").alias("GEOCODE"),
        F.when(F.pmod(F.col("p_partkey"), F.lit(11)) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" tambon "), geo.cast("string"))).alias("TAMBON_T"),
        F.col("p_name").alias("TAMBON_E"),
        amphoe.cast("string").alias("AMPHOE_CODE"),
        F.concat(F.lit("amphoe "), amphoe.cast("string")).alias("AMPHOE_T"),
        F.col("p_type").alias("AMPHOE_E"),
        prov.cast("string").alias("PROV_CODE"),
        F.concat(F.lit("prov-"), prov.cast("string")).alias("PROV_T"),
        F.concat(F.lit("NATION_"), prov.cast("string")).alias("PROV_E"),
        F.pmod(F.col("p_size"), F.lit(18)).cast("string").alias("COUNT 17 YEAR"),
        F.col("p_brand").alias("CRITERIA"),
        risk.alias("RISK"),
    )


def downstream_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservoir -> downstream provinces map: one row per nation, listing every
    nation of its region (plus junk tokens the parser must skip)."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    codes = (n.groupBy("n_regionkey")
             .agg(F.array_join(F.array_sort(F.collect_list(F.col("n_nationkey").cast("string"))), ",").alias("_codes")))
    j = n.join(F.broadcast(codes), "n_regionkey").join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("n_nationkey")
    return j.select(
        F.when(key == 0, F.lit("")).otherwise(F.concat(F.lit("dam "), key.cast("string"))).alias("reservoir_name_th"),
        F.col("n_name").alias("reservoir_name_en"),
        F.col("r_name").alias("river_basin_th"),
        F.lower(F.col("r_name")).alias("river_basin_en"),
        key.cast("int").alias("dam_province_code"),
        F.concat(F.lit("prov-"), key.cast("string")).alias("dam_province_th"),
        (F.lit(5.0) + key * 0.5).alias("lat"),
        (F.lit(97.0) + F.col("n_regionkey") * 0.5).alias("lon"),
        F.concat(F.col("_codes"), F.lit(", x,,")).alias("downstream_prov_codes"),
        F.lit("").alias("downstream_prov_th"),
        (key * 100.0).alias("capacity_mcm_ref"),
        F.when(F.pmod(key, F.lit(2)) == 0, F.lit("dam")).otherwise(F.lit("reservoir")).alias("source_type"),
    )


def part_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map that grows with the data: one row per part, naming one dam (``dam <key> of``) by its Thai name for odd keys and by its
    English one for even keys, with two provinces each."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    key, nations = F.col("p_partkey"), F.lit(25)
    name, odd = F.concat(F.lit("dam "), key.cast("string"), F.lit(" of")), F.pmod(key, F.lit(2)) == 1
    codes = F.concat_ws(",", F.pmod(F.col("p_size"), nations).cast("string"), F.pmod(key, nations).cast("string"))
    return p.select(F.when(odd, name).otherwise(F.lit("")).alias("reservoir_name_th"),
                    F.when(~odd, F.upper(name)).alias("reservoir_name_en"), codes.alias("downstream_prov_codes"),
                    F.pmod(key, nations).cast("int").alias("dam_province_code"))


def province_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Province catalogue (code, names, region, coordinates): one row per nation."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("int").alias("prov_code"),
        F.concat(F.lit("prov-"), F.col("n_nationkey").cast("string")).alias("prov_th"),
        F.col("n_name").alias("prov_en"),
        F.col("r_name").alias("region"),
        (F.lit(5.0) + F.col("n_nationkey") * 0.5).alias("lat"),
        (F.lit(97.0) + F.col("n_regionkey") * 0.5).alias("lon"),
    )
