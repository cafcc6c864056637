"""Declarative data-quality rules evaluated in one aggregate pass.

A rule table drives the checks; every metric of every rule is a ``count_if``
inside a single (optionally per-partition) aggregate, the uniqueness check is one
extra GROUP BY, and sample values come from a per-group top-k (bounded), never
from collecting a failing set.  Results are rows (rule, table, status, ...), so a
report is just a DataFrame that can be appended to a table partitioned by run.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import constants as K

REPORT_COLS = ["rule", "table", "status", "critical", "total_rows", "failed_rows", "pass_rate_pct", "details"]


@dataclass(frozen=True)
class Rule:
    name: str
    critical: bool
    failed: Column | None          # per-row failure predicate (None: computed elsewhere)
    sample_col: str | None = None  # column whose values illustrate failures
    note: str = ""


def not_null_rules(df: DataFrame, fields: list[str], sample_col: str = "reservoir_id") -> list[Rule]:
    rules = []
    for f in fields:
        if f in df.columns:
            pred = F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == "")
            rules.append(Rule(f"NULL_CHECK:{f}", True, pred, sample_col if sample_col in df.columns else None,
                              f"Sample {sample_col}s with null '{f}'"))
        else:   # absent column: every row fails
            rules.append(Rule(f"NULL_CHECK:{f}", True, F.lit(True), None, f"Column '{f}' does not exist"))
    return rules


def range_rules(df: DataFrame, ranges=K.DQ_RANGES) -> list[Rule]:
    rules = []
    for col, lo, hi, critical in ranges:
        if col not in df.columns:
            continue   # absent column: rule skipped
        v = F.col(col).cast("string").try_cast("double")
        rules.append(Rule(f"RANGE_CHECK:{col}[{lo},{hi}]", critical, (v < lo) | (v > hi), col,
                          f"Out-of-range values (expected [{lo}, {hi}])"))
    return rules


def _status(failed: Column, critical: bool) -> Column:
    return F.when(failed == 0, F.lit("PASS")).otherwise(F.lit("FAIL" if critical else "WARN"))


def _pass_rate(failed: Column, total: Column) -> Column:
    return F.round(F.lit(100.0) * (F.lit(1.0) - failed / F.greatest(total, F.lit(1))), 2)


def _fmt_list(arr: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "),
                    F.lit("]"))


def dq_report(df: DataFrame, table: str, key: list[str] | None = None, not_null: list[str] | None = None,
              ranges=K.DQ_RANGES, group: list[str] | None = None, sample_k: int = 3) -> DataFrame:
    """Rule results for ``df`` (per ``group``, e.g. ``["dt"]``, or for the whole frame).

    One scan: a first aggregate per (group, unique key) counts rows and failures
    of every rule and keeps each key's smallest failing sample value; everything
    else (totals, duplicate count, top-k samples) is computed from that per-key
    frame in a single branch.  Samples are the ``sample_k`` smallest distinct
    failing values, one per key.  A whole-frame report on empty input yields
    exactly one DATA_AVAILABILITY FAIL row.
    """
    group = group or []
    key = K.DQ_UNIQUE_KEY if key is None else key
    not_null = K.DQ_NOT_NULL_FIELDS if not_null is None else not_null
    rules = not_null_rules(df, not_null) + range_rules(df, ranges)
    key_cols = [c for c in key if c in df.columns]
    sampled = [i for i, r in enumerate(rules) if r.sample_col]

    lvl1 = df.groupBy(*group, *[F.col(c).alias(f"_k_{c}") for c in key_cols]).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(r.failed).alias(f"_f{i}") for i, r in enumerate(rules)],
        *[F.min(F.when(rules[i].failed, F.col(rules[i].sample_col).cast("string"))).alias(f"_m{i}") for i in sampled])
    if key_cols:
        lvl1 = lvl1.withColumn("_dk", F.when(F.col("_n") > 1, F.concat_ws(
            "|", *[F.col(f"_k_{c}").cast("string") for c in key_cols])))

    # Second level in ONE pass over the per-key frame (so the plan below it is not
    # computed twice): every key emits one counter record (rule '', all counters as
    # columns) plus its non-NULL sample candidates (rule, value).  One aggregate per
    # (group, rule, value) sums the counters (map-side: one row per group and task)
    # and makes sample values distinct; a row_number <= k window keeps the k
    # smallest samples per (group, rule) (Partial limit before the shuffle); a last
    # aggregate per group turns the records back into columns.
    counters = [("_n", F.col("_n"))] + [(f"_f{i}", F.col(f"_f{i}")) for i in range(len(rules))]
    if key_cols:
        counters.append(("_dup", F.when(F.col("_n") > 1, F.col("_n"))))
    sample_cols = [(f"_m{i}", f"_s{i}") for i in sampled] + ([("_dk", "_dsample")] if key_cols else [])
    recs = ([F.struct(F.lit("").alias("_rule"), F.lit(None).cast("string").alias("_v"))]
            + [F.struct(F.lit(out).alias("_rule"), F.col(src).cast("string").alias("_v")) for src, out in sample_cols])
    kept = F.filter(F.array(*recs), lambda x: (x["_rule"] == "") | x["_v"].isNotNull())
    is_counter = F.col("_p._rule") == ""
    long = lvl1.select(*group, *[c.cast("bigint").alias(n) for n, c in counters], F.explode(kept).alias("_p")).select(
        *group, F.col("_p._rule").alias("_rule"), F.col("_p._v").alias("_v"),
        *[F.when(is_counter, F.col(n)).alias(n) for n, _ in counters])
    per_value = long.groupBy(*group, "_rule", "_v").agg(*[F.sum(n).alias(n) for n, _ in counters])
    w = Window.partitionBy(*group, "_rule").orderBy("_v")
    top = per_value.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= sample_k)
    aggs = ([F.sum("_n").alias("_total")] + [F.sum(n).alias(n) for n, _ in counters[1:]]
            + [F.array_sort(F.collect_list(F.when(F.col("_rule") == out, F.col("_v")))).alias(out)
               for _, out in sample_cols])
    base = top.groupBy(*group).agg(*aggs) if group else top.agg(*aggs)

    total = F.col("_total")
    rows = []
    for i, r in enumerate(rules):
        failed = F.col(f"_f{i}")
        details = F.lit(r.note) if r.sample_col is None else F.when(
            failed > 0, F.concat(F.lit(r.note + ": "), _fmt_list(F.coalesce(F.col(f"_s{i}"), F.array()))))
        rows.append(F.struct(F.lit(r.name).alias("rule"), _status(failed, r.critical).alias("status"),
                             F.lit(r.critical).alias("critical"), failed.cast("bigint").alias("failed_rows"),
                             F.coalesce(details, F.lit("")).alias("details")))
    if key_cols:
        failed = F.coalesce(F.col("_dup"), F.lit(0)).cast("bigint")
        rows.append(F.struct(F.lit(f"DUPLICATE_CHECK:({', '.join(key)})").alias("rule"),
                             _status(failed, True).alias("status"), F.lit(True).alias("critical"),
                             failed.alias("failed_rows"),
                             F.coalesce(F.when(failed > 0, F.concat(F.lit("Duplicate key examples: "),
                                                                    _fmt_list(F.col("_dsample")))), F.lit(""))
                             .alias("details")))
    out = base.select(*group, total.cast("bigint").alias("total_rows"), F.explode(F.array(*rows)).alias("_r"))
    out = out.select(*group, "_r.rule", F.lit(table).alias("table"), "_r.status", "_r.critical", "total_rows",
                     "_r.failed_rows", _pass_rate(F.col("failed_rows"), F.col("total_rows")).alias("pass_rate_pct"),
                     "_r.details")
    if not group:
        out = out.where(F.col("total_rows") > 0).unionByName(availability(df, table))
    return out


def observe_rules(df: DataFrame, table: str, not_null: list[str] | None = None, ranges=K.DQ_RANGES):
    """(watch, report) for the not-null, range and availability rules of ``df``.

    ``watch(rows)`` adds the counters to the rows that are written (``sink_partitioned(..., watch=watch)``), as the
    last step, which runs for empty input too.  ``report()`` gives the rules' rows afterwards, from the counters
    that the job kept: no row is read again.
    Uniqueness can't be observed; ``dq_report`` has that rule.  Details name the least failing value.  A frame
    without rows gives the DATA_AVAILABILITY row alone, as in ``dq_report``.
    """
    rules = not_null_rules(df, K.DQ_NOT_NULL_FIELDS if not_null is None else not_null) + range_rules(df, ranges)
    seen = Observation(f"rules_{table}_{uuid.uuid4().hex[:8]}")
    least = [F.min(F.when(r.failed, F.col(r.sample_col).cast("string"))).alias(f"m{i}") for i, r in enumerate(rules) if r.sample_col]
    counters = [F.count(F.lit(1)).alias("n"), *[F.count_if(r.failed).alias(f"f{i}") for i, r in enumerate(rules)], *least]
    spark = df.sparkSession

    def watch(rows: DataFrame) -> DataFrame:
        return rows.observe(seen, *counters)

    def report() -> DataFrame:
        got = seen.get
        total = got["n"]
        rows = []
        for i, r in enumerate(rules):
            failed, sample = got[f"f{i}"], got.get(f"m{i}")
            status = "PASS" if not failed else "FAIL" if r.critical else "WARN"
            details = "" if not failed and r.sample_col else r.note if not r.sample_col else f"{r.note}: ['{sample}']" if sample else f"{r.note}: []"
            rows.append((r.name, table, status, r.critical, total, failed, round(100.0 * (1 - failed / max(total, 1)), 2), details))
        if not total:
            rows = [("DATA_AVAILABILITY", table, "FAIL", True, 0, 0, 0.0, "No data in the layer")]
        return spark.createDataFrame(rows, "rule STRING, table STRING, status STRING, critical BOOLEAN, total_rows BIGINT, "
                                           "failed_rows BIGINT, pass_rate_pct DOUBLE, details STRING")

    return watch, report


def unique_rule(df: DataFrame, table: str, key: list[str] | None = None) -> DataFrame:
    """The uniqueness rule of ``dq_report`` alone, over the key columns; no row for an empty frame."""
    rep = dq_report(df, table, key=key, not_null=[], ranges=())
    return rep.where(F.col("rule").startswith("DUPLICATE_CHECK"))


def availability_rows(runs: DataFrame, table: str) -> DataFrame:
    """A DATA_AVAILABILITY FAIL row for each row of ``runs`` (its columns stay), the runs that have no data."""
    zero = F.lit(0).cast("bigint")
    return runs.select("*", F.lit("DATA_AVAILABILITY").alias("rule"), F.lit(table).alias("table"), F.lit("FAIL").alias("status"),
                       F.lit(True).alias("critical"), zero.alias("total_rows"), zero.alias("failed_rows"), F.lit(0.0).alias("pass_rate_pct"),
                       F.lit("No data in the layer").alias("details"))


def availability(df: DataFrame, table: str) -> DataFrame:
    """One DATA_AVAILABILITY FAIL row if ``df`` is empty, else nothing."""
    n = df.agg(F.count(F.lit(1)).alias("total_rows")).where(F.col("total_rows") == 0)
    return n.select(F.lit("DATA_AVAILABILITY").alias("rule"), F.lit(table).alias("table"), F.lit("FAIL").alias("status"),
                    F.lit(True).alias("critical"), F.col("total_rows").cast("bigint").alias("total_rows"),
                    F.lit(0).cast("bigint").alias("failed_rows"), F.lit(0.0).alias("pass_rate_pct"),
                    F.lit("No data in the layer").alias("details"))


def dq_summary(report: DataFrame, group: list[str] | None = None) -> DataFrame:
    """PASS / WARN / FAIL counts and the overall verdict (FAIL iff a critical rule failed)."""
    group = group or []
    aggs = [F.count_if(F.col("status") == "PASS").alias("passed"), F.count_if(F.col("status") == "WARN").alias("warned"),
            F.count_if(F.col("status") == "FAIL").alias("failed"), F.count(F.lit(1)).alias("total_checks")]
    s = report.groupBy(*group).agg(*aggs) if group else report.agg(*aggs)
    return s.withColumn("overall", F.when(F.col("failed") > 0, F.lit("FAIL")).otherwise(F.lit("PASS")))


def gate_verdicts(report: DataFrame, group: list[str]) -> DataFrame:
    """Per run: the number of critical failures, and whether the gate halts it."""
    failed = F.count_if((F.col("status") == "FAIL") & F.col("critical"))
    return report.groupBy(*group).agg(failed.alias("critical_failures"), (failed > 0).alias("halts"))


class QualityGateError(RuntimeError):
    pass


def dq_gate(report: DataFrame) -> None:
    """Raise when any critical rule failed (one-row aggregate; the only driver value)."""
    bad = report.agg(F.count_if((F.col("status") == "FAIL") & F.col("critical")).alias("n")).first()["n"]
    if bad:
        raise QualityGateError(f"{bad} critical data-quality rule(s) failed - pipeline halted")


# dbt-style declarative not-null tests on the Silver tables
DBT_NOT_NULL = {
    "silver_reservoir": ["reservoir_id", "record_date", "percent_storage"],
    "silver_flood_risk": ["geocode", "month"],
    "silver_weather": ["prov_code", "forecast_date"],
}


def dbt_not_null(frames: dict[str, DataFrame]) -> DataFrame:
    """(table, column, failures) for every declared not-null test; one aggregate per table."""
    out = None
    for table, cols in DBT_NOT_NULL.items():
        if table not in frames:
            continue
        df = frames[table]
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        long = agg.unpivot([], cols, "column_name", "failures").select(
            F.lit(table).alias("table"), "column_name", F.col("failures").cast("bigint").alias("failures"))
        out = long if out is None else out.unionByName(long)
    return out.withColumn("status", F.when(F.col("failures") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")))
