"""Threshold classifiers and score components as chained ``CASE`` expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ladder(pairs, col: Column, otherwise, op=">=") -> Column:
    expr = None
    for threshold, value in pairs:
        cond = (col >= threshold) if op == ">=" else (col < threshold)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(otherwise))


def classify_status(pct) -> Column:
    """>=90 CRITICAL, >=75 HIGH, >=40 NORMAL, else LOW."""
    return _ladder(K.STATUS_THRESHOLDS, _c(pct), K.STATUS_OTHERWISE)


def classify_status_lenient(pct) -> Column:
    """Export variant: unparsable/null percent -> NORMAL."""
    v = _c(pct).cast("string").try_cast("double")
    return F.when(v.isNull(), F.lit("NORMAL")).otherwise(classify_status(v))


def classify_filling_rate(delta) -> Column:
    d = _c(delta)
    return (F.when(d > K.FILLING_FAST_ABOVE, F.lit("FAST"))
            .when(d > K.FILLING_MODERATE_ABOVE, F.lit("MODERATE"))
            .when(d >= K.FILLING_STABLE_FROM, F.lit("STABLE"))
            .otherwise(F.lit("DRAINING")))


def classify_rain(mm) -> Column:
    return _ladder(K.RAIN_LABELS, _c(mm), K.RAIN_LABEL_OTHERWISE, op="<")


def weather_component(mm) -> Column:
    return _ladder(K.WEATHER_POINTS, _c(mm), 0.0)


def historical_component(max_risk_score) -> Column:
    """4->25, 3->18, 2->10, 1->5, anything else (incl. NULL) -> 0; truncates like int()."""
    s = _c(max_risk_score).cast("double").cast("int")
    return _lookup(K.HISTORICAL_POINTS, s, 0.0)


def _lookup(mapping: dict, col: Column, other) -> Column:
    """The entry of a fixed mapping, else ``other``; a map literal is a fraction of the generated code of a ``CASE`` chain."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), col), F.lit(other))


def reservoir_row_score(status, filling) -> Column:
    """status points + filling bonus, clamped to [0, 40]."""
    base = _lookup(K.STATUS_POINTS, _c(status), K.STATUS_POINTS_OTHER)
    bonus = _lookup(K.FILLING_POINTS, _c(filling), K.FILLING_POINTS_OTHER)
    return F.least(F.lit(K.RESERVOIR_POINTS_MAX), F.greatest(F.lit(0.0), base + bonus))


def alert_level(score) -> Column:
    return _ladder(K.ALERT_LEVELS, _c(score), K.ALERT_LEVEL_OTHERWISE)


def alert_level_en(level) -> Column:
    return _lookup(K.ALERT_LEVEL_EN, _c(level), K.ALERT_LEVEL_EN_OTHERWISE)


def alert_level_rank(level_en) -> Column:
    """Sort order CRISIS < ALERT < WATCH < NORMAL (others last)."""
    col = _c(level_en)
    expr = None
    for k, v in K.ALERT_LEVEL_ORDER.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(len(K.ALERT_LEVEL_ORDER) + 1))


def risk_score(level) -> Column:
    """Hazard label -> 1..4, unmapped -> 0."""
    col = _c(level)
    expr = None
    for k, v in K.RISK_SCORES.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(0)).cast("bigint")


def region_from_code(code, english: bool = False) -> Column:
    col = _c(code)
    expr = None
    for lo, hi, short, long_ in K.REGION_RANGES:
        lab = long_ if english else short
        cond = col.between(lo, hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(K.REGION_OTHERWISE))


def normalize_region(text) -> Column:
    """Region text (Thai name or code) -> region code; unknown -> 'Unknown'."""
    codes = {r[2]: r[2] for r in K.REGION_RANGES} | K.REGION_TEXT_TO_CODE
    return _lookup(codes, F.trim(_c(text)), K.REGION_OTHERWISE)


def net_flow(inflow, outflow) -> Column:
    return _c(inflow) - _c(outflow)


def days_to_full(capacity, volume, net) -> Column:
    """(capacity - volume) / net clamped to +-365; |net| < 0.001 -> NULL."""
    n = _c(net)
    days = (_c(capacity) - _c(volume)) / n
    cap = K.DAYS_TO_FULL_CAP
    return F.when(F.abs(n) >= K.NET_FLOW_EPSILON, F.greatest(F.lit(-cap), F.least(F.lit(cap), days)))


def recompute_percent(pct, volume, capacity, scale: int = 2, clip_result: bool = True,
                      also_null: bool = False) -> Column:
    """If percent is 0 (or NULL with ``also_null``) and capacity > 0: volume/capacity*100."""
    p, v, c = _c(pct), _c(volume), _c(capacity)
    raw = v / c * 100.0
    if clip_result:
        raw = F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw))
    needs = (p == 0.0)
    if also_null:
        needs = p.isNull() | needs
    return F.when(needs & (c > 0), F.round(raw, scale)).otherwise(p)


def blank_sentinel(days) -> Column:
    """Export: |days_to_full| >= 365 or non-numeric -> NULL (blank cell)."""
    v = _c(days).cast("string").try_cast("double")
    return F.when(F.abs(v) < K.DAYS_TO_FULL_CAP, v)
