"""Property checks with generated inputs (one Spark job per property)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from hydrolake.functions.coerce import coerce_numeric, parse_code_list

_spark = None


def _session():
    global _spark
    if _spark is None:
        from hydrolake.session import build_session
        _spark = build_session("local[2]", shuffle_partitions=4, app_name="hydrolake-props",
                               extra={"spark.driver.memory": "2g"})
    return _spark


def _py_coerce(s):
    if s is None:
        return 0.0
    t = s.strip()
    if not t or t[-1] in "dfDFlL":
        return 0.0
    try:
        v = float(t)
    except ValueError:
        return 0.0
    return 0.0 if math.isnan(v) else v


numeric_text = st.one_of(
    st.none(),
    st.floats(allow_nan=False, allow_infinity=False, width=32).map(lambda x: f" {x!r} "),
    st.integers(-10**6, 10**6).map(str),
    st.sampled_from(["N/A", "", "abc", "12d", "1,000", "  7  ", "-0.0", "1e3"]),
)


@settings(max_examples=1, deadline=None)
@given(st.lists(numeric_text, min_size=50, max_size=200))
def test_coerce_numeric_matches_reference(values):
    spark = _session()
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(coerce_numeric("v")).collect()]
    want = [_py_coerce(v) for v in values]
    assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=0.0) for a, b in zip(got, want)), (values, got, want)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 99).map(str), st.sampled_from(["x", "", " ", "7a"])),
                         max_size=8).map(lambda xs: ",".join(xs)), min_size=20, max_size=60))
def test_parse_code_list_matches_reference(values):
    spark = _session()
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(parse_code_list("v")).collect()]
    want = [[int(c.strip()) for c in v.split(",") if c.strip().isdigit()] for v in values]
    assert got == want


_alphabet = st.sampled_from(list("ab c_1เขื่อน"))
_text = st.lists(_alphabet, min_size=0, max_size=12).map("".join)


@settings(max_examples=2, deadline=None)
@given(st.lists(_text, min_size=5, max_size=25), st.lists(_text, min_size=3, max_size=12), st.booleans())
def test_substring_join_on_random_text(texts, pats, ci):
    from hydrolake.operators.joins import substring_match_pairs
    spark = _session()
    t = spark.createDataFrame(list(enumerate(texts)), "tid int, t string")
    p = spark.createDataFrame(list(enumerate(pats)), "pid int, p string")
    a = sorted(tuple(r) for r in substring_match_pairs(t, "tid", p, "pid", [("t", "p", ci)]).collect())
    norm = (lambda s: s.strip().lower()) if ci else (lambda s: s.strip())
    want = sorted({(i, j) for i, x in enumerate(texts) for j, y in enumerate(pats)
                   if norm(x) and norm(y) and (norm(y) in norm(x) or norm(x) in norm(y))})
    assert a == want
