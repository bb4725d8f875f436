"""Property tests: invariants that must hold for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelrisk.functions import fixed_band, translate
from panelrisk.operators import conform, dedupe, features, forecast, joins, setops

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
names = st.sampled_from(["Peru", "Jepang", "Cina", "Laut", None, " Peru", "Chili"])
vals = st.one_of(st.none(), st.floats(min_value=-1e4, max_value=1e4, allow_nan=False))


@SETTINGS
@given(st.lists(names, min_size=1, max_size=20))
def test_identity_pairs_are_idempotent(df, xs):
    d = df([(x,) for x in xs], "s string")
    ident = {"Peru": "Peru", "Chili": "Chili"}
    assert [r[0] for r in d.select(translate("s", ident)).collect()] == xs


@SETTINGS
@given(st.lists(st.tuples(names, st.integers(2000, 2003)), min_size=1, max_size=25))
def test_left_join_with_unique_right_keeps_count(df, rows):
    left = df(rows, "e string, y int")
    right = df([("Peru", y, float(y)) for y in range(2000, 2004)], "c string, yy int, v double")
    out = joins.left_join_on(left, right, ["e", "y"], ["c", "yy"], require_unique=True)
    assert out.count() == len(rows)


@SETTINGS
@given(st.lists(vals, min_size=1, max_size=30).filter(lambda v: any(x is not None for x in v)))
def test_imputation_leaves_no_nulls(df, xs):
    d = df([(x,) for x in xs], "x double")
    out = features.median_impute(d, ["x"], relative_error=0.0)
    assert out.filter(F.col("x").isNull()).count() == 0
    assert out.count() == len(xs)


@SETTINGS
@given(st.lists(st.tuples(names, st.integers(0, 50)), min_size=1, max_size=30))
def test_keep_first_gives_unique_keys_and_minimal_order(df, rows):
    d = df([(k, s, i) for i, (k, s) in enumerate(rows)], "k string, s int, i long")
    out = dedupe.keep_first(d, ["k"], ["s", "i"]).collect()
    assert len({r.k for r in out}) == len(out) == len({k for k, _ in rows})
    for r in out:
        assert (r.s, r.i) == min((s, i) for i, (k, s) in enumerate(rows) if k == r.k)


@SETTINGS
@given(st.lists(vals, min_size=1, max_size=30))
def test_bands_partition_rows(df, xs):
    d = df([(x,) for x in xs], "v double")
    z = d.select(fixed_band("v").alias("z")).groupBy("z").count().collect()
    assert sum(r["count"] for r in z) == len(xs)
    assert {r.z for r in z} <= {"Rendah", "Sedang", "Tinggi"}


@SETTINGS
@given(st.lists(st.integers(1990, 2030), min_size=1, max_size=40))
def test_train_plus_test_is_total(df, years):
    d = df([(y,) for y in years], "year int")
    _, train, test = forecast.temporal_split(d, relative_error=0.0)
    assert train.count() + test.count() == len(years)


@SETTINGS
@given(st.integers(0, 10), st.integers(0, 10))
def test_union_count_is_sum(df, a, b):
    x = df([(i, "a") for i in range(a)], "i int, s string")
    y = df([(i, 1.0) for i in range(b)], "i int, v double")
    assert setops.union_by_name(x, y).count() == a + b


def test_rename_ignores_missing(df):
    d = df([(1, 2)], "Entity int, Year int")
    out = conform.rename_columns(d, {"Entity": "country", "Missing": "x"})
    assert out.columns == ["country", "Year"]
