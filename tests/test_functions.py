"""Scalar expressions (FIXTURES e2, e3, e4, e7, e8, e17, e18, e24)."""

import math

from pyspark.sql import functions as F

from panelrisk import constants as K
from panelrisk.functions import (casts, contains_any, fixed_band, grade, keywords_pattern,
                                 ordinal, profile_from_zone, py_strip, py_title, translate,
                                 upper_inclusive_zone)
from panelrisk.operators import conform, sort


def col(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_safe_int_cast_e2(df):
    d = df([("abc",), ("2020.0",), ("7",), (None,), ("1e3",)], "s string")
    assert col(d, casts.safe_int("s")) == [None, 2020, 7, None, 1000]
    assert col(d, casts.safe_double("s")) == [None, 2020.0, 7.0, None, 1000.0]


def test_fixed_bands_e3(df):
    d = df([(math.nan,), (None,), (281.12,), (281.13,), (694.63,), (694.64,)], "v double")
    assert col(d, fixed_band("v")) == ["Rendah", "Rendah", "Rendah", "Sedang", "Sedang", "Tinggi"]
    assert col(d, profile_from_zone(fixed_band("v")))[-1] == "Risiko Tinggi"


def test_upper_inclusive_zones_e4(df):
    d = df([(2.0,), (3.0,), (4.0,), (5.0,)], "v double")
    assert col(d, upper_inclusive_zone("v", 2, 4)) == ["Rendah", "Sedang", "Sedang", "Tinggi"]


def test_title_case_matches_python_e7(df):
    words = ["Cote d'Ivoire", "guinea-bissau", "réunion île", "UNITED STATES OF AMERICA",
             "hello world2abc", "o'neil's 3rd", "NATION_10", "", "  padded  ", "ÉCOLE"]
    d = df([(w,) for w in words] + [(None,)], "s string")
    assert col(d, py_title("s")) == [w.title() for w in words] + [None]


def test_strip_matches_python(df):
    words = ["  a b  ", "\t x\n", "y", "   ", ""]
    d = df([(w,) for w in words], "s string")
    assert col(d, py_strip("s")) == [w.strip() for w in words]


def test_strip_takes_all_white_space_without_a_pattern(df):
    """The same characters as the pattern took that was tried at every character of every row."""
    words = [f"{chr(c)}a{chr(c)} b{chr(c)}\n" for c in range(1, 0x3100)] + ["", " \u3000\t", None]
    d = df([(w,) for w in words], "s string")
    old = F.regexp_replace("s", r"(?U)^\s+|\s+$", "")
    got = d.select(py_strip("s").alias("a"), old.alias("b"))
    assert got.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
    assert "regexp" not in d.select(py_strip("s"))._jdf.queryExecution().toString()


def test_dictionary_single_pass_then_trim_e8(df):
    d = df([("a",), ("b",), (" a ",), (None,)], "s string")
    out = conform.standardise_names(d, "s", {"a": "b", "b": "a"})
    assert col(out, "s") == ["b", "a", "a", None]


def test_translate_passes_unknown_through(df):
    d = df([("Jepang",), ("Peru",), (None,)], "s string")
    assert col(d, translate("s", K.JOIN_STAGE_NAMES)) == ["Japan", "Peru", None]


def test_keyword_exclude_e17(df):
    d = df([("Caspian Sea",), (None,), ("Peru",), ("Lake Victoria",), ("Canada",)], "s string")
    out = conform.exclude_keywords(d, "s")
    assert col(out, "s") == [None, "Peru", "Canada"]


def test_pattern_filter_null_is_false_e18(df):
    d = df([(2023, None), (2023, "x dalys"), (2023, "Deaths"), (2022, "DALYs")], "year int, measure_name string")
    out = conform.year_and_pattern(d, 2023)
    assert col(out, "measure_name") == ["x dalys"]
    assert col(d, contains_any("measure_name", "daly")) == [False, True, False, True]


def test_keywords_pattern_escapes():
    assert keywords_pattern(["a.b", "c"]) == r"a\.b|c"
    assert keywords_pattern(["a.b", "c"], literal=False) == "a.b|c"


def test_ordered_category_sort_e24(df):
    d = df([("Tinggi",), (None,), ("Rendah",), ("Sedang",), ("Other",)], "z string")
    out = sort.ordered_category_sort(d, "z")
    assert col(out, "z")[:3] == ["Rendah", "Sedang", "Tinggi"]
    assert set(col(out, "z")[3:]) == {None, "Other"}
    assert col(d, ordinal("z")) == [2, None, 0, 1, None]


def test_grades(df):
    d = df([(0.9,), (0.55,), (0.3,), (0.1,)], "s double")
    assert col(d, grade("s", K.SILHOUETTE_GRADES, K.SILHOUETTE_FLOOR_GRADE)) == [
        "very good", "fair", "weak", "not meaningful"]
