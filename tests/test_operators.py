"""Operators (FIXTURES e1, e5, e6, e9-e14, e19-e23, e25, e26)."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelrisk import constants as K
from panelrisk.operators import (aggregates, cluster, conform, dedupe, features, forecast, joins,
                                 setops)


def test_drop_missing_drops_null_and_nan_e1(df):
    d = df([(None,), (math.nan,), (1.0,)], "val double")
    assert [r.val for r in conform.drop_missing(d, ["val"]).collect()] == [1.0]


def test_median_impute_e5(df):
    d = df([(None,), (math.nan,), (1.0,), (3.0,), (5.0,)], "x double")
    out = sorted(r.x for r in features.median_impute(d, ["x"], relative_error=0.0).collect())
    assert out == [1.0, 3.0, 3.0, 3.0, 5.0]
    out = sorted(r.x for r in features.median_impute(d, ["x"]).collect())
    assert out == [1.0, 3.0, 3.0, 3.0, 5.0]


def test_median_impute_by_group(df):
    d = df([("a", None), ("a", 2.0), ("b", None), ("b", 10.0), ("b", 20.0)], "k string, x double")
    out = features.median_impute(d, ["x"], 0.0, by=["k"]).orderBy("k", "x").collect()
    assert [(r.k, r.x) for r in out] == [("a", 2.0), ("a", 2.0), ("b", 10.0), ("b", 10.0), ("b", 20.0)]


def test_median_impute_all_null_errors_e6(df):
    d = df([(None,), (None,)], "x double")
    with pytest.raises(ValueError, match="no values"):
        features.median_impute(d, ["x"])


def test_covariate_join_fans_out_or_fails_e9(df):
    panel = df([("A", 2020, 1.0)], "translated_location string, year int, val double")
    cov = df([("A", 2020, 5.0), ("A", 2020, 6.0)], "country string, y int, gdp double")
    out = joins.left_join_on(panel, cov, ["translated_location", "year"], ["country", "y"])
    assert out.count() == 2
    with pytest.raises(ValueError, match="duplicate"):
        joins.left_join_on(panel, cov, ["translated_location", "year"], ["country", "y"],
                           require_unique=True)


def test_discovery_e10_e11():
    assert conform.discover_column(["x", "GDP per capita"], "gdp") == "GDP per capita"
    with pytest.raises(ValueError):
        conform.discover_column(["x", "y"], "gdp")
    assert conform.discover_column(["x", "y"], "density", fallback="last") == "y"


def test_conform_covariate_safe_casts(df):
    raw = df([("A", "2020", "1.5"), ("B", "-10", "2"), ("C", "x", "bad")],
             "Entity string, Year string, `Population density` string")
    out = conform.conform_covariate(raw, "density", "pop_density", "year_pop",
                                    fallback="last", positive_year=True).collect()
    assert [(r.country, r.year_pop, r.pop_density) for r in out] == [("A", 2020, 1.5)]


def test_keep_first_by_order_e12_e13(df):
    d = df([("X", 2, 0, "upload"), ("X", 1, 0, "pred-2"), ("X", 0, 0, "pred-1"), ("X", 0, 2, "fill"),
            ("Y", 5, 1, "only")], "k string, seq long, source_rank int, tag string")
    out = dedupe.keep_first(d, ["k"], ["source_rank", "seq"]).orderBy("k").collect()
    assert [(r.k, r.tag) for r in out] == [("X", "pred-1"), ("Y", "only")]


def test_latest_label_e14(df):
    hist = df([("E", 2019, 1, "Tinggi"), ("E", 2022, 2, "Rendah"), ("E", 2022, 3, "Sedang")],
              "translated_location string, year int, seq long, cluster_risiko string")
    ents = df([("E",), ("F",)], "translated_location string")
    out = joins.latest_lookup(ents, hist, "translated_location", ["cluster_risiko"]).orderBy(
        "translated_location").collect()
    assert [(r.translated_location, r.cluster_risiko) for r in out] == [("E", "Rendah"), ("F", None)]


def test_first_match_lookup_e19(df):
    rates = df([("A", 1), ("B", 2), (None, 3)], "location_name string, seq long")
    counts = df([("A", 20, 9.0), ("A", 10, 7.0), (None, 5, 1.0)], "location_name string, seq long, val double")
    out = joins.first_match_lookup(rates, counts, "location_name", "val", ["seq"], "n")
    got = {r.seq: r.n for r in out.collect()}
    assert got == {1: 7.0, 2: None, 3: 1.0}


def test_string_index_keep_e20(spark, df):
    train = df([("a",), ("a",), ("b",)], "c string")
    test = df([("a",), ("b",), ("z",), (None,)], "c string")
    out = features.string_index(test, "c", fit_on=train).collect()
    assert [r.c_idx for r in out] == [0.0, 1.0, 2.0, 2.0]


def test_silhouette_single_cluster_e21(df):
    d = df([(1.0, 2.0, 0), (2.0, 3.0, 0)], "a double, b double, c int")
    r = cluster.silhouette(d, ["a", "b"], "c").first()
    assert r.n_clusters == 1 and r.silhouette == 0.0


def test_silhouette_matches_clustering_evaluator(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler
    d = spark.range(300).select(
        (F.sin("id") * 3 + (F.col("id") % 3)).alias("a"), F.cos(F.col("id") * 7).alias("b"),
        (F.col("id") % 3).cast("int").alias("c"))
    v = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(d)
    want = ClusteringEvaluator(featuresCol="f", predictionCol="c",
                               distanceMeasure="squaredEuclidean").evaluate(v)
    got = cluster.silhouette(d, ["a", "b"], "c").first().silhouette
    assert abs(got - want) < 1e-12
    got_vec = cluster.silhouette(v, "f", "c", dim=2).first().silhouette
    assert abs(got_vec - want) < 1e-12


def test_regression_metrics_match_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    d = spark.range(200).select(F.col("id").cast("double").alias("val"),
                                (F.col("id") * 1.1 + F.sin("id") * 5).alias("prediction"))
    got = forecast.regression_metrics(d).first()
    ev = RegressionEvaluator(labelCol="val", predictionCol="prediction")
    for m in ("r2", "rmse", "mae"):
        want = ev.setMetricName(m).evaluate(d)
        key = {"r2": "r_squared"}.get(m, m)
        assert abs(got[key] - want) < 1e-9 * max(1.0, abs(want))


def test_entity_report_falls_back_to_history_e22(df):
    scored = df([("A", 2023, "m", 1.0, 1.0, "Rendah", 1.0, 1.0, "Risiko Rendah")],
                "translated_location string, year int, measure_name string, val double, "
                "prediction double, cluster_risiko string, gdp_per_capita double, pop_density double, "
                "profil_negara string")
    hist = df([("B", 2019, 5.0, "Risiko Tinggi"), ("B", 2020, 6.0, "Risiko Tinggi")],
              "translated_location string, year int, val double, profil_negara string")
    hit = forecast.entity_report(scored, hist, "A").collect()
    assert [r.source for r in hit] == ["scored"]
    fb = forecast.entity_report(scored, hist, "B").collect()
    assert [(r.source, r.year) for r in fb] == [("history", 2019), ("history", 2020)]


def test_rank_labels_e23(df):
    d = df([(0, 10.0), (1, 1.0), (2, 5.0), (None, 3.0)], "c int, val double")
    out = {r.c: r.profil_negara for r in cluster.rank_labels(d, "c", "val").collect()}
    assert out == {1: "Risiko Rendah", 2: "Risiko Sedang", 0: "Risiko Tinggi", None: "Tidak Diketahui"}
    d4 = df([(i, float(i)) for i in range(4)], "c int, val double")
    with pytest.raises(ValueError, match="labels"):
        cluster.rank_labels(d4, "c", "val")


def test_quantile_zones_and_split(df):
    d = df([(float(i), 2000 + i % 10) for i in range(100)], "prediction double, year int")
    z = forecast.quantile_zones(d, relative_error=0.0)
    counts = {r.cluster_risiko: r["count"] for r in aggregates.distribution(z, ["cluster_risiko"]).collect()}
    assert counts == {"Rendah": 33, "Sedang": 33, "Tinggi": 34}
    s, train, test = forecast.temporal_split(d, relative_error=0.0)
    assert train.count() + test.count() == 100
    assert train.agg(F.max("year")).first()[0] == 2007


def test_union_by_name_e26(df):
    a = df([(1, "x")], "a int, b string")
    b = df([(2, 3.0)], "a int, c double")
    out = setops.union_by_name(a, b).orderBy("a").collect()
    assert [(r.a, r.b, r.c) for r in out] == [(1, "x", None), (2, None, 3.0)]


def test_null_profile_and_counts(df):
    d = df([(None, 1.0), (2.0, None), (3.0, 4.0)], "x double, y double")
    r = aggregates.null_profile(d, ["x", "y"]).first()
    assert (r.x, r.y) == (1, 1)
    c = aggregates.row_counts({"a": d, "b": d.limit(1)}).collect()
    assert {(r.source, r.rows) for r in c} == {("a", 3), ("b", 1), ("TOTAL", 4)}


def test_checked_broadcast_bounds(spark):
    small = spark.range(5)
    big = spark.range(1000)
    assert joins.checked_broadcast(small, 10) is not small  # hinted copy
    assert joins.checked_broadcast(big, 10) is big
    assert joins.checked_broadcast(big, None) is big


def test_impute_fit_on_training_rows(df):
    d = df([(2020, 1.0), (2020, 3.0), (2021, 100.0), (2021, None)], "year int, x double")
    out = features.median_impute(d, ["x"], 0.0, fit_on=d.filter("year <= 2020"))
    assert sorted(r.x for r in out.collect()) == [1.0, 1.0, 3.0, 100.0]
