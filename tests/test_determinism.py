"""Fitted models give identical output from any input partitioning
(SURVEY 7.4): k-means thanks to ``features.stable_layout``, the forest and the
quantiles because they do not look at the layout."""

from pyspark.sql import functions as F

from panelrisk import constants as K
from panelrisk.plans import catalog as C

SF = "/root/testdata/sf0.001"


def test_bisecting_kmeans_repeatable(spark):
    from panelrisk.plans import jobs
    m = C.master(spark, SF)
    outs = []
    for n in (1, 3, 8):
        _, labelled, sil = jobs.profile_clusters(m.repartition(n))
        outs.append(sorted((r.seq, r.country_cluster) for r in labelled.select(K.SEQ, K.CLUSTER).collect()))
    assert outs[0] == outs[1] == outs[2]


def test_forest_repeatable(spark):
    from panelrisk.plans import jobs
    m = C.master(spark, SF)
    _, labelled, _ = jobs.profile_clusters(m)
    labelled = labelled.drop("raw_cluster_features", "scaled_cluster_features")
    outs = []
    for n in (1, 3):
        _, _, zoned, metrics = jobs.forecast_zones(labelled.repartition(n), trees=5)
        outs.append(sorted((r.seq, round(r.prediction, 9)) for r in zoned.select(K.SEQ, K.PREDICTION).collect()))
    assert outs[0] == outs[1]


def test_fits_do_not_hang_on_the_layout(spark):
    """Cluster labels are equal whatever number of partitions a fit is laid out
    in; the forest's metrics stay within a tenth of the labels' deviation
    (they are equal: see ``test_forecast_is_the_same_in_any_layout``)."""
    from panelrisk.plans import jobs
    m = C.master(spark, SF)
    sd = m.agg(F.stddev(K.VAL)).first()[0]
    labels, rmse = [], []
    for n in (1, 8, 16, 32):
        _, labelled, _, _, _, _, metrics = jobs.profile_and_forecast(m, partitions=n, with_silhouette=False)
        labels.append(sorted((r[0], r[1]) for r in labelled.select(K.SEQ, K.PROFILE).collect()))
        rmse.append(metrics.first()["rmse"])
    assert all(x == labels[0] for x in labels)
    assert max(rmse) - min(rmse) < 0.1 * sd, (rmse, sd)


def test_results_of_a_fit_do_not_shuffle_the_master_again(spark):
    """The frames that a fit returns start at landed files: no exchange."""
    from panelrisk.plans import jobs
    _, labelled, _, _, _, zoned, _ = jobs.profile_and_forecast(C.master(spark, SF), with_silhouette=False, trees=3)
    for frame in (labelled, zoned):
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_clusters_fitted_on_training_years_label_all_rows(spark):
    from panelrisk.plans import jobs
    m = C.master(spark, SF)
    _, labelled, sil = jobs.profile_clusters(m, fit_years_upto=1999, with_silhouette=False)
    assert sil is None
    assert labelled.count() == m.count()
    assert labelled.filter(F.col(K.PROFILE) == K.UNKNOWN_PROFILE).count() == 0


def test_single_layout_matches_separate_fits(spark):
    """C2+C3 on one cached layout give the same forecasts as the two jobs
    each laying the master out on their own."""
    from panelrisk.plans import jobs
    m = C.master(spark, SF)
    _, labelled, _ = jobs.profile_clusters(m, with_silhouette=False)
    labelled = labelled.drop("raw_cluster_features", "scaled_cluster_features")
    _, _, zoned, _ = jobs.forecast_zones(labelled, trees=5)
    *_, zoned2, _ = jobs.profile_and_forecast(m, with_silhouette=False, trees=5)
    cols = [K.SEQ, K.PREDICTION, K.ZONE, K.PROFILE]
    a = sorted((r[0], round(r[1], 9), r[2], r[3]) for r in zoned.select(*cols).collect())
    b = sorted((r[0], round(r[1], 9), r[2], r[3]) for r in zoned2.select(*cols).collect())
    assert a == b and len(a) > 0


def test_forecast_is_the_same_in_any_layout(spark):
    """Split, predictions and zones, with the sketches at their default error, at 1, 8 and 32 partitions."""
    from panelrisk.plans import jobs
    m = C.master(spark, "/root/testdata/sf0.01")
    outs = []
    for n in (1, 8, 32):
        *_, split, _, zoned, _ = jobs.profile_and_forecast(m.repartition(n), partitions=n, with_silhouette=False, trees=20)
        outs.append((str(split), sorted((r.seq, r.prediction, r.cluster_risiko) for r in zoned.collect())))
    assert len(outs[0][1]) > 100 and outs[0] == outs[1] == outs[2]
