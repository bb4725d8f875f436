"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each over the views of ``views.py``.  Every
query returns plain (non-vector), uniquely named columns; the DuckDB twin
of each is in ``oracle.py`` under the same key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import bands, casts, text
from ..functions.lookup import translate
from ..operators import (aggregates, cluster, conform, dedupe, features, forecast, joins,
                         setops, sketch, sort)
from ..session import held, shared_path
from ..sources import csv as csv_src
from ..sources import lake
from . import jobs
from . import views as V

Query = Callable[[SparkSession, str], DataFrame]

# Test-view parameters (see views.py).
TEST_MAP_DICT = {f"NATION_{k}": f"Nation {k}" for k in range(0, 25, 3)}
SWAP = {"1-URGENT": "2-HIGH", "2-HIGH": "1-URGENT"}
PART_KEYWORDS = ["ring", "BOLT"]
SAMPLE_SIZE = 300
TOP_K = 10
REPORT_ENTITY = "Nation 7"
SAMPLE_KEY_MULT = 48271
SAMPLE_KEY_MOD = 2147483647


# ------------------------------------------------------------------ shared
def _conformed_gdp(spark, d):
    raw = lake.roundtrip(V.cov_gdp(spark, d), shared_path(spark, "lake", "covariate"))
    return conform.conform_covariate(raw, "gdp", K.GDP, "year_gdp",
                                     entity_name="country_gdp")


def _translated_panel(spark, d):
    return joins.dictionary_join(V.panel(spark, d), K.LOCATION, V.dictionary(spark, d), K.TRANSLATED)


def _landed_covariates(spark, d):
    """The covariates, landed as the program's raw zone does: their size is then
    known when a join is planned, and small ones are broadcast without a
    shuffle of the panel."""
    return tuple(lake.roundtrip(cov(spark, d), shared_path(spark, "lake", "covariate"))
                 for cov in (V.cov_gdp, V.cov_density))


def integrated(spark, d, metric=V.RATE, impute=True):
    """C1 on the test views, not landed.  Covariate medians are exact."""
    gdp, pop = _landed_covariates(spark, d)
    return jobs.integrate_panel(V.panel(spark, d), gdp, pop, dictionary=V.dictionary(spark, d), metric=metric,
                                impute_relative_error=0.0, impute=impute)


def joined_panel(spark, d, metric=V.RATE):
    """C1 up to (not including) imputation."""
    return integrated(spark, d, metric, impute=False)


def master(spark, d, metric=V.RATE):
    """C1 on the test views: the imputed master is landed in the curated zone, partitioned by year,
    and re-read, as the original does: later steps scan those files, a lost
    executor recomputes from the zone, and year filters (the temporal
    split) prune partitions.  It is the only write of the panel."""
    return jobs.curate(integrated(spark, d, metric), shared_path(spark, "lake", "curated_master"))


def scored(spark, d, built=None):
    """Deterministic, SQL-checkable stand-in for the fitted models: fixed
    value bands as cluster ids, ranked into profiles; split at the exact
    0.8 quantile of year; a persistence forecast (the value of the latest
    training row of the same entity and measure, else of the latest
    training row overall); zones at exact 0.33/0.66 quantiles of the
    predictions.  ``built``: a curated master the caller
    already built (so it is not built twice)."""
    m = built if built is not None else master(spark, d)
    m = m.withColumn(K.CLUSTER, V.supplied_cluster())
    m = cluster.rank_labels(m, K.CLUSTER, K.VAL)
    _, train, test = forecast.temporal_split(m, relative_error=0.0)
    order = F.struct(F.col(K.YEAR), F.col(K.SEQ))
    last = train.groupBy(K.TRANSLATED, K.MEASURE).agg(F.max_by(K.VAL, order).alias("__m"))
    overall = train.agg(F.max_by(K.VAL, order)).first()[0]
    pred = (test.join(last, [K.TRANSLATED, K.MEASURE], "left")
                .withColumn(K.PREDICTION, F.coalesce(F.col("__m"), F.lit(overall)))
                .drop("__m"))
    return forecast.quantile_zones(pred, relative_error=0.0)


def pred_export(spark, d):
    """The prediction export, handed to the map stage by file (as the
    original hands over its CSV): written once, then scanned."""
    return lake.roundtrip(scored(spark, d).select(*K.EXPORT_COLUMNS, K.SEQ), shared_path(spark, "lake", "predictions"))


def _map_dict(spark, d):
    return V.dictionary(spark, d)


def _map_pred(spark, d):
    return jobs._standardise(pred_export(spark, d), K.TRANSLATED, _map_dict(spark, d))


def _map_master(spark, d):
    """All metrics, not landed: the map stage takes a few rows for each entity
    from it, so every reader is an aggregate over a scan, and nothing of the panel's
    size is written."""
    return jobs._standardise(integrated(spark, d, metric=None), K.TRANSLATED, _map_dict(spark, d))


def _map_upload(spark, d):
    return jobs.classify_upload(V.uploads(spark, d), dictionary=_map_dict(spark, d), rate=V.RATE,
                                count=V.COUNT, year=V.TARGET_YEAR, hold=True)


def _master_summary(mall):
    """What the map stage takes from all the years and metrics of the master, counted in one pass and
    held: its entities, and the greatest value and first row of every metric."""
    return held(mall.groupBy(K.TRANSLATED, K.YEAR, K.MEASURE, K.METRIC)
                .agg(F.max(K.VAL).alias(K.VAL), F.min(K.SEQ).alias(K.SEQ)))


def _assembled(spark, d, pattern=V.MEASURE_PATTERN):
    pred, mall = _map_pred(spark, d), _map_master(spark, d)
    up, summary = _map_upload(spark, d), _master_summary(mall)
    # the view's count rows, one for each (entity, year, measure): the join cannot explode
    counts = conform.slice_equal(summary, K.METRIC, V.COUNT)
    return jobs.assemble_results(pred, mall, up, year=V.TARGET_YEAR, pattern=pattern,
                                 count_metric=V.COUNT, counts=counts), pred, mall, summary


def _final(spark, d):
    a, pred, mall, summary = _assembled(spark, d)
    a = held(jobs.first_classified(a))  # read by both steps below: a row for each name instead of all uploads
    fb = jobs.fallback_backfill(a, pred, mall, year=V.TARGET_YEAR, entities=summary)
    return jobs.final_entity_table(setops.union_by_name(a, fb))


# ------------------------------------------------------------------ sources
def q_csv_glob_scan(spark, d):
    p = V.panel(spark, d)
    path = shared_path(spark, "lake", "glob")
    lake.land(p, path, "csv")
    schema = "seq bigint, location_name string, measure_name string, metric_name string, year int, val double"
    return csv_src.read_csv_files(spark, f"{path}/part-*.csv", schema)


def q_csv_scan_null_tokens(spark, d):
    p = V.panel(spark, d)
    other = F.col(K.METRIC) == "Other"
    txt = p.select(F.col(K.SEQ).cast("string").alias(K.SEQ), K.LOCATION,
                   F.when(other, "N/A").otherwise(F.col(K.METRIC)).alias(K.METRIC),
                   F.when(other, "nan").otherwise(F.col(K.VAL).cast("string")).alias(K.VAL))
    path = shared_path(spark, "lake", "tokens")
    lake.land(txt, path, "csv")
    return csv_src.read_csv_null_tokens(spark, path, {K.SEQ: "bigint", K.LOCATION: "string",
                                                     K.METRIC: "string", K.VAL: "double"})


def q_raw_zone_roundtrip(spark, d):
    p = V.panel(spark, d).withColumn(K.YEAR, F.col(K.YEAR).cast("string"))
    return lake.roundtrip(p, shared_path(spark, "lake", "raw"), "parquet",
                          casts={K.VAL: "double", K.YEAR: "int"})


def q_curated_zone_roundtrip(spark, d):
    m = master(spark, d)
    out = lake.roundtrip(m, shared_path(spark, "lake", "curated"), "parquet", partition_by=[K.YEAR],
                         casts={K.VAL: "double", K.GDP: "double", K.POP: "double", K.YEAR: "int"})
    return out.select(*m.columns)


def q_prediction_export(spark, d):
    path = shared_path(spark, "lake", "export")
    lake.export_csv(pred_export(spark, d), path, [*K.EXPORT_COLUMNS, K.SEQ])
    schema = ("translated_location string, profil_negara string, measure_name string, year int, "
              "gdp_per_capita double, pop_density double, val double, prediction double, "
              "cluster_risiko string, seq bigint")
    return csv_src.read_csv_files(spark, path, schema)


def _metrics_frame(spark, d):
    m = master(spark, d).withColumn(K.CLUSTER, V.supplied_cluster())
    z = features.standardize_columns(m, [K.GDP, K.POP, K.VAL, K.YEAR])
    sil = cluster.silhouette(z, [f"{c}_z" for c in (K.GDP, K.POP, K.VAL, K.YEAR)], K.CLUSTER)
    split = forecast.split_value(m, relative_error=0.0)
    summ = aggregates.split_summary(m, split)
    reg = forecast.regression_metrics(scored(spark, d, built=m.drop(K.CLUSTER)))
    r, s_ = reg.first(), sil.first()
    return (summ.select(F.lit("Persistence").alias("model"), "split_year", "training_rows",
                        "testing_rows",
                        F.lit(r["r_squared"]).alias("r_squared"), F.lit(r["rmse"]).alias("rmse"),
                        F.lit(r["mae"]).alias("mae"),
                        F.lit(s_["silhouette"]).alias("silhouette_score")))


def q_metrics_report(spark, d):
    path = shared_path(spark, "lake", "metrics")
    lake.write_metrics(_metrics_frame(spark, d), path)
    schema = ("model string, split_year int, training_rows bigint, testing_rows bigint, "
              "r_squared double, rmse double, mae double, silhouette_score double")
    return csv_src.read_csv_files(spark, path, schema)


def q_ingest_counts(spark, d):
    return aggregates.row_counts({"panel": V.panel(spark, d), "gdp": V.cov_gdp(spark, d),
                                  "pop_density": V.cov_density(spark, d)})


# ------------------------------------------------------------------ filters
def q_drop_null_required(spark, d):
    j = joins.left_join_on(_translated_panel(spark, d), _conformed_gdp(spark, d),
                           [K.TRANSLATED, K.YEAR], ["country_gdp", "year_gdp"])
    j = conform.drop_missing(j, [*K.PANEL_REQUIRED, K.GDP])
    return j.select(K.SEQ, K.TRANSLATED, K.YEAR, K.GDP)


def q_metric_slice(spark, d):
    return conform.slice_equal(V.panel(spark, d), K.METRIC, V.RATE).select(
        K.SEQ, K.LOCATION, K.MEASURE, K.YEAR, K.VAL)


def q_positive_filter(spark, d):
    p = conform.filter_greater(V.panel(spark, d), K.VAL, K.FIXED_HIGH_CUT)
    return p.select(K.SEQ, K.VAL)


def q_typed_projection(spark, d):
    p = V.panel(spark, d)
    txt = p.select(*[F.col(c).cast("string").alias(c) for c in p.columns])
    return conform.typed_projection(txt, {K.SEQ: "bigint", K.LOCATION: "string",
                                          K.YEAR: "int", K.VAL: "double"})


def q_conform_covariate(spark, d):
    return _conformed_gdp(spark, d)


def q_safe_cast(spark, d):
    o = V.table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("orderkey"),
        casts.safe_int("o_orderpriority").alias("priority_int"),
        casts.safe_int(F.substring("o_orderpriority", 1, 1)).alias("priority_digit"),
        casts.safe_int(F.concat(F.year("o_orderdate").cast("string"), F.lit(".0"))).alias("year_from_text"),
        casts.safe_double(F.col("o_totalprice").cast("string")).alias("price_from_text"),
        casts.safe_double("o_orderstatus").alias("status_double"))


def q_discover_value_column(spark, d):
    out = []
    for name, raw, needle, fb in (("gdp", V.cov_gdp(spark, d), "gdp", "error"),
                                  ("pop_density", V.cov_density(spark, d), "density", "last")):
        col = conform.discover_column(raw.columns, needle, fb)
        out.append(raw.select(F.lit(name).alias("source"), F.lit(col).alias("value_column"),
                              F.col("Entity").alias("entity"), F.col("Year").alias("year"),
                              F.col(col).alias("value")))
    return setops.union_by_name(*out)


def q_year_and_pattern_filter(spark, d):
    return conform.year_and_pattern(V.panel(spark, d), 2000, V.MEASURE_PATTERN).select(
        K.SEQ, K.LOCATION, K.MEASURE, K.VAL)


def q_entity_slice(spark, d):
    return conform.entity_slice(master(spark, d), REPORT_ENTITY,
                                [K.SEQ, K.TRANSLATED, K.YEAR, K.MEASURE, K.VAL, K.GDP, K.POP],
                                order_by=[K.YEAR, K.SEQ])


def q_dictionary_translate(spark, d):
    p = V.panel(spark, d)
    return p.select(K.SEQ, K.LOCATION, translate(K.LOCATION, TEST_MAP_DICT).alias(K.TRANSLATED))


def q_dictionary_join(spark, d):
    return _translated_panel(spark, d).select(K.SEQ, K.LOCATION, K.TRANSLATED)


def q_value_replace(spark, d):
    p = V.panel(spark, d).withColumn("padded", F.concat(F.lit(" "), F.col(K.MEASURE)))
    p = conform.standardise_names(p, K.MEASURE, SWAP)
    p = conform.standardise_names(p, "padded", SWAP)
    return p.select(K.SEQ, K.MEASURE, "padded")


def q_trim_names(spark, d):
    p = V.table(spark, d, "part")
    return p.select("p_partkey", text.py_strip(F.concat(F.lit("\t  "), F.col("p_name"), F.lit(" \n")))
                    .alias("name"), text.null_if_blank(F.lit("   ")).alias("blank"))


def q_title_case(spark, d):
    p = V.table(spark, d, "part")
    return p.select("p_partkey",
                    text.py_title("p_name").alias("name_title"),
                    text.py_title(F.concat(F.col("p_brand"), F.lit("-x'y"))).alias("brand_title"),
                    text.py_title(F.lower(F.concat(F.col("p_type"), F.lit(" d'ivoire-bissau"))))
                    .alias("type_title"))


def q_keyword_exclude(spark, d):
    p = V.table(spark, d, "part").select("p_partkey", "p_name")
    return conform.exclude_keywords(p, "p_name", PART_KEYWORDS)


def q_stamp_constants(spark, d):
    p = conform.slice_equal(V.panel(spark, d), K.METRIC, V.RATE)
    return conform.stamp_constants(p.select(K.SEQ, K.LOCATION, K.VAL),
                                   {K.YEAR: V.TARGET_YEAR, K.MEASURE: K.MAP_MEASURE,
                                    K.METRIC: K.MAP_METRIC}, {K.PREDICTION: K.VAL})


def q_optional_column(spark, d):
    p = V.panel(spark, d).select(K.SEQ, K.LOCATION, K.VAL)
    return conform.ensure_columns(p, {K.COUNT_VAL: "double", K.VAL: "double"})


def q_map_ready_table(spark, d):
    return jobs.map_ready(_final(spark, d))


# ------------------------------------------------------------------ joins
def q_left_join_covariate(spark, d):
    j = joins.left_join_on(_translated_panel(spark, d), _conformed_gdp(spark, d),
                           [K.TRANSLATED, K.YEAR], ["country_gdp", "year_gdp"])
    return j.select(K.SEQ, K.TRANSLATED, K.YEAR, K.GDP)


def q_panel_integrate(spark, d):
    return master(spark, d)


def q_left_join_counts(spark, d):
    a, *_ = _assembled(spark, d)
    return a.filter(F.col("source_rank") == 0).select(K.SEQ, K.TRANSLATED, K.YEAR, K.MEASURE,
                                                      K.COUNT_VAL, "sub_seq")


def q_first_match_lookup(spark, d):
    up = V.uploads(spark, d)
    rates = conform.slice_equal(up, K.METRIC, V.RATE)
    counts = conform.slice_equal(up, K.METRIC, V.COUNT)
    j = joins.first_match_lookup(rates, counts, K.LOCATION, K.VAL, [K.SEQ], K.COUNT_VAL)
    return j.select(K.SEQ, K.LOCATION, K.VAL, K.COUNT_VAL, F.col(f"__o_{K.SEQ}").alias("count_seq"))


def q_anti_join_missing_entities(spark, d):
    a, _, _, summary = _assembled(spark, d, pattern=K.MAP_MEASURE_PATTERN)
    ents = aggregates.distinct_values(summary, K.TRANSLATED)
    return joins.anti_join(ents, a.filter(F.col(K.ZONE).isNotNull()), K.TRANSLATED, K.TRANSLATED)


def q_latest_label_lookup(spark, d):
    ents = aggregates.distinct_values(integrated(spark, d, metric=None), K.TRANSLATED)
    return joins.latest_lookup(ents, pred_export(spark, d), K.TRANSLATED, [K.ZONE, K.PROFILE])


def q_fallback_backfill(spark, d):
    # The reference's own measure pattern matches no test measure, so every
    # entity without an uploaded row is back-filled from history.
    a, pred, mall, summary = _assembled(spark, d, pattern=K.MAP_MEASURE_PATTERN)
    fb = jobs.fallback_backfill(a, pred, mall, year=V.TARGET_YEAR, entities=summary)
    return fb.drop("source_rank")


def q_watchlist_coverage(spark, d):
    return jobs.watchlist(_final(spark, d), V.WATCH)


# ------------------------------------------------------------------ aggregates
def q_null_profile(spark, d):
    cols = [K.VAL, K.GDP, K.POP]
    before = aggregates.null_profile(joined_panel(spark, d), cols)
    after = aggregates.null_profile(master(spark, d), cols)
    return setops.union_by_name(before.withColumn("stage", F.lit("before")),
                                after.withColumn("stage", F.lit("after")))


def q_distinct_counts(spark, d):
    return aggregates.distinct_counts(V.panel(spark, d), [K.LOCATION, K.MEASURE, K.METRIC, K.YEAR])


def q_distinct_entities(spark, d):
    return aggregates.distinct_values(master(spark, d), K.TRANSLATED)


def q_group_mean(spark, d):
    m = master(spark, d).withColumn(K.CLUSTER, V.supplied_cluster())
    return aggregates.group_means(m, [K.CLUSTER], {"avg_val": K.VAL}, order_by=["avg_val"])


def q_cluster_profile_stats(spark, d):
    m = cluster.rank_labels(master(spark, d).withColumn(K.CLUSTER, V.supplied_cluster()))
    return aggregates.group_means(m, [K.CLUSTER, K.PROFILE],
                                  {"avg_tb_rate": K.VAL, "avg_gdp": K.GDP, "avg_pop_density": K.POP},
                                  order_by=["avg_tb_rate"])


def q_zone_distribution(spark, d):
    return aggregates.distribution(scored(spark, d), [K.ZONE])


def q_quantile_cuts(spark, d):
    probs = [0.2, 0.33, 0.5, 0.66, 0.8]
    y = aggregates.quantiles(V.panel(spark, d), K.YEAR, probs, 0.0)
    p = aggregates.quantiles(scored(spark, d), K.PREDICTION, probs, 0.0)
    return setops.union_by_name(y.withColumn("column", F.lit("year")),
                                p.withColumn("column", F.lit("prediction")))


#: Column, table (also of the twin), probabilities and error of the checked sketches.
SKETCHED = ((K.YEAR, "panel", (0.0, 0.2, 0.5, K.SPLIT_QUANTILE, 1.0), K.SPLIT_RELATIVE_ERROR),
            (K.VAL, "panel", (0.01, 0.25, 0.5, 0.75, 0.999), K.IMPUTE_RELATIVE_ERROR),
            (K.PREDICTION, "scored", tuple(K.ZONE_QUANTILES), K.ZONE_RELATIVE_ERROR))


def q_quantile_sketch(spark, d):
    """The default branch of the quantiles: ranks of the returned values, counted
    over all rows, against the stated error."""
    out = []
    tables = {"panel": V.panel(spark, d), "scored": scored(spark, d)}
    for column, name, probs, error in SKETCHED:
        values = aggregates.quantile_values(tables[name], column, probs, error)
        ranks = sketch.rank_check(tables[name], column, dict(zip(probs, values)), error)
        out.append(ranks.select(F.lit(column).alias("column"), "prob", "n_rows", F.lit(error).alias("relative_error"),
                                "within_error"))
    return setops.union_by_name(*out)


def q_median_impute(spark, d):
    return integrated(spark, d).select(K.SEQ, K.GDP, K.POP)


def q_temporal_split(spark, d):
    m = master(spark, d)
    s, train, test = forecast.temporal_split(m, relative_error=0.0)
    return setops.union_by_name(train.select(K.SEQ, K.YEAR, F.lit("train").alias("part")),
                                test.select(K.SEQ, K.YEAR, F.lit("test").alias("part")))


def q_temporal_split_summary(spark, d):
    m = master(spark, d)
    return aggregates.split_summary(m, forecast.split_value(m, relative_error=0.0))


# ------------------------------------------------------------------ windows / sorts
def q_dedupe_keep_first(spark, d):
    p = V.panel(spark, d).select(K.LOCATION, K.MEASURE, K.SEQ, K.YEAR, K.VAL)
    return dedupe.keep_first(p, [K.LOCATION, K.MEASURE], [K.SEQ])


def q_top_k_predictions(spark, d):
    s = scored(spark, d)
    return sort.top_k(s, [F.col(K.PREDICTION).desc(), F.col(K.SEQ)], TOP_K,
                      [K.SEQ, K.TRANSLATED, K.PROFILE, K.YEAR, K.VAL, K.PREDICTION, K.ZONE])


def q_actual_vs_predicted_sample(spark, d):
    s = scored(spark, d).select(K.SEQ, K.VAL, K.PREDICTION)
    key = (F.col(K.SEQ) * SAMPLE_KEY_MULT) % SAMPLE_KEY_MOD
    return sort.repeatable_sample(s, SAMPLE_SIZE, key, F.col(K.VAL) > 0)


def q_entity_zone(spark, d):
    return sort.first_by_order(scored(spark, d), K.ZONE, [K.YEAR, K.MEASURE, K.SEQ], [K.TRANSLATED])


def q_ordered_category_sort(spark, d):
    s = scored(spark, d).select(K.SEQ, K.TRANSLATED, K.ZONE)
    out = sort.ordered_category_sort(s, K.ZONE, K.ZONE_LABELS, [K.SEQ])
    return out.withColumn("zone_rank", bands.ordinal(K.ZONE))


def q_entity_report(spark, d):
    m = master(spark, d)
    hist = cluster.rank_labels(m.withColumn(K.CLUSTER, V.supplied_cluster()))
    return forecast.entity_report(scored(spark, d, built=m), hist, REPORT_ENTITY)


def q_entity_report_history(spark, d):
    """M14 where the entity has no scored row: its history."""
    m = master(spark, d)
    hist = cluster.rank_labels(m.withColumn(K.CLUSTER, V.supplied_cluster()))
    others = scored(spark, d, built=m).filter(F.col(K.TRANSLATED) != REPORT_ENTITY)
    return forecast.entity_report(others, hist, REPORT_ENTITY)


def q_union_by_name(spark, d):
    return setops.union_by_name(_map_pred(spark, d), _map_upload(spark, d))


# ------------------------------------------------------------------ scalar functions / ML
def q_zone_classify(spark, d):
    return scored(spark, d).select(K.SEQ, K.PREDICTION, K.ZONE)


def q_fixed_band_classify(spark, d):
    p = V.panel(spark, d)
    z = bands.fixed_band(K.VAL)
    return p.select(K.SEQ, K.VAL, z.alias(K.ZONE), bands.profile_from_zone(z).alias(K.PROFILE))


def q_metric_grades(spark, d):
    m = _metrics_frame(spark, d)
    return m.select(F.round("silhouette_score", 6).alias("silhouette_score"),
                    bands.grade("silhouette_score", K.SILHOUETTE_GRADES, K.SILHOUETTE_FLOOR_GRADE)
                    .alias("silhouette_grade"),
                    F.round("r_squared", 6).alias("r_squared"),
                    bands.grade("r_squared", K.R2_GRADES, K.R2_FLOOR_GRADE).alias("r2_grade"))


def q_rank_label_clusters(spark, d):
    m = cluster.rank_labels(master(spark, d).withColumn(K.CLUSTER, V.supplied_cluster()))
    return m.select(K.SEQ, K.CLUSTER, K.PROFILE)


def q_silhouette(spark, d):
    m = master(spark, d).withColumn(K.CLUSTER, V.supplied_cluster())
    cols = [K.GDP, K.POP, K.VAL, K.YEAR]
    z = features.standardize_columns(m, cols)
    s = cluster.silhouette(z, [f"{c}_z" for c in cols], K.CLUSTER)
    return s.select("n_clusters", F.round("silhouette", 8).alias("silhouette"))


def q_regression_metrics(spark, d):
    r = forecast.regression_metrics(scored(spark, d))
    return r.select("n", *[F.round(c, 6).alias(c) for c in ("r_squared", "rmse", "mae")])


def q_standardize(spark, d):
    cols = [K.GDP, K.POP, K.VAL, K.YEAR]
    z = features.standardize_columns(master(spark, d), cols)
    return z.select(K.SEQ, *[F.round(f"{c}_z", 8).alias(f"{c}_z") for c in cols])


def q_string_index(spark, d):
    m = master(spark, d)
    train = m.filter(F.col(K.YEAR) <= 1999)
    out = features.string_index(m, K.TRANSLATED, fit_on=train)
    out = features.string_index(out, K.MEASURE, fit_on=train)
    return out.select(K.SEQ, F.col(f"{K.TRANSLATED}_idx").cast("int").alias("location_idx"),
                      F.col(f"{K.MEASURE}_idx").cast("int").alias("measure_idx"))


def q_assemble_skip_invalid(spark, d):
    cols = [K.GDP, K.POP, K.VAL, K.YEAR]
    a = features.assemble(joined_panel(spark, d), cols, "features", "skip")
    arr = vector_to_array("features")
    return a.select(K.SEQ, *[arr[i].alias(f"f{i}") for i in range(len(cols))])


def q_upload_stream(spark, d):
    """C4 through Structured Streaming: the uploads view is landed as one upload
    of many files, in row order by file name and place, and announced; the
    stream classifies it as a whole."""
    from ..streaming import announce_upload, read_classified, start_announced_stream
    inbox, sink = shared_path(spark, "uploads", "inbox"), shared_path(spark, "uploads", "classified")
    up = V.uploads(spark, d).repartitionByRange(K.SEQ).sortWithinPartitions(K.SEQ)
    announce_upload(up.select(K.LOCATION, K.METRIC, K.VAL), inbox, "view")
    q = start_announced_stream(spark, inbox, sink, dictionary=_map_dict(spark, d), rate=V.RATE,
                               count=V.COUNT, year=V.TARGET_YEAR)
    q.awaitTermination()
    return read_classified(spark, sink).drop("batch_id", "upload", "source_file", K.SEQ)


def q_classify_upload(spark, d):
    return _map_upload(spark, d)


def q_assemble_results(spark, d):
    a, *_ = _assembled(spark, d)
    return a.select(K.SEQ, "sub_seq", "source_rank", K.TRANSLATED, K.YEAR, K.MEASURE, K.VAL,
                    K.PREDICTION, K.ZONE, K.PROFILE, K.COUNT_VAL)


def q_final_entity_table(spark, d):
    return _final(spark, d)


def q_bisecting_clusters(spark, d):
    _, labelled, _ = jobs.profile_clusters(master(spark, d), with_silhouette=False)
    return labelled.select(K.SEQ, K.CLUSTER, K.PROFILE)


def q_bisecting_clusters_check(spark, d):
    """What SQL can say of the fitted clusters: complete rows, k, the labels in
    order of mean value, and the silhouette against MLlib's evaluator."""
    _, labelled, sil = jobs.profile_clusters(master(spark, d))
    ours = sil.first()["silhouette"]
    theirs = ClusteringEvaluator(featuresCol="scaled_cluster_features", predictionCol=K.CLUSTER).evaluate(labelled)
    per = aggregates.distribution(labelled, [K.CLUSTER, K.PROFILE], count_name="n").join(
        aggregates.group_means(labelled, [K.CLUSTER], {"m": K.VAL}), K.CLUSTER)
    ranked = F.transform(F.array_sort(F.collect_list(F.struct("m", K.PROFILE))), lambda x: x[K.PROFILE])
    return per.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("k"),
                   F.array_join(ranked, ",").alias("labels_by_mean")).withColumn(
        "silhouette_agrees", F.lit(abs(ours - theirs) < 1e-9))


def q_forest_predict_check(spark, d):
    """What SQL can say of the fitted forest: split year, rows on either side,
    and every prediction within the training values."""
    m = master(spark, d)
    _, _, _, split, _, zoned, metrics = jobs.profile_and_forecast(m, with_silhouette=False, split_relative_error=0.0)
    seen = m.filter(F.col(K.YEAR) <= split).agg(F.min(K.VAL).alias("lo"), F.max(K.VAL).alias("hi")).first()
    facts = zoned.agg(F.count(K.PREDICTION).alias("n_predictions"),
                      F.count_if(~F.col(K.PREDICTION).between(seen["lo"], seen["hi"])).alias("n_outside"),
                      F.count_distinct(K.ZONE).alias("n_zones")).first()
    return aggregates.split_summary(m, split).withColumns(
        {k: F.lit(v) for k, v in facts.asDict().items()} | {"n_measured": F.lit(metrics.first()["n"])})


def q_forest_predict(spark, d):
    *_, zoned, _ = jobs.profile_and_forecast(master(spark, d), with_silhouette=False)
    return zoned.select(K.SEQ, K.TRANSLATED, K.YEAR, K.VAL, K.PREDICTION, K.ZONE, K.PROFILE)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
