"""Composite jobs C1-C7: DataFrame -> DataFrame functions built from the
operators, lazy but for fits and what they land.  Medians, cuts, the split year and per-cluster
statistics are fetched as a few numbers and enter the plans as literals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import bands, casts, text
from ..functions.lookup import translate
from ..operators import aggregates, cluster, conform, dedupe, features, forecast, joins, setops
from ..operators import sort as sorting
from ..session import staged
from ..sources import lake

Dictionary = Mapping[str, str] | DataFrame


def _translate(df: DataFrame, column: str, dictionary: Dictionary, out: str) -> DataFrame:
    """Fixed dictionaries become a constant map; dictionaries that are data
    are joined (broadcast only when small, see ``joins.dictionary_join``)."""
    if isinstance(dictionary, DataFrame):
        return joins.dictionary_join(df, column, dictionary, out)
    return df.withColumn(out, translate(column, dictionary))


def _standardise(df: DataFrame, column: str, dictionary: Dictionary) -> DataFrame:
    """Replace from the dictionary, then strip (single pass)."""
    tmp = "__std"
    df = _translate(df, column, dictionary, tmp)
    return df.withColumn(column, text.py_strip(F.col(tmp))).drop(tmp)


# ---------------------------------------------------------------- C1
def _conformed(gdp_raw: DataFrame, pop_raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    gdp = conform.conform_covariate(gdp_raw, "gdp", K.GDP, "year_gdp", entity_name="country_gdp")
    pop = conform.conform_covariate(pop_raw, "density", K.POP, "year_pop", entity_name="country_pop",
                                    fallback="last", positive_year=True)
    return gdp, pop


def _with_covariate(panel: DataFrame, cov: DataFrame, entity: str, year: str, require_unique: bool,
                    salt_rows: int | None) -> DataFrame:
    """Left join of a yearly covariate.  One that the planner will broadcast leaves
    the panel where it is; a larger one is met with hot (entity, year) keys
    of the panel dealt out."""
    keys, own = [K.TRANSLATED, K.YEAR], [entity, year]
    if salt_rows is None and joins.broadcastable(cov):
        return joins.left_join_on(panel, cov, keys, own, require_unique=require_unique)
    if require_unique:
        joins.assert_unique(cov, own)
    spread = [c for c, t in panel.dtypes if t in features.SORTABLE]
    return joins.salted_left_join(panel, cov, keys, own, spread, least_rows=salt_rows or joins.SALT_ROWS)


def integrate_panel(panel: DataFrame, gdp_raw: DataFrame, pop_raw: DataFrame,
                    dictionary: Dictionary = K.JOIN_STAGE_NAMES,
                    metric: str | None = K.METRIC_RATE,
                    impute_relative_error: float = K.IMPUTE_RELATIVE_ERROR,
                    impute: bool = True, require_unique: bool = False,
                    salt_rows: int | None = None) -> DataFrame:
    """Fact panel + two yearly covariates -> curated master.

    drop incomplete rows -> one metric -> translate entity names ->
    conform covariates (value column found by name) -> two left joins on
    (entity, year) -> typed projection -> median imputation.  The
    covariates are (entity x year) tables; the planner broadcasts them
    while they are under the size threshold, and salted joins meet them
    otherwise (``salt_rows``: always, with so many rows of a key to a salt).

    The medians are those of the joined rows, taken without joining
    them: the panel is counted by (entity, year), the counts are joined, and a
    covariate's value weighs as much as the rows it meets.  So the joined rows
    are computed once, by whoever writes or reads the master."""
    p = conform.drop_missing(panel, K.PANEL_REQUIRED)
    if metric is not None:
        p = conform.slice_equal(p, K.METRIC, metric)
    p = _translate(p, K.LOCATION, dictionary, K.TRANSLATED)
    gdp, pop = _conformed(gdp_raw, pop_raw)
    j = _with_covariate(p, gdp, "country_gdp", "year_gdp", require_unique, salt_rows)
    j = _with_covariate(j, pop, "country_pop", "year_pop", require_unique, salt_rows)
    keep = ([K.SEQ] if K.SEQ in panel.columns else []) + [
        K.LOCATION, K.TRANSLATED, K.MEASURE, K.METRIC, K.YEAR, K.VAL, K.GDP, K.POP]
    master = conform.typed_projection(j, {c: {K.YEAR: "int", K.VAL: "double", K.GDP: "double",
                                              K.POP: "double"}.get(c, "keep") for c in keep})
    if impute:
        # counted once: the medians take a pass for every refinement of their bins
        counted = _covariates_by_rows(p, gdp, pop).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            master = features.median_impute(master, [K.GDP, K.POP], impute_relative_error,
                                            fit_on=counted, weight="__rows")
        finally:
            counted.unpersist()
    return master


def _covariates_by_rows(panel: DataFrame, gdp: DataFrame, pop: DataFrame) -> DataFrame:
    """``(gdp, pop, __rows)``: what the joined panel holds in its covariate columns, one row for
    each (entity, year) and pair of matches instead of one for each panel row."""
    keys = panel.groupBy(K.TRANSLATED, K.YEAR).agg(F.count(F.lit(1)).alias("__rows"))
    j = joins.left_join_on(keys, gdp, [K.TRANSLATED, K.YEAR], ["country_gdp", "year_gdp"])
    j = joins.left_join_on(j, pop, [K.TRANSLATED, K.YEAR], ["country_pop", "year_pop"])
    return j.select("__rows", *[casts.safe_double(c).alias(c) for c in (K.GDP, K.POP)])


def curate(master: DataFrame, path: str, partition_by: Sequence[str] = (K.YEAR,)) -> DataFrame:
    """Land the master in the curated zone and continue from the files
    (a durable lineage cut; year-partitioned for pruning)."""
    return lake.roundtrip(master, path, "parquet", partition_by=list(partition_by))


# ---------------------------------------------------------------- C2
PROFILE_FEATURES = (K.GDP, K.POP, K.VAL, K.YEAR)


def _fit_profiles(data: DataFrame, features_: Sequence[str], fit_years_upto: int | None, **kw):
    """``(model, mapping)``: k-means fitted on laid-out rows, and its ranked labels."""
    fit_on = data.filter(F.col(K.YEAR) <= fit_years_upto) if fit_years_upto is not None else None
    model, out = cluster.fit_clusters(data, list(features_), fit_on=fit_on, **kw)
    return model, cluster.rank_mapping(out)


def _profiled(model, mapping: dict, df: DataFrame) -> DataFrame:
    """Rows of ``df`` with cluster and profile: a projection."""
    return cluster.rank_labels(model.transform(df), mapping=mapping)


def profile_clusters(master: DataFrame, features_: Sequence[str] = PROFILE_FEATURES,
                     key: Sequence[str] = (K.SEQ,), partitions: int | None = None,
                     fit_years_upto: int | None = None, with_silhouette: bool = True, **kw):
    """Bisecting k-means on standardised features; clusters ranked by mean
    value into profile labels.  Returns ``(model, labelled, silhouette)``
    (silhouette ``None`` when not asked for).  The fit sees a deterministic
    layout (same model from any partitioning), held only while fitting;
    ``labelled`` is a projection of the master itself, so reading it
    shuffles nothing.

    The original fits on all rows, including the value it later forecasts
    and the test years; ``fit_years_upto`` fits the scaler and k-means on
    ``year <= fit_years_upto`` only and labels every row."""
    data = features.stable_layout(master, list(key), partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model, mapping = _fit_profiles(data, features_, fit_years_upto, **kw)
    finally:
        data.unpersist()
    labelled = _profiled(model, mapping, master)
    sil = (cluster.silhouette(labelled, "scaled_cluster_features", K.CLUSTER, dim=len(features_))
           if with_silhouette else None)
    return model, labelled, sil


# ---------------------------------------------------------------- C3
def forecast_zones(labelled: DataFrame, key: Sequence[str] = (K.SEQ,),
                   split_relative_error: float = K.SPLIT_RELATIVE_ERROR,
                   zone_relative_error: float = K.ZONE_RELATIVE_ERROR, **kw):
    """Temporal split -> forest -> scored test rows -> quantile zones.
    Returns ``(split, model, zoned, metrics)``.

    None of the steps follows the layout of the rows (sketch quantiles, draws by a hash of
    ``key``), so ``labelled`` is read as it stands.  The forest scores the test
    rows once: they are dealt to as many tasks as there are cores (a file of the last year
    would be one task's), landed in the shared
    folder, and zones, metrics and every reader start at those files."""
    columns = labelled.columns
    split, train, test = forecast.temporal_split(labelled, relative_error=split_relative_error)
    model = forecast.fit_forest(train, key, **kw)
    test = test.repartition(test.sparkSession.sparkContext.defaultParallelism)
    pred = staged(model.transform(test).select(*columns, K.PREDICTION), "lake", "scored")
    zoned = forecast.quantile_zones(pred, relative_error=zone_relative_error)
    return split, model, zoned, forecast.regression_metrics(pred)


def profile_and_forecast(master: DataFrame, key: Sequence[str] = (K.SEQ,),
                         partitions: int | None = None, with_silhouette: bool = True,
                         split_relative_error: float = K.SPLIT_RELATIVE_ERROR, **forest_kw):
    """C2 then C3: the profiles fitted in C2 are a feature of the forest.
    Returns ``(cluster_model, labelled, silhouette, split, forest_model,
    zoned, metrics)``; the frames read the master and the landed scores."""
    cmodel, labelled, sil = profile_clusters(master, key=key, partitions=partitions, with_silhouette=with_silhouette)
    labelled = labelled.drop("raw_cluster_features", "scaled_cluster_features")
    split, fmodel, zoned, metrics = forecast_zones(labelled, key, split_relative_error, **forest_kw)
    return cmodel, labelled, sil, split, fmodel, zoned, metrics


# ---------------------------------------------------------------- C4
def classify_upload(upload: DataFrame, dictionary: Dictionary = K.MAP_STAGE_NAMES,
                    rate: str = K.UPLOAD_METRIC_RATE, count: str = K.UPLOAD_METRIC_COUNT,
                    year: int = K.MAP_YEAR, measure: str = K.MAP_MEASURE,
                    metric: str = K.MAP_METRIC, low: float = K.FIXED_LOW_CUT,
                    high: float = K.FIXED_HIGH_CUT, upload_column: str | None = None,
                    order: Sequence[str] = (K.SEQ,), hold: bool = False) -> DataFrame:
    """Uploaded rate rows -> classified map rows.  Each rate row gets fixed
    bands and the value of the *first* count row (by ``order``) of the same entity; with
    ``upload_column``, of the same entity in the same upload, which may be many files.
    ``hold``: see ``first_match_lookup``."""
    up = _standardise(upload, K.LOCATION, dictionary)
    rates = conform.slice_equal(up, K.METRIC, rate)
    counts = conform.slice_equal(up, K.METRIC, count)
    of = [upload_column] if upload_column else []
    j = joins.first_match_lookup(rates, counts, [K.LOCATION, *of], K.VAL, list(order), K.COUNT_VAL, hold=hold)
    j = j.drop(*[f"__o_{c}" for c in order])
    zone = bands.fixed_band(K.VAL, low, high)
    return j.select(
        F.col(K.LOCATION), F.col(K.LOCATION).alias(K.TRANSLATED),
        F.lit(measure).alias(K.MEASURE), F.lit(metric).alias(K.METRIC),
        F.lit(year).cast("int").alias(K.YEAR), F.col(K.VAL), F.col(K.VAL).alias(K.PREDICTION),
        zone.alias(K.ZONE), bands.profile_from_zone(zone).alias(K.PROFILE),
        F.col(K.COUNT_VAL), *[F.col(c) for c in order], *[F.col(c) for c in of])


# ---------------------------------------------------------------- C5
def assemble_results(pred: DataFrame, master: DataFrame, classified_upload: DataFrame,
                     year: int = K.MAP_YEAR, pattern: str = K.MAP_MEASURE_PATTERN,
                     count_metric: str = K.METRIC_COUNT, counts: DataFrame | None = None,
                     duplicates: str = "multiply") -> DataFrame:
    """Predictions of the map year whose measure matches, with the real
    counts joined on (entity, year, measure) null-safely, stacked over the
    classified uploads.  ``source_rank``/``seq``/``sub_seq`` keep the
    original row order for keep-first de-duplication.

    A count key that repeats multiplies the prediction rows, as a pandas
    merge does; ``duplicates`` may ask for ``"first"`` or ``"error"``
    instead.  ``counts``: the count rows, where they are not the master's."""
    pf = conform.year_and_pattern(pred, year, pattern)
    if K.METRIC in master.columns:
        if counts is None:
            counts = conform.slice_equal(master, K.METRIC, count_metric)
        keys = [K.TRANSLATED, K.YEAR, K.MEASURE]
        cnt = counts.select(*keys, F.col(K.VAL).alias(K.COUNT_VAL), F.col(K.SEQ).alias("sub_seq"))
        if duplicates == "error":
            joins.assert_unique(cnt, keys)
        elif duplicates == "first":
            cnt = dedupe.keep_first(cnt, keys, ["sub_seq"])
        elif duplicates != "multiply":
            raise ValueError(f"duplicates: {duplicates!r}")
        pf = joins.left_join_null_safe(pf, cnt, keys)
    else:
        pf = conform.ensure_columns(pf, {K.COUNT_VAL: "double", "sub_seq": "bigint"})
    return setops.union_by_name(pf.withColumn("source_rank", F.lit(0)),
                                classified_upload.withColumn("source_rank", F.lit(1)))


# ---------------------------------------------------------------- C6
def fallback_backfill(assembled: DataFrame, pred: DataFrame, master: DataFrame,
                      year: int = K.MAP_YEAR, measure: str = K.MAP_MEASURE,
                      metric: str = K.MAP_METRIC, low: float = K.FIXED_LOW_CUT,
                      high: float = K.FIXED_HIGH_CUT, entities: DataFrame | None = None) -> DataFrame:
    """One row for every master entity that has no classified row yet,
    provided the master has a row of the map year (its first one, any
    measure).  The label is the entity's newest history label, else the
    fixed bands of the actual value.  All lookups are per-entity partial
    aggregates (skew-safe) joined on the entity.  ``entities``: rows that name the
    master's entities, where fewer than the master's do."""
    ents = aggregates.distinct_values(master if entities is None else entities, K.TRANSLATED).withColumnRenamed(K.TRANSLATED, "ent")
    classified = assembled.filter(F.col(K.ZONE).isNotNull())
    missing = joins.anti_join(ents, classified, "ent", K.TRANSLATED)
    cur = dedupe.keep_first(
        master.filter(F.col(K.YEAR) == F.lit(year))
              .select(K.TRANSLATED, K.SEQ, K.VAL, K.GDP, K.POP), [K.TRANSLATED], [K.SEQ])
    hist = dedupe.latest_per_key(
        pred.filter(F.col(K.ZONE).isNotNull()).select(K.TRANSLATED, K.YEAR, K.SEQ, K.ZONE, K.PROFILE),
        [K.TRANSLATED])
    hist = hist.select(F.col(K.TRANSLATED).alias("__h"), F.col(K.ZONE).alias("__hz"),
                       F.col(K.PROFILE).alias("__hp"), F.lit(True).alias("__has"))
    j = (missing.join(cur, missing["ent"] == cur[K.TRANSLATED], "inner")
                .join(hist, F.col("ent") == F.col("__h"), "left"))
    band = bands.fixed_band(K.VAL, low, high)
    has = F.col("__has").isNotNull()
    return j.select(
        F.col("ent").alias(K.TRANSLATED), F.col("ent").alias(K.LOCATION),
        F.lit(year).cast("int").alias(K.YEAR), F.lit(measure).alias(K.MEASURE),
        F.lit(metric).alias(K.METRIC), F.col(K.VAL), F.col(K.VAL).alias(K.PREDICTION),
        F.when(has, F.col("__hz")).otherwise(band).alias(K.ZONE),
        F.when(has, F.col("__hp")).otherwise(bands.profile_from_zone(band)).alias(K.PROFILE),
        F.col(K.GDP), F.col(K.POP), F.col(K.SEQ), F.lit(2).alias("source_rank"))


# ---------------------------------------------------------------- C7
FINAL_COLUMNS = [K.TRANSLATED, K.LOCATION, K.YEAR, K.MEASURE, K.METRIC, K.VAL, K.PREDICTION,
                 K.ZONE, K.PROFILE, K.COUNT_VAL, K.GDP, K.POP]


def _source_order() -> list[Column]:
    return [F.col("source_rank"), F.col(K.SEQ), F.coalesce(F.col("sub_seq"), F.lit(-1))]


def first_classified(rows: DataFrame) -> DataFrame:
    """The first classified row of every name as it stands: all that the final table, and
    back-filling, take from assembled rows."""
    rows = conform.ensure_columns(rows, {K.COUNT_VAL: "double", "sub_seq": "bigint",
                                         K.GDP: "double", K.POP: "double"})
    r = rows.filter(F.col(K.ZONE).isNotNull()).select(*FINAL_COLUMNS, "source_rank", K.SEQ, "sub_seq")
    return dedupe.keep_first(r.withColumn("__name", F.col(K.TRANSLATED)), ["__name"], _source_order()).drop("__name")


def final_entity_table(rows: DataFrame, fixups: Mapping[str, str] = K.MAP_NAME_FIXUPS,
                       keywords: Sequence[str] = K.EXCLUDE_KEYWORDS,
                       order: Sequence[str] = K.ZONE_LABELS, sort: bool = True) -> DataFrame:
    """Title-case + fix-up names, drop unclassified rows, keep the first row
    per entity (source order), drop unnamed entities and water bodies, and
    sort by zone (Low < Medium < High, others last)."""
    name = translate(text.py_strip(text.py_title(K.TRANSLATED)), fixups)
    # The first row of every name as it stands, then of those the first of every written-out
    # name: names are written out once each.  The name is taken from the row that is kept, not from the
    # key, else the planner moves the filters below down to all rows, patterns included.
    r = dedupe.keep_first(first_classified(rows).withColumn(K.TRANSLATED, name), [K.TRANSLATED], _source_order())
    r = r.filter(F.col(K.TRANSLATED).isNotNull())
    r = conform.exclude_keywords(r, K.TRANSLATED, keywords)
    r = r.select(*FINAL_COLUMNS)
    return sorting.ordered_category_sort(r, K.ZONE, order, [K.TRANSLATED]) if sort else r


def map_ready(final: DataFrame) -> DataFrame:
    """Columns a choropleth layer needs: key, zone (+ its rank for the
    legend order) and the hover fields (formatting is the renderer's job)."""
    return final.select(
        F.col(K.TRANSLATED).alias("location"),
        F.col(K.ZONE).alias("zone"),
        bands.ordinal(K.ZONE).alias("zone_rank"),
        F.col(K.YEAR).alias("year"), F.col(K.MEASURE).alias("category"),
        F.col(K.COUNT_VAL).alias("cases_absolute"),
        F.col(K.VAL).alias("actual_rate"), F.col(K.PREDICTION).alias("predicted_rate"),
        F.col(K.PROFILE).alias("cluster_profile"),
        F.col(K.GDP).alias("gdp_per_capita"), F.col(K.POP).alias("pop_density"))


def watchlist(final: DataFrame, names: Sequence[str] = K.WATCH_LIST) -> DataFrame:
    return joins.watchlist_coverage(final, names, K.TRANSLATED, K.ZONE)
