"""The two user-level programs of the original, on files.

``forecast_run``: many panel CSV files + two covariate CSV files -> raw
zone -> curated master -> clusters -> forest -> zones -> prediction export,
metrics report and ingest counts.

``map_run``: prediction export + master + an uploaded CSV -> classified,
back-filled, one-row-per-entity map table (+ map-ready projection and
watch-list audit).

Both are thin compositions of the operators; every output is written by
the executors into ``out_dir`` (a shared folder).  Command line:

    python -m panelrisk.plans.batch forecast --panel 'in/IHME-*.csv' \\
        --gdp in/gdp.csv --pop in/density.csv --out lake/
    python -m panelrisk.plans.batch map --predictions lake/predictions \\
        --master lake/curated_master --upload 'in/upload.csv' --out lake/
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import bands
from ..operators import aggregates, conform, forecast, setops
from ..operators import sort as sorting
from ..session import owned_work
from ..sources import csv as csv_src
from ..sources import lake
from . import jobs

PANEL_TYPES = {K.LOCATION: "string", K.MEASURE: "string", K.METRIC: "string",
               K.YEAR: "int", K.VAL: "double"}
PRED_TYPES = {K.TRANSLATED: "string", K.PROFILE: "string", K.MEASURE: "string", K.YEAR: "int",
              K.GDP: "double", K.POP: "double", K.VAL: "double", K.PREDICTION: "double",
              K.ZONE: "string"}
UPLOAD_TYPES = {K.LOCATION: "string", K.METRIC: "string", K.VAL: "double"}


def _read_text_csv(spark: SparkSession, paths, types: Mapping[str, str] | None = None,
                   with_seq: bool = False, null_tokens: bool = False) -> DataFrame:
    """Header CSV read as text (no inference job), then safe casts of the
    named columns; the CSV parser skips the columns that are not needed.
    With ``null_tokens`` the texts that pandas reads as missing become null.
    No matching file raises ``FileNotFoundError``."""
    r = csv_src.read_csv_files(spark, paths, schema=None, with_seq=False, infer=False)
    if types:
        missing = [c for c in types if c not in r.columns]
        if missing:
            raise ValueError(f"{paths}: missing columns {missing}")
        r = r.select(*types)
    if null_tokens:
        r = csv_src.normalise_null_tokens(r)
    if types:
        r = conform.safe_casts(r, {c: t for c, t in types.items() if t != "string"})
    return csv_src.with_input_order(r, paths=[paths] if isinstance(paths, str) else paths) if with_seq else r


def forecast_run(spark: SparkSession, panel_paths: str | Sequence[str], gdp_path: str,
                 pop_path: str, out_dir: str, dictionary: Mapping[str, str] = K.JOIN_STAGE_NAMES,
                 metric: str = K.METRIC_RATE, partitions: int | None = None,
                 target: str = K.TARGET_ENTITY, **forest_kw) -> dict:
    """Ingest -> lake -> C1 -> C2 -> C3 -> exports and reports (one folder
    each; ``target`` is the entity reported on its own).  Returns the main
    frames and the paths written."""
    out = out_dir.rstrip("/")
    panel = _read_text_csv(spark, panel_paths, PANEL_TYPES, with_seq=True)
    panel = conform.drop_missing(panel, [K.VAL])
    gdp_raw = _read_text_csv(spark, gdp_path)
    pop_raw = _read_text_csv(spark, pop_path)
    counts = aggregates.row_counts({"panel": panel, "gdp": gdp_raw, "pop_density": pop_raw})

    # Raw zone: land each source, continue from the files.
    panel = lake.roundtrip(panel.drop("source_file"), f"{out}/raw/panel",
                           casts={K.VAL: "double", K.YEAR: "int"})
    gdp_raw = lake.roundtrip(gdp_raw, f"{out}/raw/gdp")
    pop_raw = lake.roundtrip(pop_raw, f"{out}/raw/pop_density")

    before, integrated = (jobs.integrate_panel(panel, gdp_raw, pop_raw, dictionary=dictionary, metric=metric,
                                               impute=impute) for impute in (False, True))
    before = aggregates.null_profile(before, [K.VAL, K.GDP, K.POP])
    master = jobs.curate(integrated, f"{out}/curated_master")

    _, labelled, sil, split, model, zoned, metrics = jobs.profile_and_forecast(
        master, partitions=partitions, **forest_kw)
    lake.export_csv(zoned, f"{out}/predictions", [*K.EXPORT_COLUMNS, K.SEQ])

    summary = aggregates.split_summary(master, split)
    m, s = metrics.first(), sil.first()
    report = summary.select(F.lit("Random Forest").alias("model"), "split_year", "training_rows",
                            "testing_rows", F.lit(m["r_squared"]).alias("r_squared"),
                            F.lit(m["rmse"]).alias("rmse"), F.lit(m["mae"]).alias("mae"),
                            F.lit(s["silhouette"]).alias("silhouette_score"))
    lake.write_metrics(report, f"{out}/metrics")
    lake.land(counts, f"{out}/ingest_counts", "csv")
    reports = _forecast_reports(labelled, zoned, s["silhouette"], m["r_squared"], target)
    reports["null_profile"] = setops.union_by_name(
        before.withColumn("stage", F.lit("before")),
        aggregates.null_profile(master, [K.VAL, K.GDP, K.POP]).withColumn("stage", F.lit("after")))
    for name, frame in reports.items():
        lake.land(frame, f"{out}/reports/{name}", "csv")
    return {"master": master, "labelled": labelled, "predictions": zoned, "metrics": report,
            "null_profile_before": before, "counts": counts, "model": model, "reports": reports,
            "paths": {k: f"{out}/{k}" for k in ("curated_master", "predictions", "metrics")}
            | {k: f"{out}/reports/{k}" for k in reports}}


#: Rows of the two bounded reports: the highest predictions and the drawn sample.
TOP_K = 10
SAMPLE_ROWS = 300


def _forecast_reports(labelled: DataFrame, zoned: DataFrame, silhouette: float | None,
                      r_squared: float | None, target: str) -> dict[str, DataFrame]:
    """The forecast program's reports, by name; each is small."""
    means = {"avg_val": K.VAL, "avg_gdp": K.GDP, "avg_pop_density": K.POP}
    scores = zoned.sparkSession.range(1).select(
        F.lit(silhouette).cast("double").alias("silhouette"), F.lit(r_squared).cast("double").alias("r_squared"))
    target_rows = zoned.filter(F.col(K.TRANSLATED) == F.lit(target))
    return {
        "cluster_profiles": aggregates.group_means(labelled, [K.CLUSTER, K.PROFILE], means, ["avg_val"]),
        "cluster_rows": aggregates.distribution(labelled, [K.CLUSTER, K.PROFILE]),
        "zone_distribution": aggregates.distribution(zoned, [K.ZONE]),
        "top_predictions": sorting.top_k(
            zoned.select(K.TRANSLATED, K.PROFILE, K.YEAR, K.VAL, K.PREDICTION, K.ZONE, K.SEQ),
            [F.col(K.PREDICTION).desc(), F.col(K.SEQ)], TOP_K).drop(K.SEQ),
        "entity_report": forecast.entity_report(zoned, labelled, target),
        "entity_zone": sorting.first_by_order(target_rows, K.ZONE, [K.YEAR, K.SEQ], [K.TRANSLATED]),
        "actual_vs_predicted": sorting.repeatable_sample(
            zoned.select(K.SEQ, K.VAL, K.PREDICTION), SAMPLE_ROWS, F.xxhash64(K.SEQ), F.col(K.VAL) > 0)
        .select(K.VAL, K.PREDICTION),
        "grades": scores.withColumns({
            "silhouette_grade": bands.grade("silhouette", K.SILHOUETTE_GRADES, K.SILHOUETTE_FLOOR_GRADE),
            "r2_grade": bands.grade("r_squared", K.R2_GRADES, K.R2_FLOOR_GRADE)}),
    }


def _read_input(spark: SparkSession, path: str, fmt: str, types: Mapping[str, str]) -> DataFrame:
    """A lake folder (``parquet``) or CSV files, safely cast, with ``seq``
    (kept when present, else input order)."""
    path = lake.resolve(spark, path)
    if fmt == "parquet":
        df = spark.read.parquet(path)
        if K.SEQ not in df.columns:
            df = csv_src.with_input_order(df, F.col("_metadata.row_index"), [path]).drop("source_file")
    else:
        df = _read_text_csv(spark, path, null_tokens=True)
        if K.SEQ not in df.columns:
            df = csv_src.with_input_order(df, paths=[path]).drop("source_file")
    casts = {c: t for c, t in types.items() if t != "string" and c in df.columns}
    casts[K.SEQ] = "bigint"
    return conform.safe_casts(df, casts)


def map_run(spark: SparkSession, predictions_path: str, master_path: str, upload_path: str,
            out_dir: str, dictionary: Mapping[str, str] = K.MAP_STAGE_NAMES,
            year: int = K.MAP_YEAR, pattern: str = K.MAP_MEASURE_PATTERN,
            watch: Sequence[str] = K.WATCH_LIST, predictions_format: str = "csv",
            master_format: str = "parquet") -> dict:
    """C4 -> C5 -> C6 -> C7 on files; writes the final table, the map-ready
    projection, the watch-list audit and the number of entities."""
    out = out_dir.rstrip("/")
    pred = _read_input(spark, predictions_path, predictions_format, PRED_TYPES)
    master = _read_input(spark, master_path, master_format,
                         {**PANEL_TYPES, K.GDP: "double", K.POP: "double"})
    upload = _read_text_csv(spark, upload_path, UPLOAD_TYPES, with_seq=True, null_tokens=True).drop("source_file")

    pred = jobs._standardise(pred, K.TRANSLATED, dictionary)
    master = jobs._standardise(master, K.TRANSLATED, dictionary)
    classified = jobs.classify_upload(upload, dictionary=dictionary, year=year)
    assembled = jobs.assemble_results(pred, master, classified, year=year, pattern=pattern)
    backfill = jobs.fallback_backfill(assembled, pred, master, year=year)
    final = jobs.final_entity_table(setops.union_by_name(assembled, backfill))
    final = lake.roundtrip(final, f"{out}/final_map_table")
    ready = jobs.map_ready(final)
    lake.land(ready, f"{out}/map_ready", "csv")
    audit = jobs.watchlist(final, watch)
    lake.land(audit, f"{out}/watchlist", "csv")
    entities = aggregates.distinct_counts(final, [K.TRANSLATED]).withColumnRenamed(K.TRANSLATED, "entities")
    lake.land(entities, f"{out}/entity_count", "csv")
    return {"final": final, "map_ready": ready, "watchlist": audit, "entities": entities}


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="panelrisk.plans.batch")
    sub = p.add_subparsers(dest="cmd", required=True)
    f = sub.add_parser("forecast")
    f.add_argument("--panel", required=True, nargs="+")
    f.add_argument("--gdp", required=True)
    f.add_argument("--pop", required=True)
    f.add_argument("--out", required=True)
    m = sub.add_parser("map")
    m.add_argument("--predictions", required=True)
    m.add_argument("--master", required=True)
    m.add_argument("--upload", required=True)
    m.add_argument("--predictions-format", choices=["csv", "parquet"], default="csv")
    m.add_argument("--master-format", choices=["csv", "parquet"], default="parquet")
    m.add_argument("--out", required=True)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"panelrisk-{a.cmd}").getOrCreate()
    with owned_work(spark):                       # results are in ``out``; work folders go
        if a.cmd == "forecast":
            res = forecast_run(spark, a.panel, a.gdp, a.pop, a.out)
            res["metrics"].show(truncate=False)
        else:
            res = map_run(spark, a.predictions, a.master, a.upload, a.out,
                          predictions_format=a.predictions_format, master_format=a.master_format)
            res["watchlist"].show(truncate=False)


if __name__ == "__main__":
    main()
