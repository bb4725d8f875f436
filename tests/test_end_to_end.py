"""Both programs end to end on domain-vocabulary CSV files."""

import csv
import os

from pyspark.sql import functions as F

from panelrisk import constants as K
from panelrisk.plans import batch
from panelrisk.session import shared_path

COUNTRIES = {"Indonesia": 700.0, "Jepang": 20.0, "Brasil": 90.0, "Peru": 300.0,
             "Laut Kaspia": 1.0, "Rusia": 150.0, "Chili": 40.0}
ENGLISH = {"Jepang": "Japan", "Brasil": "Brazil", "Rusia": "Russia"}
MEASURES = [K.MAP_MEASURE, "Deaths"]


def _write(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def _fixture(base):
    hdr = ["measure_id", "measure_name", "location_id", "location_name", "sex_name", "age_name",
           "metric_name", "year", "val", "upper", "lower"]
    rows = []
    for i, (c, v) in enumerate(COUNTRIES.items()):
        for m, mult in zip(MEASURES, (1.0, 0.1)):
            for y in range(2015, 2024):
                rate = round(v * mult * (1 + (y - 2015) * 0.03), 3)
                rows.append([1, m, i, c, "Both", "All ages", "Laju", y, rate, rate * 1.1, rate * 0.9])
                rows.append([1, m, i, c, "Both", "All ages", "Angka", y, rate * 1000, "", ""])
    rows.append([1, MEASURES[0], 99, "Chili", "Both", "All ages", "Laju", 2016, "", "", ""])  # no val
    half = len(rows) // 2
    _write(f"{base}/in/IHME-GBD_2023_DATA-1.csv", hdr, rows[:half])
    _write(f"{base}/in/IHME-GBD_2023_DATA-2.csv", hdr, rows[half:])
    gdp = [[ENGLISH.get(c, c), "X", y, 1000.0 + 10 * i + y % 7]
           for i, c in enumerate(COUNTRIES) if c not in ("Rusia", "Laut Kaspia") for y in range(2015, 2024)]
    _write(f"{base}/in/gdp.csv", ["Entity", "Code", "Year", "GDP per capita, PPP (constant 2017 international $)"], gdp)
    pop = [[ENGLISH.get(c, c), "X", y, 50.0 + i] for i, c in enumerate(COUNTRIES) for y in range(2015, 2024)]
    pop.append(["Peru", "X", -100, 1.0])
    _write(f"{base}/in/pop.csv", ["Entity", "Code", "Year", "Population density"], pop)
    _write(f"{base}/in/upload.csv", ["location_name", "metric_name", "val"],
           [["Finlandia", "Rate", 700.0], ["Finlandia", "Number", 12.0], ["Finlandia", "Number", 13.0],
            ["Botswana", "Rate", 120.0], ["Indonesia", "Rate", 1.0]])


def test_forecast_then_map(spark):
    base = shared_path(spark, "t", "e2e")
    _fixture(base)
    res = batch.forecast_run(spark, f"{base}/in/IHME-*.csv", f"{base}/in/gdp.csv",
                             f"{base}/in/pop.csv", f"{base}/lake", trees=10)
    master = res["master"]
    assert master.filter(F.col(K.METRIC) != "Laju").count() == 0
    assert {r[0] for r in master.select(K.TRANSLATED).distinct().collect()} >= {"Japan", "Brazil", "Russia"}
    assert master.filter(F.col(K.GDP).isNull() | F.col(K.POP).isNull()).count() == 0
    m = res["metrics"].first()
    # 0.8 quantile of nine equally filled years 2015-2023 (the original also split at 2022)
    assert m.split_year == 2022 and m.training_rows + m.testing_rows == master.count()
    assert res["predictions"].filter(F.col(K.YEAR) <= m.split_year).count() == 0
    counts = {r.source: r.rows for r in res["counts"].collect()}
    assert counts["panel"] == 2 * len(COUNTRIES) * len(MEASURES) * 9

    reports = {k: spark.read.option("header", True).csv(res["paths"][k]).collect() for k in res["reports"]}
    rows = master.count()
    assert [r.stage for r in sorted(reports["null_profile"], key=lambda r: r.stage)] == ["after", "before"]
    assert {r.stage: r.gdp_per_capita == "0" for r in reports["null_profile"]} == {"before": False, "after": True}
    assert sum(int(r["count"]) for r in reports["cluster_rows"]) == rows
    assert len(reports["cluster_profiles"]) == K.CLUSTER_K
    assert sum(int(r["count"]) for r in reports["zone_distribution"]) == m.testing_rows
    top = [float(r.prediction) for r in reports["top_predictions"]]
    assert top == sorted(top, reverse=True) and len(top) == min(10, m.testing_rows)
    assert {r.translated_location for r in reports["entity_report"]} == {K.TARGET_ENTITY}
    assert len(reports["entity_zone"]) == 1 and reports["entity_zone"][0].cluster_risiko in K.ZONE_LABELS
    assert len(reports["actual_vs_predicted"]) == min(300, m.testing_rows)
    assert len(reports["grades"]) == 1

    out = batch.map_run(spark, f"{base}/lake/predictions", f"{base}/lake/curated_master",
                        f"{base}/in/upload.csv", f"{base}/map", dictionary=K.MAP_STAGE_NAMES)
    final = {r.translated_location: r for r in out["final"].collect()}
    assert len(final) == out["final"].count()                       # one row per entity
    assert "Laut Kaspia" not in final                               # water body removed
    assert final["Finland"].cluster_risiko == "Tinggi" and final["Finland"].jumlah_kasus_absolut == 12.0
    assert final["Indonesia"].prediction != 1.0                     # prediction beats the upload
    assert {r.cluster_risiko for r in final.values()} <= set(K.ZONE_LABELS)
    assert out["entities"].first()["entities"] == len(final)
    audit = {r.name: r.status for r in out["watchlist"].collect()}
    assert audit["Finland"] == "mapped" and audit["Bolivia"] == "failed" and audit["Peru"] == "mapped"


def test_parquet_without_seq_is_read_in_path_order(spark):
    """The smaller file comes first by name; scans pack the larger one first."""
    base = shared_path(spark, "t", "parquet_order")
    for name, lo, n in (("a", 0, 5), ("b", 5, 3000)):
        spark.range(lo, lo + n, 1, 1).select(F.col("id").cast("double").alias(K.VAL)).write.parquet(f"{base}/{name}")
    got = batch._read_input(spark, f"{base}/*", "parquet", {K.VAL: "double"}).orderBy(K.SEQ).collect()
    assert [r[K.VAL] for r in got] == [float(i) for i in range(3005)]
