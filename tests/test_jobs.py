"""Composite jobs C1-C7 on a small domain fixture with the original
vocabulary (FIXTURES e12, e15, e16, e25 and the end-to-end flow)."""

import pytest
from pyspark.sql import functions as F

from panelrisk import constants as K
from panelrisk.operators import setops
from panelrisk.plans import jobs

M = K.MAP_MEASURE


@pytest.fixture
def panel(df):
    rows = [
        (1, "Jepang", M, "Laju", 2022, 100.0), (2, "Jepang", M, "Laju", 2023, 120.0),
        (3, "Indonesia", M, "Laju", 2022, 800.0), (4, "Indonesia", M, "Laju", 2023, 760.0),
        (5, "Peru", M, "Laju", 2023, 300.0), (6, "Laut Kaspia", M, "Laju", 2023, 5.0),
        (7, "Amerika Serikat", M, "Laju", 2023, 50.0), (8, "Jepang", M, "Angka", 2023, 9000.0),
        (9, "Chili", M, "Laju", 2023, None), (10, "Chili", M, "Laju", 2021, 700.0),
    ]
    return df(rows, "seq long, location_name string, measure_name string, metric_name string, year int, val double")


@pytest.fixture
def covs(df):
    gdp = df([("Japan", "C", 2022, 40000.0), ("Japan", "C", 2023, 41000.0), ("Indonesia", "C", 2023, 4000.0)],
             "Entity string, Code string, Year int, `GDP per capita (US$)` double")
    pop = df([("Japan", 2023, 340.0), ("Peru", 2023, 26.0), ("Peru", -100, 1.0)],
             "Entity string, Year int, density_km2 double")
    return gdp, pop


def test_integrate_panel_c1(panel, covs):
    gdp, pop = covs
    m = jobs.integrate_panel(panel, gdp, pop, impute_relative_error=0.0)
    rows = {r.seq: r for r in m.collect()}
    assert set(rows) == {1, 2, 3, 4, 5, 6, 7, 10}            # Angka and null val dropped
    assert rows[2].translated_location == "Japan" and rows[2].gdp_per_capita == 41000.0
    assert rows[7].translated_location == "United States"
    assert rows[5].pop_density == 26.0
    # medians over the joined rows: gdp {40000, 41000, 4000} -> 40000, pop {340, 26} -> 26
    assert rows[5].gdp_per_capita == 40000.0 and rows[3].pop_density == 26.0
    assert m.filter(F.col(K.GDP).isNull() | F.col(K.POP).isNull()).count() == 0


@pytest.fixture
def pred(df):
    rows = [("Japan", "Risiko Rendah", M, 2023, 1.0, 1.0, 120.0, 118.0, "Rendah", 2),
            ("Indonesia", "Risiko Tinggi", M, 2023, 1.0, 1.0, 760.0, 700.0, "Tinggi", 4),
            ("Indonesia", "Risiko Tinggi", M, 2023, 1.0, 1.0, 760.0, 650.0, "Sedang", 9),
            ("Japan", "Risiko Rendah", "Deaths", 2023, 1.0, 1.0, 5.0, 5.0, "Rendah", 11),
            ("Chili", "Risiko Sedang", M, 2021, 1.0, 1.0, 700.0, 690.0, "Sedang", 10),
            ("Chili", "Risiko Tinggi", M, 2019, 1.0, 1.0, 700.0, 690.0, "Tinggi", 12)]
    return df(rows, "translated_location string, profil_negara string, measure_name string, year int, "
                    "gdp_per_capita double, pop_density double, val double, prediction double, "
                    "cluster_risiko string, seq long")


@pytest.fixture
def upload(df):
    rows = [(1, "Finlandia", "Rate", 700.0), (2, "Finlandia", "Number", 11.0),
            (3, "Finlandia", "Number", 12.0), (4, "Botswana", "Rate", 100.0), (5, "Japan", "Rate", 999.0)]
    return df(rows, "seq long, location_name string, metric_name string, val double")


@pytest.fixture
def master(df):
    rows = [(1, "Japan", "Japan", M, "Laju", 2023, 120.0, 1.0, 1.0),
            (2, "Japan", "Japan", M, "Angka", 2023, 9000.0, 1.0, 1.0),
            (3, "Peru", "Peru", "Deaths", "Laju", 2023, 700.0, 2.0, 3.0),
            (4, "Peru", "Peru", M, "Laju", 2023, 10.0, 2.0, 3.0),
            (5, "Chili", "Chili", M, "Laju", 2023, 300.0, 5.0, 6.0),
            (6, "Nowhere", "Nowhere", M, "Laju", 2020, 1.0, 1.0, 1.0),
            (7, "Caspian Sea", "Caspian Sea", M, "Laju", 2023, 1.0, 1.0, 1.0)]
    return df(rows, "seq long, location_name string, translated_location string, measure_name string, "
                    "metric_name string, year int, val double, gdp_per_capita double, pop_density double")


def test_classify_upload_c4_e19(upload):
    out = {r.translated_location: r for r in jobs.classify_upload(upload).collect()}
    assert out["Finland"].cluster_risiko == "Tinggi" and out["Finland"].jumlah_kasus_absolut == 11.0
    assert out["Botswana"].cluster_risiko == "Rendah" and out["Botswana"].jumlah_kasus_absolut is None
    assert out["Finland"].prediction == 700.0 and out["Finland"].year == K.MAP_YEAR


def test_assemble_results_count_join_c5(pred, master, upload):
    a = jobs.assemble_results(pred, master, jobs.classify_upload(upload))
    rows = a.filter(F.col("source_rank") == 0).collect()
    assert sorted(r.seq for r in rows) == [2, 4, 9]            # 2023 + DALY pattern only
    assert {r.seq: r.jumlah_kasus_absolut for r in rows}[2] == 9000.0


def test_count_join_without_metric_column_e25(pred, master, upload):
    a = jobs.assemble_results(pred, master.drop("metric_name"), jobs.classify_upload(upload))
    assert a.filter(F.col(K.COUNT_VAL).isNotNull()).count() == 1  # only the upload's own count


def test_backfill_c6_e15_e16(pred, master, upload):
    a = jobs.assemble_results(pred, master, jobs.classify_upload(upload))
    fb = {r.translated_location: r for r in jobs.fallback_backfill(a, pred, master).collect()}
    assert "Nowhere" not in fb                                  # e16: no 2023 master row
    assert fb["Peru"].val == 700.0 and fb["Peru"].cluster_risiko == "Tinggi"   # e15: first row, any measure
    assert fb["Peru"].profil_negara == "Risiko Tinggi" and fb["Peru"].prediction == 700.0
    assert fb["Chili"].cluster_risiko == "Sedang"               # newest history label (2021)
    assert "Japan" not in fb


def test_final_entity_table_c7(pred, master, upload):
    a = jobs.assemble_results(pred, master, jobs.classify_upload(upload))
    fb = jobs.fallback_backfill(a, pred, master)
    final = jobs.final_entity_table(setops.union_by_name(a, fb))
    rows = final.collect()
    names = [r.translated_location for r in rows]
    assert len(names) == len(set(names))                        # one row per entity
    assert "Caspian Sea" not in names                           # water body dropped
    got = {r.translated_location: r for r in rows}
    assert got["Japan"].prediction == 118.0                     # prediction beats the upload (e12)
    assert got["Indonesia"].cluster_risiko == "Tinggi"          # first prediction row (e13)
    zones = [r.cluster_risiko for r in rows]
    assert zones == sorted(zones, key=["Rendah", "Sedang", "Tinggi"].index)
    cov = {r.name: r.status for r in jobs.watchlist(final).collect()}
    assert cov["Peru"] == "mapped" and cov["Finland"] == "mapped" and cov["Bolivia"] == "failed"
    assert jobs.map_ready(final).count() == final.count()


def test_medians_are_those_of_the_joined_rows(spark, df):
    """Weights of the counted keys against the joined rows, with covariate rows that repeat and fan out."""
    from panelrisk.operators import features
    rows = [(i, f"E{i * i % 7}", "m", "Laju", 2000 + i % 3, float(i)) for i in range(200)]
    panel = df(rows, "seq long, location_name string, measure_name string, metric_name string, year int, val double")
    gdp = df([(f"E{k % 5}", 2000 + k % 3, float(k * 37 % 101)) for k in range(20)], "Entity string, Year int, gdp double")
    pop = df([(f"E{k % 6}", 2000 + k % 4, float(k * 53 % 97)) for k in range(30)], "Entity string, Year int, density double")
    kw = {"dictionary": {}, "impute_relative_error": 0.0}
    joined = jobs.integrate_panel(panel, gdp, pop, impute=False, **kw)
    assert joined.count() > 200
    want = features.median_impute(joined, [K.GDP, K.POP], 0.0)
    got = jobs.integrate_panel(panel, gdp, pop, **kw)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() == joined.count()


def test_every_line_item_is_an_upload_row(spark):
    from panelrisk.plans import views
    sf = "/root/testdata/sf0.001"
    up = views.uploads(spark, sf)
    n = views.table(spark, sf, "lineitem").count()
    assert up.count() == n and sorted(r.seq for r in up.select("seq").collect()) == list(range(n))


def test_final_table_writes_the_panel_twice(spark):
    """The rate master and the predictions; nothing else of the panel's size but the upload itself."""
    import os

    from panelrisk.plans import catalog
    from panelrisk.session import owned_work
    with owned_work(spark) as folders:
        assert catalog.q_final_entity_table(spark, "/root/testdata/sf0.001").count() > 0
        kinds = sorted(f.split("/")[-2] for f in folders)
        assert all(os.path.exists(f.removeprefix("file://")) for f in folders)
    assert kinds == ["covariate"] * 4 + ["curated_master", "numbered", "predictions"]


def _upload_names(df):
    cols = ("translated_location string, risiko string, seq bigint, source_rank int")
    rows = [("guinea-BISSAU", "High", 4, 1), ("Guinea-Bissau", "Low", 3, 1), (" guinea-bissau", "Medium", 1, 2),
            ("Nation 1", "Low", 2, 0), ("NATION 1", "High", 1, 0), (None, "Low", 1, 0), ("Peru", None, 1, 0)]
    d = df(rows, cols).withColumnsRenamed({"risiko": K.ZONE})
    for c, t in ((K.LOCATION, "string"), (K.YEAR, "int"), (K.MEASURE, "string"), (K.METRIC, "string"),
                 (K.VAL, "double"), (K.PREDICTION, "double"), (K.PROFILE, "string")):
        d = d.withColumn(c, F.lit(None).cast(t))
    return d


def _below_first_rows(frame):
    """The optimized plan below the last aggregate: what is done to every row."""
    plan = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return "\n".join(plan[max(i for i, line in enumerate(plan) if "Aggregate" in line) + 1:])


def test_names_are_written_out_once_each_not_in_every_row(df):
    """neither the title case nor the keyword filter is moved down to all rows."""
    final = jobs.final_entity_table(_upload_names(df))
    got = {r[K.TRANSLATED]: (r[K.ZONE], r["n"]) for r in final.withColumn("n", F.lit(1)).collect()}
    assert got == {"Guinea-Bissau": ("Low", 1), "Nation 1": ("High", 1)}
    below = _below_first_rows(jobs.map_ready(final))
    assert "initcap" not in below and "RLIKE" not in below.upper()


def test_watched_names_are_looked_up_among_first_rows(df):
    """the filter on watched names stays above the first rows."""
    audit = jobs.watchlist(jobs.final_entity_table(_upload_names(df)), ["Guinea-Bissau", "Peru"])
    assert [(r["pos"], r[K.ZONE], r["status"]) for r in audit.orderBy("pos").collect()] == [
        (0, "Low", "mapped"), (1, None, "failed")]
    assert "initcap" not in _below_first_rows(audit)


def test_uploads_are_reduced_to_first_rows_once(spark):
    """back-filling and the final table read the first row of each name, not all uploads each."""
    from panelrisk.plans import catalog
    from panelrisk.session import owned_work
    with owned_work(spark):
        final = catalog._final(spark, "/root/testdata/sf0.001")
        assert not [f for f in final.inputFiles() if "/numbered/" in f]
        assert final.count() > 0


def test_first_rows_give_the_same_final_table(spark, df):
    """back-filling and the final table of the first rows are those of all rows; names repeat or are null."""
    rows = _upload_names(df).withColumns({K.GDP: F.lit(1.0), K.POP: F.lit(None).cast("double")})
    rows = rows.unionByName(rows.withColumns({K.SEQ: F.col(K.SEQ) + 10, K.ZONE: F.lit("High")}))
    pred = df([("Peru", 1999, 1, "Low", "p"), ("Chad", 1999, 2, None, None)], "translated_location string, year int, "
              "seq bigint, risiko string, profile string").withColumnsRenamed({"risiko": K.ZONE, "profile": K.PROFILE})
    master = df([("Peru", K.MAP_YEAR, 1, 5.0, 1.0, 2.0), ("Peru", K.MAP_YEAR, 2, 9.0, 1.0, 2.0),
                 ("Chad", K.MAP_YEAR, 3, 500.0, None, 2.0), ("Nation 1", K.MAP_YEAR, 4, 1.0, 1.0, 1.0)],
                "translated_location string, year int, seq bigint, val double, gdp_per_capita double, pop_density double")

    def final(a, **kw):
        fb = jobs.fallback_backfill(a, pred, master, **kw)
        return jobs.final_entity_table(a.unionByName(fb, allowMissingColumns=True), sort=False)

    want = final(rows)
    got = final(jobs.first_classified(rows), entities=master.select(K.TRANSLATED).distinct())
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() == 4


def test_held_frames_go_with_their_run(spark):
    from panelrisk.session import held, owned_work
    frame = spark.range(5).withColumnRenamed("id", "held_frame")
    with owned_work(spark):
        assert held(frame).count() == 5 and frame.storageLevel.useMemory
    assert not frame.storageLevel.useMemory


def test_uploads_land_their_own_columns_only(spark):
    """the order's keys are not written with the numbered uploads."""
    from panelrisk.plans import views
    up = views.uploads(spark, "/root/testdata/sf0.001")
    folder = {f.rsplit("/", 1)[0] for f in up.inputFiles()}
    assert set(spark.read.parquet(*folder).columns) == {K.LOCATION, K.METRIC, K.VAL, "__at"}
