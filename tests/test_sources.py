"""Sources and sinks (S1-S8)."""

import pytest
from pyspark.sql import functions as F

from panelrisk.session import shared_path
from panelrisk.sources import csv as csv_src
from panelrisk.sources import lake


def test_csv_glob_scan_and_guard(spark, df):
    base = shared_path(spark, "t", "glob")
    d = df([(i, f"n{i % 3}", float(i)) for i in range(30)], "seq long, name string, val double")
    lake.land(d.repartition(3), base, "csv")
    back = csv_src.read_csv_files(spark, f"{base}/part-*.csv", "seq long, name string, val double",
                                  with_seq=False)
    assert sorted(r.seq for r in back.collect()) == list(range(30))
    with pytest.raises(FileNotFoundError):
        csv_src.read_csv_files(spark, f"{base}/nothing-*.csv", "seq long")


def test_csv_seq_records_input_order(spark, df):
    base = shared_path(spark, "t", "seq")
    lake.land(df([(i,) for i in range(10)], "x long").coalesce(1), base, "csv")
    back = csv_src.read_csv_files(spark, base, "x long", with_seq=True)
    rows = back.orderBy("seq").collect()
    assert [r.x for r in rows] == list(range(10)) and rows[0].source_file


def test_csv_seq_follows_paths_not_file_sizes(spark, tmp_path):
    """The scan packs larger files first; names need not be plain."""
    (tmp_path / "a b%.csv").write_text("x\n0\n1\n")
    (tmp_path / "b+é.csv").write_text("x\n" + "".join(f"{i}\n" for i in range(2, 500)))
    back = csv_src.read_csv_files(spark, str(tmp_path), "x long", with_seq=True)
    rows = back.orderBy("seq").collect()
    assert [r.x for r in rows] == list(range(500)) and len({r.seq for r in rows}) == 500
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")  # files in many blocks
    try:
        back = csv_src.read_csv_files(spark, str(tmp_path), "x long", with_seq=True)
        assert [r.x for r in back.orderBy("seq").collect()] == list(range(500))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_null_tokens(spark, df):
    base = shared_path(spark, "t", "tokens")
    d = df([("a", "1.5"), ("NA", "nan"), ("n/a", "NULL"), ("b", "")], "s string, v string")
    lake.land(d.coalesce(1), base, "csv")
    back = csv_src.read_csv_null_tokens(spark, base, {"s": "string", "v": "double"}).collect()
    assert [(r.s, r.v) for r in back] == [("a", 1.5), (None, None), (None, None), ("b", None)]


def test_zone_roundtrip_partitioned(spark, df):
    d = df([(1, 2020, "1.0"), (2, 2021, "x")], "seq long, year int, val string")
    out = lake.roundtrip(d, shared_path(spark, "t", "curated"), "parquet", partition_by=["year"],
                         casts={"val": "double", "year": "int"})
    assert out.columns == ["seq", "year", "val"]
    assert sorted((r.seq, r.year, r.val) for r in out.collect()) == [(1, 2020, 1.0), (2, 2021, None)]


def test_metrics_sink_rounds(spark, df):
    path = shared_path(spark, "t", "metrics")
    lake.write_metrics(df([("rf", 0.123456789, 3)], "model string, r2 double, n long"), path)
    back = csv_src.read_csv_files(spark, path, "model string, r2 double, n long").collect()
    assert [(r.model, r.r2, r.n) for r in back] == [("rf", 0.1235, 3)]
    assert len([f for f in spark.read.text(path).inputFiles()]) == 1


def test_export_has_no_driver_collect(spark, df):
    path = shared_path(spark, "t", "export")
    d = df([("A", 1.0)], "translated_location string, val double")
    lake.export_csv(d, path, ["translated_location", "val"])
    assert spark.read.option("header", True).csv(path).columns == ["translated_location", "val"]


def test_partitioned_land_writes_few_files_per_year(spark):
    """``rebalance`` before ``partitionBy``: each year's rows are written by
    as few tasks as their size needs, not one file per (task, year)."""
    import glob

    df = spark.range(0, 3000, numPartitions=8).select(
        F.col("id").alias("seq"), (F.col("id") % 3 + 2020).cast("int").alias("year"))
    path = shared_path(spark, "test", "rebalanced")
    lake.land(df, path, partition_by=["year"])
    files = {y: glob.glob(f"{path}/year={y}/*.parquet") for y in (2020, 2021, 2022)}
    assert all(len(v) == 1 for v in files.values()), {k: len(v) for k, v in files.items()}
    assert spark.read.parquet(path).count() == 3000
    plain = shared_path(spark, "test", "unbalanced")
    lake.land(df, plain, partition_by=["year"], rebalance=False)
    assert len(glob.glob(f"{plain}/year=2020/*.parquet")) == 8


def test_map_program_inputs_read_null_tokens(spark, tmp_path):
    """Texts that pandas reads as missing are null in every CSV input of the map program."""
    from panelrisk.plans import batch
    (tmp_path / "b.csv").write_text("location_name,val\nNA,1.5\nPeru,nan\n")
    (tmp_path / "c.csv").write_text("location_name,val\nChad,NaN\n,2\n")
    got = batch._read_input(spark, str(tmp_path), "csv", {"location_name": "string", "val": "double"})
    assert [(r.location_name, r.val) for r in got.orderBy("seq").collect()] == [
        (None, 1.5), ("Peru", None), ("Chad", None), (None, 2.0)]
