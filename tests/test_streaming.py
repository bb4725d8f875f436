"""Upload stream: one micro-batch per file, per-file first match, and a
restart over the same checkpoint does not reprocess files.  Announced uploads
are whole, whatever number of files they have."""

import pytest

from panelrisk.session import shared_path
from panelrisk.sources import lake
from panelrisk.streaming import announce_upload, read_classified, start_announced_stream, start_upload_stream
from panelrisk.streaming.uploads import upload_of


def test_upload_stream_per_file(spark, df):
    src = shared_path(spark, "t", "up_src")
    sink = shared_path(spark, "t", "up_sink")
    ckpt = shared_path(spark, "t", "up_ckpt")
    f1 = df([("Finlandia", "Rate", 700.0), ("Finlandia", "Number", 11.0), ("Finlandia", "Number", 12.0)],
            "location_name string, metric_name string, val double")
    f2 = df([("Finlandia", "Number", 99.0), ("Finlandia", "Rate", 100.0)],
            "location_name string, metric_name string, val double")
    lake.land(f1.coalesce(1), f"{src}/a", "csv")
    q = start_upload_stream(spark, f"{src}/*", sink, ckpt)
    q.awaitTermination()
    lake.land(f2.coalesce(1), f"{src}/b", "csv")
    q = start_upload_stream(spark, f"{src}/*", sink, ckpt)
    q.awaitTermination()
    rows = sorted((r.batch_id, r.val, r.jumlah_kasus_absolut, r.cluster_risiko)
                  for r in read_classified(spark, sink).collect())
    assert rows == [(0, 700.0, 11.0, "Tinggi"), (1, 100.0, 99.0, "Rendah")]


def test_several_files_in_one_batch_keep_their_own_matches(spark, df):
    src = shared_path(spark, "t", "up_many")
    cols = "location_name string, metric_name string, val double"
    files = [[("Finlandia", "Rate", 700.0), ("Finlandia", "Number", 11.0), ("Finlandia", "Number", 12.0)],
             [("Finlandia", "Number", 99.0), ("Finlandia", "Rate", 100.0)], [("Finlandia", "Rate", 5.0)]]
    for i, rows in enumerate(files):
        lake.land(df(rows, cols).coalesce(1), f"{src}/{i}", "csv")
    sink = shared_path(spark, "t", "up_many_sink")
    start_upload_stream(spark, f"{src}/*", sink).awaitTermination()
    rows = sorted((r.batch_id, r.val, r.jumlah_kasus_absolut) for r in read_classified(spark, sink).collect())
    assert rows == [(0, 5.0, None), (0, 100.0, 99.0), (0, 700.0, 11.0)]


def test_an_upload_of_many_files_is_one_upload(spark, df):
    """Every row in a file of its own: the first count is that of the first file, for all of them."""
    cols = "location_name string, metric_name string, val double"
    inbox, sink, ckpt = (shared_path(spark, "t", n) for n in ("inbox", "announced_sink", "announced_ckpt"))
    rows = [("Finlandia", "Rate", 700.0), ("Peru", "Rate", 5.0), ("Finlandia", "Number", 11.0),
            ("Finlandia", "Number", 12.0), ("Finlandia", "Rate", 100.0)]
    one = df([(i, *r) for i, r in enumerate(rows)], f"i int, {cols}").repartitionByRange(5, "i").drop("i")
    announce_upload(one, inbox, "first")
    announce_upload(df([("Finlandia", "Number", 99.0), ("Finlandia", "Rate", 1.0), ("Peru", "Number", 3.0)], cols), inbox, "second")
    start_announced_stream(spark, inbox, sink, ckpt, uploads_per_batch=1).awaitTermination()
    got = read_classified(spark, sink)
    assert got.where("upload = 'first'").select("source_file").distinct().count() >= 3
    assert sorted((r.upload, r.val, r.jumlah_kasus_absolut) for r in got.collect()) == [
        ("first", 5.0, None), ("first", 100.0, 11.0), ("first", 700.0, 11.0), ("second", 1.0, 99.0)]
    assert got.select("batch_id").distinct().count() == 2
    with pytest.raises(FileExistsError):
        announce_upload(df([("Peru", "Rate", 2.0)], cols), inbox, "second")
    announce_upload(df([("Peru", "Rate", 2.0)], cols), inbox, "third")
    start_announced_stream(spark, inbox, sink, ckpt).awaitTermination()
    assert read_classified(spark, sink).count() == 5


def test_files_that_are_not_announced_are_left(spark, df):
    inbox, sink = shared_path(spark, "t", "inbox2"), shared_path(spark, "t", "sink2")
    cols = "location_name string, metric_name string, val double"
    lake.land(df([("Peru", "Rate", 9.0)], cols), f"{inbox}/files/unfinished", "csv")
    announce_upload(df([("Peru", "Rate", 2.0)], cols), inbox, "done")
    start_announced_stream(spark, inbox, sink).awaitTermination()
    assert [(r.upload, r.val) for r in read_classified(spark, sink).collect()] == [("done", 2.0)]


def test_the_upload_of_a_file_is_cut_from_its_path(df):
    paths = ["file:/a/b/files/view/part-0.csv", "hdfs://h:1/files/x%20y/part-1.csv", "s3a://bucket/files/a.b/p"]
    got = df([(p,) for p in paths], "source_file string").select(upload_of("source_file").alias("u"))
    assert [r.u for r in got.collect()] == ["view", "x%20y", "a.b"]
    assert "regexp" not in got._jdf.queryExecution().toString()
