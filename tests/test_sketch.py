"""Quantiles from value bins, distributed ranks, label ranks, salted joins, zones, work folders."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from panelrisk.operators import aggregates, features, joins, ranks, sketch
from panelrisk.session import owned_work, shared_path, staged
from panelrisk.sources import csv as csv_src
from panelrisk.sources import lake

PROBS = [0.0, 0.01, 0.33, 0.5, 0.66, 0.9, 1.0]


def exact(values, p):
    xs = sorted(values)
    return xs[max(0, math.ceil(p * len(xs)) - 1)]


def drawn(kind, n, seed=3):
    r = random.Random(seed)
    return {"even": lambda: [r.uniform(-1, 1) for _ in range(n)],
            "wide": lambda: [r.choice([-1, 1]) * 10 ** r.uniform(-300, 300) for _ in range(n)],
            "close": lambda: [1e9 + r.random() for _ in range(n)],
            "ties": lambda: [float(r.choice([0, 0, 0, -5, 7])) for _ in range(n)],
            "ends": lambda: [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0][:n] * 3}[kind]()


@pytest.mark.parametrize("kind", ["even", "wide", "close", "ties", "ends"])
def test_exact_and_bounded_quantiles(df, kind):
    values = drawn(kind, 700)
    d = df([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    got = sketch.column_quantiles(d, ["x"], PROBS, 0.0)["x"]
    assert got == [exact(values, p) for p in PROBS]
    for error in (0.001, 0.02, 0.3):
        near = sketch.column_quantiles(d, ["x"], PROBS, error)["x"]
        for p, v in zip(PROBS, near):
            below, upto = sum(x < v for x in values), sum(x <= v for x in values)
            assert v in values
            assert below <= (p + error) * len(values) and upto >= (p - error) * len(values)
        assert all(r.within_error for r in sketch.rank_check(d, "x", dict(zip(PROBS, near)), error).collect())
        # the same answer in any layout
        assert all(sketch.column_quantiles(d.repartition(n), ["x"], PROBS, error)["x"] == near for n in (1, 7))


def test_rank_check_sees_a_wrong_value(df):
    d = df([(float(i),) for i in range(1000)], "x double")
    got = {r.value: r.within_error for r in sketch.rank_check(d, "x", {0.5: 520.0, 0.4: 400.0, 0.3: 299.5}, 0.01).collect()}
    assert got == {520.0: False, 400.0: True, 299.5: False}


def test_weights_several_columns_and_no_values(df):
    rows = [(1.0, 10.0, 3), (2.0, None, 1), (5.0, 20.0, 5), (9.0, 30.0, 0)]
    d = df(rows, "a double, b double, w int")
    got = sketch.column_quantiles(d, ["a", "b"], [0.5], 0.0, weight="w")
    assert got == {"a": [exact([1.0] * 3 + [2.0] + [5.0] * 5, 0.5)], "b": [exact([10.0] * 3 + [20.0] * 5, 0.5)]}
    none = d.select(F.lit(None).cast("double").alias("a"))
    assert sketch.column_quantiles(none, ["a"], [0.5], 0.1) == {"a": [None]}
    assert aggregates.quantiles(none, "a", [0.5], 0.1).first().q50 is None
    with pytest.raises(ValueError, match="no values"):
        aggregates.quantile_values(none, "a", [0.5], 0.1)


def test_bins_of_parts_merge(df):
    values = drawn("wide", 500)
    parts = [df([(v,) for v in values[i::3]], "x double") for i in range(3)]
    merged = sketch.merged_bins(*[sketch.value_bins(p, ["x"]) for p in parts])
    whole = sketch.value_bins(df([(v,) for v in values], "x double"), ["x"])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))


def test_rows_are_numbered_in_order(spark):
    d = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("x"), F.lit("a").alias("s"))
    got = ranks.numbered(d, [F.col("x").desc()], "place", first=10).collect()
    assert all(r.place == 10 + 4999 - r.x for r in got) and len(got) == 5000
    assert ranks.numbered(d.limit(0), ["x"], "place").count() == 0
    tied = ranks.numbered(d, ["s"], "place").collect()
    assert sorted(r.place for r in tied) == list(range(5000))


def test_a_million_labels_are_indexed_without_a_list_on_the_driver(spark):
    n = 1_000_000
    labels = spark.range(n).select(F.format_string("label %07d", "id").alias("c"))
    hot = spark.range(n // 2).select(F.lit("label 0000007").alias("c"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")       # so that the hot label meets the salted join
    try:
        out = features.string_index(labels.unionByName(hot), "c", "i")
        found = out.agg(F.count_distinct("i").alias("n"), F.max("i").alias("top"), F.count_if(
            (F.col("c") == "label 0000007") & (F.col("i") == 0)).alias("hot"), F.count_if(
            F.col("i") != F.when(F.col("c") == "label 0000007", 0).otherwise(
                F.substring("c", 7, 7).cast("long") + F.when(F.col("c") < "label 0000007", 1).otherwise(0))).alias("off")).first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (found.n, found.top, found.hot, found.off) == (n, n - 1, n // 2 + 1, 0)
    with pytest.raises(ValueError, match="1000000 labels"):
        features.string_index(labels, "c", max_labels=299)


def test_unseen_labels(df):
    train, test = df([("a",), ("a",), ("b",)], "c string"), df([("b",), ("z",), (None,)], "c string")
    assert [r.c_idx for r in features.string_index(test, "c", handle_invalid="skip", fit_on=train).collect()] == [1.0]
    with pytest.raises(Exception, match="unseen label"):
        features.string_index(test, "c", handle_invalid="error", fit_on=train).collect()


@pytest.mark.parametrize("least", [1, 100, 10**9])
def test_salted_join_equals_the_plain_one(spark, least):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(9000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id % 50)) AS e",
                                            "if(id % 40 = 1, null, cast(if(id % 3 = 0, 1, id % 7) AS int)) AS y")
        right = spark.range(50).selectExpr("concat('k', id) AS ce", "cast(id % 7 AS int) AS cy", "id AS v").union(
            spark.sql("SELECT 'hot', 1, -1L UNION ALL SELECT 'hot', 1, -2L UNION ALL SELECT null, 1, -3L"))
        a = joins.salted_left_join(left, right, ["e", "y"], ["ce", "cy"], ["id"], tasks=8, least_rows=least)
        b = joins.left_join_on(left, right, ["e", "y"], ["ce", "cy"])
        assert a.columns == b.columns and a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_key_is_spread_over_tasks(spark):
    """A third of the rows under one key, no broadcast: no task of the joined frame holds that third."""
    from panelrisk.plans import jobs
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
                                           "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        n = 60_000
        panel = spark.range(n).selectExpr(
            "id AS seq", "if(id % 3 = 0, 'Hot', concat('C', id % 400)) AS location_name", "'m' AS measure_name",
            "'Laju' AS metric_name", "cast(if(id % 3 = 0, 2020, 2000 + id % 20) AS int) AS year", "cast(id AS double) AS val")
        gdp = spark.range(8000).selectExpr("concat('C', id % 400) AS Entity", "cast(2000 + id DIV 400 AS int) AS Year",
                                           "cast(id AS double) AS `GDP`").union(spark.sql("SELECT 'Hot', 2020, 5D"))
        pop = gdp.withColumnRenamed("GDP", "Density")
        master = jobs.integrate_panel(panel, gdp, pop, dictionary={}, salt_rows=500)
        by_task = [r.n for r in master.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(by_task) == n and max(by_task) < 3 * n / 32, sorted(by_task)
        hot = master.where("translated_location = 'Hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(hot) > 16
        plain = jobs.integrate_panel(panel, gdp, pop, dictionary={}, impute_relative_error=0.0)
        same = jobs.integrate_panel(panel, gdp, pop, dictionary={}, impute_relative_error=0.0, salt_rows=500)
        assert plain.exceptAll(same).count() == 0 and plain.count() == same.count()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


# ---------------------------------------------------------------- zones, files, work folders

def test_a_failed_overwrite_leaves_the_zone_as_it_was(spark):
    path = shared_path(spark, "t", "zone")
    lake.publish(spark.range(10), path)
    bad = spark.range(100, 200).select(F.when(F.col("id") == 150, F.raise_error(F.lit("no"))).cast("long").alias("x"),
                                       "id").select("id", F.coalesce("x", "id").alias("y"))
    with pytest.raises(Exception, match="no"):
        lake.publish(bad, path)
    assert sorted(r.id for r in lake.read_zone(spark, path).collect()) == list(range(10))
    before = lake.read_zone(spark, path)
    lake.publish(lake.read_zone(spark, path).withColumn("id", F.col("id") + 10), path)   # may read what it replaces
    assert sorted(r.id for r in lake.read_zone(spark, path).collect()) == list(range(10, 20))
    assert before.count() == 10                                        # who has begun can end
    for k in range(3):
        lake.publish(spark.range(k), path)
    import os
    folder = path.removeprefix("file://")
    versions = [f for f in os.listdir(folder) if f.startswith("v-")]
    assert len(versions) == 2 and lake.read_zone(spark, path).count() == 2
    assert lake.resolve(spark, folder) != folder and lake.resolve(spark, f"{folder}/nothing") == f"{folder}/nothing"


def test_file_ranks_are_data(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"part {i:02d}+.csv").write_text("x\n" + "".join(f"{i * 10 + k}\n" for k in range(10)))
    (tmp_path / "part 99.csv").write_text("x\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = csv_src.read_csv_files(spark, [str(tmp_path)], "x long", with_seq=True)
        assert [r.x for r in rows.orderBy("seq").collect()] == list(range(400))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert csv_src.listed_files(spark, [str(tmp_path)]).count() == 41
    plan = csv_src.listed_files(spark, [str(tmp_path)])._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_an_owner_removes_its_work_folders(spark, tmp_path):
    import os
    with owned_work(spark) as mine:
        staged(spark.range(5), "t", "owned")
        with owned_work(spark):
            inner = shared_path(spark, "t", "inner")
            spark.range(3).write.parquet(inner)
        assert not os.path.exists(inner.removeprefix("file://"))
        assert len(mine) == 1 and os.path.exists(mine[0].removeprefix("file://"))
        kept = shared_path(spark, "t", f"kept-{time.time_ns()}", unique=False)
        spark.range(2).write.parquet(kept)
    assert not os.path.exists(mine[0].removeprefix("file://")) and spark.read.parquet(kept).count() == 2
    with pytest.raises(RuntimeError):
        with owned_work(spark) as mine:
            staged(spark.range(5), "t", "owned")
            raise RuntimeError
    assert not os.path.exists(mine[0].removeprefix("file://"))
