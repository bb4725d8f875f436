"""The forest: against plain Python on small rows, against MLlib's on larger ones, and in any layout."""

import math
import random

import pytest
from pyspark.sql import functions as F

from panelrisk.operators import forest


def by_hand(rows, encoder_bins, draws, n_categorical, m, seed, depth, trees, unit):
    """Trees grown one node at a time from ``(bins, y, key)``; ``draws[tree][key]`` times each."""
    out = []
    for t in range(trees):
        tree = {}

        def grow(node, members, level):
            n, s = sum(w for _, _, w in members), sum(w * y for _, y, w in members)
            tree[node] = (None, None, s / n * unit)
            if level == depth:
                return
            best = None
            for f in sorted(random.Random(f"{seed}/{t}/{node}").sample(range(encoder_bins), m)):
                sums = {}
                for b, y, w in members:
                    got = sums.setdefault(b[f], [0, 0])
                    got[0] += w
                    got[1] += w * y
                order = sorted(sums, key=lambda b: (sums[b][1] / sums[b][0] if f < n_categorical else 0, b))
                ln = ls = 0
                for i, b in enumerate(order[:-1]):
                    ln, ls = ln + sums[b][0], ls + sums[b][1]
                    score = ls * ls / ln + (s - ls) ** 2 / (n - ln)
                    if best is None or score > best[0]:
                        left = set(order[:i + 1]) if f < n_categorical else set(range(max(order[:i + 1]) + 1))
                        best = (score, f, left)
            if best and best[0] > s * s / n * (1 + 1e-12):
                tree[node] = (best[1], best[2], s / n * unit)
                for child, inside in ((2 * node, True), (2 * node + 1, False)):
                    grow(child, [x for x in members if (x[0][best[1]] in best[2]) == inside], level + 1)

        grow(1, [(b, y, draws[t][k]) for b, y, k in rows if draws[t][k]], 0)
        out.append(tree)
    return out


def panel(spark, n, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        c, x = r.choice("abcdefg"), r.uniform(0, 10)
        rows.append((i, c, r.choice(["m1", "m2", None]), x, r.choice([1.0, 2.0, 3.0]), float(ord(c) * 3 + x * x + r.gauss(0, 1))))
    return spark.createDataFrame(rows, "seq long, c string, m string, x double, k double, y double")


KW = {"categorical": ["c", "m"], "numeric": ["x", "k"], "label": "y"}


def test_trees_by_hand(spark):
    d = panel(spark, 150)
    model = forest.fit_forest(d, trees=3, max_bins=16, seed=5, max_depth=3, **KW)
    enc, unit = model.encoder, 2.0 ** (math.frexp(d.agg(F.max(F.abs("y"))).first()[0])[1] - forest.LABEL_BITS)
    assert enc.labels["c"] == [r[0] for r in d.groupBy("c").count().orderBy(F.desc("count"), "c").collect()]
    assert enc.cuts["k"] == [1.0, 2.0] and 8 <= len(enc.cuts["x"]) <= 15
    coded = d.select("seq", "y", enc.bins().alias("b"), *[
        forest.draws(F.xxhash64("seq"), F.lit(t), 5).alias(f"w{t}") for t in range(3)]).collect()
    for r, row in zip(coded, d.collect()):
        want = [enc.labels["c"].index(row.c), enc.labels["m"].index(row.m) if row.m else 2,
                sum(x < row.x for x in enc.cuts["x"]), sum(x < row.k for x in enc.cuts["k"])]
        assert r.b == want
    rows = [(r.b, round(r.y / unit), r.seq) for r in coded]
    draws = [{r.seq: r[f"w{t}"] for r in coded} for t in range(3)]
    trees = by_hand(rows, 4, draws, 2, 2, 5, 3, 3, unit)
    for t, tree in enumerate(trees):
        for node, (f, left, mean) in tree.items():
            at = t * model.size + node
            assert model.feature[at] == (-1 if f is None else f)
            assert model.mean[at] == pytest.approx(mean, rel=1e-9)
            if f is not None:
                bits = model.left[at * model.words:(at + 1) * model.words]
                assert {b for b in range(17) if bits[b >> 6] >> (b & 63) & 1} == left

    def leaf(tree, b):
        node = 1
        while tree[node][0] is not None:
            node = 2 * node + (b[tree[node][0]] not in tree[node][1])
        return tree[node][2]

    got = {r.seq: r.prediction for r in model.transform(d).collect()}
    assert all(got[s] == pytest.approx(sum(leaf(t, b) for t in trees) / 3, rel=1e-9) for b, _, s in rows)


def test_draws_are_poisson(spark):
    counts = {r.w: r["count"] for r in spark.range(200_000).select(
        forest.draws(F.xxhash64("id"), F.lit(3), 42).alias("w")).groupBy("w").count().collect()}
    for k in range(5):
        assert counts[k] / 200_000 == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.005)
    limits = forest.poisson_limits()
    assert limits == sorted(limits) and limits[0] == int(math.exp(-1) * 2.0**64) - 2**63


@pytest.mark.parametrize("partitions", [3, 32])
def test_same_forest_in_any_layout(spark, partitions):
    d = panel(spark, 3000)
    a = forest.fit_forest(d.repartition(1), trees=5, **KW)
    b = forest.fit_forest(d.orderBy(F.rand(partitions)).repartition(partitions), trees=5, **KW)
    assert (a.feature, a.left, a.mean, a.encoder) == (b.feature, b.left, b.mean, b.encoder)


def test_as_good_as_the_library_forest(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    d = panel(spark, 4000).na.drop()
    train, test = d.where("seq % 4 > 0"), d.where("seq % 4 = 0")
    index = [StringIndexer(inputCols=["c", "m"], outputCols=["ci", "mi"], handleInvalid="keep"),
             VectorAssembler(inputCols=["ci", "mi", "x", "k"], outputCol="f")]

    def error(model):
        return model.transform(test).agg(F.avg(F.pow(F.col("y") - F.col("prediction"), 2))).first()[0]

    theirs = [error(Pipeline(stages=[*index, RandomForestRegressor(
        featuresCol="f", labelCol="y", numTrees=40, maxBins=64, seed=s)]).fit(train)) for s in (1, 2, 3)]
    ours = [error(forest.fit_forest(train, trees=40, max_bins=64, seed=s, **KW)) for s in (1, 2, 3)]
    alone = test.agg(F.var_pop("y")).first()[0]
    # two of four features tell something: seeds differ by half, means of three by less
    assert sum(ours) < 1.4 * sum(theirs) and max(ours) < 0.05 * alone, (ours, theirs, alone)


def test_bounds_and_odd_rows(spark):
    d = panel(spark, 300)
    with pytest.raises(ValueError, match="7 labels; with max_bins=7"):
        forest.fit_forest(d, trees=1, max_bins=7, **KW)
    odd = d.unionByName(spark.createDataFrame(
        [(900, "a", "m1", None, 1.0, 5.0), (901, "a", "m1", float("nan"), 1.0, 5.0), (902, None, "m1", 1.0, 1.0, 5.0),
         (903, "unseen", "zz", -1e300, 1e300, None)], d.schema))
    model = forest.fit_forest(odd.where("seq <> 903"), trees=2, **KW)
    scored = {r.seq: r.prediction for r in model.transform(odd).where("seq >= 900").collect()}
    assert set(scored) == {902, 903} and all(math.isfinite(x) for x in scored.values())
    flat = forest.fit_forest(d.withColumn("y", F.lit(3.5)), trees=2, **KW)
    assert {r.prediction for r in flat.transform(d).collect()} == {3.5}
    with pytest.raises(ValueError, match="no complete row"):
        forest.fit_forest(d.withColumn("x", F.lit(None).cast("double")), trees=1, **KW)


def test_draws_are_summed_by_bins_where_rows_agree(spark, monkeypatch):
    """the levels read one row for each tree and combination of bins, and the trees are those grown row by row."""
    d = panel(spark, 3000).withColumn("x", F.floor("x"))
    binned = d.select(F.xxhash64("seq").alias("key"), F.floor("y").alias("y"), F.array(F.col("k").cast("int")).alias("bins"))
    assert forest._drawn(binned, 4, 1).count() == 4 * 3
    summed = forest.fit_forest(d, trees=4, **KW)
    monkeypatch.setattr(forest, "ROWS_OF_A_COMBINATION", 10**9)
    single = forest.fit_forest(d, trees=4, **KW)
    assert (summed.feature, summed.left, summed.mean) == (single.feature, single.left, single.mean)
    assert forest._drawn(binned, 4, 1).count() > 4 * 1000


def test_scoring_is_dealt_to_all_cores(spark):
    """test rows of one file are scored by more than one task."""
    from panelrisk import constants as K
    from panelrisk.plans import jobs
    d = panel(spark, 400).select("seq", F.col("c").alias(K.LOCATION), F.col("m").alias(K.MEASURE), F.col("y").alias(K.VAL),
                                 (2000 + F.col("seq") % 10).cast("int").alias(K.YEAR), F.col("x").alias(K.GDP),
                                 F.col("k").alias(K.POP), F.lit(1).alias(K.CLUSTER)).coalesce(1)
    *_, zoned, _ = jobs.forecast_zones(d, ["seq"], trees=2, max_bins=16)
    cores = spark.sparkContext.defaultParallelism
    assert len(zoned.inputFiles()) == cores and zoned.count() == d.where(f"{K.YEAR} > 2007").count()
