"""Clustering: bisecting k-means profile fit, closed-form silhouette and
ranking of clusters into ordinal labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.lookup import label_or_default
from .features import scaler


def cluster_pipeline(features: Sequence[str], k: int = K.CLUSTER_K, seed: int = K.CLUSTER_SEED,
                     min_divisible: float = K.CLUSTER_MIN_DIVISIBLE,
                     prediction: str = K.CLUSTER) -> Pipeline:
    """assemble (skip invalid) -> scale -> bisecting k-means.

    Features are divided by their deviations but not centred: squared
    distances do not depend on the shift, while centring would leave the
    root centre at rounding noise, which differs with the partitioning and
    would then pick the first split."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="raw_cluster_features", handleInvalid="skip"),
        scaler("raw_cluster_features", "scaled_cluster_features", center=False),
        BisectingKMeans(featuresCol="scaled_cluster_features", predictionCol=prediction,
                        k=k, seed=seed, minDivisibleClusterSize=min_divisible),
    ])


def fit_clusters(df: DataFrame, features: Sequence[str], fit_on: DataFrame | None = None,
                 **kw) -> tuple[PipelineModel, DataFrame]:
    """Fit the cluster pipeline (on ``fit_on`` when given, e.g. training
    years only) and label every complete row of ``df``."""
    model = cluster_pipeline(features, **kw).fit(fit_on if fit_on is not None else df)
    return model, model.transform(df)


#: Most clusters whose statistics are fetched (one row each).
MAX_CLUSTERS = 1000


def _cluster_stats(df: DataFrame, feats: Sequence[Column], cluster: str) -> list:
    """Per-cluster count, feature sums and sum of squared norms: one
    aggregate job returning k small rows (k = number of clusters)."""
    sq = sum((f * f for f in feats), F.lit(0.0))
    stats = df.filter(F.col(cluster).isNotNull()).groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(f) for f in feats]).alias("s"),
        F.sum(sq).alias("ss"))
    rows = stats.limit(MAX_CLUSTERS + 1).collect()
    if len(rows) > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} cluster ids in {cluster}")
    return rows


def silhouette_scores(df: DataFrame, features: Sequence[str] | str, cluster: str,
                      dim: int | None = None) -> DataFrame:
    """Per-row silhouette with squared Euclidean distance, in closed form.

    The mean squared distance from x to the points of cluster C is
    ``|x|^2 + SS_C/N_C - 2 x.S_C/N_C``, so one aggregate over the data (k
    rows of sums, the same statistics ``ClusteringEvaluator`` gathers)
    replaces all pairwise distances; each row then needs k dot products.
    ``a`` (own cluster) excludes the point itself, a singleton cluster
    scores 0; a row with a null feature or cluster scores null.  ``features``: numeric columns, or one vector column (then
    ``dim`` is needed)."""
    if isinstance(features, str):
        from pyspark.ml.functions import vector_to_array
        arr = vector_to_array(F.col(features))
        feats = [arr[i] for i in range(dim)]
    else:
        feats = [F.col(c).cast("double") for c in features]
    # rows with a null feature or cluster have no silhouette and do not count
    valid = F.col(cluster).isNotNull()
    for f in feats:
        valid = valid & f.isNotNull()
    stats = _cluster_stats(df.filter(valid), feats, cluster)
    xx = sum((f * f for f in feats), F.lit(0.0))
    cid = F.col(cluster)

    def mean_dist(st) -> Column:
        n = float(st["n"])
        dot = sum((f * F.lit(float(sv)) for f, sv in zip(feats, st["s"])), F.lit(0.0))
        return xx + F.lit(float(st["ss"]) / n) - dot * F.lit(2.0 / n)

    a = n_own = None
    for st in stats:
        own_d = mean_dist(st) * F.lit(float(st["n"]) / (st["n"] - 1)) if st["n"] > 1 else F.lit(0.0)
        a = (F.when(cid == st[cluster], own_d) if a is None else a.when(cid == st[cluster], own_d))
        n_own = (F.when(cid == st[cluster], F.lit(st["n"])) if n_own is None
                 else n_own.when(cid == st[cluster], F.lit(st["n"])))
    if len(stats) < 2:
        return df.withColumn("silhouette", F.when(valid, F.lit(0.0)))
    # nearest other cluster: least() skips the null put in for the own one
    b = F.least(*[F.when(cid != st[cluster], mean_dist(st)) for st in stats])
    s = (F.when(n_own <= 1, F.lit(0.0))
          .when(a < b, 1.0 - a / b)
          .when(a > b, b / a - 1.0)
          .otherwise(F.lit(0.0)))
    return df.withColumn("silhouette", F.when(valid, s))


def silhouette(df: DataFrame, features: Sequence[str] | str, cluster: str,
               dim: int | None = None) -> DataFrame:
    """Mean silhouette as a one-row frame ``(n_clusters, silhouette)``;
    0.0 when there is a single cluster (the original's guard)."""
    scored = silhouette_scores(df, features, cluster, dim)
    return scored.agg(F.count_distinct(cluster).alias("n_clusters"),
                      F.avg("silhouette").alias("silhouette")) \
                 .select("n_clusters",
                         F.when(F.col("n_clusters") > 1, F.col("silhouette"))
                          .otherwise(F.lit(0.0)).alias("silhouette"))


def rank_mapping(df: DataFrame, cluster: str = K.CLUSTER, value: str = K.VAL,
                 labels: Sequence[str] = K.PROFILE_LABELS) -> dict:
    """Cluster id -> label: clusters ordered by mean ``value`` (ascending,
    ties by id), the i-th gets ``labels[i]``.  More clusters than labels is
    an error, as in the original.  The k means are one grouped aggregate."""
    means = (df.filter(F.col(cluster).isNotNull()).groupBy(cluster)
               .agg(F.avg(value).alias("m")).limit(len(labels) + 1).collect())
    ranked = sorted(means, key=lambda r: (r["m"] is None, r["m"], r[cluster]))
    if len(ranked) > len(labels):
        raise ValueError(f"more clusters than the {len(labels)} labels")
    return {r[cluster]: labels[i] for i, r in enumerate(ranked)}


def rank_labels(df: DataFrame, cluster: str = K.CLUSTER, value: str = K.VAL,
                labels: Sequence[str] = K.PROFILE_LABELS, default: str = K.UNKNOWN_PROFILE,
                out: str = K.PROFILE, mapping: dict | None = None) -> DataFrame:
    """Each row's profile label by ``rank_mapping`` (or a ``mapping`` that the
    caller has); rows without a ranked cluster get ``default``.  The labels
    enter the plan as a constant map: a projection, no join and no Python UDF."""
    if mapping is None:
        mapping = rank_mapping(df, cluster, value, labels)
    return df.withColumn(out, label_or_default(cluster, mapping, default))
