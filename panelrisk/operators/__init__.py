"""DataFrame -> DataFrame operators (conform, joins, dedupe, aggregates,
sorts, set operations, features, clustering, forecasting)."""

from . import aggregates, cluster, conform, dedupe, features, forecast, forest, joins, ranks, setops, sketch, sort

__all__ = ["aggregates", "cluster", "conform", "dedupe", "features", "forecast", "forest",
           "joins", "ranks", "setops", "sketch", "sort"]
