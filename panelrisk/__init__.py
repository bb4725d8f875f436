"""panelrisk: entity-by-year panel analytics on Spark.

Land raw files, conform names and types, join a fact panel to yearly
covariates, impute, cluster into ranked risk profiles, forecast with a
time-based split, cut predictions into risk zones and assemble one
classified row per entity -- every step a DataFrame -> DataFrame operator.
"""

__version__ = "0.1.0"
