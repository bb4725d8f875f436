"""Domain views derived from the driver's TPC-H-like tables.

The supplied tables hold no health panel, so the registered queries run
the operators over a panel that Spark derives from them; its size grows
with the tables (one panel row per order).  Every view here has a DuckDB
twin in ``oracle.py`` with the same semantics.

* panel: one row per order: entity = customer nation name, measure =
  order priority, metric from the order status (F -> Rate, O -> Number,
  else Other), year of the order date, value = total price / 500.
* covariates: per (nation, year) values keyed by the *covariate naming*
  ``Nation <key>`` (quantity shipped by the nation's suppliers; highest
  customer balance); the value column is found by name, as in the original.
* dictionary: panel name -> covariate name for the nations of three
  regions.  Nations outside it keep their panel name, miss both covariates
  and get imputed medians (the original's dictionary gap).
* uploads: one row per line item.  Suppliers of two regions report under their
  nation's name, the others under their region's, which the panel does not
  know: those nations stay to be filled from history.  Return flag R -> Rate, A ->
  Number, else Other; value = extended price / 100.  ``seq`` is the row's place
  when the rows stand in order of order key, line number and all that is reported.

Values are exact aggregates (sums of integral values, max, first-by-order)
so that the DuckDB twin reproduces them to the last bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import ranks

# Parameters of the test views (not reference values).
RATE = "Rate"
COUNT = "Number"
TARGET_YEAR = 2001
MEASURE_PATTERN = "urgent|HIGH"
DICTIONARY_REGIONS = ["AFRICA", "AMERICA", "ASIA"]
VAL_DIVISOR = 500.0
UPLOAD_REGIONS = ["ASIA", "MIDDLE EAST"]  # whose suppliers report by nation, the others by region
UPLOAD_DIVISOR = 100.0
WATCH = ["Nation 1", "Nation_3", "Nation 12", "Nation_24", "Nation 4", "Indonesia"]
# Fixed-threshold grouping used where a deterministic, SQL-checkable
# cluster id is needed in place of a fitted model's.
SUPPLIED_CLUSTER_IDS = (2, 0, 1)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def cov_name(key_col) -> F.Column:
    return F.concat(F.lit("Nation "), key_col.cast("string"))


def panel(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                         "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    return j.select(
        F.col("o_orderkey").cast("bigint").alias(K.SEQ),
        F.col("n_name").alias(K.LOCATION),
        F.col("o_orderpriority").alias(K.MEASURE),
        F.when(F.col("o_orderstatus") == "F", RATE)
         .when(F.col("o_orderstatus") == "O", COUNT).otherwise("Other").alias(K.METRIC),
        F.year("o_orderdate").cast("int").alias(K.YEAR),
        (F.col("o_totalprice") / VAL_DIVISOR).alias(K.VAL))


def dictionary(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    r = table(spark, d, "region").filter(F.col("r_name").isin(DICTIONARY_REGIONS))
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left_semi").select(
        F.col("n_name").alias("source"), cov_name(F.col("n_nationkey")).alias("target"))


def cov_gdp(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    j = l.join(s, l.l_suppkey == s.s_suppkey)
    return (j.groupBy(F.col("s_nationkey").alias("k"), F.year("l_shipdate").alias("y"))
             .agg(F.sum("l_quantity").alias("v"))
             .select(cov_name(F.col("k")).alias("Entity"),
                     F.concat(F.lit("N"), F.col("k").cast("string")).alias("Code"),
                     F.col("y").cast("int").alias("Year"),
                     F.col("v").alias("GDP per capita, PPP (constant 2017 international $)")))


def cov_density(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return (j.groupBy(F.col("c_nationkey").alias("k"), F.year("o_orderdate").alias("y"))
             .agg(F.max("c_acctbal").alias("v"))
             .select(cov_name(F.col("k")).alias("Entity"),
                     F.concat(F.lit("N"), F.col("k").cast("string")).alias("Code"),
                     F.col("y").cast("int").alias("Year"),
                     F.col("v").alias("Population density")))


def uploads(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_returnflag")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    r = table(spark, d, "region").select("r_regionkey", "r_name")
    n = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    name = F.when(F.col("r_name").isin(UPLOAD_REGIONS), F.col("n_name")).otherwise(F.col("r_name"))
    n = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", name.alias(K.LOCATION))
    g = (l.join(s, l.l_suppkey == s.s_suppkey, "left").join(F.broadcast(n), F.col("s_nationkey") == n.n_nationkey, "left"))
    g = g.select(
        "l_orderkey", "l_linenumber", K.LOCATION,
        F.when(F.col("l_returnflag") == "R", RATE)
         .when(F.col("l_returnflag") == "A", COUNT).otherwise("Other").alias(K.METRIC),
        (F.col("l_extendedprice") / UPLOAD_DIVISOR).alias(K.VAL))
    placed = ranks.numbered(g, ["l_orderkey", "l_linenumber", K.LOCATION, K.METRIC, K.VAL], K.SEQ,
                            keep=[K.LOCATION, K.METRIC, K.VAL])
    return placed.select(K.SEQ, K.LOCATION, K.METRIC, K.VAL)


def supplied_cluster(val_col: str = K.VAL) -> F.Column:
    """Deterministic stand-in cluster id: the fixed value bands, numbered
    out of order so that ranking has to reorder them."""
    lo, mid, hi = SUPPLIED_CLUSTER_IDS
    v = F.col(val_col)
    return (F.when(v <= K.FIXED_LOW_CUT, lo).when(v <= K.FIXED_HIGH_CUT, mid)
             .otherwise(hi)).cast("int")
