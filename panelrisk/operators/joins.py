"""Joins.  Broadcast hints are given only for sides whose size is bounded
by construction (literal lists, k-row tables) or after an explicit row
check; everything else is left to Catalyst/AQE, which broadcast a side only
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise plan a shuffle (sort-merge) join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..session import held
from .dedupe import keep_first, latest_per_key


def checked_broadcast(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Hint a broadcast only if the frame has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows (``limit`` stops early).
    Above the bound the frame is returned unhinted, so the planner falls
    back to a shuffle join.  ``max_rows=None`` means: no hint, let the
    planner's own size check decide."""
    if max_rows is None:
        return df
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail if ``keys`` repeat.  Runs one aggregate job (partial agg)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {dict(dup[0].asDict())} on {list(keys)}")
    return df


def left_join_on(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                 right_keys: Sequence[str], require_unique: bool = False,
                 broadcast_max_rows: int | None = None) -> DataFrame:
    """Left equi-join on differently named keys.  Duplicate right keys fan
    out (reference behaviour) unless ``require_unique``."""
    if require_unique:
        assert_unique(right, right_keys)
    r = checked_broadcast(right, broadcast_max_rows)
    cond = [left[lk] == r[rk] for lk, rk in zip(left_keys, right_keys)]
    return left.join(r, cond, "left")


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                        broadcast_max_rows: int | None = None) -> DataFrame:
    """Left join on same-named keys where null matches null (pandas
    ``merge`` semantics); key columns appear once."""
    rk = {k: f"__r_{k}" for k in keys}
    r = checked_broadcast(right.withColumnsRenamed(rk), broadcast_max_rows)
    cond = [left[k].eqNullSafe(r[rk[k]]) for k in keys]
    return left.join(r, cond, "left").drop(*rk.values())


#: Rows that make a key hot at least, and slices that a task's share of it is cut into
#: (several, so that slices that hash to the same task add up to little).
SALT_ROWS, SLICES = 100_000, 8


def salted_left_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
                     spread_by: Sequence[str], tasks: int | None = None,
                     least_rows: int = SALT_ROWS) -> DataFrame:
    """``left_join_on`` for a right side that is too large to broadcast, where
    a few keys may hold most of the left rows.  No row is lost or added.

    Left rows are counted by key (partial sums, one row for each key and
    task).  A key with more than ``least_rows`` rows and more than one
    ``tasks``-th of all rows is hot: its left rows are dealt into salts by a hash of
    ``spread_by`` (columns that tell its rows apart) and its right rows are
    repeated once for each salt.  Other keys have one salt, so the right
    side grows by hot keys only.  Fewer than ``tasks`` keys can be hot: that
    bounds the table that is broadcast to both sides.  Null keys match nothing and
    are dealt out like a hot key, so that they don't meet in one task."""
    spark = left.sparkSession
    tasks = int(tasks or spark.conf.get("spark.sql.shuffle.partitions"))
    ks = [f"__k{i}" for i in range(len(left_keys))]
    keyed = left.select(*[F.col(k).alias(n) for k, n in zip(left_keys, ks)])
    known = F.lit(True)
    for n in ks:
        known = known & F.col(n).isNotNull()
    limit = max(int(least_rows), -(-keyed.count() // tasks))
    hot = (keyed.filter(known).groupBy(*ks).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit)
           .select(*ks, F.ceil(F.col("__n") * SLICES / F.lit(limit)).cast("int").alias("__salts")))
    no_key = F.lit(False)
    for k in left_keys:
        no_key = no_key | F.col(k).isNull()
    spread = F.xxhash64(*[F.col(c) for c in spread_by])
    dealt = (left.join(F.broadcast(hot), [left[k] == hot[n] for k, n in zip(left_keys, ks)], "left").drop(*ks)
             .withColumn("__salt", F.when(no_key, F.pmod(spread, F.lit(tasks * SLICES)))
                         .otherwise(F.pmod(spread, F.coalesce("__salts", F.lit(1)))).cast("int")).drop("__salts"))
    copies = (right.join(F.broadcast(hot), [right[k] == hot[n] for k, n in zip(right_keys, ks)], "left").drop(*ks)
              .withColumn("__copy", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)))
              .drop("__salts"))
    cond = [dealt[k] == copies[r] for k, r in zip(left_keys, right_keys)]
    return dealt.join(copies, [*cond, dealt["__salt"] == copies["__copy"]], "left").drop("__salt", "__copy")


def broadcastable(df: DataFrame) -> bool:
    """Whether the planner's own estimate of ``df`` lies under the session's
    broadcast threshold: the join is then planned without a shuffle."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return threshold >= 0 and int(str(size)) <= threshold


def first_match_lookup(left: DataFrame, right: DataFrame, key: str | Sequence[str], value: str,
                       order_by: Sequence[str], out: str,
                       broadcast_max_rows: int | None = None, hold: bool = False) -> DataFrame:
    """For each left row, the ``value`` of the *first* right row (by
    ``order_by``) with the same key(s) (null-safe), else null.

    The right side is first reduced to one row per key with a partially
    aggregated ``min_by`` (map-side combine, so a hot key cannot pile up in
    one task).  This also means a duplicated right key never multiplies
    left rows: the join emits at most one partner per row.

    ``hold``: the first rows are computed at once and held, so that the planner knows
    how few they are and leaves the left rows where they are."""
    keys = [key] if isinstance(key, str) else list(key)
    firsts = keep_first(right.select(*keys, value, *[c for c in order_by if c not in keys]),
                        keys, order_by)
    ren = {k: f"__k{i}" for i, k in enumerate(keys)}
    firsts = firsts.select(*[F.col(k).alias(ren[k]) for k in keys], F.col(value).alias(out),
                           *[F.col(c).alias(f"__o_{c}") for c in order_by if c not in keys])
    firsts = checked_broadcast(held(firsts) if hold else firsts, broadcast_max_rows)
    cond = [left[k].eqNullSafe(firsts[ren[k]]) for k in keys]
    return left.join(firsts, cond, "left").drop(*ren.values())


def anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left rows with no match on the right (``NOT EXISTS``); null keys never
    match.  The right side is reduced to its distinct keys first (a partial
    aggregate), so a hot key is one row from each task."""
    r = right.select(F.col(right_key).alias("__k")).filter(F.col("__k").isNotNull()).distinct()
    return left.join(r, left[left_key] == r["__k"], "left_anti")


def latest_lookup(left: DataFrame, history: DataFrame, key: str, values: Sequence[str],
                  year_col: str = K.YEAR, seq_col: str = K.SEQ) -> DataFrame:
    """Attach the newest history row's ``values`` per key (latest year,
    then first ``seq``) to the left frame, null when there is none."""
    newest = latest_per_key(history.select(key, year_col, seq_col, *values), [key], year_col, seq_col)
    newest = newest.select(F.col(key).alias("__k"), *values)
    return left.join(newest, left[key] == newest["__k"], "left").drop("__k")


def dictionary_join(df: DataFrame, column: str, dictionary: DataFrame, out: str,
                    source: str = "source", target: str = "target",
                    broadcast_max_rows: int | None = None) -> DataFrame:
    """Translate ``column`` through a dictionary that is *data* (a
    DataFrame of source/target pairs) with pass-through for unknown values.

    The dictionary is reduced to one target per source first (so a
    duplicated source cannot multiply rows); it is broadcast only when the
    row check allows, otherwise it is shuffle-joined."""
    d = keep_first(dictionary.select(source, target), [source], [target])
    d = d.select(F.col(source).alias("__src"), F.col(target).alias("__tgt"))
    d = checked_broadcast(d, broadcast_max_rows)
    return (df.join(d, df[column] == d["__src"], "left")
              .withColumn(out, F.coalesce(F.col("__tgt"), F.col(column)))
              .drop("__src", "__tgt"))


def watchlist_coverage(spark_df: DataFrame, names: Sequence[str], key: str,
                       value: str, status_col: str = "status") -> DataFrame:
    """For each watched name: whether it is present and its first value.

    The big side is filtered to the watched names and reduced per name
    before the join, so the broadcast side holds at most ``len(names)`` rows."""
    spark = spark_df.sparkSession
    watch = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "pos int, name string")
    found = (spark_df.filter(F.col(key).isin(list(names)))
             .groupBy(key).agg(F.min(value).alias("__v"), F.count(F.lit(1)).alias("__n")))
    j = watch.join(F.broadcast(found), watch["name"] == found[key], "left")
    return j.select(
        "pos", "name",
        F.col("__v").alias(value),
        F.when(F.col("__n").isNotNull(), "mapped").otherwise("failed").alias(status_col))
