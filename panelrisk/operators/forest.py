"""Random forest for regression whose answer hangs on the rows alone.

Which rows a tree sees, and how often, is drawn from a hash of the row's key, the tree
and the seed; sums are taken over whole numbers; quantiles come from
``sketch``.  So the same rows give the same forest in any number of
partitions, in any order, and after a lost executor.

Rows that agree in all bins walk alike.  Where most do (a panel: the covariates hang on
entity and year), each tree's draws are summed by bins in one pass over the rows, and the levels read
those sums; the sums, and so the trees, are the same either way.

All trees grow level by level.  A level is one job: the rows, with the node each has
reached in each tree, add to counts by (tree, node, candidate feature, bin), which are
summed partially in every task: at most ``trees x 2**level x candidates x
max_bins`` rows leave a task, whatever the data's size.  The best split of
every node is chosen from those counts by Spark; what reaches the driver is
one row for each node.  Growing and scoring use DataFrame expressions only."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.lookup import label_or_default
from ..session import staged
from .sketch import column_quantiles

#: Depth of the trees.
MAX_DEPTH = 5

#: Labels are summed as whole multiples of a unit that gives the greatest of them this many bits.
LABEL_BITS = 40
_LOW = 20

#: Rows to a combination of bins, at least, for draws to be summed by combination first.
ROWS_OF_A_COMBINATION = 8


def poisson_limits() -> list[int]:
    """Hash values (signed 64 bits) below which a row is drawn 0, 1, 2, ... times: the
    distribution function of Poisson(1), as the bootstrap has it for many rows."""
    out, term, total = [], math.exp(-1), 0.0
    for k in range(18):
        total += term
        out.append(min(int(total * 2.0**64) - 2**63, 2**63 - 1))
        term /= k + 1
    return out


def draws(key_hash: Column, tree: Column, seed: int) -> Column:
    """How often a tree sees a row."""
    h = F.xxhash64(key_hash, tree.cast("long"), F.lit(seed).cast("long"))
    out = None
    for k, limit in enumerate(poisson_limits()):
        out = F.when(h < F.lit(limit), k) if out is None else out.when(h < F.lit(limit), k)
    return out.otherwise(len(poisson_limits())).cast("long")


@dataclass
class Encoder:
    """Features as bin numbers: a label's rank (one more for unseen ones), or the
    number of cuts below a value."""

    categorical: Sequence[str]
    numeric: Sequence[str]
    labels: Mapping[str, list] = field(default_factory=dict)
    cuts: Mapping[str, list[float]] = field(default_factory=dict)

    def complete(self, df: DataFrame) -> DataFrame:
        """Rows without null or NaN in a numeric feature."""
        return df.na.drop(how="any", subset=list(self.numeric)) if self.numeric else df

    def bins(self) -> Column:
        ranks = [label_or_default(c, {x: i for i, x in enumerate(self.labels[c])}, len(self.labels[c])).cast("int")
                 for c in self.categorical]
        return F.array(*ranks, *[_cuts_below(F.col(c).cast("double"), self.cuts[c]) for c in self.numeric])


def _literal(numbers: Sequence, kind: str) -> Column:
    """A constant array (one literal, folded when planned)."""
    if not numbers:
        return F.array().cast(f"array<{kind}>")
    return F.split(F.lit(",".join(map(repr, numbers))), ",").cast(f"array<{kind}>")


def _cuts_below(value: Column, cuts: Sequence[float]) -> Column:
    """Number of sorted ``cuts`` that are less than ``value``, by binary search."""
    if not cuts:
        return F.lit(0)
    known, n = _literal(cuts, "double"), len(cuts)
    steps = [1 << k for k in reversed(range(n.bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(
        (at + s <= n) & (F.get(known, at + s - 1) < value), at + s).otherwise(at))


def fit_encoder(train: DataFrame, categorical: Sequence[str], numeric: Sequence[str], max_bins: int) -> Encoder:
    """Bins from the training rows.  More than ``max_bins - 1`` labels of a categorical feature are an
    error, found from a count before any label is fetched.  A numeric feature with up to
    ``max_bins`` values is cut at each of them, another at its ``max_bins`` quantiles."""
    counts = train.agg(*[F.count_distinct(c).alias(f"c{i}") for i, c in enumerate(categorical)],
                       *[F.approx_count_distinct(c, 0.02).alias(f"n{i}") for i, c in enumerate(numeric)]).first()
    for i, c in enumerate(categorical):
        if counts[f"c{i}"] >= max_bins:
            raise ValueError(f"{c} has {counts[f'c{i}']} labels; with max_bins={max_bins} there may be {max_bins - 1}")
    few = [c for i, c in enumerate(numeric) if counts[f"n{i}"] <= max_bins * 1.1]
    # by now each of these features is known to have few values
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("label"),
                               F.lit(None).cast("double").alias("v")) for c in categorical],
                    *[F.struct(F.lit(c).alias("feature"), F.lit(None).cast("string").alias("label"),
                               F.col(c).cast("double").alias("v")) for c in few])
    values = (train.select(F.explode(cells).alias("x")).select("x.*").groupBy("feature", "label", "v")
              .agg(F.count(F.lit(1)).alias("n")).collect())
    labels = {c: [r["label"] for r in sorted((r for r in values if r["feature"] == c and r["label"] is not None),
                                             key=lambda r: (-r["n"], r["label"].encode()))] for c in categorical}
    cuts: dict[str, list[float]] = {}
    for c in few:
        own = sorted({r["v"] for r in values if r["feature"] == c and r["v"] is not None and r["v"] == r["v"]})
        if len(own) <= max_bins:
            cuts[c] = own[:-1]
    many = [c for c in numeric if c not in cuts]
    if many:
        probs = [k / max_bins for k in range(1, max_bins)]
        for c, found in column_quantiles(train, many, probs, 0.5 / max_bins).items():
            cuts[c] = sorted({x for x in found if x is not None})
    return Encoder(categorical, numeric, labels, cuts)


@dataclass
class Forest:
    """Grown trees.  Nodes are numbered as in a heap (root 1, children 2n and 2n + 1), a tree's
    nodes after the other's: feature (-1 at a leaf), bins that go left (as bits),
    mean label."""

    encoder: Encoder
    trees: int
    depth: int
    words: int
    prediction: str
    feature: list[int]
    left: list[int]
    mean: list[float]

    @property
    def size(self) -> int:
        return 1 << (self.depth + 1)

    def below(self, tree: Column, node: Column, bins: Column) -> Column:
        """The node that a row goes to next (the same one at a leaf)."""
        at = tree * self.size + node
        return _step(_literal(self.feature, "int"), _literal(self.left, "bigint"), self.words, at, node, bins)

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows with complete features, and their predictions: the mean over all trees, in
        their order, of the leaves they reach."""
        rows = self.encoder.complete(df).withColumn("__bins", self.encoder.bins())
        mean = _literal(self.mean, "double")
        levels = F.sequence(F.lit(1), F.lit(self.depth))

        def leaf(tree: Column) -> Column:
            return F.aggregate(levels, F.lit(1), lambda node, _: self.below(tree, node, F.col("__bins")))

        total = F.aggregate(F.sequence(F.lit(0), F.lit(self.trees - 1)), F.lit(0.0),
                            lambda s, t: s + F.get(mean, t * self.size + leaf(t)))
        return rows.withColumn(self.prediction, total / self.trees).drop("__bins")


def _step(feature: Column, left: Column, words: int, at: Column, node: Column, bins: Column) -> Column:
    f = F.get(feature, at)
    number = F.get(bins, f)
    word = F.get(left, at * words + F.shiftright(number, 6))
    goes_left = F.expr("1L").bitwiseAND(F.call_function("shiftrightunsigned", word, number.bitwiseAND(F.lit(63)))) == 1
    return F.when(f < 0, node).otherwise(2 * node + F.when(goes_left, 0).otherwise(1))


def _bits(bins: Sequence[int], words: int) -> list[int]:
    out = [0] * words
    for b in bins:
        out[b >> 6] |= 1 << (b & 63)
    return [x - (1 << 64) if x >> 63 else x for x in out]


def fit_forest(train: DataFrame, key: Sequence[str] = (K.SEQ,), categorical: Sequence[str] = (K.LOCATION, K.MEASURE),
               numeric: Sequence[str] = (K.YEAR, K.GDP, K.POP, K.CLUSTER), label: str = K.VAL,
               trees: int = K.FOREST_TREES, max_bins: int = K.FOREST_MAX_BINS, seed: int = K.FOREST_SEED,
               max_depth: int = MAX_DEPTH, prediction: str = K.PREDICTION) -> Forest:
    """Grow ``trees`` trees on rows with a label and complete numeric features.

    A row's draws hang on ``key``: rows that share it are drawn alike.  Every node
    looks at a third of the features, drawn from (seed, tree, node).  Categories of
    a node are ordered by their mean label and cut like numbers.  A node
    without a split that lowers the squared error is a leaf."""
    encoder = fit_encoder(train.where(F.col(label).isNotNull()), categorical, numeric, max_bins)
    y = F.col(label).cast("double")
    rows = encoder.complete(train).where(y.isNotNull() & ~F.isnan(y))
    top = rows.agg(F.max(F.abs(y))).first()[0]
    if top is None:
        raise ValueError("no complete row to fit a forest on")
    unit = 2.0 ** (math.frexp(top)[1] - LABEL_BITS) if top else 1.0
    binned = rows.select(F.xxhash64(*[F.col(c) for c in key]).alias("key"),
                         F.round(y / unit).cast("long").alias("y"), encoder.bins().alias("bins"))
    drawn_rows = _drawn(staged(binned, "lake", "forest_rows"), trees, seed)

    n_features = len(categorical) + len(numeric)
    m = max(1, math.ceil(n_features / 3))
    forest = Forest(encoder, trees, max_depth, -(-(max_bins + 1) // 64), prediction, [], [], [])
    forest.feature = [-1] * (trees * forest.size)
    forest.left = [0] * (trees * forest.size * forest.words)
    forest.mean = [0.0] * (trees * forest.size)
    live = {(t, 1) for t in range(trees)}
    for level in range(max_depth):
        live = _grow(forest, drawn_rows, level, live, m, n_features, len(categorical), seed, unit)
        if not live:
            break
    return forest


def _drawn(binned: DataFrame, trees: int, seed: int) -> DataFrame:
    """``(tree, bins, n, high, low)``: how often a tree draws a row, and its label as many times, in two
    whole numbers.  One row for each tree and combination of bins where these
    are few against the rows (counted first), else one for each tree and row that it draws."""
    low = (1 << _LOW) - 1
    rows = binned.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    rows = rows.withColumn("n", draws(F.col("key"), F.col("tree"), seed)).where("n > 0").select(
        "tree", "bins", "n", (F.col("n") * F.shiftright("y", _LOW)).alias("high"),
        (F.col("n") * F.col("y").bitwiseAND(F.lit(low))).alias("low"))
    size = binned.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("bins").alias("combinations")).first()
    if size["combinations"] * ROWS_OF_A_COMBINATION > size["rows"]:
        return rows
    sums = rows.groupBy("tree", "bins").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")])
    return staged(sums, "lake", "forest_draws")


def _grow(forest: Forest, drawn_rows: DataFrame, level: int, live: set[tuple[int, int]], m: int, n_features: int,
          n_categorical: int, seed: int, unit: float) -> set[tuple[int, int]]:
    """Split the ``live`` nodes of a level; the nodes below that are to be looked at next."""
    asked = [-1] * (forest.trees * forest.size * m)
    for t, node in live:
        drawn = sorted(random.Random(f"{seed}/{t}/{node}").sample(range(n_features), m))
        at = (t * forest.size + node) * m
        asked[at:at + m] = drawn
    rows = drawn_rows.withColumn("n0", F.lit(1))
    for k in range(level):
        rows = rows.withColumn(f"n{k + 1}", forest.below(F.col("tree"), F.col(f"n{k}"), F.col("bins")))
    at = (F.col("tree") * forest.size + F.col(f"n{level}")) * m
    features = _literal(asked, "int")
    cells = (rows.select("tree", F.col(f"n{level}").alias("node"), "n", "high", "low", "bins",
                         F.explode(F.array(*[F.get(features, at + j) for j in range(m)])).alias("f")).where("f >= 0"))
    # two sums of whole numbers each, so that no order of adding matters and none overflows
    sums = cells.groupBy("tree", "node", "f", F.get("bins", F.col("f")).alias("bin")).agg(
        *[F.sum(c).alias(c) for c in ("n", "high", "low")])
    total = (F.col("high").cast("decimal(38,0)") * (1 << _LOW) + F.col("low").cast("decimal(38,0)")).cast("double")
    bins = sums.select("tree", "node", "f", "bin", "n", total.alias("s"))
    order = F.when(F.col("f") < n_categorical, F.col("s") / F.col("n")).otherwise(F.lit(0.0))
    listed = bins.groupBy("tree", "node", "f").agg(
        F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("bin"), F.col("n").cast("double").alias("n"),
                                             F.col("s")))).alias("b"))
    sized = listed.withColumn("n", F.aggregate("b", F.lit(0.0), lambda a, x: a + x["n"])).withColumn(
        "s", F.aggregate("b", F.lit(0.0), lambda a, x: a + x["s"]))
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("s"), F.lit(0).alias("i"), F.lit(-1.0).alias("score"),
                     F.lit(0).alias("cut"), F.lit(0.0).alias("ln"), F.lit(0.0).alias("ls"))

    def add(a: Column, x: Column) -> Column:
        n, s = a["n"] + x["n"], a["s"] + x["s"]
        rest_n, rest_s = F.col("n") - n, F.col("s") - s
        score = F.when(rest_n > 0, s * s / n + rest_s * rest_s / rest_n)
        better = F.coalesce(score > a["score"], F.lit(False))
        return F.struct(n.alias("n"), s.alias("s"), (a["i"] + 1).alias("i"),
                        F.when(better, score).otherwise(a["score"]).alias("score"),
                        F.when(better, a["i"] + 1).otherwise(a["cut"]).alias("cut"),
                        F.when(better, n).otherwise(a["ln"]).alias("ln"), F.when(better, s).otherwise(a["ls"]).alias("ls"))

    best = sized.withColumn("best", F.aggregate("b", start, add)).select(
        "tree", "node", "f", "n", "s", "best.score", "best.ln", "best.ls",
        F.transform(F.slice("b", F.lit(1), F.col("best.cut")), lambda x: x["bin"]).alias("left"))
    packed = F.struct("f", "n", "s", "score", "ln", "ls", "left")
    chosen = best.groupBy("tree", "node").agg(F.max_by(packed, F.struct(F.col("score"), -F.col("f"))).alias("c"))
    deeper = set()
    for r in chosen.collect():                         # one row for each live node
        t, node, c = r["tree"], r["node"], r["c"]
        at = t * forest.size + node
        forest.mean[at] = c["s"] / c["n"] * unit
        if c["score"] <= c["s"] * c["s"] / c["n"] * (1 + 1e-12):
            continue
        left = range(max(c["left"]) + 1) if c["f"] >= n_categorical else c["left"]
        forest.feature[at] = c["f"]
        forest.left[at * forest.words:(at + 1) * forest.words] = _bits(left, forest.words)
        for child, n, s in ((2 * node, c["ln"], c["ls"]), (2 * node + 1, c["n"] - c["ln"], c["s"] - c["ls"])):
            forest.mean[t * forest.size + child] = s / n * unit
            deeper.add((t, child))
    return deeper
