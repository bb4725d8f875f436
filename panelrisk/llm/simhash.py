"""SimHash near-duplicates, found with vantage-point trees over Hamming distance.

Fingerprints are made from whole texts, equal ones are one class, and classes
are dealt out by the top of a vantage-point tree: every node splits at a
distance from its vantage point, and by the triangle inequality a fingerprint
can only have neighbours on the other side if its own distance is within the
radius of the split.  Such boundary fingerprints visit the other side too, so
every shard finds its pairs exactly on its own, going on down the tree in the
same way.  A shard reports a spanning forest of its links, and the forests are
joined to components by alternating stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrisk.llm.common import map_texts, null_safe_join, salt, stage

#: The contract's shingle length and greatest distance of a link.
SHINGLE = 3
MAX_BITS = 2

#: Most fingerprints in the sample that places the tree's top nodes, and the
#: share of all classes that it is at most.
TREE_SAMPLE = 65_536
TREE_SHARE = 16

#: Fingerprints that a shard should hold before visitors come.
SHARD_ROWS = 8192

#: Below this many fingerprints a branch is compared directly.
LEAF = 256


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    size = min(shingle, n)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], 42) for a, b in zip(starts[: n - size + 1].tolist(), ends[size - 1:].tolist())],
                      np.uint64)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 8192):  # bounded memory for long texts
        block = hashes[k:k + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and its fingerprint ``fp`` (the 64 bits as a signed long)."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    return map_texts(src, lambda: lambda texts: {
        "fp": np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)}, {"fp": "long"})


# -- the tree ---------------------------------------------------------------

def distance(fps: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(fps ^ point)


def vantage(fps: np.ndarray) -> tuple[np.uint64, int]:
    """A vantage point and its split: of some candidates spread over the
    array, the one that leaves the fewest fingerprints at its boundary."""
    best = None
    for p in fps[:: max(1, len(fps) // 8)][:8]:
        d = distance(fps, p)
        cut = int(np.median(d))
        if cut >= int(d.max()):
            cut = int(d.max()) - 1
        key = (int(np.count_nonzero(np.abs(d.astype(np.int64) - cut) <= MAX_BITS)), int(p))
        if best is None or key < best[0]:
            best = (key, p, cut)
    return best[1], best[2]


def tree_top(sample: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """Vantage points and splits of the top ``depth`` levels as a heap: node
    k has children 2k + 1 (distance up to the split) and 2k + 2."""
    nodes: list[tuple[int, int]] = []
    level = [np.unique(sample)]
    for _ in range(depth):
        below = []
        for own in level:
            if len(own) < 2:
                nodes.append((0, 64))  # all go to the near child
                below += [own, own[:0]]
                continue
            point, cut = vantage(own)
            nodes.append((int(point), cut))
            near = distance(own, point) <= cut
            below += [own[near], own[~near]]
        level = below
    return nodes


def deal(fps: np.ndarray, nodes: list[tuple[int, int]], depth: int, radius: int) -> tuple[np.ndarray, ...]:
    """(row, shard, home) of every shard a fingerprint lives in or visits.

    A fingerprint has one home.  It leaves its home's side as a visitor where
    the split is within the radius; only from the near side, as of two
    neighbours on both sides one visit is enough.  A visitor goes wherever
    the triangle inequality does not rule out neighbours."""
    row, at = np.arange(len(fps)), np.zeros(len(fps), np.int64)
    home = np.ones(len(fps), bool)
    points = np.array([p for p, _ in nodes], np.uint64)
    cuts = np.array([c for _, c in nodes], np.int64)
    for _ in range(depth):
        d = np.bitwise_count(fps[row] ^ points[at]).astype(np.int64)
        near = d <= cuts[at]
        to_near = np.where(home, near, d <= cuts[at] + radius)
        far_home = home & ~near
        to_far = np.where(home, (~near) | (d > cuts[at] - radius), d > cuts[at] - radius)
        row, home, at = (np.concatenate((row[to_near], row[to_far])),
                         np.concatenate((home[to_near], far_home[to_far])),
                         np.concatenate((2 * at[to_near] + 1, 2 * at[to_far] + 2)))
    return row, at - (len(nodes)), home


def shard_forest(fps: np.ndarray, home: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in a shard that touch a home row, as
    two arrays of row numbers.  Branches are split on vantage points down to
    LEAF rows; links are merged as they are found, so dense groups cost no
    memory."""
    root = np.arange(len(fps))
    stack = [(np.flatnonzero(home), np.flatnonzero(~home))]
    while stack:
        own, guests = stack.pop()
        if not len(own) or len(own) + len(guests) < 2:
            continue
        if len(own) > LEAF:
            point, cut = vantage(fps[own])
            d = distance(fps[own], point).astype(np.int64)
            g = distance(fps[guests], point).astype(np.int64)
            near = d <= cut
            if near.any() and not near.all():
                stack.append((own[near], guests[g <= cut + radius]))
                stack.append((own[~near], np.concatenate((own[near & (d > cut - radius)], guests[g > cut - radius]))))
                continue
        both = np.concatenate((own, guests))
        step = max(1, 2_000_000 // len(both))
        for k in range(0, len(own), step):
            some = own[k:k + step]
            a, b = np.nonzero(np.bitwise_count(fps[some][:, None] ^ fps[both][None, :]) <= radius)
            a, b = some[a], both[b]
            root = _merge(root, a[a != b], b[a != b])
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return moved, root[moved]


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the trees of linked rows; every row points straight to the least
    row of its component."""
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        if not len(a):
            break
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


# -- the job ----------------------------------------------------------------

def links(classes: DataFrame, radius: int, shard_rows: int, sample_rows: int) -> DataFrame:
    """Spanning links (``u``, ``v``: node ids) between classes (``node``,
    ``fp``) whose fingerprints differ in at most ``radius`` bits."""
    n = classes.count()
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / shard_rows))))
    sample = np.array([r["fp"] for r in classes.select("fp").orderBy(F.xxhash64("fp"), "fp")
                       .limit(min(sample_rows, n // TREE_SHARE)).collect()], np.int64).view(np.uint64)
    nodes = tree_top(sample, depth)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = b["fp"].to_numpy(np.int64).view(np.uint64)
            row, shard, home = deal(fps, nodes, depth, radius)
            yield pd.DataFrame({"shard": shard, "node": b["node"].to_numpy()[row],
                                "fp": b["fp"].to_numpy()[row], "home": home})

    def solve(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["node", "home"], ignore_index=True)
        u, v = shard_forest(b["fp"].to_numpy(np.int64).view(np.uint64), b["home"].to_numpy(bool), radius)
        node = b["node"].to_numpy()
        return pd.DataFrame({"u": node[u], "v": node[v]})

    dealt = classes.mapInPandas(send, "shard long, node long, fp long, home boolean")
    return dealt.groupBy("shard").applyInPandas(solve, "u long, v long").where("u <> v")


def components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """``node`` and the least node it is connected to (``component``), for
    all nodes that have a link, by alternating large and small stars; every
    round is staged."""
    edges = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (_to_least(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (_to_least(large, least).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = stage(small, name)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state


def _to_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges with their node's least neighbour; a hub's edges are dealt out."""
    salted = edges.withColumn("_s", salt(F.col("v"), 8))
    dealt = least.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(7))))
    return salted.join(dealt, ["u", "_s"]).drop("_s")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE,
                max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS, sample_rows: int = TREE_SAMPLE) -> DataFrame:
    """One row for each document: ``doc_id, fingerprint, component_id``.

    Documents whose fingerprints differ in at most ``max_bits`` bits are
    linked; ``component_id`` is the least id reachable over links, the
    document's own included.  Null, empty and wordless texts have fingerprint
    zero, which links like any other.  Ids are whole numbers; a null id never
    names a component unless all ids of the component are null.  Repeated
    rows repeat.  Columns other than the two named are not looked at."""
    fps = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    # one node for each fingerprint; equal ones are combined before they move
    classes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "classes")
    edges = links(classes.select(F.col("fp").alias("node"), "fp"), max_bits, shard_rows, sample_rows)
    found = components(edges)
    labelled = null_safe_join(classes, found.withColumnRenamed("node", "fp"), ["fp"])
    labelled = labelled.withColumn("component", F.coalesce("component", "fp"))
    names = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    labelled = null_safe_join(labelled, names, ["component"]).select("fp", "component_id")
    # back to the documents: a hot fingerprint's rows are dealt out
    salted = fps.withColumn("_salt", salt(F.col("doc_id")))
    present = salted.groupBy("fp", "_salt").agg(F.lit(1).alias("_x")).drop("_x").join(labelled, "fp")
    return (salted.join(present, ["fp", "_salt"])
            .select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Ids of the documents that stay: the least of each component."""
    groups = near_groups(docs, id_col, text_col, **options)
    return groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id")
