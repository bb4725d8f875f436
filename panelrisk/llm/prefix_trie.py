"""Conversations in a prefix trie, built from z-fast tries.

A node stands for the conversations that begin with the same turns.  Its name
is a chain of SHA-256 digests over those turns, so that names of one depth
are compared in place of texts.

* Equal conversations are counted first and are one key from then on.
* Names that begin more than ``bound`` different keys are *heavy*.  There are
  at most 10**6 of them whatever the size of the input, the root being one;
  every key finds its deepest heavy name by fat binary search among them.
* The keys below one light child of a heavy name meet in one task.  It puts
  them into a z-fast trie: compacted nodes under the name at the two-fattest
  depth of their edge, the exit node of a key found by fat binary search, the
  keys of the task inserted as one sorted batch.  Then the edges are expanded, one
  node for each depth.
* Heavy nodes are summed up from what hangs below them.

Digests of members' ids go over chunks of sorted ids, so a conversation that
a third of all ids share is sorted by many tasks, and only its chunks meet.

Turns stand in order of turn (null first), then role, then the digest of
role and text; null role and text are empty.  Rows without conv_id belong
to no conversation and are left out.  Repeated rows are repeated turns.  A
table without conversations has no root and gives no rows.  A
conversation's turns (digest and length, not text) meet in one task.  Extra
columns are not read."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrisk.llm.common import stage
from panelrisk.operators.joins import salted_left_join

#: Keys that one task's trie takes on at least before their name counts as heavy.
KEYS_AT_ONCE = 2_000

#: Heavy names there can be at most.
MOST_HEAVY = 1_000_000

#: Ids that one chunk joins.
CHUNK = 50_000

ROOT = hashlib.sha256(b"").digest()


def names(labels: Iterable[bytes]) -> list[bytes]:
    """Name of every prefix, the empty one included."""
    out = [ROOT]
    for label in labels:
        out.append(hashlib.sha256(out[-1] + label).digest())
    return out


# ---------------------------------------------------------------- the trie of one task
def two_fattest(low: int, high: int) -> int:
    """The number in ``(low, high]`` that the highest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class Node:
    """An edge and its lower end: depths ``(start, end]`` of ``path``."""

    __slots__ = ("start", "end", "path", "points", "parent", "children", "n", "least", "leaves", "saved")

    def __init__(self, start: int, end: int, path: list[bytes], points: list[int], parent: Node | None):
        self.start, self.end, self.path, self.points, self.parent = start, end, path, points, parent
        self.children: dict[bytes, Node] = {}
        self.n, self.least, self.leaves, self.saved = 0, None, 0, 0

    def handle(self) -> bytes:
        return self.path[two_fattest(self.start, self.end)]

    def holds(self, path: list[bytes]) -> bool:
        """Whether ``path`` goes over the whole edge."""
        return self.end < len(path) and path[self.end] == self.path[self.end]


class ZFastTrie:
    """Keys that agree up to depth ``start + 1``, in compacted nodes."""

    def __init__(self, start: int):
        self.start = start
        self.handles: dict[bytes, Node] = {}
        self.nodes: list[Node] = []
        self.top: Node | None = None

    def _add(self, node: Node) -> Node:
        self.handles[node.handle()] = node
        self.nodes.append(node)
        if node.parent is None:
            self.top = node
        else:
            node.parent.children[node.path[node.start + 1]] = node
        return node

    def exit_node(self, path: list[bytes]) -> Node | None:
        """The node whose edge ``path`` leaves or ends on, by fat binary search."""
        low, high, deepest = self.start, len(path) - 1, None
        while low < high:
            f = two_fattest(low, high)
            node = self.handles.get(path[f])
            if node is None:
                high = f - 1
            elif node.holds(path):
                low, deepest = node.end, node
            else:
                return node
        if deepest is None:
            return self.top
        return deepest if low + 1 >= len(path) else deepest.children.get(path[low + 1], deepest)

    def insert(self, path: list[bytes], points: list[int], n: int, least: int) -> None:
        node, depth = self.exit_node(path), len(path) - 1
        if node is None:
            node = self._add(Node(self.start, depth, path, points, None))
        else:
            if not node.holds(path):
                node = self._split(node, self._common(node, path))
            if node.end < depth:
                node = self._add(Node(node.end, depth, path, points, node))
        node.n += n
        node.least = least if node.least is None else min(node.least, least)

    @staticmethod
    def _common(node: Node, path: list[bytes]) -> int:
        """Depth up to which ``path`` follows the node's edge."""
        depths = range(node.start + 1, min(node.end, len(path) - 1) + 1)
        return node.start + bisect_left(depths, 1, key=lambda d: path[d] != node.path[d])

    def _split(self, node: Node, at: int) -> Node:
        """The upper part of the node's edge, down to depth ``at``, as a node."""
        del self.handles[node.handle()]
        upper = self._add(Node(node.start, at, node.path, node.points, node.parent))
        node.start, node.parent = at, upper
        upper.children[node.path[at + 1]] = node
        self.handles[node.handle()] = node
        return upper

    def insert_batch(self, keys: Iterable[tuple[list[bytes], list[int], int, int]]) -> None:
        for key in sorted(keys, key=lambda k: k[0]):
            self.insert(*key)

    def expanded(self) -> Iterator[tuple]:
        """``(name, least id, depth, parent's least id, members, children,
        leaves, saved, name of the depth above the trie)`` for every depth of every edge."""
        for node in sorted(self.nodes, key=lambda x: -x.start):  # those below come first
            below = node.children.values()
            node.n += sum(c.n for c in below)
            node.least = min([c.least for c in below] + ([] if node.least is None else [node.least]))
            node.leaves = sum(c.leaves for c in below) or 1
            saved = sum(c.saved for c in below)
            children = len(below)
            for c in below:
                top = c.start + 1
                yield (c.path[top], c.least, top, node.least, c.n, 1 if c.end > top else len(c.children), c.leaves,
                       c.saved, None)
            for depth in range(node.end, node.start, -1):
                saved += (node.n - 1) * node.points[depth - 1]
                if depth > node.start + 1:
                    yield (node.path[depth], node.least, depth, node.least, node.n, children, node.leaves, saved, None)
                    children = 1
            node.saved = saved
            if node.parent is None:
                yield (node.path[node.start + 1], node.least, node.start + 1, None, node.n, children, node.leaves,
                       saved, node.path[node.start])


# ---------------------------------------------------------------- jobs
def rebuilt(conversations: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """``(conv_id, labels, points)``: each conversation's turns as digests and
    code points.  Conversation c takes its first h = crc32(c) % ``most`` turns from
    conversation c - c % ``family`` (fewer if that has fewer), the others are its own."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    label = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    turn = F.struct(F.col("turn").isNotNull().alias("_known"), F.col("turn"), role.alias("role"),
                    label.alias("label"), F.length(text).cast("long").alias("points"))
    own = (conversations.where(F.col("conv_id").isNotNull()).groupBy("conv_id")
           .agg(F.array_sort(F.collect_list(turn)).alias("_t")))
    own = own.select("conv_id", F.transform("_t", lambda t: F.struct(t["label"].alias("label"),
                                                                      t["points"].alias("points"))).alias("_t"))
    heads = own.select(F.col("conv_id").alias("_base"), F.slice("_t", 1, most - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % family == F.col("_base"), "left")
    head = F.coalesce(F.slice("_head", F.lit(1), h), F.slice("_t", 1, 0))
    rest = F.slice("_t", h + 1, F.greatest(F.size("_t") - h, F.lit(0)))
    turns = joined.select("conv_id", F.concat(head, rest).alias("_t"))
    return turns.select("conv_id", F.col("_t.label").alias("labels"), F.col("_t.points").alias("points"))


def _name(labels: str) -> Column:
    return F.aggregate(labels, F.unhex(F.sha2(F.lit(""), 256)), lambda p, x: F.unhex(F.sha2(F.concat(p, x), 256)))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def _batched(rows: Iterable[tuple], schema: pa.Schema, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def heavy_names(keys: DataFrame, bound: int) -> frozenset[bytes]:
    """Names that more than ``bound`` keys begin with, and the root."""
    schema = pa.schema([("id", pa.binary())])

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(((name,) for (labels,) in _rows(batches) for name in names(labels)[1:]), schema)

    heavy = (keys.select("labels").mapInArrow(prefixes, "id binary").groupBy("id").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > bound).select("id"))
    return frozenset([ROOT, *(bytes(r.id) for r in heavy.collect())])


def deepest(path: list[bytes], heavy: frozenset[bytes]) -> int:
    """Depth of the last heavy name on ``path``, by fat binary search: names above a heavy one are heavy."""
    low, high = 0, len(path) - 1
    while low < high:
        f = two_fattest(low, high)
        if path[f] in heavy:
            low = f
        else:
            high = f - 1
    return low


_NODE = pa.schema([("id", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
                   ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                   ("saved_tokens", pa.int64()), ("above", pa.binary())])
_NODE_SQL = ("id binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
             "saved_tokens long, above binary")


def light_nodes(keys: DataFrame, heavy: frozenset[bytes]) -> DataFrame:
    """The nodes below heavy names, from one z-fast trie for each light child of one."""
    routed_schema = pa.schema([("route", pa.binary()), ("start", pa.int64()), ("labels", pa.list_(pa.binary())),
                               ("points", pa.list_(pa.int64())), ("n", pa.int64()), ("least", pa.int64())])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for labels, points, n, least in _rows(batches):
                path = names(labels)
                start = deepest(path, heavy)
                if start + 1 < len(path):
                    yield path[start + 1], start, labels, points, n, least
        return _batched(rows(), routed_schema, 1_000)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (_, start), group in groupby(_rows(batches), key=lambda r: r[:2]):
                trie = ZFastTrie(start)
                trie.insert_batch((names(labels), points, n, least) for _, _, labels, points, n, least in group)
                yield from trie.expanded()
        return _batched(rows(), _NODE)

    routed = keys.select("labels", "points", "n", "least").mapInArrow(
        route, "route binary, start long, labels array<binary>, points array<long>, n long, least long")
    return routed.repartition("route").sortWithinPartitions("route").mapInArrow(build, _NODE_SQL)


def heavy_nodes(keys: DataFrame, heavy: frozenset[bytes], light: DataFrame) -> DataFrame:
    """Heavy nodes, summed up from the keys that pass them and from what hangs below them."""
    schema = pa.schema([("id", pa.binary()), ("depth", pa.int64()), ("parent", pa.binary()), ("points", pa.int64()),
                        ("n", pa.int64()), ("least", pa.int64())])

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[bytes, list] = {}
        for labels, points, n, least in _rows(batches):
            path = names(labels)
            for d in range(deepest(path, heavy) + 1):
                got = sums.setdefault(path[d], [d, path[d - 1] if d else None, points[d - 1] if d else 0, 0, least])
                got[3] += n
                got[4] = min(got[4], least)
        return _batched(((name, *got) for name, got in sums.items()), schema)

    own = (keys.select("labels", "points", "n", "least")
           .mapInArrow(passing, "id binary, depth long, parent binary, points long, n long, least long")
           .groupBy("id", "depth", "parent", "points").agg(F.sum("n").alias("n"), F.min("least").alias("least")))
    hung = light.where(F.col("above").isNotNull()).groupBy(F.col("above").alias("id")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    both = own.join(hung, "id", "left").na.fill(0, ["children", "leaves", "saved"]).select(
        "id", "depth", "parent", "points", "n", "least", "children", "leaves", "saved")

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = sorted(_rows(batches), key=lambda r: -r[1])
        least = {r[0]: r[5] for r in nodes}
        below: dict[bytes, list[int]] = {}

        def rows():
            for name, depth, parent, points, n, first, children, leaves, saved in nodes:
                more = below.pop(name, (0, 0, 0))
                children, leaves = children + more[0], (leaves + more[1]) or 1
                saved += more[2] + (n - 1) * points
                if parent is not None:
                    sums = below.setdefault(parent, [0, 0, 0])
                    sums[0] += 1
                    sums[1] += leaves
                    sums[2] += saved
                yield name, first, depth, least.get(parent), n, children, leaves, saved, None
        return _batched(rows(), _NODE)

    # at most MOST_HEAVY rows, whatever the input
    return both.repartition(1).mapInArrow(sum_up, _NODE_SQL)


def ends(ids: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(id, ends_sha256)``: digest of the sorted ``conv_id`` of each ``id``, joined by commas."""
    piece = pa.schema([("id", pa.binary()), ("first", pa.int64()), ("joined", pa.string())])

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for name, group in groupby(_rows(batches), key=lambda r: r[0]):
                held = []
                for _, conv in group:
                    held.append(conv)
                    if len(held) == chunk:
                        yield name, held[0], ",".join(map(str, held))
                        held = []
                if held:
                    yield name, held[0], ",".join(map(str, held))
        return _batched(rows(), piece, 500)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for name, group in groupby(_rows(batches), key=lambda r: r[0]):
                total = hashlib.sha256()
                for k, (_, _, joined) in enumerate(group):
                    total.update(((("," if k else "") + joined)).encode())
                yield name, total.hexdigest()
        return _batched(rows(), pa.schema([("id", pa.binary()), ("ends_sha256", pa.string())]))

    pieces = (ids.select("id", "conv_id").repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
              .mapInArrow(join_ids, "id binary, first long, joined string"))
    return (pieces.repartition("id").sortWithinPartitions("id", "first")
            .mapInArrow(digest, "id binary, ends_sha256 string"))


def trie_nodes(conversations: DataFrame, bound: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations: ``conv_id``
    (least member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (over its subtree, members beyond the
    first times code points of the last text) and ``ends_sha256`` of the
    members that have no more turns."""
    convs = rebuilt(conversations)
    convs = stage(convs.withColumn("id", _name("labels")), "trie-conversations")
    keys = stage(convs.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"),
                                         F.first("labels").alias("labels"), F.first("points").alias("points")),
                 "trie-keys")
    if bound is None:
        turns = keys.agg(F.sum(F.size("labels"))).first()[0] or 0
        bound = max(KEYS_AT_ONCE, -(-turns // MOST_HEAVY))
    heavy = heavy_names(keys, bound)
    light = stage(light_nodes(keys, heavy), "trie-light")
    top = stage(heavy_nodes(keys, heavy, light), "trie-heavy")
    above = top.select(F.col("id").alias("_above"), F.col("conv_id").alias("_least"))
    hung = salted_left_join(light.where(F.col("above").isNotNull()), above, ["above"], ["_above"], ["id"])
    hung = hung.withColumn("parent_conv_id", F.col("_least")).select(*light.columns)
    nodes = light.where(F.col("above").isNull()).unionByName(hung).unionByName(top)
    found = nodes.join(ends(convs, chunk), "id", "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
