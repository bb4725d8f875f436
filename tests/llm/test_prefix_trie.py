"""The prefix trie against a plain dictionary of all prefixes."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from panelrisk.llm import prefix_trie
from panelrisk.llm.common import table

SF = "/root/testdata/sf0.001"


def rebuilt_by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            label = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), role, label, text))
    own = {c: [(r, t) for _, r, _, t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + ts[h:]
    return out


def by_hand(rows):
    convs = rebuilt_by_hand(rows)
    members = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, cs in members.items():
        full = ",".join(map(str, sorted(c for c in cs if len(convs[c]) == len(p))))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p],
                    hashlib.sha256(full.encode()).hexdigest()))
    return Counter(out)


def test_two_fattest():
    for low in range(20):
        for high in range(low + 1, 40):
            want = max(range(low + 1, high + 1), key=lambda x: x & -x)
            assert prefix_trie.two_fattest(low, high) == want


@pytest.mark.parametrize("seed", range(6))
def test_z_fast_trie_of_drawn_keys(seed):
    draw = random.Random(seed)
    start = draw.choice([0, 3])
    common = [b"x"] * (start + 1)
    keys = {tuple(common + [bytes([draw.choice(b"ab")]) for _ in range(draw.choice([0, 1, 2, 5, 9, 40]))])
            for _ in range(200)}
    trie, least = prefix_trie.ZFastTrie(start), {}
    for half in (0, 1):  # in two batches
        batch = [k for i, k in enumerate(sorted(keys)) if i % 2 == half]
        for k in batch:
            least[k] = draw.randrange(10**6)
        trie.insert_batch((prefix_trie.names(k), [3] * len(k), 2, least[k]) for k in batch)
    assert set(trie.handles) == {n.handle() for n in trie.nodes} and len(trie.handles) == len(trie.nodes)
    for k in keys:
        path = prefix_trie.names(k)
        node = trie.exit_node(path)
        assert node.holds(path) and node.end == len(k)
    got = Counter(r[:8] for r in trie.expanded())
    members = defaultdict(set)
    for k in keys:
        for d in range(start + 1, len(k) + 1):
            members[k[:d]].add(k)
    children = Counter(p[:-1] for p in members)
    saved = Counter()
    leaves = Counter()
    for p, ks in members.items():
        for d in range(start + 1, len(p) + 1):
            saved[p[:d]] += (2 * len(ks) - 1) * 3
            leaves[p[:d]] += not children[p]
    first = lambda p: min(least[k] for k in members[p])
    assert got == Counter((prefix_trie.names(p)[-1], first(p), len(p), first(p[:-1]) if len(p) > start + 1 else None,
                           2 * len(members[p]), children[p], leaves[p], saved[p]) for p in members)


@pytest.mark.parametrize("sizes", [{}, {"bound": 1, "chunk": 2}, {"bound": 5, "chunk": 3}])
def test_trie_of_conversations(spark, sizes):
    rows = table(spark, SF, "conversations").select("conv_id", "turn", "role", "text")
    got = Counter(map(tuple, prefix_trie.trie_nodes(rows, **sizes).collect()))
    assert got == by_hand(map(tuple, rows.collect()))


@pytest.mark.parametrize("bound", [None, 2])
def test_trie_of_odd_rows(spark, bound):
    schema = "conv_id long, turn long, role string, text string, id string, _t int"
    rows = [(c, t, r, x, "i", 1) for c in (0, 1, 2, 7, 100, 205, 250) for t, r, x in (
        (1, "user", "hi"), (None, None, None), (None, "user", ""), (2, "user", "ä" * (c % 3)), (2, "user", "tie"))]
    rows += [(300 + i, 0, "user", "same", "i", 2) for i in range(40)] + rows[:3]  # alike, and rows repeated
    rows += [(None, 1, "user", "no conversation", "i", 3), (-3, 5, "user", "below nought", "i", 3)]
    rows += [(9000, t, "user", "x" * (t % 5), "i", 4) for t in range(700)]          # one long conversation
    rows += [(9001, t, "user", "x" * (t % 5) if t != 600 else "else", "i", 4) for t in range(700)]
    df = spark.createDataFrame(rows, schema)
    got = Counter(map(tuple, prefix_trie.trie_nodes(df, bound).collect()))
    assert got == by_hand([r[:4] for r in rows])
    assert prefix_trie.trie_nodes(df.limit(0)).count() == 0
