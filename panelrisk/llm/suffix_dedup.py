"""Removal of repeated byte strings by suffix arrays built with induced sorting.

Two equal strings of ``LENGTH`` bytes hold the same least k-gram hash, their
anchor, at the same place.  Anchors therefore send equal strings to the same
shard: a first shuffle of bare hashes finds the anchors that several documents
share, and only the stretches of text around those go on, cut into fragments
whose windows have one anchor each.  A shard keeps each distinct fragment once,
builds the suffix array of all of them by induced sorting, and the permuted
common prefixes tell which windows are equal, and so which of them also start
in a document with a smaller id.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrisk.llm.common import null_safe_join, stage, with_group_totals

#: Length of the strings that are compared, and of the k-grams that anchor them.
LENGTH = 50
GRAM = 24

#: Text bytes that a shard of anchors, and of fragments, stands for.
ANCHOR_SHARD = 16 << 20
FRAGMENT_SHARD = 16 << 20

#: Bytes of the fragments that are sorted together (at about 150 bytes of
#: memory each); a shard with more is cut by further bits of the anchors.
SORTED_AT_ONCE = 3 << 19

#: Fragments whose anchors are taken in one go (at about 2 kB of memory each).
HASHED_AT_ONCE = 1 << 12


# -- anchors ----------------------------------------------------------------

def gram_hashes(text: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes from each place."""
    n = len(text) - gram + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        base = np.uint64(0x9E3779B97F4A7C15)
        first = text.astype(np.uint64) + np.uint64(1)
        # by doubling: the hash of a length from those of its halves
        length, power, h = 1, base, first
        for bit in bin(gram)[3:]:
            h = h[: len(h) - length] * power + h[length:]
            length, power = 2 * length, power * power
            if bit == "1":
                h = h[:-1] * base + first[length:length + len(h) - 1]
                length, power = length + 1, power * base
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def window_anchors(text: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """The least k-gram hash of the window of ``length`` bytes from each place."""
    h = gram_hashes(text, gram)
    width = length - gram + 1
    if len(h) < width:
        return np.empty(0, np.uint64)
    low, span = h, 1
    while span * 2 <= width:
        low, span = np.minimum(low[:-span], low[span:]), span * 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def first_anchors(fragments: list[bytes], length: int = LENGTH) -> np.ndarray:
    """The anchor of the first window of each fragment (of ``length`` bytes at least)."""
    heads = np.frombuffer(b"".join([f[:length] for f in fragments]), np.uint8)
    return window_anchors(heads, length)[::length]


def runs(values: np.ndarray) -> np.ndarray:
    """Start of every run of equal values, and the end of the last."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]))


# -- suffix arrays ----------------------------------------------------------

def suffix_types(s: np.ndarray) -> np.ndarray:
    """True for S suffixes (smaller than the next), False for L suffixes, by
    runs of equal symbols; an end mark smaller than all symbols follows."""
    n = len(s)
    is_s = np.empty(n, bool)
    is_s[-1] = False
    differs = np.empty(n, bool)
    differs[-1] = True
    differs[:-1] = s[:-1] != s[1:]
    is_s[:-1] = s[:-1] < s[1:]
    # within a run of equal symbols the type is that of the run's last
    last = np.flatnonzero(differs)
    return np.repeat(is_s[last], np.diff(last, prepend=-1))


def _induce(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """The suffix array that the given order of the leftmost S suffixes
    induces: L suffixes from the left, S suffixes from the right, one symbol's
    bucket at a time and in it one wave of equal symbols after the other."""
    n, kinds = len(s), len(heads)
    sa = np.full(n, -1, np.int64)
    by = lms[np.argsort(s[lms], kind="stable")]
    star = np.searchsorted(s[by], np.arange(kinds + 1))
    fill = heads.copy()

    def put_left(sources: np.ndarray) -> None:
        p = sources[sources > 0] - 1
        p = p[~is_s[p]]
        if not len(p):
            return
        sym = s[p]
        order = np.argsort(sym, kind="stable")
        p, sym = p[order], sym[order]
        edge = runs(sym)
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            k = int(sym[a])
            at = fill[k]
            sa[at:at + b - a] = p[a:b]
            fill[k] = at + b - a

    put_left(np.array([n], np.int64))  # the end mark's predecessor
    for c in range(kinds):
        done = heads[c]
        while done < fill[c]:  # L suffixes of the bucket, wave by wave
            some = sa[done:fill[c]].copy()
            done = fill[c]
            put_left(some)
        if star[c + 1] > star[c]:
            put_left(by[star[c]:star[c + 1]])

    fill_r = tails.copy()

    def put_right(sources: np.ndarray) -> None:
        p = sources[sources > 0] - 1
        p = p[is_s[p]]
        if not len(p):
            return
        sym = s[p]
        order = np.argsort(sym, kind="stable")
        p, sym = p[order], sym[order]
        edge = runs(sym)
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            k = int(sym[a])
            at = fill_r[k]
            sa[at - (b - a):at] = p[a:b][::-1]
            fill_r[k] = at - (b - a)

    for c in range(kinds - 1, -1, -1):
        done = tails[c]
        while done > fill_r[c]:  # S suffixes of the bucket, wave by wave from the right
            some = sa[fill_r[c]:done][::-1].copy()
            done = fill_r[c]
            put_right(some)
        if fill[c] > heads[c]:
            put_right(sa[heads[c]:fill[c]][::-1])
    return sa


def _names(s: np.ndarray, lms: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers of the LMS substrings in their order; equal ones share one."""
    n, m = len(s), len(lms)
    ends = np.append(lms[1:], n - 1)  # a substring ends with the next LMS symbol
    size = ends - lms + 1
    number = np.empty(n, np.int64)
    number[lms] = np.arange(m)
    place = number[order]
    a, b = place[:-1], place[1:]
    equal = size[a] == size[b]
    # the last one runs into the end mark: no other is equal to it
    equal &= (a != m - 1) & (b != m - 1)
    live = np.flatnonzero(equal)
    k = 0
    while len(live):
        live = live[size[a[live]] > k]
        if not len(live):
            break
        same = s[lms[a[live]] + k] == s[lms[b[live]] + k]
        equal[live[~same]] = False
        live = live[same]
        k += 1
    name = np.empty(m, np.int64)
    name[place] = np.concatenate(([0], np.cumsum(~equal)))
    return name, int(name.max()) + 1 if m else 0


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """Places of the suffixes of ``s`` (whole numbers from 0), in an order
    that is exact by at least the first ``depth`` symbols: suffixes that agree
    so far may stand in any order, all others are sorted.

    Induced sorting: suffixes are classified, the leftmost smaller (LMS)
    substrings are sorted by one induction and named, the string of names is
    sorted in the same way, and its order induces that of all suffixes.  The
    recursion ends where names are unique, or where they are so many that
    buckets hold few suffixes; there ranks are doubled until they reach the
    depth (an LMS substring has at least two symbols of its own)."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    kinds = int(s.max()) + 1
    if kinds > max(1024, n // 64):
        return _by_doubling(s, depth)
    if kinds <= 1 << 16:
        s = s.astype(np.uint16)  # numpy sorts these by radix
    is_s = suffix_types(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    counts = np.bincount(s, minlength=kinds)
    tails = np.cumsum(counts)
    heads = tails - counts
    if len(lms):
        sa = _induce(s, is_s, lms, heads, tails)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        order = sa[is_lms[sa]]
        name, many = _names(s, lms, order)
        if many < len(lms):
            order = lms[suffix_array(name, depth // 2 + 1)]
        lms = order
    return _induce(s, is_s, lms, heads, tails)


def _by_doubling(s: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols."""
    n, rank, reach = len(s), s.astype(np.int64), 1
    if rank.max() >= n:
        _, rank = np.unique(rank, return_inverse=True)
    while True:
        nxt = np.zeros(n, np.int64)
        if reach < n:
            nxt[:-reach] = rank[reach:] + 1
        key = rank * np.int64(n + 1) + nxt
        order = np.argsort(key)
        key = key[order]
        new = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        reach *= 2
        if reach >= depth or new[-1] == n - 1:
            return order


def equal_windows(text: np.ndarray, room: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``length`` bytes in suffix order and, for each, whether it
    equals the one before.

    ``room`` counts the bytes up to the end of a place's own string; shorter
    suffixes are no windows.  Common prefixes with the suffix before are found
    in text order (permuted), eight bytes at a time, up to ``length``."""
    sa = suffix_array(text, length)
    sa = sa[room[sa] >= length]
    if not len(sa):
        return sa, np.empty(0, bool)
    words = np.lib.stride_tricks.sliding_window_view(np.append(text.astype(np.uint8), np.zeros(8, np.uint8)), 8)
    words = np.ascontiguousarray(words).view(np.uint64).ravel()
    before = np.full(len(text), -1, np.int64)  # the suffix before, by text place
    before[sa[1:]] = sa[:-1]
    place = np.flatnonzero(before >= 0)
    other = before[place]
    full = np.zeros(len(text), bool)
    for k in [*range(0, length - 7, 8), length - 8]:
        hit = words[place + k] == words[other + k]
        place, other = place[hit], other[hit]
    full[place] = True
    return sa, full[sa]


# -- tasks ------------------------------------------------------------------

def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _tag(anchors: np.ndarray) -> np.ndarray:
    """What an anchor is known by in its shard: 32 of its bits.  Anchors that
    clash only send on fragments that turn out not to repeat."""
    return (anchors >> np.uint64(32)).astype(np.uint32)


def _anchor_rows(batches: Iterator[pd.DataFrame], shards: int, length: int) -> Iterator[pd.DataFrame]:
    """For each batch and shard: the distinct anchors of the batch's distinct
    texts as packed tags, and how many each text has."""
    for b in batches:
        b = b.drop_duplicates("key")
        anchors = [np.unique(window_anchors(np.frombuffer(t, np.uint8), length)) for t in b["text"]]
        a = np.concatenate(anchors) if anchors else np.empty(0, np.uint64)
        if not len(a):
            continue
        k = np.repeat(np.arange(len(anchors)), [len(x) for x in anchors])
        shard = (a % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((k, shard))
        tag, k, shard = _tag(a[order]), k[order], shard[order]
        keys = b["key"].to_numpy(np.int64)
        edge = runs(shard)
        rows = []
        for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
            of = runs(k[i:j])
            rows.append((int(shard[i]), keys[k[i:j][of[:-1]]].tobytes(), _pack(np.diff(of).astype(np.int32)),
                         tag[i:j].tobytes()))
        yield pd.DataFrame(rows, columns=["shard", "keys", "counts", "tags"])


def _shared_anchors(b: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Of one shard's anchors those that two texts or more have, packed by
    bucket of texts."""
    keys = np.concatenate([np.repeat(np.frombuffer(d, np.int64), _unpack(c, np.int32))
                           for d, c in zip(b["keys"], b["counts"], strict=True)])
    tag = np.concatenate([np.frombuffer(x, np.uint32) for x in b["tags"]])
    order = np.lexsort((keys, tag))
    keys, tag = keys[order], tag[order]
    new = np.concatenate(([True], (tag[1:] != tag[:-1]) | (keys[1:] != keys[:-1])))
    keys, tag = keys[new], tag[new]
    edge = runs(tag)
    shared = np.repeat(np.diff(edge) > 1, np.diff(edge))
    return _bucketed(keys[shared], tag[shared], buckets)


def _bucketed(keys: np.ndarray, values: np.ndarray, buckets: int) -> pd.DataFrame:
    """(key, value) pairs as one packed row for each bucket of keys."""
    bucket = (keys.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((keys, bucket))
    keys, values, bucket = keys[order], values[order], bucket[order]
    edge, rows = runs(bucket), []
    for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
        of = runs(keys[i:j])
        rows.append((int(bucket[i]), keys[i:j][of[:-1]].tobytes(), _pack(np.diff(of).astype(np.int32)),
                     _pack(values[i:j])))
    return pd.DataFrame(rows, columns=["bucket", "keys", "counts", "data"])


def _by_key(b: pd.DataFrame, kind, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One bucket's pairs from all shards: values in the order of their keys,
    the keys, and where each key's run of values starts (and the last ends)."""
    keys = np.concatenate([np.repeat(np.frombuffer(k, np.int64), _unpack(c, np.int32))
                           for k, c in zip(b["keys"], b["counts"], strict=True)])
    values = np.concatenate([_unpack(d, kind).reshape(-1, width) for d in b["data"]])
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    edge = runs(keys)
    return values, keys[edge[:-1]], edge


def _tags_of_texts(b: pd.DataFrame) -> pd.DataFrame:
    """The shared anchors of every text of a bucket."""
    tags, keys, edge = _by_key(b, np.uint32, 1)
    return pd.DataFrame({"key": keys, "tags": [tags[i:j].tobytes() for i, j in
                                               zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]})


def _windows_of_docs(b: pd.DataFrame) -> pd.DataFrame:
    """The removed windows of every document of a bucket."""
    found, keys, edge = _by_key(b, np.int64, 3)
    rows = []
    for key, i, j in zip(keys.tolist(), edge[:-1].tolist(), edge[1:].tolist()):
        mine = found[i:j][np.argsort(found[i:j, 0], kind="stable")]
        of = runs(mine[:, 0])
        rows += [(int(mine[x, 0]), key, mine[x:y, 1:].tobytes()) for x, y in zip(of[:-1].tolist(), of[1:].tolist())]
    return pd.DataFrame(rows, columns=["doc", "key", "windows"])


def _fragment_rows(batches: Iterator[pd.DataFrame], shards: int, length: int) -> Iterator[pd.DataFrame]:
    """Rows of two kinds: a document's text (shard -1), and for each batch and
    shard the fragments of its documents whose anchors are shared."""
    pack = zstandard.ZstdCompressor(level=1)
    for b in batches:
        out, found, held = [], {}, 0
        for doc, key, text, shared in zip(b["doc"], b["key"], b["text"], b["tags"], strict=True):
            out.append((-1, int(doc), int(key), pack.compress(text), None, None))
            a = window_anchors(np.frombuffer(text, np.uint8), length)
            edge = runs(a)
            first = a[edge[:-1]]
            hit = np.isin(_tag(first), np.frombuffer(shared, np.uint32))
            for anchor, i, j in zip(first[hit].tolist(), edge[:-1][hit].tolist(), edge[1:][hit].tolist()):
                found.setdefault((anchor >> 8) % shards, []).append((doc, key, i, text[i:j + length - 1]))
                held += j - i + length
            if held > 8 << 20:
                out += _packed(found, pack)
                found, held = {}, 0
                yield pd.DataFrame(out, columns=["shard", "doc", "key", "data", "places", "sizes"])
                out = []
        out += _packed(found, pack)
        yield pd.DataFrame(out, columns=["shard", "doc", "key", "data", "places", "sizes"])


def _packed(found: dict[int, list[tuple]], pack) -> list[tuple]:
    return [(shard, 0, 0, pack.compress(b"".join([r[3] for r in rows])),
             _pack(np.array([r[:3] for r in rows], np.int64)), _pack(np.array([len(r[3]) for r in rows], np.int64)))
            for shard, rows in found.items()]


def _removed_windows(b: pd.DataFrame, length: int, buckets: int) -> pd.DataFrame:
    """One shard: runs of windows that also start in a document with a smaller
    id, packed by bucket of documents."""
    owners: dict[bytes, list[tuple[int, int, int]]] = {}
    for data, places, sizes in zip(b["data"], b["places"], b["sizes"], strict=True):
        text = zstandard.ZstdDecompressor().decompress(data)
        at = 0
        for place, size in zip(map(tuple, _unpack(places, np.int64).reshape(-1, 3).tolist()),
                               _unpack(sizes, np.int64).tolist()):
            owners.setdefault(text[at:at + size], []).append(place)
            at += size
    keys, found = array("q"), array("q")  # of each run: the text's key; document, first window, end
    for some in _portions(list(owners), length):
        for fragment, least, low, high in _first_docs(some, owners, length):
            for doc, key, start in owners[fragment]:
                if doc <= low:
                    continue
                if doc > high:
                    keys.append(key)
                    found.extend((doc, start, start + len(least)))
                    continue
                smaller = least < doc
                edge = runs(smaller)
                for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
                    if smaller[i]:
                        keys.append(key)
                        found.extend((doc, start + i, start + j))
    return _bucketed(np.array(keys, np.int64), np.array(found, np.int64).reshape(-1, 3), buckets)


def _portions(fragments: list[bytes], length: int) -> Iterator[list[bytes]]:
    """Fragments in portions of bounded size that keep equal anchors together."""
    total = sum(map(len, fragments))
    parts = -(-total // SORTED_AT_ONCE)
    if parts <= 1:
        yield fragments
        return
    dealt: list[list[bytes]] = [[] for _ in range(parts)]
    for i in range(0, len(fragments), HASHED_AT_ONCE):
        some = fragments[i:i + HASHED_AT_ONCE]
        part = (first_anchors(some, length) >> np.uint64(36)) % np.uint64(parts)
        for f, k in zip(some, part.tolist(), strict=True):
            dealt[k].append(f)
    yield from dealt


def _first_docs(fragments: list[bytes], owners: dict, length: int) -> Iterator[tuple[bytes, np.ndarray, int, int]]:
    """For each fragment the least document id that has each of its windows,
    and the least and largest of those."""
    if not fragments:
        return
    sizes = np.array([len(f) for f in fragments], np.int64)
    text = np.frombuffer(b"\x00".join(fragments), np.uint8).astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    of = np.repeat(np.arange(len(fragments)), sizes + 1)[: len(text)]
    room = starts[of] + sizes[of] - np.arange(len(text))
    least = np.array([min(owners[f])[0] for f in fragments], np.int64)
    sa, same = equal_windows(text, room, length)
    edge = np.flatnonzero(~same)
    low = np.minimum.reduceat(least[of[sa]], edge)
    by_place = np.zeros(len(text), np.int64)
    by_place[sa] = np.repeat(low, np.diff(np.append(edge, len(sa))))
    ends = starts + sizes - length + 1
    edges = np.column_stack((starts, ends)).ravel()
    lows, highs = (extreme.reduceat(by_place, edges)[::2] for extreme in (np.minimum, np.maximum))
    for f, a, b, low, high in zip(fragments, starts.tolist(), ends.tolist(), lows.tolist(), highs.tolist(),
                                  strict=True):
        yield f, by_place[a:b], low, high


def _cut_rows(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Documents without the bytes that their removed windows cover."""
    for b in batches:
        rows = []
        for doc, key, ztext, parts in zip(b["doc"], b["key"], b["data"], b["windows"], strict=True):
            text = zstandard.ZstdDecompressor().decompress(ztext)
            windows = np.frombuffer(parts, np.int64).reshape(-1, 2)
            step = np.zeros(len(text) + 1, np.int64)
            np.add.at(step, windows[:, 0], 1)
            np.add.at(step, windows[:, 1] + length - 1, -1)
            gone = np.cumsum(step)[:-1] > 0
            rest = np.frombuffer(text, np.uint8)[~gone].tobytes()
            spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
            rows.append((doc, key, int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
        yield pd.DataFrame(rows, columns=["doc", "key", "n_removed", "n_spans", "kept_sha256"])


# -- the job ----------------------------------------------------------------

def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = LENGTH,
                   anchor_shard: int = ANCHOR_SHARD, fragment_shard: int = FRAGMENT_SHARD) -> DataFrame:
    """One row for each document: ``doc_id, n_bytes, n_removed, n_spans,
    kept_sha256``.

    A byte is removed if a string of ``length`` bytes that covers it also
    starts in a document with a smaller id; strings are judged on the input
    and never cross documents.  Of documents with equal texts only the one
    with the least id is searched: the others are covered by it as a whole
    (from ``length`` bytes on).  Null texts are empty.  Ids are whole
    numbers.  Rows that repeat an id count as neither smaller nor larger than
    each other; a null id counts as larger than all others, and null ids as
    equal.  Each input row gives one row; an empty table an empty result."""
    last = F.lit((1 << 63) - 1)
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    src = (docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), last).alias("doc"),
                       text.alias("text")).withColumn("key", F.xxhash64("text")))
    heads = src.select("doc_id", "doc", "key", F.octet_length("text").cast("long").alias("n_bytes"),
                       F.sha2("text", 256).alias("sha"))
    heads = stage(with_group_totals(stage(heads, "suffix-heads"), ["sha"], "doc", {"p": F.min("doc")},
                                    {"first": F.min("p")}), "suffix-firsts")
    total = heads.agg(F.sum("n_bytes")).first()[0] or 0
    anchor_shards, fragment_shards = 1 + total // anchor_shard, 1 + total // fragment_shard

    anchors = src.where(F.octet_length("text") >= length).select("key", "text").mapInPandas(
        lambda it: _anchor_rows(it, anchor_shards, length), "shard long, keys binary, counts binary, tags binary")
    packed = "bucket long, keys binary, counts binary, data binary"
    shared = (anchors.groupBy("shard").applyInPandas(lambda b: _shared_anchors(b, anchor_shards), packed)
              .groupBy("bucket").applyInPandas(_tags_of_texts, "key long, tags binary"))
    searched = heads.where("doc = first").select("doc", "key").distinct()
    todo = stage(searched.join(shared, "key"), "suffix-todo")

    found = src.select("doc", "key", "text").join(todo, ["doc", "key"]).select("doc", "key", "text", "tags")
    rows = stage(found.mapInPandas(
        lambda it: _fragment_rows(it, fragment_shards, length),
        "shard long, doc long, key long, data binary, places binary, sizes binary"), "suffix-fragments")
    windows = (rows.where("shard >= 0").select("shard", "data", "places", "sizes").groupBy("shard")
               .applyInPandas(lambda b: _removed_windows(b, length, anchor_shards), packed)
               .groupBy("bucket").applyInPandas(_windows_of_docs, "doc long, key long, windows binary"))
    texts = rows.where("shard < 0").select("doc", "key", "data")
    cut = (texts.join(windows, ["doc", "key"])
           .mapInPandas(lambda it: _cut_rows(it, length),
                        "doc long, key long, n_removed long, n_spans long, kept_sha256 string")
           .dropDuplicates(["doc", "key"]))
    out = null_safe_join(heads, cut, ["doc", "key"])
    covered = (F.col("doc") > F.col("first")) & (F.col("n_bytes") >= length)
    return out.select(
        "doc_id", "n_bytes",
        F.when(covered, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(covered, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(covered, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "sha"))
        .alias("kept_sha256"))
