"""Collocations mined with weighted acyclic automata.

Every task turns its texts into count transducers: automata over words, at
most three arcs deep, that carry the count of the n-gram that ends at an
arc, built level by level from the chunk's sorted n-grams, states with the same
arcs and weights being registered once.  Transducers are cut at the borders of prefix
ranges, meet by range, and their union sums the weights.  Where one shuffle
would give each chunk too many ranges, the union goes through levels of
``FAN_OUT`` ranges each, so that the number of pieces grows as the input
does.  The parts of the candidates are acceptors; they travel the same way
and are composed with the range's transducer, which looks their counts up.

Words, pieces and the rules for candidates, cuts and scores are those of
``collocations``.  A null text is empty, a null language counts as ``und``;
repeated rows count again; a null id is of no consequence; a table without
words gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelrisk.llm.common import stage
from panelrisk.operators.joins import salted_left_join

#: Bytes of text that one transducer is built from.  A window holds fewer
#: than 2**21 different words, so that three of them fit into 64 bits.
WINDOW = 4 << 20

#: Ranges that a transducer is cut into at one level.
FAN_OUT = 128

#: Bytes of text that one last range stands for on average, at most.
RANGE_BYTES = 32 << 20

#: Texts' bytes from which the borders of the ranges are drawn (they decide the balance only).
SAMPLE_BYTES = 8 << 20

#: Slices for the two steps of the ranking.
RANK_SLICES = 256

PIECES = b".,;:!?\n\x0b\x0c\r"
_TO_BREAKS = bytes.maketrans(PIECES + b"\t", b"\n" * len(PIECES) + b" ")
_BITS = 21


# ---------------------------------------------------------------- n-grams of a window
def windows(raw: bytes, size: int = WINDOW) -> Iterator[tuple[bytes, bool]]:
    """Consecutive parts of ``raw``, cut at blanks, of at most ``size`` bytes
    (longer only if one word is), and whether the part is the last."""
    at = 0
    while len(raw) - at > size:
        end = raw.rfind(b" ", at, at + size)
        if end <= at:
            end = raw.find(b" ", at + size)
        if end < 0:
            break
        yield raw[at:end], False
        at = end + 1
    yield raw[at:], True


def counted(raw: bytes, size: int = WINDOW) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """``(words, n-grams, counts)`` for each window of texts joined by line
    feeds: the sorted words, and the sorted n-grams as rows of three word
    numbers (from 1; 0 where there is no word).

    Two words are held over from window to window, so that n-grams across
    their border are counted, once."""
    raw = raw.lower().translate(_TO_BREAKS).replace(b"\n", b" \n ")
    held: list[bytes] = []
    for part, last in windows(raw, size):
        number = defaultdict(count().__next__)
        number[b""], number[b"\n"]  # 0 and 1, in this order
        tokens = held + part.split(b" ")
        ids = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
        ids = ids[ids != 0]
        known = list(number)
        held = [] if last else [known[i] for i in ids[-2:]]
        order = sorted(range(2, len(known)), key=known.__getitem__)
        rank = np.zeros(len(known), np.int64)
        rank[order] = np.arange(1, len(order) + 1)
        a = rank[ids]
        b, c = np.append(a[1:], 0), np.append(a[2:], (0, 0))[:len(a)]
        starts = np.arange(len(a)) < len(a) - len(held)
        one = starts & (a > 0)
        two = one & (b > 0)
        three = two & (c > 0)
        keys, counts = np.unique(np.concatenate([
            a[one] << 2 * _BITS, a[two] << 2 * _BITS | b[two] << _BITS,
            a[three] << 2 * _BITS | b[three] << _BITS | c[three]]), return_counts=True)
        if len(keys):
            low = (1 << _BITS) - 1
            yield ([known[i] for i in order], np.stack([keys >> 2 * _BITS, keys >> _BITS & low, keys & low]),
                   counts.astype(np.int64))


# ---------------------------------------------------------------- transducers
def _packed(arrays: Sequence[np.ndarray]) -> bytes:
    out = []
    for x in arrays:
        top = int(x.max()) if len(x) else 0
        x = x.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")
        out.append(bytes([x.itemsize]) + len(x).to_bytes(8, "little") + x.tobytes())
    raw = b"".join(out)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)
    out, at = [], 0
    while at < len(raw):
        n = int.from_bytes(raw[at + 1:at + 9], "little")
        out.append(np.frombuffer(raw, f"<u{raw[at]}", n, at + 9).astype(np.int64))
        at += 9 + n * raw[at]
    return out


def _registered(labels: np.ndarray, weights: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """State of each run of arcs (runs begin at ``first``), and the states'
    arcs: runs that are equal in labels and weights are one state."""
    size = np.diff(np.append(first, len(labels)))
    state = np.empty(len(first), np.int64)
    single = size == 1
    _, weight_no = np.unique(weights, return_inverse=True)
    at = first[single]
    sign = labels[at] * (int(weight_no.max(initial=0)) + 1) + weight_no[at]
    _, example, state[single] = np.unique(sign, return_index=True, return_inverse=True)
    runs = [slice(x, x + 1) for x in at[example].tolist()]
    register: dict[tuple[bytes, bytes], int] = {}
    for k in np.flatnonzero(~single).tolist():
        run = slice(first[k], first[k] + size[k])
        found = register.setdefault((labels[run].tobytes(), weights[run].tobytes()), len(runs))
        if found == len(runs):
            runs.append(run)
        state[k] = found
    places = np.concatenate([np.arange(r.start, r.stop) for r in runs]) if runs else np.empty(0, np.int64)
    return state, [np.array([r.stop - r.start for r in runs], np.int64), labels[places], weights[places]]


def transducer(words: Sequence[bytes], grams: np.ndarray, weights: np.ndarray) -> bytes:
    """The automaton of sorted n-grams with their weights, as bytes.

    Arrays: the words' lengths and letters; the arcs that leave the root (word,
    weight, number of arcs that follow); the second arcs (word, weight,
    number of the state they lead to, 0 for none); the registered states'
    sizes and their arcs (word, weight)."""
    used, flat = np.unique(grams, return_inverse=True)
    a, b, c = flat.reshape(grams.shape) + (0 if len(used) and used[0] == 0 else 1)
    kept = [words[i - 1] for i in used.tolist() if i]
    letters = b"".join(kept)
    new_a = np.append(True, a[1:] != a[:-1]) if len(a) else np.empty(0, bool)
    new_ab = (new_a | np.append(True, b[1:] != b[:-1]) if len(a) else new_a) & (b > 0)
    first_a, first_ab, last = np.flatnonzero(new_a), np.flatnonzero(new_ab), c > 0
    under = np.cumsum(new_ab) - 1                       # second arc that an n-gram goes over
    arcs_after = np.bincount(np.cumsum(new_a)[first_ab] - 1, minlength=len(first_a))
    thirds = np.flatnonzero(last)
    runs = np.flatnonzero(np.append(True, under[thirds][1:] != under[thirds][:-1])) if len(thirds) else thirds
    state, states = _registered(c[thirds], weights[thirds], runs)
    leads = np.zeros(len(first_ab), np.int64)
    leads[under[thirds][runs]] = state + 1
    return _packed([np.array([len(w) for w in kept], np.int64), np.frombuffer(letters, np.uint8),
                    a[first_a], np.where(b[first_a] == 0, weights[first_a], 0), arcs_after,
                    b[first_ab], np.where(c[first_ab] == 0, weights[first_ab], 0), leads, *states])


def entries(blob: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """``(words, n-grams, weights)`` that a transducer accepts, sorted."""
    sizes, letters, a1, w1, after, b2, w2, leads, run, c3, w3 = _unpacked(blob)
    text, ends = letters.astype(np.uint8).tobytes(), np.cumsum(sizes).tolist()
    words = [text[x:y] for x, y in zip([0, *ends], ends)]
    a2 = np.repeat(a1, after)
    start = np.append(0, np.cumsum(run))
    arcs = np.where(leads > 0, np.append(0, run)[leads], 0)
    a3, b3 = np.repeat(a2, arcs), np.repeat(b2, arcs)
    step = np.arange(int(arcs.sum())) - np.repeat(np.cumsum(arcs) - arcs, arcs)
    place = np.repeat(start[np.maximum(leads - 1, 0)], arcs) + step
    none = np.zeros_like
    grams = np.stack([np.concatenate(x).astype(np.int32) for x in (
        (a1, a2, a3), (none(a1), b2, b3), (none(a1), none(a2), c3[place]))])
    weights = np.concatenate([w1, w2, w3[place]])
    order = np.lexsort(grams[::-1])
    order = order[weights[order] > 0]
    return words, grams[:, order], weights[order]


def united(parts: Sequence[tuple[list[bytes], np.ndarray, np.ndarray]]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Union of entries: the weights of equal n-grams are summed."""
    if len(parts) == 1:
        return parts[0]
    words = sorted(set().union(*[p[0] for p in parts]))
    number = dict(zip(words, count(1)))
    renamed = []
    for own, grams, _ in parts:
        ids = np.array([0, *map(number.__getitem__, own)], np.int32)
        renamed.append(ids[grams])
    grams, weights = np.concatenate(renamed, axis=1), np.concatenate([p[2] for p in parts])
    del renamed
    if len(words) < 1 << _BITS:
        a, b, c = (g.astype(np.int64) for g in grams)
        order = np.argsort(a << 2 * _BITS | b << _BITS | c, kind="stable")
        del a, b, c
    else:
        order = np.lexsort(grams[::-1])
    grams = grams[:, order]
    new = np.flatnonzero(np.append(True, (grams[:, 1:] != grams[:, :-1]).any(axis=0)))
    return words, grams[:, new], np.add.reduceat(weights[order], new)


def composed(asked: tuple, known: tuple) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Composition of an acceptor with a transducer: the n-grams of both, with
    the transducer's weights."""
    wanted = (asked[0], asked[1], np.ones_like(asked[2]))
    own, grams, weights = _restricted(known, set(asked[0]))
    # a known weight is doubled, so that an odd sum shows an n-gram that is asked for
    words, grams, sums = united([wanted, (own, grams, 2 * weights)])
    found = (sums & 1 == 1) & (sums > 1)
    return words, grams[:, found], sums[found] >> 1


def _restricted(known: tuple, words: set[bytes]) -> tuple:
    """The entries of a transducer all of whose words are in ``words``."""
    own, grams, weights = known
    ok = np.array([True, *[w in words for w in own]])
    keep = ok[grams].all(axis=0)
    return own, grams[:, keep], weights[keep]


# ---------------------------------------------------------------- prefix ranges
class Ranges:
    """Prefix ranges of n-grams, in levels of ``fan_out``.

    ``borders`` are sorted ``(language, word, ...)`` tuples.  The first two
    levels are ranges between borders; deeper ones tell n-grams of one range apart by a
    hash, so that the list of borders stays under ``fan_out ** 2``."""

    def __init__(self, borders: list[tuple], levels: int, fan_out: int = FAN_OUT):
        self.borders, self.levels, self.fan_out = borders, levels, fan_out

    def _at(self, level: int) -> list[tuple]:
        return self.borders[self.fan_out - 1::self.fan_out] if level == 1 and self.levels > 1 else self.borders

    def cut(self, level: int, lang: bytes, found: tuple) -> Iterator[tuple[int, tuple]]:
        """``(shard, entries)`` for each range of ``level`` that holds entries."""
        words, (a, b, c), weights = found
        borders = self._at(level)
        lo, hi = bisect_left(borders, (lang,)), bisect_right(borders, (lang + b"\0",))
        while hi > lo and borders[hi - 1][0] != lang:
            hi -= 1
        marks = [0, *[_place(words, (a, b, c), border[1:]) for border in borders[lo:hi]], len(a)]
        for k in range(len(marks) - 1):
            x, y = marks[k], marks[k + 1]
            if x < y:
                part = (words, np.stack([a, b, c])[:, x:y], weights[x:y])
                yield from self._deeper(level, lo + k, part)

    def _deeper(self, level: int, shard: int, part: tuple) -> Iterator[tuple[int, tuple]]:
        if level <= 2:
            yield shard, part
            return
        words, grams, weights = part
        of = np.array([0, *map(zlib.crc32, words)], np.uint64)
        h = (of[grams[0]] * np.uint64(1000003) ^ of[grams[1]]) * np.uint64(1000003) ^ of[grams[2]]
        deep = np.uint64(self.fan_out ** (level - 2))
        digit = ((h >> np.uint64(7)) % deep).astype(np.int64)
        for d in np.unique(digit).tolist():
            yield shard * int(deep) + d, (words, grams[:, digit == d], weights[digit == d])


def _place(words: list[bytes], columns: tuple, border: tuple) -> int:
    """Number of sorted entries before ``border``."""
    lo, hi = 0, len(columns[0])
    for column, word in zip(columns, border):
        k = bisect_left(words, word)
        at = lo + int(np.searchsorted(column[lo:hi], k + 1))
        if k == len(words) or words[k] != word:
            return at
        lo, hi = at, lo + int(np.searchsorted(column[lo:hi], k + 2))
    return lo


def _levels(total_bytes: int, range_bytes: int, fan_out: int) -> int:
    n = 1
    while range_bytes * fan_out**n < total_bytes:
        n += 1
    return n


def _borders(docs: DataFrame, total_bytes: int, n: int) -> list[tuple]:
    """About ``n - 1`` borders from the n-grams of a sample of the texts."""
    if not total_bytes or n < 2:
        return []
    share = min(1.0, SAMPLE_BYTES / total_bytes)
    every = max(1, min(total_bytes, SAMPLE_BYTES) // (n * 64))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, raw in _joined(batches, SAMPLE_BYTES):
            for words, grams, _ in counted(raw):
                rows = grams[:, ::every].T.tolist()
                yield pa.RecordBatch.from_pydict({
                    "lang": [lang.decode()] * len(rows),
                    "words": [[words[i - 1][:32] for i in row if i] for row in rows]}, _BORDER)

    _BORDER = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.binary()))])
    sample = docs.sample(share, seed=7) if share < 1 else docs
    drawn = sample.mapInArrow(draw, "lang string, words array<binary>").limit(256 * n)
    rows = sorted({(r.lang.encode(), *map(bytes, r.words)) for r in drawn.collect()})
    return [rows[k * len(rows) // n] for k in range(1, n)] if len(rows) >= n else rows


# ---------------------------------------------------------------- jobs
def _joined(batches: Iterator[pa.RecordBatch], size: int = WINDOW) -> Iterator[tuple[bytes, bytes]]:
    """Texts of a task, joined by line feeds for each language, some ``size`` bytes at a time."""
    held: dict[bytes, list[bytes]] = defaultdict(list)
    sizes: dict[bytes, int] = defaultdict(int)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lang, text in zip(batch.column("lang").cast(pa.binary()).to_pylist(), texts):
            if sizes[lang] + len(text) > size and sizes[lang]:
                yield lang, b"\n".join(held.pop(lang))
                del sizes[lang]
            held[lang].append(text)
            sizes[lang] += len(text) + 1
        if sum(sizes.values()) > 4 * size:
            for lang in list(held):
                yield lang, b"\n".join(held.pop(lang))
            sizes.clear()
    for lang in list(held):
        yield lang, b"\n".join(held.pop(lang))


_PIECE = "lang string, shard long, groups long, blob binary"
_PIECE_ARROW = pa.schema([("lang", pa.string()), ("shard", pa.int64()), ("groups", pa.int64()), ("blob", pa.binary())])


def _pieces(ranges: Ranges, level: int, lang: bytes, found: tuple, group: int) -> Iterator[pa.RecordBatch]:
    rows = [(lang.decode(), shard, group, transducer(*part)) for shard, part in ranges.cut(level, lang, found)]
    for k in range(0, len(rows), 16):
        yield pa.RecordBatch.from_pydict(dict(zip(_PIECE_ARROW.names, zip(*rows[k:k + 16]))), _PIECE_ARROW)


def _merged(pieces: DataFrame, ranges: Ranges, fan_out: int) -> DataFrame:
    """Pieces of the last level, after unions at all levels before it.

    At every level the pieces of one range are united, about ``fan_out`` at a time,
    and cut into the ranges of the next level: there are ``fan_out`` times fewer groups
    of pieces and as many times more ranges, so the number of pieces stays in proportion to that of windows."""
    for level in range(2, ranges.levels + 1):
        def deeper(batches: Iterator[pa.RecordBatch], level=level) -> Iterator[pa.RecordBatch]:
            for (lang, _, group), found in _grouped(batches, ("lang", "shard", "groups")):
                yield from _pieces(ranges, level, lang.encode(), found, group)

        pieces = (pieces.withColumn("groups", F.floor(F.col("groups") / fan_out))
                  .repartition("lang", "shard", "groups").sortWithinPartitions("lang", "shard", "groups")
                  .mapInArrow(deeper, _PIECE))
    return pieces


def _grouped(batches: Iterator[pa.RecordBatch], keys: Sequence[str], at_once: int = 32) -> Iterator[tuple[tuple, tuple]]:
    """Entries of the pieces that follow one another under the same key, united."""
    now, held = None, []
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in keys]
        for row in zip(*columns, batch.column("blob")):
            if row[:-1] != now:
                if held:
                    yield now, united(held)
                now, held = row[:-1], []
            held.append(entries(row[-1].as_py()))
            if len(held) == at_once:
                held = [united(held)]
    if held:
        yield now, united(held)


def count_transducers(docs: DataFrame, ranges: Ranges, fan_out: int = FAN_OUT, window: int = WINDOW,
                      groups: int = 1) -> DataFrame:
    """Count transducers of all texts, cut into the ranges of the last level
    (several pieces for each range).  ``groups``: about the number of windows, by
    which they are dealt into unions; it decides the size of unions only."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, raw in _joined(batches, window):
            for k, found in enumerate(counted(raw, window)):
                yield from _pieces(ranges, 1, lang, found, (zlib.crc32(raw[:4096]) + k) % groups)

    return _merged(docs.mapInArrow(build, _PIECE), ranges, fan_out)


def frequent(pieces: DataFrame, least: int) -> DataFrame:
    """One transducer for each range and language: ``(lang, shard, n_words, blob)`` with
    the summed occurrences of all its words, and only entries of at least
    ``least`` occurrences."""
    schema = pa.schema([("lang", pa.string()), ("shard", pa.int64()), ("n_words", pa.int64()), ("blob", pa.binary())])

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard, lang), (words, grams, weights) in _grouped(batches, ("shard", "lang")):
            n = int(weights[grams[1] == 0].sum())
            keep = weights >= least
            yield pa.RecordBatch.from_pydict({"lang": [lang], "shard": [shard], "n_words": [n],
                                              "blob": [transducer(words, grams[:, keep], weights[keep])]}, schema)

    return (pieces.repartition("shard", "lang").sortWithinPartitions("shard", "lang")
            .mapInArrow(union, "lang string, shard long, n_words long, blob binary"))


def listed(transducers: DataFrame) -> DataFrame:
    """``(lang, phrase, n, a)``: the n-grams of transducers, their words joined by
    blanks, number of words and weight."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int32()), ("a", pa.int64())])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, blob in zip(batch.column("lang").to_pylist(), batch.column("blob")):
                words, grams, weights = entries(blob.as_py())
                size = (grams > 0).sum(axis=0)
                for x in range(0, len(weights), 50_000):
                    phrases = [b" ".join([words[i - 1] for i in row if i]).decode()
                               for row in grams[:, x:x + 50_000].T.tolist()]
                    yield pa.RecordBatch.from_pydict(
                        {"lang": [lang] * len(phrases), "phrase": phrases, "n": size[x:x + 50_000].astype(np.int32),
                         "a": weights[x:x + 50_000]}, schema)

    return transducers.select("lang", "blob").mapInArrow(spell, "lang string, phrase string, n int, a long")


def look_up(parts: DataFrame, counts: DataFrame, ranges: Ranges, fan_out: int = FAN_OUT,
            groups: int = 1, at_once: int = 200_000) -> DataFrame:
    """``(lang, part, f)`` for distinct parts ``(lang, part)``: acceptors of the
    parts go to the ranges of ``counts`` and are composed with them there."""
    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple]] = defaultdict(list)
        n = 0

        def acceptors():
            for lang, grams in held.items():
                words = sorted({w for g in grams for w in g})
                number = dict(zip(words, count(1)))
                rows = np.array(sorted([*map(number.__getitem__, g), 0, 0][:3] for g in grams), np.int64).T
                found = (words, rows, np.ones(len(grams), np.int64))
                yield from _pieces(ranges, 1, lang.encode(), found, zlib.crc32(words[0] + words[-1]) % groups)
            held.clear()

        for batch in batches:
            for lang, part in zip(batch.column("lang").to_pylist(), batch.column("part").cast(pa.binary()).to_pylist()):
                held[lang].append(tuple(part.split(b" ")))
                n += 1
                if n % at_once == 0:
                    yield from acceptors()
        yield from acceptors()

    schema = pa.schema([("lang", pa.string()), ("part", pa.string()), ("f", pa.int64())])

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place = None, None
        for (shard, lang, asked), found in _grouped(batches, ("shard", "lang", "asked")):
            if not asked:
                known, place = found, (shard, lang)
            elif place == (shard, lang):
                words, grams, weights = composed(found, known)
                spelt = [b" ".join([words[i - 1] for i in row if i]).decode() for row in grams.T.tolist()]
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(spelt), "part": spelt, "f": weights}, schema)

    asked = _merged(parts.mapInArrow(accept, _PIECE), ranges, fan_out)
    both = (counts.select("shard", "lang", F.lit(False).alias("asked"), "blob")
            .unionByName(asked.select("shard", "lang", F.lit(True).alias("asked"), "blob")))
    return (both.repartition("shard", "lang").sortWithinPartitions("shard", "lang", "asked")
            .mapInArrow(compose, "lang string, part string, f long"))


def _sub(words: F.Column, start: int, size: int) -> F.Column:
    return F.array_join(F.slice(words, start, size), " ")


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, inside: int = 50, *, window: int = WINDOW,
                 fan_out: int = FAN_OUT, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Each language's ``top`` phrases of two or three words.

    Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
    those at blanks and tabs into words.  A candidate occurs ``a >= least``
    times.  Cutting it after its first k words gives ``l`` and ``r``, the counts
    of both parts, and the score floor(1000000 a a / (l r)) in exact decimals;
    the cut with the least score counts, of equal ones the first.  Two-word
    candidates that lie in a three-word one of at least ``inside`` per cent
    of their count are dropped.  Rows: ``lang, rank, phrase, a, l, r, n,
    score``, ordered by score and ``a`` (descending) and phrase (bytes)."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    levels = _levels(total, range_bytes, fan_out)
    ranges = Ranges(_borders(texts, total, fan_out ** min(levels, 2)), levels, fan_out)
    groups = max(1, total // window)
    counts = stage(frequent(count_transducers(texts, ranges, fan_out, window, groups), least), "phrases-counts")
    candidates = stage(listed(counts).where("n > 1"), "phrases-candidates")

    words = F.split("phrase", " ")
    two = F.array(F.struct(F.lit(1).alias("k"), F.lit("l").alias("side"), _sub(words, 1, 1).alias("part")),
                  F.struct(F.lit(1).alias("k"), F.lit("r").alias("side"), _sub(words, 2, 1).alias("part")))
    three = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), _sub(words, start, size).alias("part"))
                      for k, side, start, size in ((1, "l", 1, 1), (1, "r", 2, 2), (2, "l", 1, 2), (2, "r", 3, 1))])
    uses = candidates.select("lang", "phrase", "a", F.explode(F.when(F.col("n") == 2, two).otherwise(three)).alias("u"))
    uses = uses.select("lang", "phrase", "a", "u.k", "u.side", "u.part")
    answers = stage(look_up(uses.select("lang", "part").distinct(), counts, ranges, fan_out, groups), "phrases-parts")
    answers = answers.select(F.col("lang").alias("part_lang"), F.col("part").alias("asked"), "f")
    met = salted_left_join(uses, answers, ["lang", "part"], ["part_lang", "asked"], ["phrase"])
    f = {f"{s}{k}": F.max(F.when((F.col("k") == k) & (F.col("side") == s), F.col("f"))).alias(f"{s}{k}")
         for k in (1, 2) for s in "lr"}
    cuts = met.groupBy("lang", "phrase", "a").agg(*f.values())

    longer = (candidates.where("n = 3").select("lang", F.col("a").alias("longer_a"), F.explode(F.array(
        _sub(words, 1, 2), _sub(words, 2, 2))).alias("phrase")).groupBy("lang", "phrase").agg(
            F.max("longer_a").alias("longer_a")))
    kept = (cuts.join(longer, ["lang", "phrase"], "left")
            .where(F.col("longer_a").isNull() | (100 * F.col("longer_a") < inside * F.col("a"))))

    def score(k: int) -> F.Column:
        return F.expr(f"CAST((CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(14,0)) * CAST(a AS DECIMAL(14,0))) "
                      f"DIV (CAST(l{k} AS DECIMAL(14,0)) * CAST(r{k} AS DECIMAL(14,0))) AS BIGINT)")

    kept = kept.withColumn("s1", score(1)).withColumn("s2", F.when(F.col("l2").isNotNull(), score(2)))
    second = F.col("s2").isNotNull() & (F.col("s2") < F.col("s1"))
    scored = kept.select("lang", "phrase", "a", F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"),
                         F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"),
                         F.when(second, F.col("s2")).otherwise(F.col("s1")).alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first within slices of each language, then among the slices' best
    sliced = scored.withColumn("_slice", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SLICES)))
    best = (sliced.withColumn("_in", F.row_number().over(Window.partitionBy("lang", "_slice").orderBy(*order)))
            .where(F.col("_in") <= top))
    placed = (best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
              .where(F.col("rank") <= top))
    n = counts.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return placed.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
