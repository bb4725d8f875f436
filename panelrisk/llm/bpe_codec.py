"""BPE encoding and decoding, merging with a segment tree over pair ranks.

The leaves of the tree are the ranks of adjacent symbol pairs; every node
holds the least rank below it, so the root names the leftmost pair of lowest
rank.  A merge changes three leaves and their paths upwards, so a pre-token of
n symbols is encoded in O(n log n), also when it is a megabyte long.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelrisk.llm.common import map_texts

#: White space as the vocabulary's pattern counts it (Unicode's property).
SPACE = r"\t-\r\x20\x85\xa0  -     　"
#: Pre-tokens of the vocabulary's file, fixed by it.
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
#: The same for lower-case ASCII.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r\x20a-z0-9]+")

#: Characters outside these long-settled blocks may be newer than one of the
#: Unicode tables at hand; texts with any are split by the library's own tables.
UNSETTLED = regex.compile(r"[^\x00-\u024f\u0300-\u036f\u0386-\u03ff\u0400-\u0481\u048a-\u0513\u1e00-\u1eff"
                          r"\u2000-\u206f\u20ac\u3000-\u303f\u3041-\u3096\u30a0-\u30ff\u4e00-\u9fa5\uac00-\ud7a3"
                          r"\uff00-\uff9f]")

#: Pre-tokens in each of the two generations that a Python worker remembers.
MEMORY = 100_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    visible Latin-1, else the next of the characters from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


#: A leaf or node without a pair.
NONE = 1 << 60

#: Children of a node of the tree, as a power of two.
FAN = 4


def pair_tree(leaves: list[int]) -> list[list[int]]:
    """Segment tree over adjacent pairs, level by level from the leaves to the
    root: a node is the least of its (up to sixteen) children."""
    levels = [leaves]
    while len(levels) == 1 or len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([min(below[k:k + (1 << FAN)]) for k in range(0, len(below), 1 << FAN)])
    return levels


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge the leftmost pair of lowest rank until none is left.

    A leaf is its pair's rank followed by its place, so that the root names
    the pair to merge.  A merge changes up to three leaves and the nodes above
    them."""
    n, get = len(symbols), ranks.get
    if n < 2:
        return symbols
    bits = n.bit_length()
    mask = (1 << bits) - 1
    leaves = [NONE if (r := get(p)) is None else r << bits for p in zip(symbols, symbols[1:])]
    leaves = [x if x == NONE else x | k for k, x in enumerate(leaves)]
    levels = pair_tree(leaves)
    top = levels[-1]
    if top[0] == NONE:
        return symbols
    above = list(zip(levels, levels[1:]))
    text: list[str | None] = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (root := top[0]) != NONE:
        i = root & mask
        j = after[i]  # the pair is (i, j): it is kept at the place of its left symbol
        s = text[i] = text[i] + text[j]
        text[j] = None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            leaves[j] = NONE
            rank = get((s, text[k]))
            leaves[i] = NONE if rank is None else rank << bits | i
        else:
            leaves[i] = NONE
        if (h := before[i]) >= 0:
            rank = get((text[h], s))
            leaves[h] = NONE if rank is None else rank << bits | h
        if len(leaves) <= 1 << FAN:
            top[0] = min(leaves)
            continue
        changed = {p >> FAN for p in (h, i, j) if 0 <= p < n - 1}
        for below, nodes in above:
            for p in changed:
                nodes[p] = min(below[p << FAN:p + 1 << FAN])
            changed = {p >> FAN for p in changed}
    return [t for t in text if t is not None]


class WordBpe:
    """A vocabulary file of the tokenizers library: lower case, word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = (p if isinstance(p, list) else p.split(" ") for p in model["merges"])
        self.ranks = {(a, b): k for k, (a, b) in enumerate(pairs)}
        self.end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        self.symbols = byte_symbols()
        self.known: dict[str, tuple[str, str, int]] = {}
        self.old: dict[str, tuple[str, str, int]] = {}
        self.bytes = {c: b for b, c in enumerate(self.symbols)}
        self.library = Tokenizer.from_file(path)

    def word(self, piece: str) -> list[int]:
        """Ids of a pre-token."""
        symbols = list(map(self.symbols.__getitem__, piece.encode("utf-8", "surrogatepass")))
        symbols[-1] += self.end
        return [self.ids[s] for s in merge(symbols, self.ranks) if s in self.ids]

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text; special strings stay whole."""
        if text.isascii() and "<|" not in text:
            return ASCII_PIECES.findall(text.lower())
        out: list[str] = []
        for part in self.marks.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(part)
            elif part.isascii():
                out += ASCII_PIECES.findall(part.lower())
            elif UNSETTLED.search(part):
                normal = self.library.normalizer.normalize_str(part)
                out += [bytes(map(self.bytes.__getitem__, mapped)).decode()
                        for mapped, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
            else:
                part = unicodedata.normalize("NFC", part)
                part = part.replace("Σ", "σ")  # each character alone: no final form
                out += PIECES.findall(part.lower())
        return out

    def coded(self, piece: str) -> tuple[str, str, int]:
        """Ids and tokens of a pre-token, each joined by blanks, and their number.

        Short pre-tokens are remembered in two generations: the old one goes
        when the young one is full, what is met again moves to the young one."""
        got = self.old.get(piece)
        if got is None:
            found = [self.special[piece]] if piece in self.special else self.word(piece)
            got = " ".join(map(str, found)), " ".join([self.tokens[i] for i in found]), len(found)
        if len(piece) <= 64:
            if len(self.known) >= MEMORY:
                self.old, self.known = self.known, {}
            self.known[piece] = got
        return got

    def ids_and_decoded(self, text: str) -> tuple[str, str, int]:
        """Ids and decoded tokens, each joined by blanks, and their number.
        The file names no decoder, so decoding joins the tokens by blanks."""
        pieces = self.pieces(text)
        coded = list(map(self.known.get, pieces))
        if None in coded:
            coded = [c or self.known.get(p) or self.coded(p) for c, p in zip(coded, pieces)]
        ids, tokens, numbers = zip(*coded) if coded else ((), (), ())
        if 0 in numbers:  # pre-tokens without a token leave no blank
            ids, tokens = filter(None, ids), [t for t, n in zip(tokens, numbers) if n]
        return " ".join(ids), " ".join(tokens), sum(numbers)

    def encode(self, text: str) -> list[int]:
        ids = self.ids_and_decoded(text)[0]
        return [int(i) for i in ids.split(" ")] if ids else []

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])


@lru_cache(maxsize=4)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: ``doc_id``, its token ``ids`` and the
    ``decoded`` text.  Null texts are empty; empty texts have no ids."""
    def make():
        bpe = load(path)

        def work(texts: list) -> dict:
            ids = [bpe.encode(t or "") for t in texts]
            return {"ids": ids, "decoded": [bpe.decode(i) for i in ids]}

        return work

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(src, make, {"ids": "array<int>", "decoded": "string"})


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: ``doc_id, n_tokens, ids_sha256,
    decoded_sha256`` of the whole text's encoding and of its decoding.

    ``path`` names the vocabulary file, which every executor must have.
    Null texts are empty: no tokens, and the digests of the empty string.
    Rows are coded one by one: nothing is shuffled, repeated rows repeat, and
    an empty table gives an empty result."""
    def make():
        bpe = load(path)

        def work(texts: list) -> dict:
            rows = [bpe.ids_and_decoded(t or "") for t in texts]
            sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
            return {"n_tokens": [r[2] for r in rows], "ids_sha256": [sha(r[0]) for r in rows],
                    "decoded_sha256": [sha(r[1]) for r in rows]}

        return work

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(src, make, {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"})
