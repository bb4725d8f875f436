"""Token counts of a sentencepiece BPE model by rank-synchronous array merging.

Pre-tokens of a whole batch are held as one ragged numpy array of symbol
numbers.  In every round each sequence applies its own lowest-rank pair, all
sequences at once, until no pair is left; the symbols that survive are the
tokens.
"""

from __future__ import annotations

import re
import sys
from functools import lru_cache
from itertools import chain, islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrisk.llm.common import map_texts

#: The character that stands for a blank.
BLANK = "▁"

#: Pre-tokens remembered by each Python worker, and merged at a time.
MEMORY = 300_000
AT_ONCE = 1 << 18

NONE = np.int64(1) << 40


class PieceBpe:
    """Pieces and scores of a model file, as arrays for merging."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)
                       if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        scores = {sp.id_to_piece(i): sp.get_score(i) for i in range(size)}
        number = {p: i for i, p in enumerate(self.pieces)}
        # number of each character, by code point; -1 without a piece
        self.chars = np.full(sys.maxunicode + 1, -1, np.int64)
        for p, i in number.items():
            if len(p) == 1:
                self.chars[ord(p)] = i
        # equal scores are equal ranks: of those the leftmost pair goes first
        order = {s: r for r, s in enumerate(sorted({scores[p] for p in self.pieces}, reverse=True))}
        keys, made, rank = [], [], []
        for p, i in number.items():
            for k in range(1, len(p)):
                a, b = number.get(p[:k]), number.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    made.append(i)
                    rank.append(order[scores[p]])
        by = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[by]
        self.made, self.rank = np.array(made, np.int64)[by], np.array(rank, np.int64)[by]
        # neighbours inside some piece: no merge can ever join any others
        self.joined = np.array(sorted({ord(p[k]) << 32 | ord(p[k + 1])
                                       for p in self.pieces for k in range(len(p) - 1)} | {1 << 62}), np.int64)
        self.known: dict[str, int] = {}

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of each pair; ``NONE`` where it is no piece or a
        symbol is unknown (-1)."""
        key = left << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank[at], NONE), self.made[at]

    def surviving(self, words: list[str]) -> np.ndarray:
        """Tokens of each word, all merged together.  Words are cut into
        sequences wherever two neighbours are in no piece together.  A
        character that is no piece counts its bytes."""
        tokens = np.zeros(len(words), np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        if not len(code):
            return tokens
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        sym = self.chars[code]
        cost = np.where(sym < 0, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), 1)
        key = code[:-1] << 32 | code[1:]
        joined = self.joined[np.searchsorted(self.joined, key)] == key
        seq = np.cumsum(np.r_[True, (owner[1:] != owner[:-1]) | ~joined])
        rank, made = np.full(len(sym), NONE), np.zeros(len(sym), np.int64)
        rank[:-1], made[:-1] = self.rank_of(sym[:-1], sym[1:])
        rank[:-1][seq[:-1] != seq[1:]] = NONE
        held = (sym, seq, owner, cost, rank, made)
        while True:
            seq, rank = held[1], held[4]
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            size = np.diff(np.r_[first, len(seq)])
            least = np.repeat(np.minimum.reduceat(rank, first), size)
            done = least == NONE
            if done.any():  # finished sequences leave the arrays
                tokens += np.bincount(held[2][done], held[3][done], len(words)).astype(np.int64)
                held = tuple(x[~done] for x in held)
                least = least[~done]
                if not len(least):
                    return tokens
            held = self._round(held, least)

    def _round(self, held: tuple, least: np.ndarray) -> tuple:
        """The arrays after a round: in each sequence the occurrences of its
        lowest rank have merged from the left, up to the first whose product
        makes a pair that ranks no higher and so has to go next."""
        seq, rank = held[1], held[4]
        go = rank == least
        # of overlapping occurrences (a run of pairs) every other one, from the left
        start = go & ~np.r_[False, go[:-1]]
        place = np.arange(len(go))
        run = np.maximum.accumulate(np.where(start, place, 0))
        go &= (place - run) % 2 == 0
        after, left = self._merged(held, go)
        # a neighbour's own pair that was there before ranks above the least, or is in ``go``
        low = np.minimum(after[4], np.r_[NONE, after[4][:-1]])
        stops = left[go[left] & (low <= least[left])]
        if not len(stops):
            return after
        first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
        size = np.diff(np.r_[first, len(seq)])
        limit = np.full(len(go), len(go))
        limit[stops] = stops
        limit = np.repeat(np.minimum.reduceat(limit, first), size)
        return self._merged(held, go & (place <= limit))[0]

    def _merged(self, held: tuple, go: np.ndarray) -> tuple[tuple, np.ndarray]:
        """The arrays with the pairs at ``go`` merged, and the places that are
        left.  Only pairs beside a merge are ranked anew."""
        left = np.flatnonzero(~np.r_[False, go[:-1]])
        sym, seq, owner, cost, rank, made = (x[left] for x in held)
        new = go[left]
        sym = np.where(new, made, sym)
        at = np.flatnonzero(new | np.r_[new[1:], False])
        right = np.minimum(at + 1, len(sym) - 1)
        rank[at], made[at] = self.rank_of(sym[at], sym[right])
        rank[at[(right == at) | (seq[right] != seq[at])]] = NONE
        return (sym, seq, owner, cost, rank, made), left

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text.  Of the words met, short ones are
        remembered, those met again before others, at most ``MEMORY``."""
        words = [_words(t) for t in texts]
        seen = set(chain.from_iterable(words))
        again = seen & self.known.keys()
        found: dict[str, int] = {}
        part: list[str] = []
        held = 0
        for w in seen - again:
            part.append(w)
            held += len(w)
            if held >= AT_ONCE:
                found.update(zip(part, self.surviving(part).tolist()))
                part, held = [], 0
        found.update(zip(part, self.surviving(part).tolist()))
        self.known.update(found)
        get = self.known.__getitem__
        totals = [sum(map(get, ws)) for ws in words]
        for w in found:
            if len(w) > 64:
                del self.known[w]
        if len(self.known) > MEMORY:
            kept = ((w, n) for w, n in found.items() if len(w) <= 64)
            self.known = {w: get(w) for w in again}
            self.known.update(islice(kept, MEMORY - len(again)))
        return totals


_RUNS = re.compile(f"{BLANK}+[^{BLANK}]*")


def _words(text: str) -> list[str]:
    """Pre-tokens: a text gets a blank in front, and is cut before each run
    of blanks, which no piece crosses."""
    if not text:
        return []
    text = text.replace(" ", BLANK)
    return _RUNS.findall(BLANK + text)


@lru_cache(maxsize=4)
def load(path: str) -> PieceBpe:
    return PieceBpe(path)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """One row for each document: ``doc_id, n_bytes, n_tokens, over_limit``.

    Whole texts are counted as the model at ``path`` (a file that every
    executor has) splits them, without begin or end marks; special strings in
    a text are ordinary text.  Null texts are empty: no bytes, no tokens.
    Rows are counted one by one: nothing is shuffled, repeated rows repeat,
    and an empty table gives an empty result."""
    def make():
        bpe = load(path)

        def work(texts: list) -> dict:
            n = np.array(bpe.count(texts), np.int64)
            return {"n_tokens": n, "over_limit": n > limit}

        return work

    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    return map_texts(src, make, {"n_tokens": "long", "over_limit": "boolean"})
