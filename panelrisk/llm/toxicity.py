"""Toxicity by multiple-instance learning over sentences.

Only documents carry labels, sentences do not.  A sentence's probability is a
logistic function of its words; a document's is the noisy-or of its sentences,
1 - prod(1 - p): one toxic sentence is enough.  Training document labels
through the noisy-or therefore teaches the sentence scores, which then point
to the offending sentences.

The odds of every sentence are divided by the document's number of distinct
sentences, so that what sentences without telling words add up to is the same
in short and in long documents.
"""

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, expm1, log, log1p

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelrisk.llm.common import map_texts

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W_]+")

#: A word's features: itself, and its beginnings of these lengths (inflected forms share them).
PREFIXES = (5, 7)

#: Words whose summed weight each Python worker remembers.
MEMORY = 300_000

#: The fit's documented bounds: labelled documents, and their characters in all.
TRAIN_DOCS = 5000
TRAIN_CHARS = 12_000_000

#: Documents that the fit joins to one, besides teaching each by itself.
JOINED = 16


@dataclass(frozen=True)
class SentenceModel:
    """Weights of lower-cased words and word beginnings (marked by a hyphen
    at the end), and the bias of a document's only sentence."""

    weights: dict[str, float]
    bias: float


class WordWeights(dict):
    """Summed weight of each word's features, remembered up to a bound."""

    def __init__(self, model: SentenceModel) -> None:
        self.of = model.weights
        self.bias = model.bias

    def __missing__(self, word: str) -> float:
        if len(self) >= MEMORY:
            self.clear()
        x = self[word] = sum([self.of.get(f, 0.0) for f in features(word)])
        return x


def features(word: str) -> list[str]:
    return [word, *[word[:k] + "-" for k in PREFIXES if len(word) > k]]


def held_out(doc_id: Column) -> Column:
    """Rows that never teach: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS,
                  max_chars: int = TRAIN_CHARS) -> DataFrame:
    """At most ``max_docs`` labelled documents that are not held out, of any
    length, in an order drawn by a hash of the id, as far as ``max_chars``
    characters in all go.

    Rows with a null id, text or label do not teach; an id with several
    labels takes the largest.  A text of more than an eighth of ``max_chars``
    does not teach either: it would take the place of all others."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    # Lengths pick the rows; only the picked ids (a bounded table) are sent to the texts.
    fits = F.char_length("text") <= max_chars // 8
    sizes = docs.where(fits).groupBy("doc_id").agg(F.sum(F.char_length("text")).alias("_chars"))
    ids = sizes.join(known, "doc_id").withColumn("_drawn", F.xxhash64("doc_id"))
    ids = ids.orderBy("_drawn", "doc_id").limit(max_docs)
    so_far = F.sum("_chars").over(Window.orderBy("_drawn", "doc_id"))  # over at most max_docs rows
    ids = ids.withColumn("_so_far", so_far).where(F.col("_so_far") <= max_chars).select("doc_id", "toxic")
    return docs.select("doc_id", "text").where(fits).join(F.broadcast(ids), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, *, max_docs: int = TRAIN_DOCS, max_chars: int = TRAIN_CHARS,
        least_docs: int = 3, steps: int = 200, rate: float = 0.1, sparse: float = 2e-4) -> SentenceModel:
    """Fit on a bounded sample (see ``training_rows``) by Adam over the whole
    sample, with soft thresholds of strength ``sparse``, so that few words
    keep a weight.  Toxic and clean documents weigh alike as classes.  The
    sample is all that reaches the driver, at any size of the corpus.

    So that long documents are taught as well, the clean documents are also
    joined by ``JOINED``, and each toxic one is joined to such a group: a label
    of joined documents follows from theirs.

    With no labelled row, or labels of one kind only, the model has no words
    and its bias follows the share of toxic rows."""
    rows = training_rows(docs, labels, max_docs, max_chars).toPandas()
    rows = rows.drop_duplicates("doc_id").sort_values("doc_id")
    y = rows["toxic"].to_numpy(np.float64) > 0
    if not len(rows) or y.all() or not y.any():
        share = float(y.mean()) if len(rows) else 0.0
        return SentenceModel({}, float(np.clip(np.log((share + 1e-6) / (1 - share + 1e-6)), -12, 12)))
    number: dict[str, int] = {}
    numbers_of: dict[str, list[int]] = {}
    at, col, owner, in_docs = array("i"), array("i"), array("i"), array("i")
    n_sent = 0
    for k, text in enumerate(rows.pop("text")):
        found = set()
        for s in SENTENCE.findall(text):
            mine = set()
            for w in WORD.findall(s.lower()):
                if w not in numbers_of:
                    numbers_of[w] = [number.setdefault(f, len(number)) for f in features(w)]
                mine.update(numbers_of[w])
            found.add(frozenset(mine))
        for mine in found or {frozenset()}:
            at.extend([n_sent] * len(mine))
            col.extend(sorted(mine))
            owner.append(k)
            n_sent += 1
        in_docs.extend(set().union(*found))
    del numbers_of
    often = np.bincount(np.array(in_docs, np.int32), minlength=len(number)) >= least_docs
    at, col, own = np.array(at, np.int32), np.array(col, np.int32), np.array(owner, np.int32)
    cells = often[col]
    at, col = at[cells], (np.cumsum(often) - 1).astype(np.int32)[col[cells]]
    names = [f for f, x in zip(number, often, strict=True) if x]
    n_docs, n_col = len(y), len(names)

    toxic, tame = np.flatnonzero(y), np.flatnonzero(~y)
    groups = max(len(tame) // JOINED, 1)
    group = np.empty(n_docs, np.int64)
    group[np.random.default_rng(0).permutation(tame)] = np.arange(len(tame)) % groups
    group[toxic] = np.arange(len(toxic)) % groups
    # sentences of each document by itself, and of its group (a toxic one: with its own)
    alone = np.bincount(own, minlength=n_docs)
    joined = np.bincount(group[tame], alone[tame], groups)[group] + np.where(y, alone, 0)
    log_alone, log_joined = np.log(alone)[own], np.log(joined)[own]

    def pull(total: np.ndarray) -> np.ndarray:
        """d loss / d total of toxic documents; that of clean ones is their weight."""
        return -0.5 / len(toxic) / np.expm1(np.clip(total, 1e-9, 700))

    theta = np.zeros(n_col + 1)
    theta[-1] = -3.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        raw = theta[-1] + np.bincount(at, theta[col], n_sent)
        z = raw - log_alone
        total = np.bincount(own, np.logaddexp(0, z), n_docs)  # -log(1 - p) of the sentences, summed
        factor = np.where(y, pull(total), 0.5 / len(tame))
        dz = 0.5 * factor[own] / (1 + np.exp(-np.clip(z, -500, 500)))
        z = raw - log_joined
        total = np.bincount(own, np.logaddexp(0, z), n_docs)
        of_group = np.bincount(group[tame], total[tame], groups)
        factor[toxic] = pull(total[toxic] + of_group[group[toxic]])
        factor[tame] = (np.bincount(group[toxic], factor[toxic], groups) + 0.5 / groups)[group[tame]]
        dz += 0.5 * factor[own] / (1 + np.exp(-np.clip(z, -500, 500)))
        grad = np.append(np.bincount(col, dz[at], n_col), dz.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = rate * (1 if t < 0.6 * steps else 0.2) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        theta -= step * m / (1 - 0.9**t)
        theta[:-1] = np.sign(theta[:-1]) * np.maximum(np.abs(theta[:-1]) - sparse * step[:-1], 0)
    keep = np.abs(theta[:-1]) > 1e-3
    return SentenceModel({w: float(x) for w, x, k in zip(names, theta, keep) if k}, float(theta[-1]))


def score_text(text: str | None, words: WordWeights) -> tuple[float, int, int, int, float]:
    """Document score, number of sentences, and the start, end and score of
    the worst sentence (-1, -1, 0 without one).  Offsets count code points."""
    best, span, n = -600.0, (-1, -1), 0
    memo: dict[str, float] = {}  # a repeated sentence is one piece of evidence
    for found in SENTENCE.finditer(text or ""):
        s = found[0]
        z = memo.get(s)
        if z is None:
            z = memo[s] = words.bias + sum([words[w] for w in set(WORD.findall(s.lower()))])
        n += 1
        if z > best:
            best, span = z, found.span()
    if not n:
        return -expm1(-log1p(exp(words.bias))), 0, -1, -1, 0.0
    share = log(len(memo))
    log_clean = sum([log1p(exp(z - share)) if z - share < 30 else z - share for z in memo.values()])
    return -expm1(-log_clean), n, span[0], span[1], 1 / (1 + exp(-max(min(best - share, 500), -500)))


def score(docs: DataFrame, model: SentenceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: ``doc_id, held_out, score, predicted``, then
    ``n_sentences`` and the worst sentence's ``worst_start, worst_end,
    worst_score``.

    Whole texts are scored; nothing but the text is an input.  Null and empty
    texts, and texts without a sentence, get the score of one wordless
    sentence.  Rows are scored one by one: nothing is shuffled, and repeated
    rows repeat."""
    model_on = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        words = WordWeights(model_on.value)

        def work(texts: list) -> dict:
            names = ("score", "n_sentences", "worst_start", "worst_end", "worst_score")
            out = dict(zip(names, zip(*[score_text(t, words) for t in texts]), strict=False))
            out = {n: out.get(n, ()) for n in names}
            return out | {"predicted": [int(x >= 0.5) for x in out["score"]]}

        return work

    src = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                      F.col(text_col).alias("text"))
    return map_texts(src, make, {"score": "double", "predicted": "int", "n_sentences": "int", "worst_start": "int",
                                 "worst_end": "int", "worst_score": "double"})


def clean(docs: DataFrame, model: SentenceModel, text_col: str = "text") -> DataFrame:
    """The documents themselves, all columns, without those predicted toxic."""
    model_on = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def toxic(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = WordWeights(model_on.value)
        for b in texts:
            yield pd.Series([score_text(t, words)[0] >= 0.5 for t in b], dtype=bool)

    return docs.where(~toxic(F.col(text_col)))
