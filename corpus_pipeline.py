"""The corpus pipeline: toxic documents go, equal texts go, near copies go, what
is left is mixed by source and tokenised.

Each stage takes the documents that its predecessor kept, works on all of
them, and returns documents again (all columns, no row twice); the last one
returns the tokenised corpus.  Nulls, empty texts, ties and repeated rows are
treated as each operator's docstring says: null and empty texts are scored,
grouped and tokenised like any other, a null id is matched null-safely, and
rows that repeat an id stay or go together.  Extra columns are carried along,
whatever their names; empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelrisk.llm import bpe_codec, chunk_dedup, mixing, simhash, toxicity
from panelrisk.llm.common import semi_join_ids, stage, table

#: Vocabulary of the last stage.
VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-or model does not call toxic.  The model is
    fitted on the labelled documents among those of this stage."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model)


def drop_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (white space aside)."""
    return semi_join_ids(docs, chunk_dedup.exact_groups(docs).where("kept"))


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the least id.  Three
    words and two bits, as the operator's contract has them."""
    return semi_join_ids(docs, simhash.keep_one(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out in the order that interleaves their sources by
    target weight (square root of size): files and rows follow the schedule."""
    return mixing.in_mixed_order(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded documents."""
    return bpe_codec.digests(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_equal),
    ("simhash near-dedup", drop_near),
    ("mixing", mix_sources),
    ("bpe", tokenise),
]

#: SQL can't express the fitted model, SimHash or BPE; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and
    read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
