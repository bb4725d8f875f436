"""Toxicity, SimHash, BPE, token counts and suffix dedup against libraries and brute force."""

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelrisk.llm import bpe_codec, piece_counts, simhash, suffix_dedup, toxicity
from panelrisk.llm.common import table
from tests.llm.conftest import ODD_TEXTS

SF = "/root/testdata/sf0.001"
WORD, PIECE = P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")


def odd_strings():
    draw = random.Random(5)
    out = [t or "" for t in ODD_TEXTS]
    out += ["<|endoftext|>", "x<|startoftext|>y <|endoftext|><|endoftext|>", "<|END|>", "it's they'RE don''t'sx",
            "\x00\x1c a\x85b c", "é é ȧ̈", "日本語 한국어", "👩‍👩‍👧😀", "ab" * 3000, "▁ ▁▁a ▁b", " " * 40 + "x", "<s> </s>"]
    for _ in range(60):
        out.append("".join(draw.choice(["the", "  ", " ", "a", "in", "▁", "\n", "=", "é", "'s", "1"]) for _ in range(40)))
        out.append("".join(chr(draw.choice([draw.randrange(1, 0x3000), draw.randrange(0x10000, 0x1F000)]))
                           for _ in range(60)))
    return out


@pytest.fixture(scope="module")
def strings(spark):
    texts = odd_strings()
    return texts, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_word_bpe_is_the_library(spark, strings):
    texts, odd = strings
    docs = table(spark, SF, "documents").select("doc_id", "text")
    texts = {("odd", i): t for i, t in enumerate(texts)} | {("doc", r.doc_id): r.text for r in docs.collect()}
    lib = Tokenizer.from_file(WORD)
    lib.no_truncation()
    lib.no_padding()
    for name, df in (("odd", odd), ("doc", docs)):
        for r in bpe_codec.digests(df, WORD).collect():
            ids = lib.encode(texts[name, r.doc_id], add_special_tokens=False).ids
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
                len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()), r
    r = bpe_codec.encode_texts(odd.where("doc_id = 4"), WORD).first()
    assert r.ids == lib.encode("a", add_special_tokens=False).ids and r.decoded == lib.decode(r.ids)


def test_segment_tree_merges_like_a_scan():
    bpe = bpe_codec.load(WORD)

    def scan(symbols):
        while True:
            ranked = [(bpe.ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in bpe.ranks]
            if not ranked:
                return symbols
            i = min(ranked)[1]
            symbols = symbols[:i] + [symbols[i] + symbols[i + 1]] + symbols[i + 2:]

    draw = random.Random(2)
    for n in [1, 2, 3, 5, 8, 30, 200]:
        for _ in range(20):
            s = [draw.choice("aeinrstho") for _ in range(n)]
            assert bpe_codec.merge(s, bpe.ranks) == scan(s)


def test_piece_counts_are_the_library(spark, strings):
    texts, odd = strings
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for r in piece_counts.token_counts(odd, PIECE, limit=30).collect():
        n = len(lib.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 30), texts[r.doc_id]
    docs = table(spark, SF, "documents").select("doc_id", "text")
    want = {r.doc_id: len(lib.encode(r.text)) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in piece_counts.token_counts(docs, PIECE).collect()} == want


def fingerprint_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(fps, ids):
    label = np.array([1 << 62 if i is None else i for i in ids], np.int64)
    near = np.bitwise_count(np.array(fps, np.uint64)[:, None] ^ np.array(fps, np.uint64)[None, :]) <= 2
    while True:
        new = np.where(near, label[None, :], 1 << 62).min(1)
        if (new == label).all():
            return [None if x == 1 << 62 else int(x) for x in label]
        label = new


def test_simhash_groups(spark, odd_docs):
    close = "one two three four five six seven eight nine ten eleven twelve " * 12
    rows = [(100 + i, close + " ".join(["x"] * i), "en", "s", "", 0.0) for i in range(12)]
    for docs in (odd_docs.unionByName(spark.createDataFrame(rows, odd_docs.schema)), table(spark, SF, "documents")):
        kept = docs.select("doc_id", "text").collect()
        fps = [fingerprint_by_hand(r.text) for r in kept]
        want = Counter(zip([r.doc_id for r in kept], [f"{f:016x}" for f in fps],
                           components_by_hand(fps, [r.doc_id for r in kept]), strict=True))
        got = simhash.near_groups(docs, shard_rows=16)
        assert Counter(tuple(r) for r in got.select("doc_id", "fingerprint", "component_id").collect()) == want


def test_vantage_shards_lose_no_link():
    draw = np.random.default_rng(0)
    base = draw.integers(0, 1 << 63, 500, dtype=np.uint64)
    flip = lambda x: x ^ np.uint64(1 << int(draw.integers(64))) ^ np.uint64(1 << int(draw.integers(64)))
    fps = np.unique(np.concatenate([base, [flip(x) for x in base[:200]], [flip(base[0]) for _ in range(900)]]))
    want = components_by_hand(fps, range(len(fps)))
    nodes = simhash.tree_top(fps[::5], 3)
    row, shard, home = simhash.deal(fps, nodes, 3, 2)
    assert home.sum() == len(fps)
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k in range(8):
        own = row[shard == k]
        for a, b in zip(*simhash.shard_forest(fps[own], home[shard == k], 2), strict=True):
            x, y = sorted((find(int(own[a])), find(int(own[b]))))
            parent[y] = x
    assert [find(x) for x in range(len(fps))] == want


def test_stars_follow_long_chains(spark):
    edges = spark.range(40).selectExpr("id AS u", "id + 1 AS v").union(spark.createDataFrame([(90, 80), (95, 90)], "u long, v long"))
    got = {r.node: r.component for r in simhash.components(edges).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 0), 90: 80, 95: 80}


def repeats_by_hand(rows, length=50):
    high = 1 << 62
    rows = [(high if i is None else i, i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, _, b in rows:
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            first[w] = min(first.get(w, high), i)
    out = []
    for i, doc, b in rows:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < i:
                gone[k:k + length] = b"\1" * length
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((doc, len(b), sum(gone), spans, sha256(rest).hexdigest()))
    return Counter(out)


def test_suffix_dedup(spark, odd_docs):
    same = "a passage that is well over fifty bytes long and shared by several documents, é included. "
    rows = [(50, "head " + same + "tail"), (40, same * 2), (45, "x" * 60), (44, "y" + "x" * 70), (60, same[:49]),
            (61, same[:50]), (None, same), (70, "\0" * 80), (71, "\0" * 55 + "z")]
    more = spark.createDataFrame([(i, t, "en", "s", "", 0.0) for i, t in rows], odd_docs.schema)
    for docs in (odd_docs.unionByName(more), table(spark, SF, "documents")):
        want = repeats_by_hand([(r.doc_id, r.text) for r in docs.collect()])
        got = suffix_dedup.remove_repeats(docs, anchor_shard=1 << 17, fragment_shard=1 << 17)
        assert Counter(tuple(r) for r in got.collect()) == want


def test_suffix_arrays_by_induction():
    draw = np.random.default_rng(1)
    texts = [bytes(draw.integers(0, k, n, dtype=np.uint8)) for n in (1, 2, 7, 60, 400) for k in (1, 2, 4) for _ in range(6)]
    for b in [*texts, b"a" * 900, b"ab" * 500, b"abcabd" * 200 + b"zz", b"\0" * 70]:
        order = suffix_dedup.suffix_array(np.frombuffer(b, np.uint8).astype(np.int64), 50).tolist()
        assert sorted(order) == list(range(len(b)))
        starts = [b[i:i + 50] for i in order]
        assert starts == sorted(starts)


def test_suffix_arrays_of_large_numbers():
    draw = np.random.default_rng(2)
    for top in (3000, 70000, 1 << 50):
        s = draw.integers(0, top, 1500)
        s[700:900] = s[100:300]
        order = suffix_dedup.suffix_array(s, 50).tolist()
        starts = [s[i:i + 50].tolist() for i in order]
        assert sorted(order) == list(range(len(s))) and starts == sorted(starts)


def test_anchors_of_fragments_are_hashed_together(monkeypatch):
    """op10: dealing a shard's fragments into portions hashed each fragment by itself."""
    draw = np.random.default_rng(3)
    texts = [bytes(draw.integers(97, 101, n, dtype=np.uint8)) for n in draw.integers(50, 90, 500)]
    anchors = [int(suffix_dedup.window_anchors(np.frombuffer(t[:50], np.uint8))[0]) for t in texts]
    calls, hashed = [], suffix_dedup.window_anchors
    monkeypatch.setattr(suffix_dedup, "window_anchors", lambda *a: calls.append(1) or hashed(*a))
    monkeypatch.setattr(suffix_dedup, "SORTED_AT_ONCE", 8000)
    parts = -(-sum(map(len, texts)) // 8000)
    dealt = list(suffix_dedup._portions(texts, 50))
    assert dealt == [[t for t, a in zip(texts, anchors, strict=True) if (a >> 36) % parts == k] for k in range(parts)]
    assert len(calls) <= 2


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs.join(labels, "doc_id", "left_semi"), model).join(labels, "doc_id").where("held_out").collect()
    right = sum((r.score >= 0.5) == (r.toxic == 1) for r in rows)
    caught = sum(r.score >= 0.5 for r in rows if r.toxic == 1)
    assert right / len(rows) > 0.96 and caught / sum(r.toxic for r in rows) > 0.85
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


def test_toxicity_points_to_the_sentence(spark):
    model = toxicity.SentenceModel({"bad": 9.0, "scoun-": 8.0}, -6.0)
    docs = spark.createDataFrame([(1, "All is well. You are bad! Bye."), (2, "A scoundrel."), (3, None), (4, "")],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert "All is well. You are bad! Bye."[got[1].worst_start:got[1].worst_end] == " You are bad"
    assert (got[1].predicted, got[2].predicted, got[3].predicted, got[4].predicted) == (1, 1, 0, 0)
    assert got[3].score == got[4].score > 0 and got[3].worst_start == -1
    assert {r.doc_id for r in toxicity.clean(docs, model).collect()} == {3, 4}


def test_toxicity_of_long_documents(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    words = toxicity.WordWeights(model)
    held = docs.join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).orderBy("doc_id").collect()
    clean = [r.text or "" for r in held if r.toxic == 0 and toxicity.score_text(r.text, words)[0] < 0.5]
    for k in (20, 50, 200):
        scores = [toxicity.score_text("\n".join(clean[i:i + k]), words)[0] for i in range(0, len(clean) - k + 1, k)]
        assert scores and sum(x >= 0.5 for x in scores) <= len(scores) // 20, (k, scores)
    # a sentence without a known word is no evidence, however often one comes
    plain = ". ".join(f"{i} {i + 1}" for i in range(20_000))
    assert toxicity.score_text(plain, toxicity.WordWeights(toxicity.SentenceModel({"bad": 20.0}, -3.0)))[0] < 0.1
    toxic = max((w for w, x in model.weights.items() if not w.endswith("-")), key=model.weights.get)
    strong = f"{toxic} " + " ".join(w for w in sorted(model.weights, key=model.weights.get)[-60:] if not w.endswith("-"))
    text = "\n".join([*clean[:25], strong, *clean[25:50]])
    got = toxicity.score_text(text, words)
    assert got[0] >= 0.5 and text[got[2]:got[3]] == strong


def test_toxicity_learns_from_all_lengths(spark):
    rows = [(i, "word " * (3000 if i % 2 else 3)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 == 0) for i in range(40)], "doc_id long, toxic boolean")
    labels = labels.withColumn("toxic", F.col("toxic").cast("int"))
    teach = {r.doc_id for r in toxicity.training_rows(docs, labels).collect()}
    assert teach == {r.doc_id for r in docs.where(~toxicity.held_out(F.col("doc_id"))).collect()}
    some = toxicity.training_rows(docs, labels, max_chars=150_000).collect()
    assert {len(r.text) for r in some} == {15, 15_000} and sum(len(r.text) for r in some) <= 150_000


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd_docs, labels)
    got = toxicity.score(odd_docs, model)
    assert got.count() == odd_docs.count() and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert toxicity.fit(no_docs, labels.limit(0)).weights == {}
    held = {r.doc_id for r in got.where("held_out").collect()}
    assert held == {r.doc_id for r in odd_docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).collect()}


def test_odd_ids_and_empty_tables(odd_docs, no_docs):
    assert Counter(r.doc_id for r in bpe_codec.digests(odd_docs, WORD).collect()) == Counter(
        r.doc_id for r in odd_docs.collect())
    assert piece_counts.token_counts(odd_docs, PIECE).count() == odd_docs.count()
    for df in (bpe_codec.digests(no_docs, WORD), piece_counts.token_counts(no_docs, PIECE),
               simhash.near_groups(no_docs), suffix_dedup.remove_repeats(no_docs)):
        assert df.count() == 0
