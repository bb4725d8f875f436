"""Chunk-recipe dedup, adaptive rules and Hilbert shards against brute force."""

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelrisk.llm import adaptive_rules as A
from panelrisk.llm import chunk_dedup as C
from panelrisk.llm import hilbert_shards as H
from panelrisk.llm.common import table

SF = "/root/testdata/sf0.001"
WHITE = re.compile(r"[\x20\x09-\x0D]")


def groups_by_hand(rows):
    by = defaultdict(list)
    for i, t in rows:
        by[WHITE.sub("", t or "")].append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        norm = WHITE.sub("", t or "")
        keep = min(by[norm])[2]
        out.append((i, keep, len(by[norm]), i == keep, sha256(norm.encode()).hexdigest()))
    return Counter(out)


def as_counter(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


CONTRACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_groups_of_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert as_counter(C.exact_groups(odd_docs), *CONTRACT) == groups_by_hand(rows)


def test_clashing_digests_give_the_same_groups(spark):
    docs = table(spark, SF, "documents")
    want = as_counter(C.exact_groups(docs), *CONTRACT)
    assert as_counter(C.exact_groups(docs, digest_bits=3, least=16, most=64), *CONTRACT) == want
    assert want == groups_by_hand([(r.doc_id, r.text) for r in docs.collect()])


def test_chunks_join_to_the_text(spark):
    texts = [(C.CUT_AFTER * 50,), ("x" * 5000,), ("é." * 700,), ("",), ("banana. " * 900,)]
    df = spark.createDataFrame(texts, "t string").withColumn("c", C.chunks(F.col("t"), 32, 256))
    assert df.where(F.array_join("c", "") != F.col("t")).count() == 0
    assert df.select(F.max(F.expr("array_max(transform(c, x -> length(x)))"))).first()[0] <= 256


def measures_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {k for i, w in enumerate(windows) if seen[w] > 1 for k in range(i, i + 5)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_measures(spark, odd_docs):
    for docs in (odd_docs, table(spark, SF, "documents")):
        want = Counter((r.doc_id, *measures_by_hand(r.text)) for r in docs.collect())
        assert as_counter(A.adaptive_quality(docs), "doc_id", *BASE) == want


def test_quality_verdict_by_hand(spark):
    """Fences worked out from exact bin counts."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = A.adaptive_quality(docs).collect()
    meta = {r.doc_id: r for r in docs.select("doc_id", "lang", "source", "text").collect()}
    value = {
        "symbol_share": lambda r, n: r.n_symbols * 1000 // max(r.word_chars, 1),
        "word_length": lambda r, n: r.word_chars * 100 // max(r.n_words, 1),
        "dup_line_share": lambda r, n: r.n_dup_lines * 1000 // max(n, 1),
        "repeat_share": lambda r, n: r.n_repeat_words * 1000 // max(r.n_words, 1)}
    lines = {i: sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (m.text or "").split("\n")) for i, m in meta.items()}

    def top(v):  # largest value of a value's bin
        shift = max(v.bit_length() - (A.SUB_BITS + 1), 0)
        return ((v >> shift) + 1 << shift) - 1

    pools = defaultdict(list)
    for r in got:
        if not r.base_failed:
            m = meta[r.doc_id]
            for key in (("own", m.lang, m.source), ("lang", m.lang), ("all",)):
                pools[key].append(r)
    kept = 0
    for r in got:
        m = meta[r.doc_id]
        keys = (("own", m.lang, m.source), ("lang", m.lang))
        pool = next((pools[k] for k in keys if len(pools[k]) >= 30), pools["all",])
        broken = []
        for name, (_, slack, sides) in A.MEASURES.items():
            tops = sorted(top(value[name](x, lines[x.doc_id])) for x in pool)
            q = [next(t for k, t in enumerate(tops, 1) if k * 100 >= len(tops) * p) for p in (25, 50, 75)]
            high = q[1] + max(slack, 6 * (q[2] - q[1]))
            low = q[1] - max(slack, 6 * (q[1] - q[0])) if sides == "both" else -1
            if not low <= value[name](r, lines[r.doc_id]) <= high:
                broken.append(name)
        assert (r.kept, r.broken) == (not r.base_failed and not broken, broken), r
        kept += r.kept
    assert kept / len(got) > 0.8


def test_bins_and_tops(spark):
    df = spark.range(5000).select("id", F.expr(A.bin_of("id")).alias("b"))
    df = df.withColumn("top", F.expr(A.bin_top("b")))
    assert df.where("top < id OR top > id + id / 16").count() == 0
    assert df.groupBy("b").agg(F.countDistinct("top").alias("n")).where("n <> 1").count() == 0


def test_hilbert_neighbours(spark):
    bits, n = 2, 3
    cells = spark.range(1 << bits * n).selectExpr(*[f"int(shiftright(id, {bits * i}) & 3) AS x{i}" for i in range(n)])
    path = cells.selectExpr("*", H.hilbert_index(["x0", "x1", "x2"], bits) + " AS h").orderBy("h").collect()
    assert [r.h for r in path] == list(range(1 << bits * n))
    assert all(sum(abs(a[k] - b[k]) for k in range(n)) == 1 for a, b in zip(path, path[1:]))


def shards_hold(docs, shards):
    rows = docs.collect()
    got = H.hilbert_shards(docs, shards).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        assert (r.law, r.grown_shard) == ("rows", None) and 0 <= r.shard < shards
        by[r.shard].append(r)
    sizes = [len(by[k]) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    order = [r.curve_index for k in range(shards) for r in sorted(by[k], key=lambda r: r.slot)]
    assert order == sorted(order)


def test_hilbert_shards(spark, odd_docs):
    shards_hold(odd_docs, 8)
    shards_hold(odd_docs.limit(3), 8)
    shards_hold(table(spark, SF, "documents"), 8)


def test_empty_tables(no_docs):
    assert C.exact_groups(no_docs).count() == 0
    assert A.adaptive_quality(no_docs).count() == 0
    assert H.hilbert_shards(no_docs).count() == 0


def test_repeated_words_of_any_text(spark):
    @settings(max_examples=1, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(["a", "b", "c"]), max_size=40).map(" ".join), min_size=60, max_size=60))
    def holds(texts):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = A.text_measures(docs, "doc_id", "text", ()).collect()
        assert all(r.n_repeat_words == measures_by_hand(texts[r.doc_id])[4] for r in got)
    holds()
