"""Mixing, archives and the pipeline."""

import base64
import hashlib
import io
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelrisk.llm import arc_convert, bpe_codec, chunk_dedup, mixing, simhash, toxicity
from panelrisk.llm.common import table

SF = "/root/testdata/sf0.001"


# -- mixing -----------------------------------------------------------------

@pytest.mark.parametrize("weights", [[1], [5, 3, 2], [1000] + [k * k + 300 for k in range(19)],
                                     [10**6, 4000, 4000, 5000] + [9999 + i for i in range(60)]])
def test_no_source_is_a_block_off_in_any_of_many_periods(weights):
    """Weights themselves, not rounded ones, over 1,000 periods (every one of the first, then jumps)."""
    total, slots = sum(weights), 512
    numbers = [*range(40), *range(40, 1000, 37), 999, 10**9 + 7]
    sources = [(w, 10**18, True, True) for w in weights]
    had = None
    for j in numbers:
        begin = mixing.shares(weights, total, j * slots)
        if had is not None and j < 40:
            assert begin == had
        assert sum(begin) == j * slots and all(abs(b * total - w * j * slots) < total for b, w in zip(begin, weights))
        had = list(begin)
        seen = 0
        for i, k, slot, release, due in mixing.one_period(j, slots, total, sources):
            assert (k, slot) == (had[i], j * slots + seen) and release <= slot < due
            assert (release, due) == (k * total // weights[i], -(-(k + 1) * total // weights[i]))
            had[i] += 1
            seen += 1
            if slot % 5 == 0:
                assert all(abs(h * total - w * (slot + 1)) < total for h, w in zip(had, weights))
        assert seen == slots


def test_mix_over_many_periods(spark):
    """Short periods, sources that run out one after the other: every block once, one for a slot, no
    source a block off its unrounded share until the first has run out."""
    sizes = {None: 4000, "b": 900, "c": 2500, "d": 60}
    docs = spark.createDataFrame([(i, s) for s, n in sizes.items() for i in range(n)], "doc_id long, source string")
    weights = {None: 40.0, "b": 27.0, "c": 30.0, "d": 3.0}
    got = mixing.mix(docs, weights, block=2, period=128).collect()
    assert len(got) == sum(sizes.values()) and sorted(r.position for r in got) == list(range(len(got)))
    slots = dict.fromkeys((r.slot, r.source, r.block) for r in sorted(got, key=lambda r: r.position))
    assert len({x[0] for x in slots}) == len(slots) == sum(-(-n // 2) for n in sizes.values())
    assert Counter(x[1:] for x in slots) == Counter((s, k) for s, n in sizes.items() for k in range(-(-n // 2)))
    seen, on = Counter(), {r.slot for r in got if r.on_target}
    for slot, source, k in slots:
        assert k == seen[source]
        seen[source] += 1
        if slot in on:
            assert all(abs(seen[s] - w / 100 * (slot + 1)) < 1 + 1e-6 for s, w in weights.items())
    # "d" runs out first: its window after 30 blocks is that of slots 1000 to 1033
    assert 999 <= max(on) < 1033
    by_hand, parts = [], {s: int(w / 100.0 * mixing.UNITS) for s, w in weights.items()}
    total = sum(parts.values())
    order = sorted(sizes, key=lambda s: (s is not None, s or ""))
    until = {s: ((-(-n // 2) + 2) * total / parts[s] / 128) // 1 + 1 for s, n in sizes.items()}
    for j in range(2000):
        rows = [(parts[s], -(-sizes[s] // 2), j <= until[s] + 1, j <= until[s]) for s in order]
        by_hand += [(slot, order[i], k) for i, k, slot, _, _ in mixing.one_period(j, 128, total, rows) if k < rows[i][1]]
    assert by_hand == list(slots)


def test_many_sources_are_a_table(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('s', id % 12000) AS source")
    got = mixing.mix(docs, block=1)
    assert got.count() == 30_000 and got.select("slot").distinct().count() == 30_000
    table_ = spark.createDataFrame([("s0", 1.0), ("s1", 3.0)], "source string, weight double")
    two = mixing.mix(docs.where("source IN ('s0', 's1')"), table_, block=1).collect()
    assert len(two) == 6
    with pytest.raises(ValueError, match="no positive weight"):
        mixing.mix(docs, table_)


def test_mix_of_documents(spark):
    docs = table(spark, SF, "documents").withColumn("source", F.expr("if(doc_id % 3 = 0, 'big', source)"))
    got = mixing.mix(docs, block=4).collect()
    assert sorted(r.position for r in got) == list(range(docs.count()))
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs.collect())
    assert all(r.release <= r.slot < r.deadline for r in got)
    got.sort(key=lambda r: r.position)
    assert [r.slot for r in got] == sorted(r.slot for r in got)
    sizes = Counter(r.source for r in docs.collect())
    share = {s: n**0.5 / sum(m**0.5 for m in sizes.values()) for s, n in sizes.items()}
    seen, slots = Counter(), dict.fromkeys((r.slot, r.source) for r in got if r.on_target)
    for k, (slot, source) in enumerate(slots):
        assert slot == k  # no slot is empty while all sources last
        seen[source] += 1
        assert all(abs(seen[s] - share[s] * (k + 1)) < 1 + 1e-6 for s in share)


def test_mix_of_odd_rows(odd_docs, no_docs):
    got = mixing.mix(odd_docs, block=2)
    assert sorted(r.position for r in got.collect()) == list(range(odd_docs.count()))
    assert mixing.mix(no_docs).count() == 0
    with pytest.raises(ValueError, match="no positive weight"):
        mixing.mix(odd_docs, {"s": 1})


def test_mixed_order_reaches_the_files(spark, tmp_path):
    docs = table(spark, SF, "documents")
    mixing.in_mixed_order(docs).write.parquet(str(tmp_path / "mix"))
    ids = [r.doc_id for f in sorted(Path(tmp_path / "mix").glob("*.parquet"))
           for r in spark.read.parquet(str(f)).select("doc_id").collect()]
    assert ids == [r.doc_id for r in mixing.mix(docs).orderBy("position").collect()]


# -- archives ---------------------------------------------------------------

def pages_by_hand(rows):
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    first = {}
    for i, t in rows:
        if i is not None:
            first[digest(t)] = min(i, first.get(digest(t), i))
    return Counter((i, len((t or "").encode()), digest(t),
                    "response" if i is None or first[digest(t)] == i else "revisit",
                    None if i is None or first[digest(t)] == i else first[digest(t)]) for i, t in rows)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_pages_to_archives_and_back(spark):
    rows = [(i, "http://x/a b", "<p>same</p>") for i in (9, 4, 7)] + [
        (1, None, None), (2, "", ""), (3, "http://x/\r\nWARC-Type: x", "WARC/1.1\r\n\r\n"), (None, "u", "<p>same</p>"),
        (5, "u", "\n\n1 2 3\n"), (6, "u" * 50, "é" * 70_000), (2**60 + 1, "u", "big id"), (8, "u", "r"), (8, "u", "r")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                  "page_id long, url string, html string, digest string, _salt int")
    got = arc_convert.convert_pages(pages)
    assert Counter(tuple(r) for r in got.select(*COLUMNS).collect()) == pages_by_hand([(r[0], r[2]) for r in rows])
    assert arc_convert.convert_pages(pages.limit(0)).count() == 0
    real = table(spark, SF, "pages")
    want = pages_by_hand([(r.page_id, r.html) for r in real.collect()])
    back = arc_convert.convert_pages(real)
    assert Counter(tuple(r) for r in back.select(*COLUMNS).collect()) == want
    urls = {r.page_id: r.url for r in real.collect()}
    assert all(urls[r.page_id] == r.url and r.date[:4] == "2000" for r in back.collect())


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")],
                                  "page_id long, url string, html string")
    got = {r.page_id: r.record_type for r in arc_convert.convert_pages(pages, least_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_rows_of_one_id_are_judged_by_their_payload(spark):
    rows = [(1, "u", "same"), (1, "u", "other"), (5, "u", "same"), (5, "u", "only here"), (5, "u", "same"),
            (7, "u", "other"), (None, "u", "same"), (None, "u", "no id"), (8, "u", "no id")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to)
                  for r in arc_convert.convert_pages(pages).collect())
    assert got == Counter({(1, 4, "response", None): 1, (1, 5, "response", None): 1, (5, 4, "revisit", 1): 2,
                           (5, 9, "response", None): 1, (7, 5, "revisit", 1): 1, (None, 4, "response", None): 1,
                           (None, 5, "response", None): 1, (8, 5, "response", None): 1})


def test_records_of_one_segment_are_judged_by_their_payload(spark):
    head, record = arc_convert.version_block(1), b"http://a 1.2.3.4 20200102030405 text/html %d\n%s\n"
    make = lambda *payloads: bytearray(head + b"".join(record % (len(p), p) for p in payloads))
    arcs = spark.createDataFrame([(1, make(b"a")), (2, make(b"a", b"unique"))], "page_id long, arc binary")
    got = {(r.page_id, r.payload_bytes, r.record_type) for r in
           arc_convert.read_archives(arc_convert.convert(arcs)).collect()}
    assert got == {(1, 1, "response"), (2, 1, "revisit"), (2, 6, "response")}


def test_arc_versions_and_faults():
    one = arc_convert.version_block(1) + b"http://a/x y 1.2.3.4 20200102030405 text/html 5\nab\ncd\n"
    two = arc_convert.version_block(2) + b"http://b 1.2.3.4 2020 text/html 200 - - 0 f.arc 0\n\n"
    (a,), (b,) = arc_convert.parse_arc(one), arc_convert.parse_arc(two)
    assert (a.url, a.payload, a.content_type) == ("http://a/x y", b"ab\ncd", "text/html")
    assert (b.payload, b.fields["Result-code"]) == (b"", "200")
    assert arc_convert.w3c_date(a.date) == "2020-01-02T03:04:05Z"
    assert arc_convert.w3c_date("2020") == "2020-01-01T00:00:00Z"
    assert arc_convert.w3c_date("20201399") == arc_convert.w3c_date("x") == "1970-01-01T00:00:00Z"
    for bad, why in ((one[:-4], "shorter"), (one.replace(b"1 0 panel", b"7 0 panel"), "unknown version"),
                     (b"http://a 1.2.3.4 2020 text/html 1\nx\n", "no version block"), (b"abc", "without an end"),
                     (one.replace(b"text/html 5", b"text/html five"), "declared fields")):
        with pytest.raises(ValueError, match=why):
            list(arc_convert.parse_arc(bad))


def test_archives_that_were_cut_are_refused():
    record = arc_convert.ArcRecord("u", "2020", "text/html", b"x" * 500, {})
    raw = arc_convert.warc_record(record, 1, arc_convert.sha1_base32(record.payload), None, False)
    assert arc_convert.parse_warc(raw)[1] == record.payload
    import gzip
    packed = gzip.compress(raw) + gzip.compress(raw)
    assert list(arc_convert.members(io.BytesIO(packed), 7)) == [raw, raw]
    with pytest.raises(ValueError, match="inside a member"):
        list(arc_convert.members(io.BytesIO(packed[:-9])))
    with pytest.raises(ValueError, match="declared length"):
        arc_convert.parse_warc(raw[:-5])


def test_many_archives_are_read_by_many_tasks(spark):
    pages = spark.range(600).selectExpr("id AS page_id", "'http://a/' || id AS url", "repeat(sha2(string(id), 512), 40) AS html")
    arcs = arc_convert.as_arc(pages).repartition(8)
    manifest = arc_convert.convert(arcs, archive_bytes=4_000)
    n = manifest.count()
    assert n > 20
    found = arc_convert.read_archives(manifest)
    by_task = [r.n for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(by_task) == 600 and len(by_task) > n / 2 and max(by_task) < 200, by_task


def test_archives_open_with_warcinfo_and_keep_addresses(spark):
    import pyarrow.fs as pafs
    one = arc_convert.version_block(1, "old.arc", "19990102030405") + b"http://a 10.2.3.4 20200102030405 text/html 1\nx\n"
    two = arc_convert.version_block(2) + b"http://b 0.0.0.0 2020 text/html 200 - - 0 f.arc 1\ny\n"
    arcs = spark.createDataFrame([(1, bytearray(one)), (2, bytearray(two))], "page_id long, arc binary").coalesce(1)
    (row,) = arc_convert.convert(arcs).collect()
    store, _ = pafs.FileSystem.from_uri(row.folder if ":" in row.folder else f"file://{row.folder}")
    with store.open_input_stream(row.path, compression=None) as stream:
        (info, block), (a, _), (b, _) = map(arc_convert.parse_warc, arc_convert.members(stream))
    assert info["WARC-Type"] == "warcinfo" and info["WARC-Date"] == "1999-01-02T03:04:05Z" and row.records == 2
    assert b"arc-name: old.arc" in block and b"arc-version: 1" in block and row.path.endswith(info["WARC-Filename"])
    assert a["WARC-IP-Address"] == "10.2.3.4" and "WARC-IP-Address" not in b
    with pytest.raises(ValueError, match="no version block"):
        arc_convert.version_fields(b"http://a 1 2 3 4\n")


# -- pipeline ---------------------------------------------------------------

def test_pipeline_stage_by_stage(spark):
    """Every stage keeps what the brute-force reading of its decisions keeps."""
    docs = table(spark, SF, "documents")
    for (name, run), check in zip(corpus_pipeline.STAGES[:-1], CHECKS, strict=True):
        out = run(spark, docs, SF)
        assert out.columns == docs.columns
        rows = {r.doc_id: r for r in docs.collect()}
        kept = {r.doc_id: r for r in out.collect()}
        assert all(rows[i] == r for i, r in kept.items()), name
        assert set(kept) == check(spark, docs, rows), name
        docs = spark.createDataFrame(list(kept.values()), docs.schema)
    final = corpus_pipeline.run(spark, SF).collect()
    bpe = bpe_codec.load(corpus_pipeline.public_tokenizers.path(corpus_pipeline.VOCABULARY))
    assert {r.doc_id: r.n_tokens for r in final} == {i: len(bpe.encode(r.text)) for i, r in kept.items()}


def _clean(spark, docs, rows):
    words = toxicity.WordWeights(toxicity.fit(docs, table(spark, SF, "labels")))
    return {i for i, r in rows.items() if toxicity.score_text(r.text, words)[0] < 0.5}


def _unequal(spark, docs, rows):
    first = {}
    for i, r in sorted(rows.items(), key=lambda x: (-len(x[1].text), x[0])):
        first.setdefault("".join(r.text.translate({c: None for c in (9, 10, 11, 12, 13, 32)})), i)
    return set(first.values())


def _apart(spark, docs, rows):
    ids = sorted(rows)
    fps = [simhash.fingerprint(rows[i].text) for i in ids]
    label = {i: i for i in ids}
    while True:
        new = {i: min(label[j] for j, g in zip(ids, fps, strict=True) if (f ^ g).bit_count() <= 2)
               for i, f in zip(ids, fps, strict=True)}
        if new == label:
            return {i for i in ids if label[i] == i}
        label = new


CHECKS = [_clean, _unequal, _apart, lambda spark, docs, rows: set(rows)]


def test_pipeline_stages_take_odd_rows(spark, odd_docs, no_docs, tmp_path):
    labels = spark.createDataFrame([(6, 0, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd_docs, no_docs):
        for _, run in corpus_pipeline.STAGES[:-1]:
            out = run(spark, docs, str(tmp_path))
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
    # one of the equal texts, and one of those without words
    left = corpus_pipeline.drop_equal(spark, odd_docs, str(tmp_path))
    assert left.where("text LIKE 'The same%'").count() == 1
    assert chunk_dedup.exact_groups(odd_docs).where("kept").count() >= left.select("doc_id").distinct().count()
