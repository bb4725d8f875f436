"""Secret scans: base spans against Python's own patterns, the battery against plain statistics."""

import hashlib
import math
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from panelrisk.llm import queries, secrets_scan
from panelrisk.llm.common import table

SF = "/root/testdata/sf0.001"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_by_hand(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


def written(spans):
    return ",".join(f"{secrets_scan.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def check_base(rows, docs):
    want = sorted((str(i), *(sum(k == x for _, k, _ in b) for x in range(3)),
                   hashlib.sha256(written(b).encode()).hexdigest()) for i, b in ((d[0], base_by_hand(d[1])) for d in docs))
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows) == want


def test_running_sums(spark):
    for n in (0, 1, 2, 3, 10, 1000):
        row = spark.range(1).select(F.sequence(F.lit(1), F.lit(n)).cast("array<bigint>").alias("a") if n else
                                    F.array().cast("array<bigint>").alias("a"))
        got = row.select(secrets_scan.running_sums(F.col("a"))).first()[0]
        assert got == [k * (k + 1) // 2 for k in range(1, n + 1)]


ODD = ["token=token=abcdef", "secret: token: abcdefgh", "PASSWORD = 'x1x2x3'é token:short", "api_key:\"" + "k" * 30 + "\"",
       "AKIAAKIA" + "A" * 14 + " AKIA" + "0" * 15 + " AKIA" + "0" * 16, "ſecret=abcdefgh toKen=abcdefg",
       "é" * 5 + "deadbeef" * 3 + " " + "0" * 24 + "A" + "f" * 23, "x" * 30 + "=" * 40, "password=\n abcdefgh",
       "secret=abcdef " * 3000]


def test_scan_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(100 + i, t) for i, t in enumerate(ODD)]
    got = secrets_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_base(got, rows)
    check_base(secrets_scan.scan(odd_docs).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert secrets_scan.scan(no_docs).count() == 0
    empty = secrets_scan.scan(odd_docs.where("text = ''")).first()
    assert (empty.spans, empty.base_sha256) == ("", hashlib.sha256(b"").hexdigest())


def test_scan_of_documents(spark):
    docs = table(spark, SF, "documents")
    got = secrets_scan.scan(docs).collect()
    check_base(got, [(r.doc_id, r.text) for r in docs.collect()])


def statistics(run, alphabet):
    n, k = len(run), len(alphabet)
    squares = sum(run.count(c) ** 2 for c in alphabet)
    z1 = (squares * k / n - n - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    bits = [alphabet.index(c) >= k // 2 for c in run]
    z2 = (2 * sum(x != y for x, y in zip(bits, bits[1:])) - (n - 1)) / math.sqrt(n - 1)
    v = [2 * alphabet.index(c) - (k - 1) for c in run]
    z3 = sum(x * y for x, y in zip(v, v[1:])) / ((k * k - 1) / 3 * math.sqrt(n - 1))
    return squares, z1 * z1 + z2 * z2 + z3 * z3


def test_battery_by_hand(spark):
    draw = random.Random(5)
    runs = [(name, "".join(draw.choices(alphabet, k=n))) for name, alphabet in secrets_scan.ALPHABETS.items()
            for n in (20, 41, 300)]
    runs += [("hex", "0123456789abcdef" * 2), ("base36", "zyzy0" * 9)]
    rows = spark.createDataFrame(runs, "name string, run string")
    for name, alphabet in secrets_scan.ALPHABETS.items():
        for r in rows.where(F.col("name") == name).select("run", secrets_scan._scores(F.col("run"), alphabet).alias("s")).collect():
            squares, chaos = statistics(r.run, alphabet)
            assert (r.s.n, r.s.squares) == (len(r.run), squares) and r.s.chaos == pytest.approx(chaos, rel=1e-12)
    told = rows.select("run", secrets_scan._encoding(F.col("run"))["name"].alias("e")).collect()
    assert all(e == {"0123456789abcdef" * 2: "hex", "zyzy0" * 9: "base36"}.get(run, dict((x, n) for n, x in runs)[run])
               for run, e in told)


def test_drawn_runs_are_found_and_text_is_left_alone(spark):
    draw = random.Random(11)
    words = ["the", "river", "of", "winter", "house", "seven", "letters", "and", "long", "evening", "paper", "road"]
    prose = lambda n, by: by.join(draw.choices(words, k=n))
    keys = ["".join(draw.choices(a, k=n)) for n in (32, 40, 44, 64) for a in list(secrets_scan.ALPHABETS.values())[1:]
            for _ in range(5)]
    keys = [k for k in keys if re.search("[0-9]", k) and re.search("[A-Za-z]", k)]
    texts = [(i, prose(60, " ") + f" ({k}) " + prose(9, " ")) for i, k in enumerate(keys)]
    clean = [(1000 + i, prose(40, " ") + " " + prose(6, by) + "7 " + "ab12" * 10 + " 0123456789abcdefghijklmnopqrstuvwxyz")
             for i, by in enumerate("-_/" * 10)]
    got = {r.doc_id: r for r in secrets_scan.scan(spark.createDataFrame(texts + clean, "doc_id long, text string")).collect()}
    caught, whole = Counter(), Counter(map(len, keys))
    for i, k in enumerate(keys):
        start = texts[i][1].index(k)
        caught[len(k)] += got[i].spans == f"random:{start}:{start + len(k)}"
    # a short run of few characters can also be text: the longer, the surer
    assert caught[32] >= 0.6 * whole[32] and caught[40] >= 0.8 * whole[40] and all(
        caught[n] >= 0.9 * whole[n] for n in (44, 64)), (caught, whole)
    assert not any(got[i].n_random for i, _ in clean)


def test_discoveries_are_bounded_by_band(spark):
    p = secrets_scan.tail()
    rows = [(9, -1)] * 990 + [(9, 16 * 4)] * 10 + [(11, 16 * 2)] * 10 + [(11, -1)] * 1000
    bars = secrets_scan.thresholds(spark.createDataFrame(rows, "band int, bin int"), 0.01)
    assert bars == {9: 64} and 1000 * p[64] <= 0.01 * 10 and 1010 * p[32] > 0.01 * 10


def test_sql_twin_sees_the_same_drawn_runs(spark, tmp_path):
    import duckdb
    draw = random.Random(3)
    texts = [(i, "some words of prose " * 5 + "".join(draw.choices(secrets_scan.ALPHABETS["base64"], k=20 + i)) + " end")
             for i in range(60)] + [(None, None), (5, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{next(Path(tmp_path / 'documents').glob('*.parquet'))}'")
        found = con.execute(queries.ORACLE["op13_random_secrets"])
        names = [d[0] for d in found.description]
        want = sorted(map(str, found.fetchall()))
    got = secrets_scan.scan(docs).select(*names).collect()
    assert sorted(str(tuple(r)) for r in got) == want and sum(r.n_random for r in got) > 40
