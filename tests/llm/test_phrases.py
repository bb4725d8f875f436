"""Collocations against a plain count of all n-grams, and the automata by themselves."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from panelrisk.llm import phrases
from panelrisk.llm.common import table

SF = "/root/testdata/sf0.001"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least=10, top=2000):
    f, n, out = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UP)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i:i + k])] += 1
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        drop = {q for p, a in found.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * c[q]}
        rows = []
        for p, a in found.items():
            if p not in drop:
                s, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def test_entries_come_back_from_a_transducer():
    words, grams, counts = next(phrases.counted(b"A b\tc, a b c. a b d x\x01 \xc3\xa9 a a\n" * 3))
    again = phrases.entries(phrases.transducer(words, grams, counts))
    assert again[0] == words and (again[1] == grams).all() and (again[2] == counts).all()
    none = phrases.entries(phrases.transducer(words, grams[:, :0], counts[:0]))
    assert none[0] == [] and none[1].shape == (3, 0)
    double = phrases.united([again, again, none])
    assert (double[2] == 2 * counts).all() and (double[1] == grams).all()
    some = (words, grams[:, ::3], counts[::3])
    found = phrases.composed(some, double)
    assert [[found[0][i - 1] for i in g if i] for g in found[1].T] == [
        [words[i - 1] for i in g if i] for g in some[1].T] and (found[2] == 2 * some[2]).all()


def test_equal_states_are_registered_once():
    text = b"".join(b"a%d b%d end. " % (i, i) for i in range(300))
    words, grams, counts = next(phrases.counted(text))
    state, (sizes, labels, _) = phrases._registered(np.full(300, 7), np.ones(300, np.int64), np.arange(300))
    assert len(sizes) == 1 and list(labels) == [7] and not state.any()
    assert len(phrases._unpacked(phrases.transducer(words, grams, counts))[8]) == 1


@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_windows_lose_nothing(size):
    text = b"a b c d. e ff ggggggggggg h i\nj k " * 9
    whole = phrases.united(list(phrases.counted(text)))
    parts = phrases.united(list(phrases.counted(text, size)))
    assert whole[0] == parts[0] and (whole[1] == parts[1]).all() and (whole[2] == parts[2]).all()


def test_every_part_finds_the_range_of_its_n_gram():
    words, grams, counts = next(phrases.counted(b"a a b a c b a d c b. a b c d e f g " * 5))
    borders = [(b"", b"z"), (b"en", b"a", b"b", b"c"), (b"en", b"b"), (b"en", b"c", b"a", b"x"), (b"eo", b"a")]
    for levels in (1, 2, 3, 4):
        ranges = phrases.Ranges(borders, levels, 4)
        whole = {tuple(g): s for s, p in ranges.cut(levels, b"en", (words, grams, counts)) for g in p[1].T.tolist()}
        assert set(whole) == set(map(tuple, grams.T.tolist()))
        for i in range(grams.shape[1]):
            (shard, _), = ranges.cut(levels, b"en", (words, grams[:, i:i + 1], counts[i:i + 1]))
            assert shard == whole[tuple(grams[:, i])]


@pytest.mark.parametrize("sizes", [{}, {"window": 5000, "fan_out": 4, "range_bytes": 4000}])
def test_collocations_of_documents(spark, sizes):
    docs = table(spark, SF, "documents")
    got = sorted(map(tuple, phrases.collocations(docs, **sizes).collect()))
    assert got == by_hand([(r.lang, r.text) for r in docs.collect()]) and len(got) > 100


def test_pieces_do_not_grow_with_ranges_times_windows(spark):
    """Two levels: after the unions there are about as many pieces for a window as after one level."""
    docs = table(spark, SF, "documents").selectExpr("'xx' AS lang", "text").repartition(4)
    total = docs.selectExpr("sum(octet_length(text))").first()[0]
    borders = phrases._borders(docs, total, 64)
    window, groups = 10_000, total // 10_000
    two = phrases.count_transducers(docs, phrases.Ranges(borders, 2, 8), 8, window, groups)
    one = phrases.count_transducers(docs, phrases.Ranges(borders[7::8], 1, 8), 8, window, groups)
    assert groups > 30 and two.count() < 2 * one.count()
    a, b = (phrases.listed(phrases.frequent(x, 1).select("lang", "blob")) for x in (one, two))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0 and a.count() > 1000


def test_collocations_of_odd_rows(spark, odd_docs, no_docs):
    assert phrases.collocations(no_docs).count() == 0
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, phrases.collocations(odd_docs, 1).collect())) == by_hand(rows, 1)
    hot = odd_docs.selectExpr("if(doc_id = 3, null, lang) AS lang", "repeat('New York, new york CITY. ', 400) AS text")
    got = sorted(map(tuple, phrases.collocations(hot, top=2).collect()))
    assert got == by_hand([(r.lang, r.text) for r in hot.collect()], top=2)
    assert phrases.collocations(odd_docs.selectExpr("lang", "repeat('xy ', 400000) AS text").limit(2)).first().a > 10**5
