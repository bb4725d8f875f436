"""Secrets in texts: fixed patterns, and runs of characters that look drawn at random.

The fixed patterns give the base spans.  The battery adds spans: a run of at
least ``least`` characters of an encoding (hexadecimal, base 32, base 36, base
64, told from its characters) is tested against its alphabet.

* chi-squared: sum of squared counts against the uniform alphabet;
* runs: changes between the lower and the upper half of the alphabet;
* serial correlation: products of neighbours, by their place in the alphabet.

Each statistic has its exact mean and variance for characters drawn at
random; the sum of the three squared scores must stay under ``most_chaos``
(about 1 in 1,000 drawn runs fails).  Texts are not random, so a run
that passes is a discovery only if its squared counts are also too low for
text: their mean and variance follow from the letter frequencies of the
whole corpus (of those letters that the encoding has).  The scores against text
go through the Benjamini-Hochberg rule by length band, over all runs of the
band, at ``rate``: the score is counted in bins, which merge, and
the lower end of a bin stands for it.  Digits alone and letters of one case alone are no
encoding.  Runs that overlap a base span add nothing.

All of it is DataFrame functions; a text never leaves its row.  A null text
is empty; null or repeated ids and repeated rows are rows of their own; an
empty table gives no rows; extra columns are not read.  Without any letter
a-z in the corpus the battery adds nothing."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrisk.llm.common import stage

# FIXED VALUES of the base kinds: name, pattern, least length (of the value for ``assign``).
KINDS = ("assign", "access", "hex", "random")
VALUE = r"[A-Za-z0-9+/_.=-]+"
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

# FIXED VALUES: the alphabets of the encodings, in their order.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
LETTERS = "abcdefghijklmnopqrstuvwxyz"

#: Shortest run that is tested, greatest sum of squared scores, rate of false discoveries.
LEAST, MOST_CHAOS, RATE = 20, 16.27, 0.01

#: Bins of the score against text for each unit, and the greatest score that is told apart.
BINS, TOP = 16, 8


def either_case(words: tuple[str, ...]) -> str:
    """Pattern of one of ``words``, each letter in either case."""
    return "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in words)


#: Quotes and blanks are written as hexadecimal escapes.
ASSIGN = rf"({either_case(ASSIGN_WORDS)})[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?({VALUE})"
ACCESS = rf"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}"
HEX = rf"[0-9a-f]{{{HEX_LEAST},}}"
RUN = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"


def tail(bins: int = BINS, top: int = TOP) -> list[float]:
    """Probability that a normal score reaches the lower end of each bin from 0 to ``top``."""
    return [0.5 * math.erfc(k / bins / math.sqrt(2)) for k in range(bins * top + 1)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def running_sums(numbers: Column) -> Column:
    """Sum of an array's elements up to each place, this one included: block
    sums of square-root size, so that long arrays stay cheap."""
    zero = F.lit(0).cast("long")

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, lambda a, x: a + x)

    def by_block(d: Column, size: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(d) / size).cast("int") - 1),
                             lambda b: total(F.slice(d, b * size + 1, size)))
        return let(blocks, lambda sums: let(
            F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b))), lambda before: F.transform(
                d, lambda _, i: F.element_at(before, F.floor(i / size).cast("int") + 1)
                + total(F.slice(d, F.floor(i / size).cast("int") * size + 1, i % size + 1)))))

    return let(numbers, lambda d: F.when(F.size(d) == 0, F.array().cast("array<bigint>")).otherwise(
        let(F.ceil(F.sqrt(F.size(d))).cast("int"), lambda size: by_block(d, size))))


def found(text: Column, pattern: str) -> Column:
    """Leftmost matches that don't overlap: array of ``(start, end, match)``, in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")

    def spans(ms: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
        sizes = F.transform(ms, lambda m: F.length(m).cast("long"))
        ends = let(sizes, lambda s: running_sums(F.zip_with(F.slice(gaps, F.lit(1), F.size(s)), s, lambda g, x: g + x)))
        return F.zip_with(ends, ms, lambda e, m: F.struct(
            (e - F.length(m)).alias("start"), e.alias("end"), m.alias("match")))

    return let(matches, lambda ms: F.when(F.size(ms) == 0, none).otherwise(spans(ms)))


def _encoding(run: Column) -> Column:
    """Struct of the encoding's name and the run in its alphabet; null where there is none."""
    lower = F.lower(run)
    plain = F.translate(run, "-_=", "+/")

    def of(name: str, written: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), written.alias("run"))

    return (F.when(run.rlike(r"^[0-9]+$") | run.rlike(r"^[A-Z]?[a-z]+$") | run.rlike(r"^[A-Z]+$"), F.lit(None))
            .when(run.rlike(r"^[0-9a-f]+$") | run.rlike(r"^[0-9A-F]+$"), of("hex", lower))
            .when(run.rlike(r"^[A-Z2-7]+$"), of("base32", run))
            .when(run.rlike(r"^[0-9a-z]+$") | run.rlike(r"^[0-9A-Z]+$"), of("base36", lower))
            .when(F.length(plain) >= LEAST, of("base64", plain)))


def _scores(run: Column, alphabet: str) -> Column:
    """Struct of length, squared counts, and the sum of the three squared scores."""
    k = len(alphabet)
    n = F.octet_length(run).cast("long")
    squares = F.aggregate(F.array(*[F.lit(c) for c in alphabet]), F.lit(0).cast("long"), lambda total, c: total + let(
        (F.octet_length(run) - F.octet_length(F.replace(run, c, F.lit("")))).cast("long"), lambda x: x * x))
    halves = F.translate(run, alphabet, "0" * (k // 2) + "1" * (k - k // 2))

    def changes(bits: Column) -> Column:
        return sum(((F.octet_length(bits) - F.octet_length(F.replace(bits, F.lit(x), F.lit(""))))
                    for x in ("01", "10")), F.lit(0)) / 2

    places = F.transform(F.filter(F.split(run, ""), lambda c: c != ""),
                         lambda c: (2 * F.instr(F.lit(alphabet), c) - (k + 1)).cast("long"))
    products = let(places, lambda v: F.aggregate(
        F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1), lambda x, y: x * y),
        F.lit(0).cast("long"), lambda total, x: total + x))
    spread = (k * k - 1) / 3.0

    def scored(size: Column, sq: Column, flips: Column, prod: Column) -> Column:
        chi = sq.cast("double") * k / size - size
        z1 = (chi - (k - 1)) / F.sqrt(2.0 * (k - 1) * (size - 1) / size)
        z2 = (2 * flips - (size - 1)) / F.sqrt((size - 1).cast("double"))
        z3 = prod.cast("double") / (F.lit(spread) * F.sqrt((size - 1).cast("double")))
        return F.struct(size.alias("n"), sq.alias("squares"), (z1 * z1 + z2 * z2 + z3 * z3).alias("chaos"))

    return let(n, lambda size: let(squares, lambda sq: let(let(halves, changes), lambda flips: let(
        products, lambda prod: scored(size, sq, flips, prod)))))


def _tested(runs: Column) -> Column:
    """Runs with an encoding, and their scores."""
    def test(r: Column) -> Column:
        def score(e: Column) -> Column:
            s = None
            for name, alphabet in ALPHABETS.items():
                s = (F.when if s is None else s.when)(e["name"] == name, _scores(e["run"], alphabet))
            return let(s, lambda x: F.struct(
                r["start"].alias("start"), r["end"].alias("end"), e["name"].alias("encoding"), x["n"].alias("n"),
                x["squares"].alias("squares"), x["chaos"].alias("chaos"),
                F.floor(F.log2(x["n"].cast("double") + 0.5) * 2).cast("int").alias("band")))
        return let(_encoding(r["match"]), lambda e: F.when(e.isNotNull(), score(e)))

    return F.filter(F.transform(runs, test), lambda x: x.isNotNull())


def text_moments(counts: dict[str, int]) -> dict[str, tuple[float, float]]:
    """Sums of squared and of cubed letter frequencies for each encoding (over the letters that it has)."""
    out = {}
    for name, alphabet in ALPHABETS.items():
        own = [counts[c] for c in LETTERS if c in alphabet.lower()]
        total = sum(own)
        if total:
            out[name] = (float(sum(x * x for x in own)) / float(total * total),
                         float(sum(x**3 for x in own)) / float(total**3))
    return out


def _bin(run: Column, moments: dict[str, tuple[float, float]]) -> Column:
    """Bin of the score against text: how far the squared counts lie under those of
    as many letters of text; null where the corpus has no letters."""
    n = run["n"].cast("double")
    z = None
    for name, (s2, s3) in moments.items():
        mean = n + n * (n - 1) * s2
        var = 2 * n * (n - 1) * (s2 + 2 * (n - 2) * s3 - (2 * n - 3) * (s2 * s2))
        score = (mean - run["squares"].cast("double")) / F.sqrt(var)
        z = (F.when if z is None else z.when)(run["encoding"] == name, F.when(var > 0, score))
    if z is None:
        return F.lit(None).cast("int")
    return F.greatest(F.least(F.floor(z * BINS), F.lit(BINS * TOP)), F.lit(-1)).cast("int")


def thresholds(runs: DataFrame, rate: float = RATE) -> dict[int, int]:
    """Least bin of discoveries for each length band (Benjamini-Hochberg).

    ``runs``: one row for each tested run, with ``band`` and ``bin``.  At most
    ``BINS * TOP + 2`` counts for each band, of which there are two for each doubling of the length."""
    counts = runs.where(F.col("bin").isNotNull()).groupBy("band", "bin").agg(F.count(F.lit(1)).alias("n"))
    p, out = tail(), {}
    rows = sorted(((r.band, r.bin, r.n) for r in counts.collect()), reverse=True)
    tested: dict[int, int] = {}
    for band, _, n in rows:
        tested[band] = tested.get(band, 0) + n
    reached: dict[int, int] = {}
    for band, at, n in rows:
        reached[band] = reached.get(band, 0) + n
        if at >= 0 and tested[band] * p[at] <= rate * reached[band]:
            out[band] = at
    return out


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), s["start"].cast("string"),
        s["end"].cast("string"))), ",")


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """One row for each document: ``doc_id, n_assign, n_access, n_hex,
    base_sha256, spans`` and ``n_random``, the spans that the battery adds."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def kind(number: int, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"),
                                                     s["end"].alias("end")))

    assigned = F.filter(found(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_LEAST)
    letters = [(F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))).cast("long").alias(f"_{c}")
               for c in LETTERS]
    rows = docs.select(F.col("doc_id"), kind(0, assigned).alias("assign"), kind(1, found(text, ACCESS)).alias("access"),
                       kind(2, found(text, HEX)).alias("hex"), _tested(found(text, RUN)).alias("runs"), *letters)
    rows = stage(rows, "secrets-runs")
    sums = rows.agg(*[F.sum(f"_{c}").alias(c) for c in LETTERS]).first().asDict()
    moments = text_moments({c: n or 0 for c, n in sums.items()})
    runs = rows.select(F.explode("runs").alias("run")).select(
        F.col("run.band").alias("band"), _bin(F.col("run"), moments).alias("bin"))
    least = thresholds(runs, rate)

    base = F.array_sort(F.concat("assign", "access", "hex"))
    bars = F.create_map(*[F.lit(x) for pair in sorted(least.items()) for x in pair]) if least else None

    def drawn(r: Column) -> Column:
        if bars is None:
            return F.lit(False)
        clear = ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))
        return F.coalesce((r["chaos"] <= MOST_CHAOS) & (_bin(r, moments) >= F.try_element_at(bars, r["band"])) & clear,
                          F.lit(False))

    out = rows.withColumn("base", base)
    out = out.withColumn("random", kind(3, F.filter("runs", drawn)))
    return out.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
                      F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                      _listed(F.array_sort(F.concat("base", "random"))).alias("spans"),
                      F.size("random").cast("long").alias("n_random"))
