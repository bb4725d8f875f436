"""Quality rules with adaptive thresholds, in DataFrame functions only.

Text measures are computed in one pass inside arrays.  For every language and
source a quantile sketch of each measure is built: counts in bins whose width
grows with the value, so that two sketches merge by adding counts and every
quantile is off by at most one part in 16.  Outlier fences read off the
sketches take the place of fixed cutoffs, and a join with the fences filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelrisk.llm.common import WHITE, null_safe_join, stage, with_small_table

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Measures with a fence: expression over the base columns (whole numbers),
#: least distance between median and fence, and which sides are fenced.
MEASURES = {
    "symbol_share": ("n_symbols * 1000 div greatest(word_chars, 1)", 30, "upper"),
    "word_length": ("word_chars * 100 div greatest(n_words, 1)", 200, "both"),
    "dup_line_share": ("n_dup_lines * 1000 div greatest(n_lines, 1)", 300, "upper"),
    "repeat_share": ("n_repeat_words * 1000 div greatest(n_words, 1)", 100, "upper"),
}

#: Sub-bins of each doubling, as a power of two.
SUB_BITS = 4


def text_measures(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...]) -> DataFrame:
    """``doc_id``, the carried columns and the whole-text base measures."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), *[F.col(c) for c in carry], text.alias("_text"))
    spaced = F.translate("_text", WHITE, " " * len(WHITE))
    base = base.withColumn("_words", F.array_remove(F.split(spaced, " "), ""))
    base = base.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    base = base.withColumn("_n", F.size("_words")).withColumn("_low", F.length(F.bin("_n")))
    base = base.withColumn("_windows", F.expr(
        f"if(_n < {WINDOW}, array(), transform(sequence(0, _n - {WINDOW}), i -> xxhash64("
        + ", ".join(f"_hash[i + {k}]" if k else "_hash[i]" for k in range(WINDOW)) + ")))"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    base = base.withColumn("_lines", lines)
    base = base.withColumn("_repeats", F.size("_windows") != F.size(F.array_distinct("_windows")))
    return base.select(
        "doc_id", *carry, F.col("_n").cast("long").alias("n_words"),
        F.char_length(F.translate("_text", WHITE, "")).cast("long").alias("word_chars"),
        (F.char_length("_text") - F.char_length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("_repeats"), F.expr(_repeat_words())).otherwise(0).cast("long").alias("n_repeat_words"))


def _repeat_words() -> str:
    """Words in windows that the text holds at least twice.

    Each window's hash gives its lower bits to the window's place, so that one
    sort of whole numbers brings equal windows together; those whose upper
    bits meet are then sorted by their words, which settles which are equal."""
    packed = "sort_array(transform(_windows, (h, i) -> shiftleft(shiftright(h, _low), _low) | i))"
    near = ("transform(filter(transform(p, (x, j) -> struct(x AS x, coalesce("
            "shiftright(x ^ get(p, j - 1), _low) = 0, false) OR coalesce("
            "shiftright(x ^ get(p, j + 1), _low) = 0, false) AS meets)), y -> y.meets), "
            "y -> int(y.x & (shiftleft(1L, _low) - 1)))")
    by_words = f"sort_array(transform(c, i -> struct(array_join(slice(_words, i + 1, {WINDOW}), ' ') AS w, i AS i)))"
    equal = ("transform(filter(transform(s, (x, j) -> struct(x AS x, get(s, j - 1).w AS a, get(s, j + 1).w AS b)), "
             "y -> coalesce(y.x.w = y.a, false) OR coalesce(y.x.w = y.b, false)), y -> y.x.i)")
    covered = f"size(array_distinct(flatten(transform(e, i -> sequence(i, i + {WINDOW - 1})))))"
    let = lambda value, name, body: f"transform(array({value}), {name} -> {body})[0]"
    return let(packed, "p", let(near, "c", let(by_words, "s", let(equal, "e", covered))))


def bin_of(value: str) -> str:
    """SQL for the bin of a whole number: exact below 2**SUB_BITS, then
    2**SUB_BITS bins to each doubling."""
    shift = f"greatest(length(bin({value})) - {SUB_BITS + 1}, 0)"
    return f"int(shiftleft({shift}, {SUB_BITS}) + shiftright({value}, {shift}))"


def bin_top(b: str) -> str:
    """SQL for the largest value of a bin."""
    shift = f"greatest(shiftright({b}, {SUB_BITS}) - 1, 0)"
    return f"shiftleft(bigint({b}) - shiftleft({shift}, {SUB_BITS}) + 1, {shift}) - 1"


def sketch(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Quantile sketches: counts by (keys, measure, bin).  Rows are combined
    before they move, so a hot group sends no more than any other."""
    each = ", ".join(f"struct('{m}' AS measure, {bin_of(f'({sql})')} AS bin)" for m, (sql, _, _) in MEASURES.items())
    return (rows.select(*keys, F.expr(f"inline(array({each}))"))
            .groupBy(*keys, "measure", "bin").agg(F.count(F.lit(1)).alias("n")))


def merged(sketches: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Sketches of coarser groups: the sums of the finer ones."""
    return sketches.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, keys: tuple[str, ...], spread: int) -> DataFrame:
    """One row for each group: its number of rows, then the lower and upper
    fence of each measure.

    The upper fence lies ``spread`` times the distance from median to upper
    quartile (the measure's least distance where that is larger) above the
    median; the lower one likewise.  The windows run over a sketch's bins,
    whose number does not grow with the rows."""
    by = Window.partitionBy(*keys, "measure")
    ranks = (sketches.withColumn("upto", F.sum("n").over(by.orderBy("bin")))
             .withColumn("total", F.sum("n").over(by)))
    at = lambda q: F.expr(f"min(CASE WHEN upto * 100 >= total * {q} THEN {bin_top('bin')} END)")
    points = (ranks.groupBy(*keys, "measure")
              .agg(F.max("total").alias("rows"), at(25).alias("q25"), at(50).alias("q50"), at(75).alias("q75")))
    cols = []
    for m, (_, slack, sides) in MEASURES.items():
        mine = F.col("measure") == m
        up = F.col("q50") + F.greatest(F.lit(slack), spread * (F.col("q75") - F.col("q50")))
        down = F.col("q50") - F.greatest(F.lit(slack), spread * (F.col("q50") - F.col("q25")))
        cols += [F.max(F.when(mine, up)).alias(f"{m}_high"),
                 F.max(F.when(mine, down if sides == "both" else F.lit(-1).cast("long"))).alias(f"{m}_low")]
    return points.groupBy(*keys).agg(F.max("rows").alias("rows"), *cols)


def adaptive_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source", *, spread: int = 6, least_rows: int = 30) -> DataFrame:
    """One row for each document: ``doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept``, then ``broken`` (names
    of the measures outside their fences).

    Fences come from the sketch of the document's language and source; with
    under ``least_rows`` documents there, from the merged sketch of the
    language, and with too few there as well, from that of all documents.
    Documents that fail the base rule do not enter the sketches: junk does
    not shift the thresholds.  Null texts have no words; null languages and
    sources are groups of their own.  If no document passes the base rule
    there are no fences, and nothing is kept.  Each input row gives one row."""
    meta = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"),
                       F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    rows = stage(text_measures(meta, "doc_id", "text", ("lang", "source")).withColumn(
        "base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")), "measures")
    fine = stage(sketch(rows.where(~F.col("base_failed")), ("lang", "source")), "sketches")
    by_lang = merged(fine, ("lang",))
    every = merged(by_lang, ())
    names = [f"{m}_{side}" for m in MEASURES for side in ("high", "low")]
    renamed = lambda df, tag: df.withColumnsRenamed({c: f"{tag}_{c}" for c in ["rows", *names]})
    groups = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("_docs")).drop("_docs")
    groups = null_safe_join(groups, renamed(fences(fine, ("lang", "source"), spread), "own"), ["lang", "source"])
    groups = null_safe_join(groups, renamed(fences(by_lang, ("lang",), spread), "lang"), ["lang"])
    overall = fences(every.withColumn("_one", F.lit(1)), ("_one",), spread).first()  # one row of numbers
    pick = lambda c: F.when(F.col("own_rows") >= least_rows, F.col(f"own_{c}")).when(
        F.col("lang_rows") >= least_rows, F.col(f"lang_{c}")).otherwise(
        F.lit(overall[c] if overall else None).cast("long"))
    groups = groups.select("lang", "source", *[pick(c).alias(c) for c in names])
    fenced = with_small_table(rows, groups, ["lang", "source"], "doc_id")
    out = F.array_compact(F.array(*[
        F.when(~F.coalesce(F.expr(f"({sql}) BETWEEN {m}_low AND {m}_high"), F.lit(False)), F.lit(m))
        for m, (sql, _, _) in MEASURES.items()]))
    return fenced.withColumn("broken", out).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"), "broken")
