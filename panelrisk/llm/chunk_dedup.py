"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text is normalised (white space deleted) and cut into chunks where its own
characters say so, so that equal stretches are cut alike.  Chunks are
deduplicated over the corpus: the content of every distinct chunk moves once
and proves that its digest names one content (where it names several, they
are numbered).  A document is then the ordered list of its verified
chunk identifiers, its recipe, and only recipes are grouped, compared and
joined back; texts never move again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelrisk.llm.common import WHITE, null_safe_join, stage, with_group_totals

#: A chunk ends after one of these, once it has its least length.
CUT_AFTER = "[.,;:!?。、！？]|[aeou][nrst]"


def normalised(text: Column) -> Column:
    """The text without the contract's white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def chunks(norm: Column, least: int, most: int) -> Column:
    """The chunks of a text; joined in order they give the whole text back.

    A chunk is the shortest run of at least ``least`` code points that ends
    after CUT_AFTER, or else ``most`` code points (or what is left)."""
    pattern = f"(?s).{{{least},{most}}}?(?<={CUT_AFTER})|.{{1,{most}}}"
    return F.regexp_extract_all(norm, F.lit(pattern), F.lit(0))


def digest(chunk: Column, bits: int) -> Column:
    """64-bit digest of a chunk; fewer bits only to test digests that clash."""
    full = F.xxhash64(chunk)
    return full if bits == 64 else full.bitwiseAND(F.lit((1 << bits) - 1))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = 512,
                 most: int = 4096, digest_bits: int = 64) -> DataFrame:
    """One row for each document: ``doc_id, keep_id, group_size, kept,
    text_sha256``, then ``n_chunks``.

    Of documents with equal normalised text the one with the most code points
    in its original text stays, then the smallest id.  Null texts are empty;
    all empty texts form one group.  A null id ranks after every other id.
    Rows that repeat an id with the same text tie and are marked alike; each
    input row gives one output row.  Columns other than the two named are not
    looked at.  An empty table gives an empty result."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    cut = (src.withColumn("norm", normalised(F.col("text")))
           .withColumn("chunk", chunks(F.col("norm"), least, most)))
    key = lambda c: F.struct(digest(c, digest_bits).alias("h"), F.char_length(c).alias("n"))
    recipes = stage(cut.select(
        "doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("points"),
        F.sha2(F.encode("norm", "UTF-8"), 256).alias("text_sha256"),
        F.size("chunk").alias("n_chunks"), F.transform("chunk", key).alias("recipe")), "recipes")

    # Every distinct chunk content, once: what repeats is combined before it moves.
    distinct = (cut.select(F.explode("chunk").alias("content"))
                .groupBy(F.xxhash64("content").alias("full"), "content").agg(F.lit(1).alias("one"))
                .select(digest(F.col("content"), digest_bits).alias("h"),
                        F.char_length("content").alias("n"), "full"))
    clashing = stage(distinct.groupBy("h", "n").agg(F.count(F.lit(1)).alias("contents"))
                     .where("contents > 1").select("h", "n"), "clashing-digests")
    recipes = (recipes.withColumn("variants", F.lit(None).cast("array<struct<pos:int,variant:int>>"))
               if clashing.isEmpty() else _with_variants(cut, recipes, clashing, digest_bits))

    least_first = F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("no_id"),
                           F.col("doc_id").alias("id"))
    keyed = recipes.withColumn("recipe_hash", F.xxhash64("recipe", "variants"))
    grouped = with_group_totals(
        keyed, ["recipe_hash", "recipe", "variants"], "doc_id",
        {"n_part": F.count(F.lit(1)), "best_part": F.min(least_first)},
        {"group_size": F.sum("n_part"), "best": F.min("best_part")})
    return grouped.select("doc_id", F.col("best.id").alias("keep_id"), "group_size",
                          F.col("doc_id").eqNullSafe(F.col("best.id")).alias("kept"), "text_sha256", "n_chunks")


def _with_variants(cut: DataFrame, recipes: DataFrame, clashing: DataFrame, bits: int) -> DataFrame:
    """Recipes of documents that hold a chunk with a clashing digest also get
    the number of that chunk's content among the contents of its digest."""
    row = ["doc_id", "text_sha256"]
    each = (cut.select("doc_id", F.sha2(F.encode("norm", "UTF-8"), 256).alias("text_sha256"),
                       F.posexplode("chunk").alias("pos", "content"))
            .withColumns({"h": digest(F.col("content"), bits), "n": F.char_length("content")})
            .join(clashing, ["h", "n"], "left_semi"))
    numbers = (each.select("h", "n", "content").distinct()
               .withColumn("variant", F.row_number().over(Window.partitionBy("h", "n").orderBy("content"))))
    found = (each.join(numbers, ["h", "n", "content"]).groupBy(*row)
             .agg(F.sort_array(F.collect_set(F.struct("pos", "variant"))).alias("variants")))
    return null_safe_join(recipes, found, row)
