"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelrisk.llm import (adaptive_rules, arc_convert, bpe_codec, chunk_dedup, hilbert_shards, mixing, phrases,
                           piece_counts, prefix_trie, secrets_scan, simhash, suffix_dedup, toxicity)
from panelrisk.llm.common import table

#: Vocabulary files, by the name the tokenizer package knows them by.
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file, the same on every executor."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_vantage_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op3_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # without n_chunks, which RE2's bounds on repetition keep from the oracle
    return chunk_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("n_chunks")


def op4_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # without the names of the broken rules, which the verdict sums up
    return adaptive_rules.adaptive_quality(table(spark, sf_dir, "documents")).drop("broken")


def op5_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE))


def op6_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary(PIECE_BPE))


def op7_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_arc_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    # without the identifiers, dates and addresses made up for the records
    return arc_convert.convert_pages(table(spark, sf_dir, "pages")).drop("record_id", "date", "url")


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.hilbert_shards(table(spark, sf_dir, "documents"), 8)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op11_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_z_fast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_nodes(table(spark, sf_dir, "conversations"))


def op13_random_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.scan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_toxicity, op2_vantage_simhash, op3_chunk_dedup, op4_adaptive_rules, op5_segment_tree_bpe, op6_piece_counts,
    op7_pfair_mix, op8_arc_convert, op9_hilbert_shards, op10_suffix_dedup, op11_phrase_automata,
    op12_z_fast_trie, op13_random_secrets)}

def _secrets_sql() -> str:
    """The scan in SQL, from the same fixed values."""
    S = secrets_scan
    cases = lambda f: " ".join(f"WHEN '{n}' THEN {f(n, a)}" for n, a in S.ALPHABETS.items())
    size = {n: len(a) for n, a in S.ALPHABETS.items()}
    halves = cases(lambda n, a: f"translate(run, '{a}', '{'0' * (len(a) // 2) + '1' * (len(a) - len(a) // 2)}')")
    letters = ", ".join(f"sum(length(text) - length(replace(text, '{c}', '')))::HUGEINT AS l_{c}" for c in S.LETTERS)

    def moment(n: str, a: str, power: int) -> str:
        own = [f"l_{c}" for c in S.LETTERS if c in a.lower()]
        total = "(" + " + ".join(own) + ")"
        return (f"(SELECT CAST({' + '.join('*'.join([x] * power) for x in own)} AS DOUBLE) / "
                f"nullif(CAST({'*'.join([total] * power)} AS DOUBLE), 0) FROM letters)")

    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
m AS (
  {" UNION ALL ".join(f"SELECT rid, {k} AS kind, regexp_extract_all(text, '{p}') AS ms, string_split_regex(text, '{p}') AS gaps FROM t"
                      for k, p in ((0, S.ASSIGN), (1, S.ACCESS), (2, S.HEX), (3, S.RUN)))}),
e AS (
  SELECT rid, kind, unnest(ms) AS match, unnest(gaps[1:len(ms)]) AS gap, generate_subscripts(ms, 1) AS i
  FROM m WHERE len(ms) > 0),
placed AS (
  SELECT rid, kind, match,
         CAST(sum(length(gap) + length(match)) OVER (PARTITION BY rid, kind ORDER BY i) AS BIGINT) AS stop FROM e),
spans AS (SELECT rid, kind, stop - length(match) AS start, stop, match FROM placed),
base AS (
  SELECT * FROM spans
  WHERE kind IN (1, 2) OR kind = 0 AND length(regexp_extract(match, '{S.ASSIGN}', 2)) >= {S.ASSIGN_LEAST}),
told AS (
  SELECT rid, start, stop, match, translate(replace(match, '=', ''), '-_', '+/') AS plain,
         CASE WHEN regexp_matches(match, '^([0-9]+|[A-Z]?[a-z]+|[A-Z]+)$') THEN NULL
              WHEN regexp_matches(match, '^([0-9a-f]+|[0-9A-F]+)$') THEN 'hex'
              WHEN regexp_matches(match, '^[A-Z2-7]+$') THEN 'base32'
              WHEN regexp_matches(match, '^([0-9a-z]+|[0-9A-Z]+)$') THEN 'base36'
              WHEN length(replace(match, '=', '')) >= {S.LEAST} THEN 'base64' END AS encoding
  FROM spans WHERE kind = 3),
runs AS (
  SELECT rid, start, stop, encoding,
         CASE encoding WHEN 'base64' THEN plain WHEN 'base32' THEN match ELSE lower(match) END AS run,
         CASE encoding {cases(lambda n, a: f"'{a}'")} END AS alphabet, CASE encoding {cases(lambda n, a: size[n])} END AS k
  FROM told WHERE encoding IS NOT NULL),
counted AS (
  SELECT *, length(run) AS n, CASE encoding {halves} END AS bits,
         list_transform(string_split(run, ''), lambda c: 2 * strpos(alphabet, c) - (k + 1)) AS v,
         list_sum(list_transform(string_split(alphabet, ''),
                  lambda c: (length(run) - length(replace(run, c, ''))) ** 2))::DOUBLE AS squares
  FROM runs),
tested AS (
  SELECT *, CAST(floor(log2(n + 0.5::DOUBLE) * 2) AS INTEGER) AS band,
         ((squares * k / n - n) - (k - 1)) / sqrt(CAST(2 * (k - 1) AS DOUBLE) * (n - 1) / n) AS z1,
         ((length(bits) - length(replace(bits, '01', ''))) / 2 * 2 + (length(bits) - length(replace(bits, '10', ''))) / 2 * 2
          - (n - 1)) / sqrt(CAST(n - 1 AS DOUBLE)) AS z2,
         CAST(list_sum(list_transform(range(1, n), lambda i: v[i] * v[i + 1])) AS DOUBLE)
         / ((k * k - 1) / 3.0::DOUBLE * sqrt(CAST(n - 1 AS DOUBLE))) AS z3
  FROM counted),
letters AS (SELECT {letters} FROM t),
moments AS (
  {" UNION ALL ".join(f"SELECT '{n}' AS encoding, {moment(n, a, 2)} AS s2, {moment(n, a, 3)} AS s3"
                      for n, a in S.ALPHABETS.items())}),
spread AS (
  SELECT t.*, CAST(n AS DOUBLE) AS x, s2, s3,
         2 * CAST(n AS DOUBLE) * (n - 1) * (s2 + 2 * CAST(n - 2 AS DOUBLE) * s3 - CAST(2 * n - 3 AS DOUBLE) * (s2 * s2)) AS var
  FROM tested t JOIN moments m ON t.encoding = m.encoding),
binned AS (
  SELECT *, CASE WHEN var > 0 THEN CAST(greatest(least(floor(
           (x + x * (x - 1) * s2 - squares) / sqrt(var) * {S.BINS}), {S.BINS * S.TOP}), -1) AS INTEGER) END AS bin
  FROM spread),
bins AS (SELECT band, bin, count(*) AS n FROM binned WHERE bin IS NOT NULL GROUP BY band, bin),
reached AS (
  SELECT band, bin, sum(n) OVER (PARTITION BY band) AS tested, sum(n) OVER (PARTITION BY band ORDER BY bin DESC) AS n FROM bins),
bars AS (
  SELECT band, min(bin) AS bar FROM reached
  WHERE bin >= 0 AND CAST(tested AS DOUBLE) * ({S.tail()!r}::DOUBLE[])[bin + 1] <= {S.RATE}::DOUBLE * CAST(n AS DOUBLE)
  GROUP BY band),
drawn AS (
  SELECT rid, 3 AS kind, start, stop FROM binned r JOIN bars ON r.band = bars.band
  WHERE bin >= bar AND z1 * z1 + z2 * z2 + z3 * z3 <= {S.MOST_CHAOS}::DOUBLE
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = r.rid AND b.start < r.stop AND r.start < b.stop)),
listed AS (
  SELECT rid, kind, start, stop, ({list(S.KINDS)!r})[kind + 1] || ':' || start || ':' || stop AS word
  FROM (SELECT rid, kind, start, stop FROM base UNION ALL SELECT * FROM drawn))
SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
       count(*) FILTER (WHERE kind = 2) AS n_hex, count(*) FILTER (WHERE kind = 3) AS n_random,
       sha256(coalesce(string_agg(word, ',' ORDER BY start, kind, stop) FILTER (WHERE kind < 3), '')) AS base_sha256,
       coalesce(string_agg(word, ',' ORDER BY start, kind, stop) FILTER (WHERE word IS NOT NULL), '') AS spans
FROM t LEFT JOIN listed ON t.rid = listed.rid GROUP BY t.rid, doc_id
"""


#: Queries that SQL can express; the others are tested against brute force.
ORACLE = {
    "op3_chunk_dedup": r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM g
""",
    "op4_adaptive_rules": r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
base AS (
  SELECT rid, doc_id, lang, source,
         list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(text, chr(10)),
                     lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) > 0) AS lines
  FROM t),
placed AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM base),
wins AS (
  SELECT rid, pos, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' '
         || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS win
  FROM placed WINDOW o AS (PARTITION BY rid ORDER BY pos)),
twice AS (SELECT rid, pos, win IS NOT NULL AND count(*) OVER (PARTITION BY rid, win) > 1 AS again FROM wins),
covered AS (
  SELECT rid, bool_or(again) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c
  FROM twice),
repeats AS (SELECT rid, count(*) FILTER (WHERE c) AS n FROM covered GROUP BY rid),
counts AS (
  SELECT b.rid, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
         CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM base b LEFT JOIN repeats r ON b.rid = r.rid),
rules AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts),
vals AS (
  SELECT rid, lang, source, base_failed, 'symbol_share' AS measure, n_symbols * 1000 // greatest(word_chars, 1) AS v
  FROM rules
  UNION ALL SELECT rid, lang, source, base_failed, 'word_length', word_chars * 100 // greatest(n_words, 1) FROM rules
  UNION ALL SELECT rid, lang, source, base_failed, 'dup_line_share', n_dup_lines * 1000 // greatest(n_lines, 1)
  FROM rules
  UNION ALL SELECT rid, lang, source, base_failed, 'repeat_share', n_repeat_words * 1000 // greatest(n_words, 1)
  FROM rules),
-- a value's bin ends at the value with all bits below its first five set
tops AS (
  SELECT lang, source, measure,
         (((v >> greatest(length(bin(v)) - 5, 0)) + 1) << greatest(length(bin(v)) - 5, 0)) - 1 AS top
  FROM vals WHERE NOT base_failed),
levels AS (
  SELECT 3 AS level, lang, source, measure, top FROM tops
  UNION ALL SELECT 2, lang, NULL, measure, top FROM tops
  UNION ALL SELECT 1, NULL, NULL, measure, top FROM tops),
points AS (
  SELECT level, lang, source, measure, count(*) AS n, quantile_disc(top, 0.25) AS q25, quantile_disc(top, 0.5) AS q50,
         quantile_disc(top, 0.75) AS q75
  FROM levels GROUP BY level, lang, source, measure),
slacks AS (SELECT * FROM (VALUES ('symbol_share', 30), ('word_length', 200), ('dup_line_share', 300),
                                 ('repeat_share', 100)) AS x(measure, slack)),
fences AS (
  SELECT level, lang, source, p.measure, n, q50 + greatest(slack, 6 * (q75 - q50)) AS high,
         CASE WHEN p.measure = 'word_length' THEN q50 - greatest(slack, 6 * (q50 - q25)) ELSE -1 END AS low
  FROM points p JOIN slacks s ON p.measure = s.measure),
judged AS (
  SELECT v.rid, coalesce(bool_and(coalesce(
           v.v BETWEEN CASE WHEN o.n >= 30 THEN o.low WHEN l.n >= 30 THEN l.low ELSE a.low END
                   AND CASE WHEN o.n >= 30 THEN o.high WHEN l.n >= 30 THEN l.high ELSE a.high END, false)), false) AS fits
  FROM vals v
  LEFT JOIN fences o ON o.level = 3 AND o.measure = v.measure AND o.lang IS NOT DISTINCT FROM v.lang
                    AND o.source IS NOT DISTINCT FROM v.source
  LEFT JOIN fences l ON l.level = 2 AND l.measure = v.measure AND l.lang IS NOT DISTINCT FROM v.lang
  LEFT JOIN fences a ON a.level = 1 AND a.measure = v.measure
  GROUP BY v.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND fits AS kept
FROM rules JOIN judged ON rules.rid = judged.rid
""",
    "op8_arc_convert": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, payload,
         -- five hexadecimal digits are four of base 32
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
           CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)
         ) & 31 AS BIGINT), 1)), '') AS payload_digest
  FROM p),
f AS (SELECT payload, min(page_id) AS first_id FROM d GROUP BY payload)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d JOIN f ON d.payload = f.payload
""",
    "op11_phrase_automata": r"""
WITH t AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (SELECT rid, lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
numbered AS (SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
w AS (SELECT pid, lang, unnest(words) AS w1, generate_subscripts(words, 1) AS pos FROM numbered),
grams AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY pid ORDER BY pos)),
f AS (
  SELECT lang, w1 AS phrase, 1 AS size, count(*) AS a FROM grams GROUP BY lang, w1
  UNION ALL SELECT lang, w1 || ' ' || w2, 2, count(*) FROM grams WHERE w2 IS NOT NULL GROUP BY lang, w1, w2
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*) FROM grams WHERE w3 IS NOT NULL
  GROUP BY lang, w1, w2, w3),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, phrase, size, a, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND a >= 10),
dropped AS (
  SELECT DISTINCT s.lang, s.phrase
  FROM c s JOIN c g ON s.lang = g.lang AND s.size = 2 AND g.size = 3 AND 100 * g.a >= 50 * s.a
   AND s.phrase IN (g.words[1] || ' ' || g.words[2], g.words[2] || ' ' || g.words[3])),
cuts AS (
  SELECT c.*, k, array_to_string(words[1:k], ' ') AS head, array_to_string(words[k + 1:size], ' ') AS tail
  FROM c, (VALUES (1), (2)) AS x(k) WHERE k < size),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, h.a AS l, t.a AS r,
         (1000000::HUGEINT * cuts.a * cuts.a // (h.a::HUGEINT * t.a))::BIGINT AS score
  FROM cuts JOIN f h ON h.lang = cuts.lang AND h.phrase = head JOIN f t ON t.lang = cuts.lang AND t.phrase = tail
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, k) = 1),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM scored WHERE NOT EXISTS (SELECT 1 FROM dropped d WHERE d.lang = scored.lang AND d.phrase = scored.phrase))
SELECT placed.lang, rank, phrase, a, l, r, n, score FROM placed JOIN n ON placed.lang = n.lang WHERE rank <= 2000
""",
    "op12_z_fast_trie": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role,
                       sha256(length(role)::VARCHAR || ':' || role || text)) AS ts
  FROM t GROUP BY conv_id),
-- CRC-32 of the decimal digits, bit by bit
hs AS (
  SELECT conv_id, ts, xor(list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
           lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)), lambda x, i:
             CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) % 6 AS h
  FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.ts[1:c.h], []), c.ts[c.h + 1:]) AS ts
  FROM hs c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (
  SELECT conv_id, d, ts[1:d] AS p, d = len(ts) AS whole
  FROM (SELECT conv_id, ts, unnest(range(len(ts) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE whole), '') AS ends
  FROM prefixes GROUP BY p, d),
kids AS (SELECT p[1:depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
own_sums AS (
  SELECT nodes.p, depth, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(nodes.p[depth].text) END AS saved,
         CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END AS leaf
  FROM nodes LEFT JOIN kids ON nodes.p = kids.p),
subtrees AS (
  SELECT p[1:k] AS p, sum(saved) AS saved, sum(leaf) AS leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS k FROM own_sums) GROUP BY ALL)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN subtrees s ON n.p = s.p LEFT JOIN kids ON n.p = kids.p
     LEFT JOIN nodes u ON n.depth > 0 AND u.p = n.p[1:n.depth - 1]
""",
    "op13_random_secrets": _secrets_sql(),
}
