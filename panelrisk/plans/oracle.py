"""DuckDB twins of the registered queries (independent SQL, same
semantics).  Each entry is one statement over the driver's pre-registered
tables; the shared views are a common ``WITH`` prefix."""

from __future__ import annotations

from .. import constants as K
from . import catalog as C
from . import views as V


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _case_map(expr: str, mapping: dict) -> str:
    if not mapping:
        return expr
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"(CASE {expr} {whens} ELSE {expr} END)"


def _strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def _title(expr: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({expr}, "
            f"'[{_CASED}]+|[^{_CASED}]+'), lambda x: upper(x[1]) || lower(x[2:])), '')")


def _band(expr: str) -> str:
    return (f"(CASE WHEN {expr} > {K.FIXED_HIGH_CUT}::DOUBLE THEN 'Tinggi' "
            f"WHEN {expr} > {K.FIXED_LOW_CUT}::DOUBLE THEN 'Sedang' ELSE 'Rendah' END)")


def _contains(expr: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({expr}, {_q(pattern)}, 'i'), false)"


_CLUSTER = (f"CAST(CASE WHEN val <= {K.FIXED_LOW_CUT}::DOUBLE THEN {V.SUPPLIED_CLUSTER_IDS[0]} "
            f"WHEN val <= {K.FIXED_HIGH_CUT}::DOUBLE THEN {V.SUPPLIED_CLUSTER_IDS[1]} "
            f"ELSE {V.SUPPLIED_CLUSTER_IDS[2]} END AS INTEGER)")

_PROFILE_CASE = " ".join(f"WHEN {i + 1} THEN {_q(lab)}" for i, lab in enumerate(K.PROFILE_LABELS))


def _views(pattern: str = V.MEASURE_PATTERN) -> str:
    """All shared views.  ``pattern`` selects the map-stage measures."""
    rate, count = _q(V.RATE), _q(V.COUNT)
    y = V.TARGET_YEAR
    return f"""
WITH
panel AS (
  SELECT CAST(o.o_orderkey AS BIGINT) AS seq, n.n_name AS location_name,
         o.o_orderpriority AS measure_name,
         CASE o.o_orderstatus WHEN 'F' THEN {rate} WHEN 'O' THEN {count} ELSE 'Other' END AS metric_name,
         CAST(year(o.o_orderdate) AS INTEGER) AS year,
         o.o_totalprice / {V.VAL_DIVISOR} AS val
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey),
dict AS (
  SELECT n.n_name AS source, 'Nation ' || CAST(n.n_nationkey AS VARCHAR) AS target
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE r.r_name IN {_in(V.DICTIONARY_REGIONS)}),
cov_gdp_raw AS (
  SELECT 'Nation ' || CAST(s.s_nationkey AS VARCHAR) AS Entity, 'N' || CAST(s.s_nationkey AS VARCHAR) AS Code,
         CAST(year(l.l_shipdate) AS INTEGER) AS Year, sum(l.l_quantity) AS v
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY s.s_nationkey, year(l.l_shipdate)),
cov_pop_raw AS (
  SELECT 'Nation ' || CAST(c.c_nationkey AS VARCHAR) AS Entity, 'N' || CAST(c.c_nationkey AS VARCHAR) AS Code,
         CAST(year(o.o_orderdate) AS INTEGER) AS Year, max(c.c_acctbal) AS v
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY c.c_nationkey, year(o.o_orderdate)),
cov_gdp AS (SELECT Entity AS country_gdp, Year AS year_gdp, CAST(v AS DOUBLE) AS gdp_per_capita FROM cov_gdp_raw),
cov_pop AS (SELECT Entity AS country_pop, Year AS year_pop, CAST(v AS DOUBLE) AS pop_density
            FROM cov_pop_raw WHERE Year > 0),
ptr AS (
  SELECT p.*, coalesce(d.target, p.location_name) AS translated_location
  FROM panel p LEFT JOIN dict d ON p.location_name = d.source),
jall AS (
  SELECT t.seq, t.location_name, t.translated_location, t.measure_name, t.metric_name, t.year, t.val,
         g.gdp_per_capita, q.pop_density
  FROM ptr t
  LEFT JOIN cov_gdp g ON t.translated_location = g.country_gdp AND t.year = g.year_gdp
  LEFT JOIN cov_pop q ON t.translated_location = q.country_pop AND t.year = q.year_pop),
jrate AS (SELECT * FROM jall WHERE metric_name = {rate}),
master AS (
  SELECT seq, location_name, translated_location, measure_name, metric_name, year, val,
         coalesce(gdp_per_capita, (SELECT quantile_disc(gdp_per_capita, 0.5) FROM jrate)) AS gdp_per_capita,
         coalesce(pop_density, (SELECT quantile_disc(pop_density, 0.5) FROM jrate)) AS pop_density
  FROM jrate),
master_all AS (
  SELECT seq, location_name, translated_location, measure_name, metric_name, year, val,
         coalesce(gdp_per_capita, (SELECT quantile_disc(gdp_per_capita, 0.5) FROM jall)) AS gdp_per_capita,
         coalesce(pop_density, (SELECT quantile_disc(pop_density, 0.5) FROM jall)) AS pop_density
  FROM jall),
mc AS (SELECT *, {_CLUSTER} AS country_cluster FROM master),
cr AS (SELECT country_cluster, row_number() OVER (ORDER BY avg(val), country_cluster) AS r
       FROM mc GROUP BY country_cluster),
mp AS (SELECT mc.*, CASE cr.r {_PROFILE_CASE} ELSE {_q(K.UNKNOWN_PROFILE)} END AS profil_negara
       FROM mc LEFT JOIN cr ON mc.country_cluster = cr.country_cluster),
split AS (SELECT CAST(quantile_disc(year, 0.8) AS INTEGER) AS s FROM master),
train AS (SELECT * FROM mp WHERE year <= (SELECT s FROM split)),
test AS (SELECT * FROM mp WHERE year > (SELECT s FROM split)),
lastv AS (
  SELECT translated_location, measure_name, val AS m FROM train
  QUALIFY row_number() OVER (PARTITION BY translated_location, measure_name ORDER BY year DESC, seq DESC) = 1),
lastall AS (SELECT val AS m FROM train ORDER BY year DESC, seq DESC LIMIT 1),
pr AS (
  SELECT t.*, coalesce(l.m, (SELECT m FROM lastall)) AS prediction
  FROM test t LEFT JOIN lastv l
    ON t.translated_location = l.translated_location AND t.measure_name = l.measure_name),
cuts AS (SELECT quantile_disc(prediction, 0.33) AS lo, quantile_disc(prediction, 0.66) AS hi FROM pr),
scored AS (
  SELECT pr.*, CASE WHEN prediction <= (SELECT lo FROM cuts) THEN 'Rendah'
                    WHEN prediction <= (SELECT hi FROM cuts) THEN 'Sedang' ELSE 'Tinggi' END AS cluster_risiko
  FROM pr),
pexp AS (
  SELECT translated_location, profil_negara, measure_name, year, gdp_per_capita, pop_density, val,
         prediction, cluster_risiko, seq FROM scored),
pstd AS (
  SELECT p.* EXCLUDE (translated_location),
         {_strip('coalesce(d.target, p.translated_location)')} AS translated_location
  FROM pexp p LEFT JOIN dict d ON p.translated_location = d.source),
mstd AS (
  SELECT m.* EXCLUDE (translated_location),
         {_strip('coalesce(d.target, m.translated_location)')} AS translated_location
  FROM master_all m LEFT JOIN dict d ON m.translated_location = d.source),
up_rows AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN r_name IN {_in(V.UPLOAD_REGIONS)} THEN n_name ELSE r_name END AS location_name,
         CASE l_returnflag WHEN 'R' THEN {rate} WHEN 'A' THEN {count} ELSE 'Other' END AS metric_name,
         l_extendedprice / {V.UPLOAD_DIVISOR} AS val
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey),
uploads AS (
  SELECT row_number() OVER (ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, location_name NULLS FIRST,
                            metric_name, val NULLS FIRST) - 1 AS seq, location_name, metric_name, val
  FROM up_rows),
ustd AS (
  SELECT u.seq, {_strip('coalesce(d.target, u.location_name)')} AS location_name, u.metric_name, u.val
  FROM uploads u LEFT JOIN dict d ON u.location_name = d.source),
ucnt AS (
  SELECT location_name, val AS jumlah_kasus_absolut, seq AS count_seq FROM ustd WHERE metric_name = {count}
  QUALIFY row_number() OVER (PARTITION BY location_name ORDER BY seq) = 1),
classified AS (
  SELECT r.location_name, r.location_name AS translated_location, {_q(K.MAP_MEASURE)} AS measure_name,
         {_q(K.MAP_METRIC)} AS metric_name, CAST({y} AS INTEGER) AS year, r.val, r.val AS prediction,
         {_band('r.val')} AS cluster_risiko, {_q(K.PROFILE_PREFIX)} || {_band('r.val')} AS profil_negara,
         c.jumlah_kasus_absolut, r.seq
  FROM ustd r LEFT JOIN ucnt c ON r.location_name IS NOT DISTINCT FROM c.location_name
  WHERE r.metric_name = {rate}),
cnt AS (
  SELECT translated_location, year, measure_name, max(val) AS jumlah_kasus_absolut, min(seq) AS sub_seq
  FROM mstd WHERE metric_name = {count} GROUP BY translated_location, year, measure_name),
pf AS (SELECT * FROM pstd WHERE year = {y} AND {_contains('measure_name', pattern)}),
pfj AS (
  SELECT pf.*, c.jumlah_kasus_absolut, c.sub_seq FROM pf LEFT JOIN cnt c
    ON pf.translated_location IS NOT DISTINCT FROM c.translated_location
   AND pf.year IS NOT DISTINCT FROM c.year AND pf.measure_name IS NOT DISTINCT FROM c.measure_name),
assembled AS (
  SELECT *, 0 AS source_rank FROM pfj
  UNION ALL BY NAME SELECT *, 1 AS source_rank FROM classified),
ents AS (SELECT DISTINCT translated_location AS ent FROM mstd WHERE translated_location IS NOT NULL),
missing AS (
  SELECT ent FROM ents WHERE NOT EXISTS (
    SELECT 1 FROM assembled a WHERE a.cluster_risiko IS NOT NULL AND a.translated_location = ents.ent)),
cur AS (
  SELECT translated_location, seq, val, gdp_per_capita, pop_density FROM mstd WHERE year = {y}
  QUALIFY row_number() OVER (PARTITION BY translated_location ORDER BY seq) = 1),
hist AS (
  SELECT translated_location, cluster_risiko, profil_negara FROM pstd WHERE cluster_risiko IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY translated_location ORDER BY year DESC, seq) = 1),
backfill AS (
  SELECT m.ent AS translated_location, m.ent AS location_name, CAST({y} AS INTEGER) AS year,
         {_q(K.MAP_MEASURE)} AS measure_name, {_q(K.MAP_METRIC)} AS metric_name, c.val, c.val AS prediction,
         CASE WHEN h.translated_location IS NOT NULL THEN h.cluster_risiko ELSE {_band('c.val')} END AS cluster_risiko,
         CASE WHEN h.translated_location IS NOT NULL THEN h.profil_negara
              ELSE {_q(K.PROFILE_PREFIX)} || {_band('c.val')} END AS profil_negara,
         c.gdp_per_capita, c.pop_density, c.seq, 2 AS source_rank
  FROM missing m JOIN cur c ON m.ent = c.translated_location
  LEFT JOIN hist h ON m.ent = h.translated_location),
allrows AS (SELECT * FROM assembled UNION ALL BY NAME SELECT * FROM backfill),
named AS (
  SELECT * EXCLUDE (translated_location),
         {_case_map(_strip(_title('translated_location')), K.MAP_NAME_FIXUPS)} AS translated_location
  FROM allrows WHERE cluster_risiko IS NOT NULL),
dd AS (
  SELECT * FROM named
  QUALIFY row_number() OVER (PARTITION BY translated_location
                             ORDER BY source_rank, seq, coalesce(sub_seq, -1)) = 1),
final AS (
  SELECT translated_location, location_name, year, measure_name, metric_name, val, prediction,
         cluster_risiko, profil_negara, jumlah_kasus_absolut, gdp_per_capita, pop_density
  FROM dd WHERE translated_location IS NOT NULL
   AND NOT {_contains('translated_location', '|'.join(K.EXCLUDE_KEYWORDS))}),
zs AS (
  SELECT seq, country_cluster,
    (gdp_per_capita - (SELECT avg(gdp_per_capita) FROM mc)) / (SELECT stddev_samp(gdp_per_capita) FROM mc) AS f1,
    (pop_density - (SELECT avg(pop_density) FROM mc)) / (SELECT stddev_samp(pop_density) FROM mc) AS f2,
    (val - (SELECT avg(val) FROM mc)) / (SELECT stddev_samp(val) FROM mc) AS f3,
    (year - (SELECT avg(year) FROM mc)) / (SELECT stddev_samp(year) FROM mc) AS f4
  FROM mc),
cs AS (
  SELECT country_cluster AS cid, count(*) AS n, sum(f1) AS s1, sum(f2) AS s2, sum(f3) AS s3, sum(f4) AS s4,
         sum(f1*f1 + f2*f2 + f3*f3 + f4*f4) AS ss
  FROM zs GROUP BY country_cluster),
pd AS (
  SELECT z.seq, z.country_cluster, c.cid, c.n,
         (z.f1*z.f1 + z.f2*z.f2 + z.f3*z.f3 + z.f4*z.f4) + c.ss / c.n
           - 2.0 * (z.f1*c.s1 + z.f2*c.s2 + z.f3*c.s3 + z.f4*c.s4) / c.n AS d
  FROM zs z CROSS JOIN cs c),
pa AS (
  SELECT seq,
         max(CASE WHEN cid = country_cluster THEN (CASE WHEN n > 1 THEN d * n / (n - 1) ELSE 0 END) END) AS a,
         max(CASE WHEN cid = country_cluster THEN n END) AS n_own,
         min(CASE WHEN cid <> country_cluster THEN d END) AS b
  FROM pd GROUP BY seq),
sil AS (
  SELECT (SELECT count(DISTINCT country_cluster) FROM mc) AS n_clusters,
         avg(CASE WHEN n_own <= 1 THEN 0.0 WHEN a < b THEN 1.0 - a / b WHEN a > b THEN b / a - 1.0
                  ELSE 0.0 END) AS silhouette
  FROM pa),
reg AS (
  SELECT count(*) AS n,
         1.0 - sum((val - prediction) * (val - prediction)) / (var_pop(val) * count(*)) AS r_squared,
         sqrt(sum((val - prediction) * (val - prediction)) / count(*)) AS rmse,
         sum(abs(val - prediction)) / count(*) AS mae
  FROM scored),
summ AS (
  SELECT (SELECT s FROM split) AS split_year,
         count(*) FILTER (WHERE year <= (SELECT s FROM split)) AS training_rows,
         count(*) FILTER (WHERE year > (SELECT s FROM split)) AS testing_rows
  FROM mc)
"""


def _grade(expr: str, bands, floor: str) -> str:
    whens = " ".join(f"WHEN {expr} >= {thr}::DOUBLE THEN {_q(name)}" for thr, name in bands)
    return f"(CASE {whens} ELSE {_q(floor)} END)"


_MAP_DICT_CASE = _case_map("location_name", C.TEST_MAP_DICT)
_SWAP_CASE = _case_map("measure_name", C.SWAP)
_PAD = "chr(9) || '  ' || p_name || ' ' || chr(10)"
_PROBS = [0.2, 0.33, 0.5, 0.66, 0.8]
_QCOLS_Y = ", ".join(f"CAST(quantile_disc(year, {p}) AS DOUBLE) AS q{int(round(p * 100)):02d}" for p in _PROBS)
_QCOLS_P = ", ".join(f"quantile_disc(prediction, {p}) AS q{int(round(p * 100)):02d}" for p in _PROBS)
_METRICS_ROW = """SELECT 'Persistence' AS model, summ.split_year, summ.training_rows, summ.testing_rows,
       round(reg.r_squared, 4) AS r_squared, round(reg.rmse, 4) AS rmse, round(reg.mae, 4) AS mae,
       round(sil.silhouette, 4) AS silhouette_score
FROM summ, reg, sil"""

BODIES: dict[str, str] = {
    "csv_glob_scan": "SELECT seq, location_name, measure_name, metric_name, year, val FROM panel",
    "csv_scan_null_tokens": """SELECT seq, location_name,
        CASE WHEN metric_name = 'Other' THEN NULL ELSE metric_name END AS metric_name,
        CASE WHEN metric_name = 'Other' THEN NULL ELSE val END AS val FROM panel""",
    "raw_zone_roundtrip": "SELECT seq, location_name, measure_name, metric_name, year, val FROM panel",
    "curated_zone_roundtrip": "SELECT * FROM master",
    "prediction_export": "SELECT * FROM pexp",
    "metrics_report": _METRICS_ROW,
    "ingest_counts": """SELECT 'panel' AS source, count(*) AS rows FROM panel
        UNION ALL SELECT 'gdp', count(*) FROM cov_gdp_raw
        UNION ALL SELECT 'pop_density', count(*) FROM cov_pop_raw
        UNION ALL SELECT 'TOTAL', CAST((SELECT count(*) FROM panel) + (SELECT count(*) FROM cov_gdp_raw)
                                  + (SELECT count(*) FROM cov_pop_raw) AS BIGINT)""",
    "drop_null_required": """SELECT t.seq, t.translated_location, t.year, g.gdp_per_capita
        FROM ptr t LEFT JOIN cov_gdp g ON t.translated_location = g.country_gdp AND t.year = g.year_gdp
        WHERE g.gdp_per_capita IS NOT NULL AND NOT isnan(g.gdp_per_capita)""",
    "metric_slice": f"SELECT seq, location_name, measure_name, year, val FROM panel WHERE metric_name = {_q(V.RATE)}",
    "positive_filter": f"SELECT seq, val FROM panel WHERE val > {K.FIXED_HIGH_CUT}::DOUBLE",
    "typed_projection": "SELECT seq, location_name, year, val FROM panel",
    "conform_covariate": "SELECT country_gdp, year_gdp, gdp_per_capita FROM cov_gdp",
    "safe_cast": """SELECT o_orderkey AS orderkey,
        CAST(TRY_CAST(o_orderpriority AS DOUBLE) AS INTEGER) AS priority_int,
        CAST(TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS INTEGER) AS priority_digit,
        CAST(TRY_CAST(CAST(year(o_orderdate) AS VARCHAR) || '.0' AS DOUBLE) AS INTEGER) AS year_from_text,
        TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS price_from_text,
        TRY_CAST(o_orderstatus AS DOUBLE) AS status_double
        FROM orders""",
    "discover_value_column": """SELECT 'gdp' AS source, 'GDP per capita, PPP (constant 2017 international $)' AS value_column,
          Entity AS entity, Year AS year, v AS value FROM cov_gdp_raw
        UNION ALL SELECT 'pop_density', 'Population density', Entity, Year, v FROM cov_pop_raw""",
    "year_and_pattern_filter": f"""SELECT seq, location_name, measure_name, val FROM panel
        WHERE year = 2000 AND {_contains('measure_name', V.MEASURE_PATTERN)}""",
    "entity_slice": f"""SELECT seq, translated_location, year, measure_name, val, gdp_per_capita, pop_density
        FROM master WHERE translated_location = {_q(C.REPORT_ENTITY)}""",
    "dictionary_translate": f"SELECT seq, location_name, {_MAP_DICT_CASE} AS translated_location FROM panel",
    "dictionary_join": "SELECT seq, location_name, translated_location FROM ptr",
    "value_replace": f"""SELECT seq, {_strip(_SWAP_CASE)} AS measure_name,
        {_strip(_case_map("(' ' || measure_name)", C.SWAP))} AS padded FROM panel""",
    "trim_names": f"SELECT p_partkey, {_strip(_PAD)} AS name, CAST(NULL AS VARCHAR) AS blank FROM part",
    "title_case": f"""SELECT p_partkey, {_title('p_name')} AS name_title,
        {_title("p_brand || '-x''y'")} AS brand_title,
        {_title("lower(p_type || ' d''ivoire-bissau')")} AS type_title FROM part""",
    "keyword_exclude": f"""SELECT p_partkey, p_name FROM part
        WHERE NOT {_contains('p_name', '|'.join(C.PART_KEYWORDS))}""",
    "stamp_constants": f"""SELECT seq, location_name, val, CAST({V.TARGET_YEAR} AS INTEGER) AS year,
        {_q(K.MAP_MEASURE)} AS measure_name, {_q(K.MAP_METRIC)} AS metric_name, val AS prediction
        FROM panel WHERE metric_name = {_q(V.RATE)}""",
    "optional_column": "SELECT seq, location_name, val, CAST(NULL AS DOUBLE) AS jumlah_kasus_absolut FROM panel",
    "map_ready_table": """SELECT translated_location AS location, cluster_risiko AS zone,
        CASE cluster_risiko WHEN 'Rendah' THEN 0 WHEN 'Sedang' THEN 1 WHEN 'Tinggi' THEN 2 END AS zone_rank,
        year, measure_name AS category, jumlah_kasus_absolut AS cases_absolute, val AS actual_rate,
        prediction AS predicted_rate, profil_negara AS cluster_profile, gdp_per_capita, pop_density
        FROM final""",
    "left_join_covariate": """SELECT t.seq, t.translated_location, t.year, g.gdp_per_capita
        FROM ptr t LEFT JOIN cov_gdp g ON t.translated_location = g.country_gdp AND t.year = g.year_gdp""",
    "panel_integrate": "SELECT * FROM master",
    "left_join_counts": """SELECT seq, translated_location, year, measure_name, jumlah_kasus_absolut, sub_seq
        FROM assembled WHERE source_rank = 0""",
    "first_match_lookup": f"""SELECT r.seq, r.location_name, r.val, c.jumlah_kasus_absolut, c.count_seq
        FROM uploads r LEFT JOIN (
          SELECT location_name, val AS jumlah_kasus_absolut, seq AS count_seq FROM uploads
          WHERE metric_name = {_q(V.COUNT)}
          QUALIFY row_number() OVER (PARTITION BY location_name ORDER BY seq) = 1) c
        ON r.location_name IS NOT DISTINCT FROM c.location_name
        WHERE r.metric_name = {_q(V.RATE)}""",
    "anti_join_missing_entities": "SELECT ent AS translated_location FROM missing",
    "latest_label_lookup": """SELECT e.translated_location, h.cluster_risiko, h.profil_negara
        FROM (SELECT DISTINCT translated_location FROM master_all WHERE translated_location IS NOT NULL) e
        LEFT JOIN (SELECT translated_location, cluster_risiko, profil_negara FROM pexp
                   QUALIFY row_number() OVER (PARTITION BY translated_location ORDER BY year DESC, seq) = 1) h
        ON e.translated_location = h.translated_location""",
    "fallback_backfill": "SELECT * EXCLUDE (source_rank) FROM backfill",
    "watchlist_coverage": "SELECT w.pos, w.name, f.cluster_risiko, CASE WHEN f.translated_location IS NULL "
                          "THEN 'failed' ELSE 'mapped' END AS status FROM (VALUES "
                          + ", ".join(f"({i}, {_q(n)})" for i, n in enumerate(V.WATCH))
                          + ") AS w(pos, name) LEFT JOIN final f ON f.translated_location = w.name",
    "null_profile": """SELECT count(*) FILTER (WHERE val IS NULL) AS val,
          count(*) FILTER (WHERE gdp_per_capita IS NULL) AS gdp_per_capita,
          count(*) FILTER (WHERE pop_density IS NULL) AS pop_density, 'before' AS stage FROM jrate
        UNION ALL SELECT count(*) FILTER (WHERE val IS NULL), count(*) FILTER (WHERE gdp_per_capita IS NULL),
          count(*) FILTER (WHERE pop_density IS NULL), 'after' FROM master""",
    "distinct_counts": """SELECT count(DISTINCT location_name) AS location_name, count(DISTINCT measure_name) AS measure_name,
        count(DISTINCT metric_name) AS metric_name, count(DISTINCT year) AS year FROM panel""",
    "distinct_entities": "SELECT DISTINCT translated_location FROM master WHERE translated_location IS NOT NULL",
    "group_mean": "SELECT country_cluster, avg(val) AS avg_val FROM mc GROUP BY country_cluster",
    "cluster_profile_stats": """SELECT country_cluster, profil_negara, avg(val) AS avg_tb_rate,
        avg(gdp_per_capita) AS avg_gdp, avg(pop_density) AS avg_pop_density
        FROM mp GROUP BY country_cluster, profil_negara""",
    "zone_distribution": "SELECT cluster_risiko, count(*) AS count FROM scored GROUP BY cluster_risiko",
    "quantile_cuts": f"""SELECT {_QCOLS_Y}, 'year' AS "column" FROM panel
        UNION ALL SELECT {_QCOLS_P}, 'prediction' FROM scored""",
    "quantile_sketch": f"""SELECT x.* FROM ({" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS prob, count({c}) AS n_rows, {e}::DOUBLE AS relative_error, "
        f"true AS within_error FROM {t}" for c, t, ps, e in C.SKETCHED for p in ps)}) x""",
    "median_impute": "SELECT seq, gdp_per_capita, pop_density FROM master",
    "temporal_split": """SELECT seq, year, CASE WHEN year <= (SELECT s FROM split) THEN 'train' ELSE 'test' END AS part
        FROM master""",
    "temporal_split_summary": "SELECT * FROM summ",
    "dedupe_keep_first": """SELECT location_name, measure_name, seq, year, val FROM panel
        QUALIFY row_number() OVER (PARTITION BY location_name, measure_name ORDER BY seq) = 1""",
    "top_k_predictions": f"""SELECT seq, translated_location, profil_negara, year, val, prediction, cluster_risiko
        FROM scored ORDER BY prediction DESC, seq LIMIT {C.TOP_K}""",
    "actual_vs_predicted_sample": f"""SELECT seq, val, prediction FROM scored WHERE val > 0
        ORDER BY (seq * {C.SAMPLE_KEY_MULT}) % {C.SAMPLE_KEY_MOD}, seq, val, prediction LIMIT {C.SAMPLE_SIZE}""",
    "entity_zone": """SELECT translated_location, cluster_risiko FROM scored
        QUALIFY row_number() OVER (PARTITION BY translated_location ORDER BY year, measure_name, seq) = 1""",
    "ordered_category_sort": """SELECT seq, translated_location, cluster_risiko,
        CASE cluster_risiko WHEN 'Rendah' THEN 0 WHEN 'Sedang' THEN 1 WHEN 'Tinggi' THEN 2 END AS zone_rank
        FROM scored""",
    "entity_report": f"""SELECT translated_location, year, measure_name, val, prediction, cluster_risiko,
        gdp_per_capita, pop_density, profil_negara, 'scored' AS source
        FROM scored WHERE translated_location = {_q(C.REPORT_ENTITY)}
        UNION ALL BY NAME SELECT translated_location, year, val, profil_negara, 'history' AS source
        FROM mp WHERE translated_location = {_q(C.REPORT_ENTITY)}
          AND NOT EXISTS (SELECT 1 FROM scored WHERE translated_location = {_q(C.REPORT_ENTITY)})""",
    "entity_report_history": f"""SELECT translated_location, year, CAST(NULL AS VARCHAR) AS measure_name, val,
        CAST(NULL AS DOUBLE) AS prediction, CAST(NULL AS VARCHAR) AS cluster_risiko,
        CAST(NULL AS DOUBLE) AS gdp_per_capita, CAST(NULL AS DOUBLE) AS pop_density, profil_negara, 'history' AS source
        FROM mp WHERE translated_location = {_q(C.REPORT_ENTITY)}""",
    "union_by_name": "SELECT * FROM pstd UNION ALL BY NAME SELECT * FROM classified",
    "zone_classify": "SELECT seq, prediction, cluster_risiko FROM scored",
    "fixed_band_classify": f"""SELECT seq, val, {_band('val')} AS cluster_risiko,
        {_q(K.PROFILE_PREFIX)} || {_band('val')} AS profil_negara FROM panel""",
    "metric_grades": f"""SELECT round(silhouette_score, 6) AS silhouette_score,
        {_grade('silhouette_score', K.SILHOUETTE_GRADES, K.SILHOUETTE_FLOOR_GRADE)} AS silhouette_grade,
        round(r_squared, 6) AS r_squared, {_grade('r_squared', K.R2_GRADES, K.R2_FLOOR_GRADE)} AS r2_grade
        FROM ({_METRICS_ROW.replace('round(reg.r_squared, 4)', 'reg.r_squared').replace('round(sil.silhouette, 4)', 'sil.silhouette')})""",
    "rank_label_clusters": "SELECT seq, country_cluster, profil_negara FROM mp",
    "silhouette": "SELECT n_clusters, round(silhouette, 8) AS silhouette FROM sil",
    "regression_metrics": """SELECT n, round(r_squared, 6) AS r_squared, round(rmse, 6) AS rmse,
        round(mae, 6) AS mae FROM reg""",
    "standardize": """SELECT seq,
        round((gdp_per_capita - (SELECT avg(gdp_per_capita) FROM master)) / (SELECT stddev_samp(gdp_per_capita) FROM master), 8) AS gdp_per_capita_z,
        round((pop_density - (SELECT avg(pop_density) FROM master)) / (SELECT stddev_samp(pop_density) FROM master), 8) AS pop_density_z,
        round((val - (SELECT avg(val) FROM master)) / (SELECT stddev_samp(val) FROM master), 8) AS val_z,
        round((year - (SELECT avg(year) FROM master)) / (SELECT stddev_samp(year) FROM master), 8) AS year_z
        FROM master""",
    "string_index": """SELECT m.seq,
        CAST(coalesce(li.idx, (SELECT count(*) FROM li)) AS INTEGER) AS location_idx,
        CAST(coalesce(mi.idx, (SELECT count(*) FROM mi)) AS INTEGER) AS measure_idx
        FROM master m
        LEFT JOIN li ON m.translated_location = li.label
        LEFT JOIN mi ON m.measure_name = mi.label""",
    "assemble_skip_invalid": """SELECT seq, gdp_per_capita AS f0, pop_density AS f1, val AS f2, CAST(year AS DOUBLE) AS f3
        FROM jrate WHERE gdp_per_capita IS NOT NULL AND pop_density IS NOT NULL AND val IS NOT NULL
          AND NOT isnan(gdp_per_capita) AND NOT isnan(pop_density) AND NOT isnan(val)""",
    "bisecting_clusters_check": f"""SELECT count(*) AS n_rows, {K.CLUSTER_K} AS k,
        {_q(",".join(K.PROFILE_LABELS[:K.CLUSTER_K]))} AS labels_by_mean, true AS silhouette_agrees
        FROM master WHERE gdp_per_capita IS NOT NULL AND pop_density IS NOT NULL AND val IS NOT NULL
          AND year IS NOT NULL""",
    "forest_predict_check": """SELECT (SELECT s FROM split) AS split_year,
        count(*) FILTER (WHERE year <= (SELECT s FROM split)) AS training_rows,
        count(*) FILTER (WHERE year > (SELECT s FROM split)) AS testing_rows,
        count(*) FILTER (WHERE year > (SELECT s FROM split)) AS n_predictions,
        0 AS n_outside, 3 AS n_zones,
        count(*) FILTER (WHERE year > (SELECT s FROM split)) AS n_measured FROM master""",
    "classify_upload": "SELECT * FROM classified",
    "upload_stream": "SELECT * EXCLUDE (seq) FROM classified",
    "assemble_results": """SELECT seq, sub_seq, source_rank, translated_location, year, measure_name, val, prediction,
        cluster_risiko, profil_negara, jumlah_kasus_absolut FROM assembled""",
    "final_entity_table": "SELECT * FROM final",
}

# Frequency-descending label tables for ``string_index`` (fit on years <= 1999).
_INDEX_CTES = """,
li AS (SELECT translated_location AS label, row_number() OVER (ORDER BY count(*) DESC, translated_location) - 1 AS idx
       FROM master WHERE year <= 1999 AND translated_location IS NOT NULL GROUP BY translated_location),
mi AS (SELECT measure_name AS label, row_number() OVER (ORDER BY count(*) DESC, measure_name) - 1 AS idx
       FROM master WHERE year <= 1999 AND measure_name IS NOT NULL GROUP BY measure_name)
"""

# Queries that use the map stage with the reference's own measure pattern.
_REFERENCE_PATTERN = {"anti_join_missing_entities", "fallback_backfill"}


def oracle_sql() -> dict[str, str]:
    out = {}
    for key, body in BODIES.items():
        pattern = K.MAP_MEASURE_PATTERN if key in _REFERENCE_PATTERN else V.MEASURE_PATTERN
        prefix = _views(pattern)
        if key == "string_index":
            prefix = prefix.rstrip() + _INDEX_CTES
        out[key] = prefix + "\n" + body
    return out
