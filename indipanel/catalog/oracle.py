"""SQL counterparts of the registered queries, written for DuckDB.

They are stated independently of the Spark plans: plain windows, quantile_cont and
nested CASE over the same tables.
"""

from __future__ import annotations

from . import inputs as I

# ------------------------------------------------------------------ shared CTEs

_PANEL = """
cells AS (
  SELECT c.c_nationkey AS entity_id,
         year(o.o_orderdate) * 12 + month(o.o_orderdate) - 1 AS period,
         o.o_orderpriority AS indicator_code,
         sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS cents
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2, 3),
panel AS (
  SELECT entity_id, period, indicator_code,
         CASE WHEN (entity_id + CAST(floor(period / 3) AS BIGINT) + ascii(indicator_code)) % 4 = 0
                OR (entity_id = 7 AND indicator_code IN ('4-NOT SPECIFIED', '5-LOW')) THEN NULL
              ELSE CAST(cents AS DOUBLE) / 100.0 END AS value
  FROM cells)"""

_NEIGHBOURS = _PANEL + """,
near AS (
  SELECT *,
         last_value(value IGNORE NULLS) OVER before AS previous_value,
         last_value(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER before AS previous_period,
         first_value(value IGNORE NULLS) OVER after AS next_value,
         first_value(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER after AS next_period
  FROM panel
  WINDOW before AS (PARTITION BY entity_id, indicator_code ORDER BY period
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (PARTITION BY entity_id, indicator_code ORDER BY period
                   ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
medians AS (
  SELECT entity_id, indicator_code, quantile_cont(value, 0.5) AS median
  FROM panel WHERE value IS NOT NULL GROUP BY 1, 2)"""

_LINE = """previous_value + (next_value - previous_value)
         * (CAST(period - previous_period AS DOUBLE) / CAST(next_period - previous_period AS DOUBLE))"""

_STAR = _PANEL + """,
star AS (
  SELECT p.entity_id AS countryiso3code, p.period AS annee, p.indicator_code,
         CAST(round(p.value * 100) AS BIGINT) AS cents,
         n.n_name AS country_name, r.r_name AS region, substr(p.indicator_code, 3, 20) AS indicator_name
  FROM panel p JOIN nation n ON p.entity_id = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""

_EVENTS = r"""
k_events AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, strftime(ts, '%Y%m%d') AS ymd FROM events),
event_rows AS (
  SELECT event_id, ts, user_id, k, ymd,
         event_type AS indicator_code, 'Event ' || event_type AS indicator_name,
         CAST(user_id AS VARCHAR) AS country_code, 'User ' || user_id AS country_name,
         CASE WHEN user_id % 10 = 9 THEN '  ' ELSE ' C' || user_id END AS countryiso3code,
         CASE WHEN k = 13 THEN 'x' WHEN k = 17 THEN ymd || '.5' ELSE ymd END AS date,
         CASE WHEN k % 5 = 3 THEN NULL ELSE value END AS value,
         CASE WHEN k < 50 THEN ' EUR ' ELSE ' ' END AS unit,
         CASE WHEN k < 10 THEN 'F' ELSE '' END AS obs_status,
         k AS decimal
  FROM k_events),
raw AS (
  SELECT *, sha256(concat_ws('|', event_id, user_id, indicator_code, k)) AS row_hash,
         ts AS inserted_at, ymd AS batch_id
  FROM event_rows)"""

_OBSERVATION = ("indicator_code, indicator_name, country_code, country_name, countryiso3code, "
                "date, value, unit, obs_status, decimal")

_METADATA = """
metadata AS (
  SELECT 'C' || c_custkey AS countryiso3code, c_name AS country_name,
         CASE WHEN r_name = 'EUROPE' THEN NULL WHEN r_name = 'MIDDLE EAST' THEN 'Aggregates' ELSE r_name END AS region,
         c_mktsegment AS income_level,
         CASE WHEN r_name = 'MIDDLE EAST' THEN 'agregat' ELSE 'pays_ou_territoire' END AS type_entite,
         c_custkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
known AS (SELECT * FROM metadata WHERE income_level <> 'HOUSEHOLD')"""


def _staged(metadata: str) -> str:
    return _EVENTS + "," + _METADATA + f""",
ranked AS (
  SELECT indicator_code, indicator_name, country_code, country_name,
         nullif(trim(countryiso3code), '') AS countryiso3code,
         CASE WHEN regexp_full_match(date, '[0-9]+') THEN CAST(date AS BIGINT) END AS annee,
         value AS valeur, nullif(trim(unit), '') AS unit, nullif(trim(obs_status), '') AS obs_status,
         decimal AS decimal_places, row_hash, inserted_at
  FROM raw),
newest AS (
  SELECT * FROM ranked WHERE annee IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY country_name, annee, indicator_code
                             ORDER BY inserted_at DESC, row_hash DESC) = 1),
staging AS (
  SELECT s.indicator_code, s.indicator_name, s.country_code, s.country_name, s.countryiso3code,
         m.region, m.income_level,
         CASE WHEN m.type_entite IS NOT NULL THEN m.type_entite
              WHEN s.countryiso3code IS NULL THEN 'agregat' ELSE 'inconnu' END AS type_entite,
         s.annee, s.valeur, s.unit, s.obs_status, s.decimal_places, s.row_hash, s.inserted_at
  FROM newest s LEFT JOIN {metadata} m ON s.countryiso3code = m.countryiso3code)"""


_STAGED, _STAGED_KNOWN = _staged("metadata"), _staged("known")

_ENRICHED = _EVENTS + "," + _METADATA + """,
enriched AS (
  SELECT e.event_id, nullif(trim(e.countryiso3code), '') AS countryiso3code, m.region, m.income_level,
         CASE WHEN m.type_entite IS NOT NULL THEN m.type_entite
              WHEN nullif(trim(e.countryiso3code), '') IS NULL THEN 'agregat' ELSE 'inconnu' END AS type_entite
  FROM event_rows e LEFT JOIN known m ON nullif(trim(e.countryiso3code), '') = m.countryiso3code)"""

_CONTENT = ("sha256(concat_ws('|', indicator_code, country_code, countryiso3code, date, "
            "coalesce(CAST(value AS VARCHAR), '~'), unit, obs_status, CAST(decimal AS VARCHAR)))")

_TWO_BATCHES = _EVENTS + f""",
hashed AS (SELECT *, {_CONTENT} AS h FROM event_rows),
b1 AS (SELECT * FROM hashed WHERE ts < TIMESTAMP '{I.FIRST_UNTIL}'),
b2 AS (SELECT * FROM hashed WHERE ts >= TIMESTAMP '{I.SECOND_FROM}')"""

_INGESTED = "WITH " + _TWO_BATCHES + f"""
SELECT {_OBSERVATION}, '20240201_000000_000000' AS batch_id FROM b1
UNION ALL
SELECT {_OBSERVATION}, '20240202_000000_000000' AS batch_id FROM b2 WHERE h NOT IN (SELECT h FROM b1)"""

_COPIED = """
copied AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS inserted_at,
         sha256(concat_ws('|', user_id, event_type, strftime(ts, '%Y%m%d'))) AS row_hash
  FROM events)"""

_YEARLY = """
yearly_cells AS (
  SELECT o_custkey, 'C' || o_custkey AS countryiso3code, year(o_orderdate) AS annee, o_orderpriority AS code,
         count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
  FROM orders GROUP BY ALL),
totals AS (
  SELECT o_custkey, countryiso3code, annee, CAST(sum(cents) AS DOUBLE) / 100.0 AS total
  FROM yearly_cells GROUP BY ALL),
wide AS (
  SELECT y.countryiso3code, y.annee,
         CAST(max(CASE WHEN code = '1-URGENT' THEN n END) AS DOUBLE) AS n_urgent,
         CAST(max(CASE WHEN code = '2-HIGH' THEN n END) AS DOUBLE) AS n_high,
         CAST(max(CASE WHEN code = '3-MEDIUM' THEN n END) AS DOUBLE) AS n_medium,
         CAST(max(CASE WHEN code = '4-NOT SPECIFIED' THEN n END) AS DOUBLE) AS n_unspecified,
         CAST(max(CASE WHEN code = '5-LOW' THEN n END) AS DOUBLE) AS n_low,
         max(c.c_acctbal) AS balance
  FROM yearly_cells y LEFT JOIN customer c ON y.o_custkey = c.c_custkey
  GROUP BY y.countryiso3code, y.annee),
classed AS (
  SELECT countryiso3code, annee, total,
         CASE WHEN annee BETWEEN 1995 AND 2000 THEN
           CASE WHEN total <= 100000 + 1000 * (annee - 1995) THEN 'Low income'
                WHEN total <= 400000 + 4000 * (annee - 1995) THEN 'Lower middle income'
                WHEN total <= 900000 + 9000 * (annee - 1995) THEN 'Upper middle income'
                ELSE 'High income' END END AS income_level
  FROM totals)"""

_KNOWN_MART = _YEARLY + "," + _METADATA + """,
mart AS (
  SELECT w.countryiso3code, m.country_name, m.region, w.annee,
         w.n_urgent, w.n_high, w.n_medium, w.n_unspecified, w.n_low, w.balance, c.income_level
  FROM wide w JOIN classed c ON w.countryiso3code = c.countryiso3code AND w.annee = c.annee
  JOIN known m ON w.countryiso3code = m.countryiso3code)"""
_MART = _KNOWN_MART.replace("JOIN known m", "JOIN metadata m")

_FEATURES = ("n_urgent", "n_high", "n_medium", "n_unspecified", "n_low", "balance")
_TRAIN = "annee BETWEEN 1995 AND 1998 AND income_level IS NOT NULL"

_JUDGED = "judged AS (SELECT quality AS actual, toxic AS predicted FROM labels)"

_STAMPED = "TIMESTAMP '2024-02-01 06:30:00.123456'"
_MICROS = "'%Y-%m-%d %H:%M:%S.%f'"


def _page_rows() -> str:
    return f"CAST(floor(event_id / {I.PAGE_ROWS}) AS BIGINT) + 1"


def _each(rows, template: str, glue: str = "\nUNION ALL\n") -> str:
    return glue.join(template.format(r) if isinstance(r, str) else template.format(*r) for r in rows)


ORACLE: dict[str, str] = {}

# --------------------------------------------------------------- sources, sinks

ORACLE["page_explode"] = f"WITH {_EVENTS} SELECT {_OBSERVATION} FROM event_rows"

ORACLE["completeness_check"] = """
SELECT event_type AS code, count(*) + CASE WHEN event_type = 'error' THEN 7 ELSE 0 END AS announced,
       count(*) AS received, event_type <> 'error' AS complete
FROM events GROUP BY event_type"""

ORACLE["page_policy"] = f"""
WITH p AS (
  SELECT event_type AS code, {_page_rows()} AS page FROM events GROUP BY ALL),
f AS (
  SELECT *, NOT ((code = 'click' AND page = 1) OR (code = 'view' AND page = 2)) AS ok,
         max(page) OVER (PARTITION BY code) AS wanted FROM p)
SELECT code,
       CASE WHEN max(CASE WHEN page = 1 AND ok THEN 1 ELSE 0 END) = 0 THEN 'skipped'
            WHEN count(*) FILTER (ok) < max(wanted) THEN 'failed' ELSE 'accepted' END AS status,
       count(*) FILTER (NOT ok) AS bad_pages,
       max(CASE WHEN page = 1 AND ok THEN wanted END) AS announced_pages
FROM f GROUP BY code"""

ORACLE["entity_metadata"] = f"""
WITH {_METADATA} SELECT countryiso3code, country_name, region, income_level, type_entite FROM metadata"""

ORACLE["ingest_append"] = f"""
WITH {_EVENTS}
SELECT {_OBSERVATION}, row_hash, strftime(inserted_at, {_MICROS}) AS inserted_at, batch_id FROM raw"""

ORACLE["rollback_batch"] = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, 'first' AS batch_id FROM events WHERE ts < TIMESTAMP '{I.FIRST_UNTIL}'"""

ORACLE["rollback_filter"] = f"""
WITH {_EVENTS} SELECT row_hash, batch_id FROM raw WHERE batch_id <> '20240110'"""

ORACLE["replace_table"] = ORACLE["entity_metadata"]

# ----------------------------------------------------------- incremental ingest

ORACLE["row_hash"] = r"""
SELECT event_id,
       sha256('{"cents":' || CAST(round(value * 100) AS BIGINT) || ',"event_id":' || event_id
              || ',"event_type":"' || event_type || '","props":"' || replace(props, '"', '\"')
              || '","user_id":' || user_id || '}') AS row_hash
FROM events"""

ORACLE["recent_hashes"] = f"""
WITH {_COPIED}
SELECT DISTINCT row_hash FROM (
  SELECT row_hash FROM copied ORDER BY inserted_at DESC, row_hash LIMIT {I.LOOKBACK})"""

ORACLE["ingest_new_rows"] = f"""
WITH {_COPIED}
SELECT event_id, row_hash FROM copied
WHERE ts >= TIMESTAMP '{I.SECOND_FROM}'
  AND row_hash NOT IN (SELECT row_hash FROM copied WHERE ts < TIMESTAMP '{I.FIRST_UNTIL}')"""

ORACLE["stamp_batch"] = f"""
SELECT event_id, strftime({_STAMPED}, '%Y%m%d_%H%M%S_%f') AS batch_id,
       epoch_us({_STAMPED}) AS inserted_at
FROM events"""

ORACLE["ingest_two_batches"] = _INGESTED
ORACLE["ingest_stream"] = _INGESTED

# ------------------------------------------- projections, filters, scalar functions

ORACLE["stage_clean"] = f"""
WITH {_STAGED} SELECT * REPLACE (strftime(inserted_at, {_MICROS}) AS inserted_at) FROM staging"""

ORACLE["blank_to_null"] = f"""
WITH {_EVENTS},
padded AS (
  SELECT event_id, CASE WHEN k < 20 THEN '  ' || chr(9) || ' '
                        WHEN k < 60 THEN ' ' || chr(9) || indicator_code || '  '
                        ELSE indicator_code END AS t
  FROM event_rows)
SELECT event_id, nullif(regexp_replace(t, '^\\s+|\\s+$', '', 'g'), '') AS cleaned FROM padded"""

ORACLE["safe_cast"] = f"""
WITH {_EVENTS}
SELECT event_id,
       CASE WHEN regexp_full_match(date, '[0-9]+') THEN CAST(date AS BIGINT) END AS as_int,
       TRY_CAST(date AS DOUBLE) AS as_float
FROM event_rows"""

ORACLE["classify_entity"] = f"WITH {_ENRICHED} SELECT event_id, type_entite FROM enriched"

ORACLE["filter_entities"] = f"""
WITH {_ENRICHED}
SELECT event_id, countryiso3code FROM enriched
WHERE type_entite = 'pays_ou_territoire' AND countryiso3code IS NOT NULL"""

ORACLE["enrich_left"] = f"WITH {_ENRICHED} SELECT * FROM enriched"

ORACLE["period_filter"] = f"""
WITH {_YEARLY}
SELECT *, 'train' AS part FROM classed WHERE {_TRAIN}
UNION ALL SELECT *, 'score' AS part FROM classed WHERE annee >= 2000"""

ORACLE["label_lookup"] = """
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgente' WHEN '2-HIGH' THEN 'Haute'
                            WHEN '5-LOW' THEN 'Basse' ELSE o_orderpriority END AS label
FROM orders"""

ORACLE["safe_divide"] = """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) / nullif(CAST(l_linenumber - 1 AS DOUBLE), 0) AS share
FROM lineitem"""

ORACLE["outcome_label"] = """
SELECT d.doc_id,
       CASE WHEN l.quality IS NULL THEN 'En attente'
            WHEN l.quality = CASE WHEN d.n_chars > 500 THEN 1 ELSE 0 END THEN 'Juste' ELSE 'Faux' END
         AS prediction_correcte
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

# ------------------------------------------------------------- versions, windows

ORACLE["latest_version"] = """
SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS event_day,
       CAST(round(value * 100) AS BIGINT) AS cents
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                           ORDER BY ts DESC, event_id DESC) = 1"""

ORACLE["neighbors"] = f"WITH {_NEIGHBOURS} SELECT * FROM near"

ORACLE["entity_median"] = f"WITH {_NEIGHBOURS} SELECT * FROM medians"

ORACLE["interpolate"] = f"""
WITH {_NEIGHBOURS}
SELECT entity_id, period, indicator_code, value,
       CASE WHEN value IS NULL AND next_period > previous_period THEN {_LINE} END AS interpolated
FROM near WHERE indicator_code IN ('1-URGENT', '2-HIGH')"""

ORACLE["median_fill"] = f"""
WITH {_NEIGHBOURS}
SELECT p.entity_id, p.period, p.indicator_code, m.median
FROM panel p LEFT JOIN medians m ON p.entity_id = m.entity_id AND p.indicator_code = m.indicator_code
WHERE p.value IS NULL AND p.indicator_code IN ('3-MEDIUM', '4-NOT SPECIFIED')"""

ORACLE["gap_treatment"] = f"""
WITH {_NEIGHBOURS},
treated AS (
  SELECT n.entity_id, n.period, n.indicator_code, n.value AS valeur_originale,
         CASE WHEN value IS NULL AND n.indicator_code IN ('1-URGENT', '2-HIGH')
                   AND previous_value IS NOT NULL AND next_value IS NOT NULL AND next_period > previous_period
              THEN {_LINE}
              WHEN value IS NULL AND n.indicator_code IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN m.median
              ELSE value END AS valeur,
         CASE WHEN value IS NOT NULL THEN 'originale'
              WHEN n.indicator_code IN ('1-URGENT', '2-HIGH')
                   AND previous_value IS NOT NULL AND next_value IS NOT NULL THEN 'interpolation_temporelle'
              WHEN n.indicator_code IN ('3-MEDIUM', '4-NOT SPECIFIED') AND m.median IS NOT NULL THEN 'mediane_pays'
              ELSE 'non_disponible' END AS methode_traitement
  FROM near n LEFT JOIN medians m ON n.entity_id = m.entity_id AND n.indicator_code = m.indicator_code)
SELECT * REPLACE (CASE WHEN indicator_code = '1-URGENT' AND methode_traitement = 'interpolation_temporelle'
                       THEN round(valeur) ELSE valeur END AS valeur),
       methode_traitement IN ('interpolation_temporelle', 'mediane_pays') AS est_imputee
FROM treated"""

# ------------------------------------------------------------- dimensions, star

ORACLE["dim_entity"] = f"""
WITH {_STAGED}
SELECT DISTINCT countryiso3code, country_code, country_name, region, income_level FROM staging
WHERE type_entite = 'pays_ou_territoire' AND countryiso3code IS NOT NULL AND country_name IS NOT NULL"""

ORACLE["dim_period"] = f"WITH {_STAGED} SELECT DISTINCT annee FROM staging WHERE annee IS NOT NULL"

ORACLE["dim_indicator"] = f"""
WITH {_STAGED}
SELECT indicator_code, min(indicator_name) AS indicator_name,
       CASE indicator_code WHEN 'click' THEN 'Clics' WHEN 'view' THEN 'Vues' ELSE min(indicator_name) END
         AS indicator_label_fr,
       min(unit) AS unit
FROM staging GROUP BY indicator_code"""

ORACLE["star_report"] = f"""
WITH {_STAR}
SELECT * FROM star
WHERE annee BETWEEN {1997 * 12} AND {1999 * 12 + 11} AND region IN ('ASIA', 'EUROPE')
  AND indicator_code IN ('1-URGENT', '3-MEDIUM')"""

ORACLE["region_overview"] = f"""
WITH {_STAR}
SELECT region, CAST(floor(annee / 12) AS BIGINT) AS year, indicator_code, count(cents) AS n_values,
       CAST(sum(cents) AS BIGINT) AS total, CAST(sum(cents) AS DOUBLE) / count(cents) AS mean
FROM star GROUP BY ALL"""

ORACLE["evolution"] = f"""
WITH {_PANEL},
seen AS (
  SELECT *, lag(period) OVER w AS previous_period, lag(value) OVER w AS previous_value FROM panel
  WINDOW w AS (PARTITION BY entity_id, indicator_code ORDER BY period))
SELECT *, value - previous_value AS change, (value - previous_value) / nullif(previous_value, 0) AS change_rate
FROM seen"""

# ------------------------------------------------------------- features, classes

ORACLE["pivot_features"] = f"WITH {_YEARLY} SELECT * FROM wide"

ORACLE["features_with_entity"] = f"""
WITH {_YEARLY}, {_METADATA}
SELECT t.countryiso3code, t.annee, t.total, m.country_name, m.region
FROM totals t JOIN known m ON t.countryiso3code = m.countryiso3code"""

ORACLE["classify_by_year"] = f"WITH {_YEARLY} SELECT * FROM classed"

ORACLE["feature_mart"] = f"WITH {_KNOWN_MART} SELECT * FROM mart WHERE annee >= 1996"

ORACLE["factor_relation"] = f"""
WITH {_YEARLY},
both_ AS (SELECT w.*, t.total FROM wide w JOIN totals t ON w.countryiso3code = t.countryiso3code AND w.annee = t.annee)
""" + _each(_FEATURES, """SELECT '{0}' AS factor, count({0}) AS n, round(corr({0}, total), 6) AS correlation FROM both_""")

ORACLE["factor_by_class"] = f"""
WITH {_MART}
SELECT income_level, count(*) AS n, """ + _each(
    _FEATURES[:-1], "round(avg({0}), 6) AS mean_{0}", ", ") + """
FROM mart WHERE income_level IS NOT NULL GROUP BY income_level"""

# ------------------------------------------------------------- profiles

ORACLE["value_counts"] = f"""
WITH {_YEARLY}
SELECT income_level, count(*) AS n FROM classed WHERE income_level IS NOT NULL
GROUP BY income_level ORDER BY n DESC, income_level"""

ORACLE["missing_profile"] = f"WITH {_MART}\n" + _each(
    ("countryiso3code", "country_name", "region", "annee", *_FEATURES, "income_level"),
    "SELECT '{0}' AS column_name, count(*) - count({0}) AS missing FROM mart")

ORACLE["dataset_profile"] = f"""
WITH {_MART}
SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns, min(annee) AS first_period, max(annee) AS last_period FROM mart"""

# ------------------------------------------------------------- model

ORACLE["temporal_split"] = f"WITH {_MART}\n" + _each(
    (("train", 1995, 1998), ("test", 1999, 1999), ("final", 1995, 1999)),
    """SELECT '{0}' AS split, income_level, count(*) AS n FROM mart
WHERE annee BETWEEN {1} AND {2} AND income_level IS NOT NULL GROUP BY income_level""") + """
UNION ALL SELECT 'score' AS split, income_level, count(*) AS n FROM mart WHERE annee >= 2000 GROUP BY income_level"""

ORACLE["train_medians"] = f"WITH {_MART}\n" + _each(
    _FEATURES, "SELECT '{0}' AS feature, quantile_cont({0}, 0.5) AS median FROM mart WHERE " + _TRAIN)

ORACLE["class_weights"] = f"""
WITH {_MART},
c AS (SELECT income_level, count(*) AS n FROM mart WHERE {_TRAIN} GROUP BY income_level)
SELECT income_level, n, CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n) AS weight FROM c"""

ORACLE["model_roundtrip"] = f"""
WITH {_MART} SELECT count(*) AS n_rows, count(*) AS n_equal, count(*) AS n_classes_known FROM mart"""

ORACLE["train_job"] = f"""
WITH {_MART}
SELECT countryiso3code, country_name, region, annee, income_level, 'Test' AS type_prediction,
       true AS class_known, true AS outcome_right, epoch_us(TIMESTAMP '2024-02-01') AS date_prediction
FROM mart WHERE annee = 1999 AND income_level IS NOT NULL"""

ORACLE["forest_certain"] = f"""
WITH {_MART}
SELECT countryiso3code, annee, income_level, income_level AS income_level_predit
FROM mart WHERE annee >= 2000 AND income_level IS NOT NULL"""

ORACLE["prediction_ledger"] = f"""
WITH {_MART},
p AS (
  SELECT *, CASE coalesce(n_urgent, 0) WHEN 0 THEN 'Low income' WHEN 1 THEN 'Lower middle income'
                                       WHEN 2 THEN 'Upper middle income' ELSE 'High income' END AS income_level_predit
  FROM mart)
SELECT countryiso3code, country_name, region, annee, income_level, income_level_predit,
       CASE WHEN annee = 1999 THEN 'Test' ELSE 'Production' END AS type_prediction,
       CASE WHEN income_level IS NULL THEN 'En attente'
            WHEN income_level = income_level_predit THEN 'Juste' ELSE 'Faux' END AS prediction_correcte,
       CASE WHEN annee = 1999 THEN '2024-02-01 00:00:00.000000'
            ELSE '2024-02-03 00:00:00.000000' END AS date_prediction
FROM p WHERE (annee = 1999 AND income_level IS NOT NULL) OR annee >= 2000"""

ORACLE["predictions_by_entity"] = f"""
WITH {_MART},
p AS (
  SELECT *, CASE WHEN n_urgent IS NULL THEN 'Low income' WHEN n_urgent = 1 THEN 'Lower middle income'
                 ELSE 'Upper middle income' END AS predit,
         CASE WHEN annee < 2000 THEN 'Test' ELSE 'Production' END AS type_prediction
  FROM mart WHERE (annee BETWEEN 1995 AND 1998 AND income_level IS NOT NULL) OR annee >= 2000),
g AS (
  SELECT countryiso3code, type_prediction, count(*) AS n_predictions,
         count(*) FILTER (income_level = predit) AS n_right,
         count(*) FILTER (income_level <> predit) AS n_wrong,
         count(*) FILTER (income_level IS NULL) AS n_waiting, max(annee) AS annee
  FROM p GROUP BY ALL)
SELECT g.*, p.country_name, p.region, p.income_level, p.predit AS income_level_predit
FROM g JOIN p USING (countryiso3code, type_prediction, annee)"""

ORACLE["ledger_renewal"] = f"""
WITH {_MART}
SELECT countryiso3code, country_name, region, annee, income_level, 'Lower middle income' AS income_level_predit,
       CASE WHEN annee <= 1999 THEN 'Test' ELSE 'Production' END AS type_prediction,
       CASE WHEN income_level IS NULL THEN 'En attente'
            WHEN income_level = 'Lower middle income' THEN 'Juste' ELSE 'Faux' END AS prediction_correcte,
       CASE WHEN annee <= 1999 THEN '2024-02-01 00:00:00.000000'
            ELSE '2024-02-03 00:00:00.000000' END AS date_prediction
FROM mart WHERE (annee <= 1999 AND income_level IS NOT NULL) OR annee >= 2000"""

ORACLE["accuracy"] = f"""
WITH {_JUDGED}
SELECT CAST(count(*) FILTER (actual = predicted) AS DOUBLE) / count(*) AS accuracy, count(*) AS n FROM judged"""

ORACLE["classification_report"] = f"""
WITH {_JUDGED},
classes AS (SELECT actual AS c FROM judged UNION SELECT predicted FROM judged),
counted AS (
  SELECT CAST(c AS VARCHAR) AS label,
         (SELECT count(*) FROM judged WHERE actual = c AND predicted = c) AS hit,
         (SELECT count(*) FROM judged WHERE actual = c) AS support,
         (SELECT count(*) FROM judged WHERE predicted = c) AS claimed
  FROM classes),
rated AS (
  SELECT label, support, hit,
         coalesce(CAST(hit AS DOUBLE) / nullif(claimed, 0), 0) AS precision,
         coalesce(CAST(hit AS DOUBLE) / nullif(support, 0), 0) AS recall
  FROM counted),
scored AS (
  SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM rated)
SELECT label, precision, recall, f1, support FROM scored
UNION ALL
SELECT 'accuracy', CAST(sum(hit) AS DOUBLE) / sum(support), CAST(sum(hit) AS DOUBLE) / sum(support),
       CAST(sum(hit) AS DOUBLE) / sum(support), CAST(sum(support) AS BIGINT) FROM scored
UNION ALL
SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM scored
UNION ALL
SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
       sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM scored"""

ORACLE["confusion_matrix"] = f"""
WITH {_JUDGED}
SELECT a.actual, count(j.actual) FILTER (j.predicted = 0) AS predicted_0,
       count(j.actual) FILTER (j.predicted = 1) AS predicted_1
FROM (VALUES (0), (1)) a(actual) LEFT JOIN judged j ON a.actual = j.actual GROUP BY a.actual ORDER BY a.actual"""

# ------------------------------------------------------------- data quality

ORACLE["dq_not_null"] = f"""
WITH {_EVENTS} SELECT row_hash, indicator_code FROM raw WHERE NOT regexp_full_match(date, '[0-9]+')"""

ORACLE["dq_unique"] = "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1"

ORACLE["dq_accepted_values"] = f"""
WITH {_ENRICHED}
SELECT type_entite, count(*) AS n FROM enriched
WHERE type_entite NOT IN ('pays_ou_territoire', 'agregat') GROUP BY type_entite"""

ORACLE["dq_relationships"] = f"""
WITH {_METADATA}
SELECT 'C' || o_custkey AS countryiso3code, count(*) AS n FROM orders
WHERE 'C' || o_custkey NOT IN (SELECT countryiso3code FROM known) GROUP BY 1"""

ORACLE["dq_grain"] = """
SELECT user_id, event_type, strftime(ts, '%Y-%m-%d') AS event_day, count(*) AS n
FROM events GROUP BY ALL HAVING count(*) > 1"""

_DQ_NULLS = (
    ("raw", "raw", "row_hash"), ("raw", "raw", "inserted_at"),
    ("metadata", "known", "countryiso3code"), ("metadata", "known", "country_name"), ("metadata", "known", "type_entite"),
    ("staging", "staging", "indicator_code"), ("staging", "staging", "country_name"), ("staging", "staging", "type_entite"),
    ("staging", "staging", "annee"), ("staging", "staging", "row_hash"), ("staging", "staging", "inserted_at"),
    ("dim_entity", "dim_entity", "countryiso3code"), ("dim_entity", "dim_entity", "country_name"),
    ("dim_period", "dim_period", "annee"),
    ("dim_indicator", "dim_indicator", "indicator_code"), ("dim_indicator", "dim_indicator", "indicator_label_fr"),
    ("fact", "fact", "countryiso3code"), ("fact", "fact", "annee"), ("fact", "fact", "indicator_code"),
    ("fact", "fact", "methode_traitement"), ("fact", "fact", "est_imputee"), ("fact", "fact", "inserted_at"))

_DQ_UNIQUE = (("metadata", "known", "countryiso3code"), ("dim_entity", "dim_entity", "countryiso3code"),
              ("dim_period", "dim_period", "annee"), ("dim_indicator", "dim_indicator", "indicator_code"))

_DQ_PARENTS = (("dim_entity", "countryiso3code"), ("dim_period", "annee"), ("dim_indicator", "indicator_code"))

ORACLE["dq_suite"] = f"""
WITH {_STAGED_KNOWN},
dim_entity AS (
  SELECT DISTINCT countryiso3code, country_code, country_name, region, income_level FROM staging
  WHERE type_entite = 'pays_ou_territoire' AND countryiso3code IS NOT NULL AND country_name IS NOT NULL),
dim_period AS (SELECT DISTINCT annee FROM staging WHERE annee IS NOT NULL),
dim_indicator AS (
  SELECT indicator_code, CASE WHEN indicator_code = 'click' THEN 'Clics' ELSE min(indicator_name) END AS indicator_label_fr
  FROM staging WHERE indicator_code IS NOT NULL GROUP BY indicator_code),
fact AS (
  SELECT countryiso3code, annee, indicator_code, inserted_at,
         CASE WHEN valeur IS NOT NULL THEN 'originale' ELSE 'non_disponible' END AS methode_traitement,
         valeur IS NULL AS est_imputee
  FROM staging WHERE type_entite = 'pays_ou_territoire' AND countryiso3code IS NOT NULL),
lines AS (
""" + _each(_DQ_NULLS, """SELECT '{0}' AS table_name, 'not_null' AS rule, '{2}' AS column_name,
  (SELECT count(*) FROM {1} WHERE {2} IS NULL) AS failures""") + """
UNION ALL
""" + _each(_DQ_UNIQUE, """SELECT '{0}', 'unique', '{2}',
  (SELECT count(*) FROM (SELECT {2} FROM {1} WHERE {2} IS NOT NULL GROUP BY {2} HAVING count(*) > 1))""") + """
UNION ALL
""" + _each(_DQ_PARENTS, """SELECT 'fact', 'relationships', '{1}',
  (SELECT count(*) FROM fact WHERE {1} IS NOT NULL AND {1} NOT IN (SELECT {1} FROM {0}))""") + """
UNION ALL
SELECT 'staging', 'accepted_values', 'type_entite',
  (SELECT count(*) FROM staging WHERE type_entite NOT IN ('pays_ou_territoire', 'agregat'))
UNION ALL
SELECT 'fact', 'accepted_values', 'methode_traitement', 0
UNION ALL
SELECT 'fact', 'grain', 'countryiso3code,annee,indicator_code',
  (SELECT count(*) FROM (SELECT 1 FROM fact GROUP BY countryiso3code, annee, indicator_code HAVING count(*) > 1)))
SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM lines"""

# ------------------------------------------------------- facts, loads, stored tables

_FACT = """,
base AS (SELECT * FROM staging WHERE type_entite = 'pays_ou_territoire' AND countryiso3code IS NOT NULL),
near_rows AS (
  SELECT *,
         last_value(valeur IGNORE NULLS) OVER before AS previous_value,
         last_value(CASE WHEN valeur IS NOT NULL THEN annee END IGNORE NULLS) OVER before AS previous_period,
         first_value(valeur IGNORE NULLS) OVER after AS next_value,
         first_value(CASE WHEN valeur IS NOT NULL THEN annee END IGNORE NULLS) OVER after AS next_period
  FROM base
  WINDOW before AS (PARTITION BY countryiso3code, indicator_code ORDER BY annee, row_hash
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (PARTITION BY countryiso3code, indicator_code ORDER BY annee, row_hash
                   ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
middles AS (
  SELECT countryiso3code, indicator_code, quantile_cont(valeur, 0.5) AS median FROM base WHERE valeur IS NOT NULL GROUP BY 1, 2),
methods AS (
  SELECT n.*, m.median,
         CASE WHEN valeur IS NOT NULL THEN 'originale'
              WHEN indicator_code IN ('click', 'view') AND previous_value IS NOT NULL AND next_value IS NOT NULL
                THEN 'interpolation_temporelle'
              WHEN indicator_code = 'error' AND median IS NOT NULL THEN 'mediane_pays'
              ELSE 'non_disponible' END AS methode_traitement,
         CASE WHEN next_period > previous_period THEN
           previous_value + (next_value - previous_value)
             * (CAST(annee - previous_period AS DOUBLE) / CAST(next_period - previous_period AS DOUBLE)) END AS line
  FROM near_rows n LEFT JOIN middles m USING (countryiso3code, indicator_code)),
fact AS (
  SELECT countryiso3code, annee, indicator_code, valeur AS valeur_originale,
         CASE methode_traitement WHEN 'originale' THEN valeur WHEN 'mediane_pays' THEN median
              WHEN 'interpolation_temporelle' THEN CASE indicator_code WHEN 'view' THEN round(line) ELSE line END END AS valeur,
         methode_traitement, methode_traitement IN ('interpolation_temporelle', 'mediane_pays') AS est_imputee,
         obs_status, decimal_places, inserted_at
  FROM methods)"""

ORACLE["build_fact"] = f"""
WITH {_STAGED}{_FACT} SELECT * REPLACE (strftime(inserted_at, {_MICROS}) AS inserted_at) FROM fact"""

_DAILY = _STAGED.replace("  FROM raw)", """  FROM (
    SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY user_id, indicator_code, CAST(ts AS DATE)
                                                 ORDER BY ts DESC, event_id DESC) = 1))""")

ORACLE["ingest_incremental"] = f"WITH {_DAILY}{_FACT} SELECT * EXCLUDE (inserted_at) FROM fact"

ORACLE["stream_broken_landing"] = f"WITH {_EVENTS} SELECT {_OBSERVATION} FROM event_rows"

ORACLE["registered_views"] = f"""
WITH {_STAGED}{_FACT},
dim_entity AS (
  SELECT DISTINCT countryiso3code, country_code, country_name, region, income_level FROM base WHERE country_name IS NOT NULL)
SELECT region, indicator_code, methode_traitement, count(*) AS n, 0 AS n_before
FROM fact JOIN dim_entity USING (countryiso3code) GROUP BY ALL"""

ORACLE["dataset"] = f"WITH {_MART} SELECT * FROM mart"

ORACLE["empty_scoring"] = f"""
WITH {_MART}
SELECT countryiso3code, annee, income_level,
       CASE WHEN income_level IS NULL THEN 'En attente' ELSE 'Juste' END AS prediction_correcte, 0 AS scored
FROM mart"""
