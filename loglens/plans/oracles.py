"""SQL over the same tables that must give the result of the query of that name."""

from __future__ import annotations

# --- shared views ---------------------------------------------------------------

_LINES = """lines AS (
  SELECT event_id, user_id, ts, event_type, concat(
    '10.', (user_id >> 16) % 256, '.', (user_id >> 8) % 256, '.', user_id % 256,
    ' - - [', strftime(ts, '%d/%b/%Y:%H:%M:%S'), ' +0000] "',
    CASE event_type WHEN 'view' THEN 'GET' WHEN 'click' THEN 'GET'
      WHEN 'purchase' THEN 'POST' WHEN 'signup' THEN 'PUT' ELSE 'BADVERB' END,
    ' /', event_type, '/', event_id % 58, ' HTTP/1.1" ',
    CASE WHEN event_type = 'error' THEN '500' WHEN event_id % 25 = 0 THEN '404' ELSE '200' END,
    ' ', CAST(round(value * 100) AS BIGINT), ' "-" "agent-', user_id % 7, '"') AS message
  FROM events)"""

# One pattern per field, since a group index above 9 is not available.
_FIELD_PATTERNS = {
    "clientip": r"^(\S+) ",
    "ident": r"^\S+ (\S+) ",
    "auth": r"^\S+ \S+ (\S+) ",
    "timestamp": r"\[([^\]]+)\]",
    "verb": r'\] "(\w+) ',
    "request": r'\] "\w+ (\S+) ',
    "httpversion": r" HTTP/([0-9.]+)",
    "response": r'" (\d+) \d+ "',
    "bytes": r'" \d+ (\d+) "',
    "referrer": r'\d+ ("[^"]*") "',
    "agent": r' ("[^"]*")$',
}
_PARSED = (
    _LINES
    + ", parsed AS (SELECT event_id, user_id, ts, event_type, message, "
    + ", ".join(
        f"regexp_extract(message, '{pattern}', 1) AS \"{name}\""
        for name, pattern in _FIELD_PATTERNS.items()
    )
    + " FROM lines)"
)

_RECORDS = (
    _PARSED
    + """, records AS (
  SELECT p.* REPLACE (CASE WHEN event_id % 97 = 0 THEN '-' ELSE response END AS response),
    n_name AS country_name,
    CASE WHEN n_nationkey % 10 <> 3 THEN n_name END AS city_name,
    CAST(n_nationkey * 3 - 36 AS DOUBLE) AS latitude,
    CAST(n_nationkey * 14 - 170 AS DOUBLE) AS longitude
  FROM parsed p LEFT JOIN (customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey) ON user_id = c_custkey)"""
)

_FEATURES = (
    _RECORDS
    + """, feature_rows AS (
  SELECT event_id, city_name, latitude, longitude, verb,
    TRY_CAST(response AS DOUBLE) AS response, request
  FROM records
  WHERE city_name IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
    AND verb IS NOT NULL AND TRY_CAST(response AS DOUBLE) IS NOT NULL AND request IS NOT NULL)"""
)


def _index(column, out):
    return f""", {out}_table AS (
  SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE)
    AS "{out}" FROM feature_rows GROUP BY {column})"""


_INDEXED = (
    _FEATURES
    + _index("request", "requestIndex")
    + _index("verb", "verbIndex")
    + _index("city_name", "geoIpCityNameIndex")
    + """, indexed AS (
  SELECT * FROM feature_rows JOIN requestIndex_table USING (request)
    JOIN verbIndex_table USING (verb) JOIN geoIpCityNameIndex_table USING (city_name))"""
)

_IS_TRAIN = "(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT) % 100 < 40"

_CLUSTERED = (
    _INDEXED
    + f""", centres(c, x, y) AS (VALUES (0, 200.0, 20.0), (1, 200.0, 100.0), (2, 200.0, 200.0),
  (3, 404.0, 100.0), (4, 500.0, 100.0)),
clustered AS (
  SELECT i.*, (SELECT c FROM centres
      ORDER BY (response - x) * (response - x) + (requestIndex - y) * (requestIndex - y), c
      LIMIT 1) AS clusters,
    {_IS_TRAIN} AS is_train
  FROM indexed i)"""
)

_MAJORITY = """, majority AS (
  SELECT clusters AS c FROM clustered WHERE is_train
  GROUP BY clusters ORDER BY count(*) DESC, clusters LIMIT 1)"""

_PRECISION = (
    _CLUSTERED
    + _MAJORITY
    + """, precision_row AS (
  SELECT round(CAST(sum(CASE WHEN clusters = c THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6)
    AS "precision" FROM clustered, majority WHERE NOT is_train),
scored AS (SELECT * FROM clustered, precision_row)"""
)

_VERB_CLUSTERS = (
    _INDEXED
    + """, verb_clusters AS (
  SELECT *, CAST(dense_rank() OVER (ORDER BY verbIndex) - 1 AS INTEGER) AS clusters FROM indexed)"""
)

_RANGES = """blocks AS (
  SELECT w, min(c_custkey) AS lo, max(c_custkey) AS hi, arg_min(c_nationkey, c_custkey) AS n
  FROM customer, (VALUES (60), (600)) widths(w) GROUP BY w, c_custkey // w),
ranges AS (
  SELECT w, lo, CASE w WHEN 60 THEN lo + (hi - lo) * 3 // 4 ELSE lo + (hi - lo) // 2 END AS hi, n
  FROM blocks)"""

# Raw lines with the place of the innermost range; lines of another form have no field.
_RAW = (
    _PARSED
    + ", "
    + _RANGES
    + """, raw AS (
  SELECT event_id, event_id % 89 <> 0 AS parsed,
    CASE WHEN event_id % 89 <> 0 THEN verb END AS verb,
    CASE WHEN event_id % 89 <> 0 THEN coalesce(i.n, o.n) END AS nation
  FROM parsed
  LEFT JOIN ranges i ON i.w = 60 AND user_id BETWEEN i.lo AND i.hi
  LEFT JOIN ranges o ON o.w = 600 AND user_id BETWEEN o.lo AND o.hi),
raw_kept AS (SELECT * FROM raw WHERE parsed AND nation % 10 <> 3),
raw_clusters AS (
  SELECT verb, count(*) AS support,
    CAST(row_number() OVER (ORDER BY count(*) DESC, verb) - 1 AS INTEGER) AS clusters
  FROM raw_kept GROUP BY verb)"""
)

_PAIRS = """pairs AS (SELECT doc_id, CAST(quality AS DOUBLE) AS prediction,
  CAST(toxic AS DOUBLE) AS label FROM labels)"""

_BY_CLASS = (
    _PAIRS
    + """, by_class AS (
  SELECT k AS class, count(*) FILTER (label = k) AS support,
    count(*) FILTER (prediction = k) AS predicted,
    count(*) FILTER (label = k AND prediction = k) AS hits
  FROM pairs, (SELECT label AS k FROM pairs UNION SELECT prediction FROM pairs)
  GROUP BY k),
rates AS (
  SELECT *, coalesce(hits / nullif(predicted, 0), 0.0) AS "precision",
    coalesce(hits / nullif(support, 0), 0.0) AS recall,
    2 * hits / (support + predicted) AS f_measure FROM by_class)"""
)

_ROC = """scores AS (SELECT value AS score, event_type = 'error' AS positive FROM events),
totals AS (SELECT CAST(count(*) FILTER (positive) AS DOUBLE) AS p,
  CAST(count(*) FILTER (NOT positive) AS DOUBLE) AS n FROM scores),
grouped AS (SELECT score, count(*) FILTER (positive) AS pos, count(*) FILTER (NOT positive) AS neg
  FROM scores GROUP BY score),
curve AS (SELECT score, pos, neg, row_number() OVER w AS point,
  sum(pos) OVER w AS tp, sum(neg) OVER w AS fp
  FROM grouped WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""

_NESTED_KEYS = """
  SELECT event_id, element, 'b' AS key, CAST(event_id AS VARCHAR) AS value FROM nested
  UNION ALL SELECT event_id, element, 'd1', CAST(user_id AS VARCHAR) FROM nested
  UNION ALL SELECT event_id, element, 'd11', CAST(event_id % 7 AS VARCHAR) FROM nested
  UNION ALL SELECT event_id, element, 'd12', '3' FROM nested
  UNION ALL SELECT event_id, element, 'd3e', event_type FROM nested
  UNION ALL SELECT event_id, element, 'd3h', 'true' FROM nested
  UNION ALL SELECT event_id, element, 'f', 'w' FROM nested"""
_FLAT = f"""nested AS (
  SELECT event_id, user_id, event_type,
    CAST(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS INTEGER) AS element
  FROM events WHERE event_type NOT IN ('error', 'view')),
flat AS ({_NESTED_KEYS}
  UNION ALL SELECT event_id, 0, 'k', json_extract_string(props, '$.k') FROM events
    WHERE event_type IN ('signup', 'view'))"""
_KEYS = ("b", "d1", "d11", "d12", "d3e", "d3h", "f", "k")
_WIDE = (
    _FLAT
    + ", wide AS (SELECT event_id, element, "
    + ", ".join(f"coalesce(max(value) FILTER (key = '{k}'), '') AS {k}" for k in _KEYS)
    + " FROM flat GROUP BY event_id, element)"
)


def _windows(length, slide):
    return f"""WITH starts AS (
  SELECT event_type, (CAST(floor(epoch(ts) / {slide}) AS BIGINT) - i) * {slide} AS s
  FROM events, range({length // slide}) r(i))
SELECT strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(make_timestamp((s + {length}) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end,
  event_type, count(*) AS n
FROM starts GROUP BY s, event_type"""


def _indexed_query(column, out):
    return f"""WITH {_FEATURES}{_index(column, out)}
SELECT event_id, {column}, "{out}" FROM feature_rows JOIN {out}_table USING ({column})"""


_NORM = "sqrt(response*response + requestIndex*requestIndex + verbIndex*verbIndex + geoIpCityNameIndex*geoIpCityNameIndex)"
_FOUR = ("response", "requestIndex", "verbIndex", "geoIpCityNameIndex")


def _rule(antecedents):
    parts = " || ' AND ' || ".join(f"'{a}=' || {a}" for a in antecedents)
    return f"""'IF ' || {parts} || ' THEN clusters=' || clusters || ' -- precision=' || "precision" """


_MOMENTS = """, moments AS (
  SELECT avg(verbIndex * verbIndex) AS xx, avg(verbIndex * clusters) AS xy
  FROM clustered WHERE is_train)"""

_NB = (
    _CLUSTERED
    + ", nb AS (SELECT clusters AS c, count(*) AS n, "
    + ", ".join(f"sum({f}) AS s{i}" for i, f in enumerate(_FOUR))
    + """ FROM clustered WHERE is_train GROUP BY clusters),
nb_log AS (SELECT c, ln((n + 1.0) / (sum(n) OVER () + count(*) OVER ())) AS log_prior, """
    + ", ".join(f"ln((s{i} + 1.0) / (s0 + s1 + s2 + s3 + 4.0)) AS l{i}" for i in range(4))
    + " FROM nb)"
)



def _least_squares():
    """Regression on the four normalised features with an intercept.

    Each feature is replaced by what the features before it do not explain; the
    coefficients on these uncorrelated columns are plain ratios.
    """
    columns = ["y", "x0", "x1", "x2", "x3"]
    sql = _CLUSTERED + ", r0 AS (SELECT event_id, is_train, CAST(clusters AS DOUBLE) AS label, "
    sql += "CAST(clusters AS DOUBLE) AS y, "
    sql += ", ".join(f"{f} / {_NORM} AS x{i}" for i, f in enumerate(_FOUR)) + " FROM clustered)"
    sql += ", m AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in columns)
    sql += " FROM r0 WHERE is_train), z0 AS (SELECT event_id, is_train, label, m_y, "
    sql += ", ".join(f"{c} - m_{c} AS {c}" for c in columns) + " FROM r0, m)"
    for i in range(4):
        rest = ["y"] + [f"x{j}" for j in range(i + 1, 4)]
        sql += f", k{i} AS (SELECT " + ", ".join(
            f"sum({c} * x{i}) / sum(x{i} * x{i}) AS k_{c}" for c in rest
        )
        sql += f" FROM z{i} WHERE is_train), z{i + 1} AS (SELECT event_id, is_train, label, m_y, "
        kept = [f"{c} - k_{c} * x{i} AS {c}" for c in rest]
        sql += ", ".join(kept) + f" FROM z{i}, k{i})"
    return sql


_LABEL_MEANS = """parts AS (
  SELECT vec_id, label, unnest(embedding) AS x, unnest(range(len(embedding))) AS dim
  FROM embeddings),
centre0 AS (SELECT label AS c, CAST(dim AS INTEGER) AS dim, avg(CAST(x AS DOUBLE)) AS mean
  FROM parts GROUP BY label, dim)"""


def _lloyd_step(i):
    return f""", near{i} AS (
  SELECT vec_id, CAST(arg_min(c, (d, c)) AS INTEGER) AS clusters FROM (
    SELECT vec_id, c, sum((x - mean) * (x - mean)) AS d
    FROM parts JOIN centre{i} USING (dim) GROUP BY vec_id, c) GROUP BY vec_id),
centre{i + 1} AS (
  SELECT clusters AS c, dim, avg(CAST(x AS DOUBLE)) AS mean
  FROM parts JOIN near{i} USING (vec_id) GROUP BY clusters, dim
  UNION ALL SELECT c, dim, mean FROM centre{i} WHERE c NOT IN (SELECT clusters FROM near{i}))"""


ORACLE_SQL = {
    "parse_combined_log": f"""WITH {_PARSED}
SELECT event_id, clientip, ident, auth, "timestamp", verb, request, httpversion,
  CAST(NULL AS VARCHAR) AS rawrequest, response, bytes, referrer, agent, true AS parsed,
  CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS event_seconds FROM parsed""",
    "log_file_lines": f"""WITH {_PARSED}
SELECT 'apache-access' AS "type", verb, response, count(*) AS n,
  CAST(sum(CAST(bytes AS BIGINT)) AS BIGINT) AS bytes FROM parsed GROUP BY verb, response""",
    "json_file_records": f"""WITH {_RECORDS}
SELECT verb, city_name, count(*) AS n, CAST(sum(CAST(bytes AS BIGINT)) AS BIGINT) AS bytes
FROM records GROUP BY verb, city_name""",
    "json_strings_to_table": f"""WITH {_PARSED}
SELECT event_id, CASE WHEN event_type <> 'error' THEN verb END AS verb,
  CASE WHEN event_type <> 'error' THEN request END AS request,
  CASE WHEN event_type = 'error' THEN 'malformed JSON' END AS reason FROM parsed""",
    "message_log_records": f"""WITH {_PARSED}
SELECT event_id, verb, request, response, count(*) AS times, count(*) AS places
FROM parsed GROUP BY event_id, verb, request, response""",
    "message_log_offsets": """WITH dealt AS (
  SELECT CAST(CAST(concat('0x', substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 8
    AS INTEGER) AS "partition" FROM events)
SELECT 'logstash_logs' AS topic, "partition", count(*) AS n, count(*) AS places,
  CAST(0 AS BIGINT) AS first_offset, count(*) - 1 AS last_offset
FROM dealt GROUP BY 2""",
    "kafka_payload": f"""WITH {_PARSED}
SELECT CAST(event_id AS VARCHAR) AS key, concat('{{"event_id":', event_id, ',"clientip":"',
  clientip, '","verb":"', verb, '","response":"', response, '"}}') AS value FROM parsed""",
    "cluster_csv_files": f"""WITH {_PRECISION}
SELECT strftime(ts, '%Y-%m-%d') || '--00-00' AS minute, verb, clusters, "precision",
  count(*) AS n FROM scored JOIN (SELECT event_id, ts FROM events) USING (event_id)
GROUP BY ALL""",
    "rule_text_files": f"""WITH {_PRECISION}
SELECT DISTINCT {_rule(("verb", "response"))} AS rule FROM scored""",
    "log_feature_rows": f"WITH {_FEATURES} SELECT * FROM feature_rows",
    "accumulate_union": f"""WITH {_PARSED}
SELECT event_id, verb, response FROM parsed WHERE verb = 'GET'
UNION ALL BY NAME SELECT request, event_id, verb FROM parsed WHERE verb <> 'GET'""",
    "row_counts": f"""WITH {_FEATURES}
SELECT (SELECT count(*) FROM records) AS n_logs, (SELECT count(*) FROM feature_rows) AS n_kept""",
    "category_frequency": f"""WITH {_FEATURES}
SELECT 'request' AS "column", request AS value, count(*) AS n FROM feature_rows GROUP BY request
UNION ALL SELECT 'verb', verb, count(*) FROM feature_rows GROUP BY verb
UNION ALL SELECT 'city_name', city_name, count(*) FROM feature_rows GROUP BY city_name""",
    "csv_line_cells": """SELECT c_custkey, replace(c_name || ',' || c_mktsegment, ',', '') AS name,
  CAST(c_nationkey AS VARCHAR) AS nation, CAST(2 AS INTEGER) AS n_cells FROM customer""",
    "string_index_verb": _indexed_query("verb", "verbIndex"),
    "string_index_request": _indexed_query("request", "requestIndex"),
    "string_index_city": _indexed_query("city_name", "geoIpCityNameIndex"),
    "feature_table_four": f"WITH {_INDEXED} SELECT event_id, "
    + ", ".join(f"{f} AS f{i}, round({f} / {_NORM}, 6) AS u{i}" for i, f in enumerate(_FOUR))
    + " FROM indexed",
    "feature_table_verb": f"""WITH {_INDEXED}
SELECT event_id, verb, verbIndex AS f0, CASE WHEN verbIndex = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS u0
FROM indexed""",
    "feature_table_lat_long": f"""WITH {_FEATURES}
SELECT event_id, latitude AS p0, longitude AS p1 FROM feature_rows""",
    "feature_model_verb": f"""WITH {_INDEXED}
SELECT event_id, verb, verbIndex AS "verbIndex", verbIndex AS f0 FROM indexed""",
    "standard_scale": f"WITH {_INDEXED} SELECT event_id, "
    + ", ".join(
        f"round(({f} - avg({f}) OVER ()) / stddev_samp({f}) OVER (), 6) AS s{i}"
        for i, f in enumerate(_FOUR)
    )
    + " FROM indexed",
    "one_hot_verb": f"WITH {_INDEXED} SELECT event_id, verb, "
    + ", ".join(
        f"CAST(CASE WHEN verbIndex = {i} THEN 1 ELSE 0 END AS DOUBLE) AS v{i}" for i in range(3)
    )
    + " FROM indexed",
    "vector_index": f"""WITH {_INDEXED}
SELECT event_id, CAST(dense_rank() OVER (ORDER BY response) - 1 AS DOUBLE) AS x0,
  verbIndex AS x1 FROM indexed""",
    "request_vectors": f"""WITH {_FEATURES}
SELECT event_id, CAST(16 AS INTEGER) AS dimensions FROM feature_rows""",
    "request_cooccurrences": f"""WITH {_FEATURES}, words AS (
  SELECT list_filter(string_split(request, '/'), lambda w: w <> '') AS w, count(*) AS weight
  FROM feature_rows GROUP BY request),
places AS (SELECT w, weight, unnest(range(1, len(w) + 1)) AS i FROM words),
pairs AS (SELECT w[i] AS a, unnest(w[i + 1 : i + 5]) AS b, weight FROM places)
SELECT word, other, CAST(sum(weight) AS BIGINT) AS n FROM (
  SELECT a AS word, b AS other, weight FROM pairs
  UNION ALL SELECT b, a, weight FROM pairs) GROUP BY word, other""",
    "split_assignment": f"SELECT event_id, {_IS_TRAIN} AS is_train FROM events",
    "centroids_by_label": f"""WITH {_LABEL_MEANS}
SELECT c AS label, dim, round(mean, 6) AS mean FROM centre0""",
    "assign_nearest": f"WITH {_LABEL_MEANS}{_lloyd_step(0)} SELECT vec_id, clusters FROM near0",
    "lloyd_two_steps": f"""WITH {_LABEL_MEANS}{_lloyd_step(0)}{_lloyd_step(1)}{_lloyd_step(2)}
SELECT vec_id, clusters FROM near2""",
    "kmeans_verb": f"WITH {_VERB_CLUSTERS} SELECT event_id, verb, clusters FROM verb_clusters",
    "kmeans_centers": f"""WITH {_VERB_CLUSTERS}
SELECT DISTINCT clusters, verbIndex AS center FROM verb_clusters""",
    "linreg_simple": f"""WITH {_CLUSTERED}{_MOMENTS}
SELECT event_id, CAST(clusters AS DOUBLE) AS label, round(verbIndex * xy / xx, 6) AS prediction
FROM clustered, moments WHERE NOT is_train""",
    "linreg_with_intercept": f"""WITH {_CLUSTERED}, line AS (
  SELECT regr_slope(clusters, requestIndex) AS a, regr_intercept(clusters, requestIndex) AS b
  FROM clustered WHERE is_train)
SELECT event_id, CAST(clusters AS DOUBLE) AS label, round(a * requestIndex + b, 6) AS prediction
FROM clustered, line WHERE NOT is_train""",
    # What is left of y is the residual: prediction = label - residual.
    "linreg_complex": f"""WITH {_least_squares()}
SELECT event_id, label, round(label - y, 6) AS prediction FROM z4 WHERE NOT is_train""",
    # Two steps of 1e-15 and 1e-15/sqrt(2); the change of the gradient between
    # them is far below the rounding.
    "linreg_sgd": f"""WITH {_CLUSTERED}{_MOMENTS}
SELECT event_id, CAST(clusters AS DOUBLE) AS label,
  round(verbIndex * xy * (1 + 1 / sqrt(2)), 6) AS prediction
FROM clustered, moments WHERE NOT is_train""",
    "linreg_gd": f"""WITH RECURSIVE {_CLUSTERED}{_MOMENTS}, descent(t, w) AS (
  SELECT 0, 0.0::DOUBLE UNION ALL
  SELECT t + 1, w - 0.1 / sqrt(t + 1) * (w * xx - xy) FROM descent, moments WHERE t < 10)
SELECT event_id, CAST(clusters AS DOUBLE) AS label, round(verbIndex * w, 6) AS prediction
FROM clustered, descent WHERE NOT is_train AND t = 10""",
    "naive_bayes_simple": f"""WITH {_CLUSTERED}{_MAJORITY}
SELECT event_id, CAST(clusters AS DOUBLE) AS label, CAST(c AS DOUBLE) AS prediction
FROM clustered, majority WHERE NOT is_train""",
    "naive_bayes_complex": f"""WITH {_NB}
SELECT event_id, CAST(any_value(clusters) AS DOUBLE) AS label,
  CAST(arg_max(c, log_prior + response * l0 + requestIndex * l1 + verbIndex * l2
    + geoIpCityNameIndex * l3) AS DOUBLE) AS prediction
FROM clustered, nb_log WHERE NOT is_train GROUP BY event_id""",
    "naive_bayes_model": f"WITH {_NB} "
    + " UNION ALL ".join(
        f"""SELECT CAST(c AS DOUBLE) AS label, round(log_prior, 6) AS log_prior,
 '{f}' AS feature, round(l{i}, 6) AS log_likelihood FROM nb_log"""
        for i, f in enumerate(_FOUR)
    ),
    "decision_tree_simple": f"""WITH {_CLUSTERED}, leaf AS (
  SELECT verbIndex, arg_max(clusters, (n, -clusters)) AS c FROM (
    SELECT verbIndex, clusters, count(*) AS n FROM clustered WHERE is_train
    GROUP BY verbIndex, clusters) GROUP BY verbIndex)
SELECT event_id, CAST(clusters AS DOUBLE) AS label, CAST(c AS DOUBLE) AS prediction
FROM clustered JOIN leaf USING (verbIndex) WHERE NOT is_train""",
    "metrics_all": f"""WITH {_PAIRS}, sums AS (
  SELECT count(*) AS n, count(*) FILTER (prediction = label) AS n_correct,
    avg((prediction - label) * (prediction - label)) AS mse FROM pairs)
SELECT n, n_correct, n - n_correct AS n_wrong, round(mse, 9) AS mse,
  round(n_correct / n, 9) AS accuracy, round((n - n_correct) / n, 9) AS test_error,
  round(n_correct / n, 9) AS "precision", round(n_correct / n, 9) AS recall,
  round(n_correct / n, 9) AS f_measure FROM sums""",
    "metrics_by_class": f"""WITH {_BY_CLASS}
SELECT class, support, predicted, hits, round("precision", 9) AS "precision",
  round(recall, 9) AS recall, round(f_measure, 9) AS f_measure FROM rates""",
    "metrics_weighted": f"""WITH {_BY_CLASS}
SELECT round(sum(hits) / sum(support), 9) AS accuracy,
  round(sum("precision" * support) / sum(support), 9) AS weighted_precision,
  round(sum(recall * support) / sum(support), 9) AS weighted_recall,
  round(sum(f_measure * support) / sum(support), 9) AS weighted_f_measure FROM rates""",
    "classifier_evaluator": f"""WITH {_BY_CLASS}
SELECT round(sum(hits) / sum(support), 9) AS accuracy,
  round(sum("precision" * support) / sum(support), 9) AS "precision",
  round(sum(recall * support) / sum(support), 9) AS recall FROM rates""",
    "correct_predictions": f"WITH {_PAIRS} SELECT * FROM pairs WHERE prediction = label",
    "wrong_predictions": f"WITH {_PAIRS} SELECT * FROM pairs WHERE prediction <> label",
    "roc_curve": f"""WITH {_ROC}
SELECT point, score, round(fp / n, 9) AS fpr, round(tp / p, 9) AS tpr FROM curve, totals
UNION ALL SELECT 0, NULL, 0.0, 0.0
UNION ALL SELECT count(*) + 1, NULL, 1.0, 1.0 FROM grouped""",
    "auc": f"""WITH {_ROC}
SELECT round(sum(neg * (tp + tp - pos) / 2.0) / any_value(p * n), 9) AS auc FROM curve, totals""",
    "rules_text": f"""WITH {_PRECISION}
SELECT {_rule(("verb", "response", "requestIndex"))} AS rule, count(*) AS support
FROM scored GROUP BY ALL""",
    "rules_per_row": f"""WITH {_PRECISION}
SELECT event_id, {_rule(("verb",))} AS rule FROM scored""",
    "rules_filtered": f"""WITH {_CLUSTERED}, counted AS (
  SELECT verb, response, clusters, count(*) AS n,
    sum(count(*)) OVER (PARTITION BY verb, response) AS total
  FROM clustered GROUP BY verb, response, clusters),
confident AS (SELECT *, round(n / total, 6) AS "precision" FROM counted)
SELECT {_rule(("verb", "response"))} AS rule, n AS support FROM confident
WHERE "precision" >= 0.5""",
    "rules_in_order": f"""WITH {_CLUSTERED}, counted AS (
  SELECT verb, response, clusters, count(*) AS n,
    sum(count(*)) OVER (PARTITION BY verb, response) AS total
  FROM clustered GROUP BY verb, response, clusters),
confident AS (SELECT *, round(n / total, 6) AS "precision" FROM counted)
SELECT row_number() OVER (ORDER BY "precision", verb, response, clusters) AS rank,
  {_rule(("verb", "response"))} AS rule, "precision" FROM confident""",
    "minute_rule_support": f"""WITH {_PRECISION}
SELECT strftime(ts, '%Y-%m-%d--%H-%M') AS minute, {_rule(("verb",))} AS rule,
  count(*) AS support
FROM scored JOIN (SELECT event_id, ts FROM events) USING (event_id) GROUP BY ALL""",
    # Clusters that follow the order of one index can be separated completely by
    # linear scores and by a tree, so the precision is 1.
    "log_rules": f"""WITH {_VERB_CLUSTERS}
SELECT verb, clusters, CAST(1 AS DOUBLE) AS "precision", count(*) AS support,
  'IF verb=' || verb || ' THEN clusters=' || clusters || ' -- precision=1.0' AS rule
FROM verb_clusters GROUP BY verb, clusters""",
    "stream_minute_rules": f"""WITH {_VERB_CLUSTERS}
SELECT DISTINCT 'IF verb=' || verb || ' THEN clusters=' || clusters || ' -- precision=1.0' AS rule
FROM verb_clusters""",
    "log_rules_tree": f"""WITH {_VERB_CLUSTERS}
SELECT 'IF verb=' || verb || ' THEN clusters=' || clusters || ' -- precision=1.0' AS rule,
  count(*) AS support FROM verb_clusters GROUP BY verb, clusters""",
    "json_flat_long": f"WITH {_FLAT} SELECT event_id, element, key, value FROM flat",
    "json_collisions": f"""WITH {_FLAT}
SELECT event_id, element, CAST(max(CASE WHEN key = 'f' THEN 1 ELSE 0 END) AS INTEGER)
  AS collisions FROM flat GROUP BY event_id, element""",
    "json_quarantine": """SELECT event_id, concat('{bad ', props) AS document,
  'malformed JSON' AS reason FROM events WHERE event_type = 'error'""",
    "json_flat_wide": f"WITH {_WIDE} SELECT * FROM wide",
    "json_csv_lines": f"""WITH {_WIDE}
SELECT 0 AS line_no, '{",".join(_KEYS)}' AS line UNION ALL
SELECT row_number() OVER (ORDER BY event_id, element), concat_ws(',', {", ".join(_KEYS)})
FROM wide""",
    "json_csv_files": f"WITH {_WIDE} SELECT {', '.join(_KEYS)} FROM wide",
    "geoip_enrich": f"""WITH {_PARSED}, {_RANGES}
SELECT event_id, clientip, n_name AS geo_city FROM parsed
LEFT JOIN ranges i ON i.w = 60 AND user_id BETWEEN i.lo AND i.hi
LEFT JOIN ranges o ON o.w = 600 AND user_id BETWEEN o.lo AND o.hi
LEFT JOIN nation ON n_nationkey = coalesce(i.n, o.n)""",
    "raw_line_rules": f"""WITH {_RAW}
SELECT verb, clusters, CAST(1 AS DOUBLE) AS "precision", support,
  'IF verb=' || verb || ' THEN clusters=' || clusters || ' -- precision=1.0' AS rule
FROM raw_clusters""",
    "raw_line_counts": f"""WITH {_RAW}
SELECT parsed, verb, n_name AS country_name,
  CASE WHEN n_nationkey % 10 <> 3 THEN n_name END AS city_name, count(*) AS n,
  sum(CAST(n_nationkey * 14 - 170 AS DOUBLE)) AS longitudes
FROM raw LEFT JOIN nation ON n_nationkey = nation GROUP BY ALL""",
    "stream_raw_line_rules": f"""WITH {_RAW}
SELECT 'IF verb=' || verb || ' THEN clusters=' || clusters || ' -- precision=1.0' AS rule
FROM raw_clusters""",
    "stream_rule_scores": f"""WITH {_RAW}
SELECT model, count(*) AS n, count(*) AS n_correct, CAST(0 AS DOUBLE) AS mse,
  CAST(1 AS DOUBLE) AS auc
FROM raw_kept, (VALUES ('logistic'), ('tree')) m(model) WHERE NOT {_IS_TRAIN} GROUP BY model""",
    "geocode_lookup": f"""WITH {_RECORDS}
SELECT event_id, city_name AS address,
  CAST(CASE WHEN n.n_name IS NULL THEN 0 ELSE n.n_nationkey + 0.5 END AS DOUBLE) AS lat,
  CAST(CASE WHEN n.n_name IS NULL THEN 0 ELSE n.n_nationkey * 2 END AS DOUBLE) AS lng,
  n.n_name IS NOT NULL AS geocoded
FROM records r LEFT JOIN nation n ON city_name = CASE WHEN n_regionkey = 2 THEN lower(n.n_name) ELSE n.n_name END""",
    "geocode_sql_functions": f"""WITH {_RECORDS}
SELECT event_id,
  CAST(CASE WHEN n.n_name IS NULL THEN 0 ELSE n.n_nationkey + 0.5 END AS DOUBLE) AS lat,
  CAST(CASE WHEN n.n_name IS NULL THEN 0 ELSE n.n_nationkey * 2 END AS DOUBLE) AS lng
FROM records r LEFT JOIN nation n ON city_name = CASE WHEN n_regionkey = 2 THEN lower(n.n_name) ELSE n.n_name END""",
    "window_counts": _windows(10, 2),
    "minute_counts": _windows(60, 60),
    "stream_window_counts": _windows(10, 2),
    "stream_late_rows": """WITH bounds AS (
  SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events),
parts AS (
  SELECT ts, event_type, epoch_us(ts) AS us, least(3, (epoch_us(ts) - low) * 4 // (high - low + 1)
    + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END) AS part
  FROM events, bounds),
marks AS (
  SELECT part, max(max(us)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - 600000000 AS mark
  FROM parts GROUP BY part)
SELECT strftime(ts, '%Y-%m-%d %H:%M') AS minute, event_type,
  CASE WHEN (us // 60000000 + 1) * 60000000 <= mark THEN 'behind the watermark' ELSE 'counted' END
    AS kind, count(*) AS n
FROM parts JOIN marks USING (part) GROUP BY ALL""",
    "stream_ingest": f"""WITH {_PARSED}
SELECT CASE WHEN event_type <> 'error' THEN verb END AS verb,
  CASE WHEN event_type = 'error' THEN 'malformed JSON' END AS reason, count(*) AS n
FROM parsed GROUP BY ALL""",
    "stream_ingest_twice": f"""WITH {_PARSED}
SELECT CASE WHEN event_type <> 'error' THEN verb END AS verb,
  CASE WHEN event_type = 'error' THEN 'malformed JSON' END AS reason, 2 * count(*) AS n
FROM parsed GROUP BY ALL""",
}
