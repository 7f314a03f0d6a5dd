"""DuckDB SQL that recomputes each registered query from the raw tables.

The driver runs these against views named after the parquet tables and
compares them with the Spark results (names, row counts, values).
"""

from __future__ import annotations

_VOCAB = "['benign','attack_1','attack_2','attack_3','attack_4','attack_5'," \
         "'attack_6','attack_7','attack_8','attack_9']"

_ENV = """(SELECT event_type AS topic, ts AS kafka_ts, CAST(user_id % 4 AS INTEGER) AS "partition",
          event_id AS "offset", props AS json_str, value AS f1,
          CAST(event_type = 'error' AS INTEGER) AS label, event_type AS attack_name,
          CAST(json_extract_string(props, '$.k') AS DOUBLE) AS f2
   FROM events)"""

_SCORED_EVENTS = f"""(SELECT *, is_attack_pred AND NOT is_attack_true AS fp_b,
          NOT is_attack_pred AND is_attack_true AS fn_b,
          is_attack_pred AND is_attack_true AS tp_b,
          NOT is_attack_pred AND NOT is_attack_true AS tn_b
   FROM (SELECT *, label = 1 AS is_attack_true,
                (CASE WHEN f1 > 150 OR f2 > 90 THEN 1 ELSE 0 END) = 1 AS is_attack_pred
         FROM {_ENV}))"""

def _fold(e: str) -> str:
    """Ten scores from all entries of a list: score j sums the entries i with i mod 10 = j."""
    parts = ", ".join(f"list_sum([CAST({e}[i + 1] AS DOUBLE) for i in range({j}, len({e}), 10)])"
                      for j in range(10))
    return f"[{parts}]"


_SOFT = f"""(SELECT vec_id, class_label, label, attack_name, prob,
          {_VOCAB}[list_position(prob, list_max(prob))] AS predicted_attack,
          list_max(prob) AS confidence, prob[1] AS p_benign, 1 - prob[1] AS anomaly_score
   FROM (SELECT vec_id, class_label, label, attack_name,
                [x / list_sum(ex) for x in ex] AS prob
         FROM (SELECT vec_id, label AS class_label,
                      CASE WHEN vec_id % 11 = 0 THEN NULL ELSE CAST(label <> 0 AS INTEGER) END AS label,
                      CASE WHEN vec_id % 7 = 0 THEN NULL ELSE 'attack_' || CAST(label AS VARCHAR) END AS attack_name,
                      [exp(20.0 * x) for x in {_fold('embedding')}] AS ex
               FROM embeddings)))"""

_ALERTS = f"""(SELECT *, anomaly_score >= 0.7 AS suspect,
          CASE WHEN anomaly_score >= 0.7 AND confidence >= 0.7 THEN 'ALERT_HIGH'
               WHEN anomaly_score >= 0.7 AND confidence < 0.7 THEN 'ALERT_LOW'
               ELSE 'BENIGN' END AS rule_alert
   FROM {_SOFT})"""

_KEY_U = "((((l_orderkey * 8 + l_linenumber) % 2147483648) * 1103515245 + 12345) % 2147483648) / 2147483648.0"


def _planted(c: str, shift: int) -> str:
    b = f"((l_orderkey + {shift}) % 97)"
    return (f"TRY_CAST(CASE WHEN {b} = 1 THEN 'x' WHEN {b} = 2 THEN 'NaN' "
            f"WHEN {b} = 3 THEN 'Infinity' WHEN {b} = 4 THEN '-Infinity' "
            f"WHEN {b} = 5 THEN NULL WHEN {b} = 6 THEN '\"2.5\"' WHEN {b} = 7 THEN '1e39' "
            f"ELSE CAST({c} AS VARCHAR) END AS DOUBLE)")


def _f32ok(c: str) -> str:
    return f"COALESCE(NOT isnan({c}) AND abs({c}) <= 3.4028234663852886e38, false)"


_PLANTED = f"""(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
          {_planted('l_quantity', 0)} AS q, {_planted('l_extendedprice', 50)} AS e
   FROM lineitem)"""

_MC = """(SELECT round(sum(tp_c) / sum(n_c), 9) AS accuracy,
        round(sum(CASE WHEN n_c > 0 THEN n_c * 2.0 * tp_c / (n_c + m_c) ELSE 0 END) / sum(n_c), 9)
          AS weighted_f1,
        CAST(sum(n_c) AS BIGINT) AS n
   FROM (SELECT c, sum(n_c) AS n_c, sum(m_c) AS m_c, sum(tp_c) AS tp_c
         FROM (SELECT t AS c, 1 AS n_c, 0 AS m_c, CAST(t = p AS INTEGER) AS tp_c FROM pairs
               UNION ALL SELECT p AS c, 0, 1, 0 FROM pairs)
         GROUP BY c))"""

SQL: dict[str, str] = {
    "rule_alert_simple": """
SELECT event_id AS "offset", event_type AS topic, value AS f1, 1 AS rule_alert
FROM events WHERE value > 113""",

    "rule_alert_compound": f"""
SELECT "offset", f1, f2, CASE WHEN f1 > 150 OR f2 > 90 THEN 1 ELSE 0 END AS rule_alert
FROM {_ENV}""",

    "alert_counts": f"""
SELECT count(*) AS total, count(*) FILTER (WHERE f1 > 150 OR f2 > 90) AS alerted
FROM {_ENV}""",

    "json_decode_flatten": """
SELECT event_id AS "offset",
       COALESCE(TRY_CAST(json_extract(props, '$.k') AS DOUBLE), 0.0) AS k,
       TRY_CAST(json_extract(props, '$.label') AS INTEGER) AS label,
       json_extract_string(props, '$.attack_name') AS attack_name,
       TRY_CAST(json_extract(props, '$.ts') AS DOUBLE) AS ts
FROM events""",

    "event_envelope": f"""
SELECT topic, strftime(kafka_ts, '%Y-%m-%d %H:%M:%S.%f') AS kafka_ts, "partition", "offset",
       json_str, topic || ':' || CAST("partition" AS VARCHAR) || ':' || CAST("offset" AS VARCHAR)
         AS event_id, 'vigil_v1' AS model_version
FROM {_ENV}""",

    "event_json_encode": f"""
SELECT topic || ':' || CAST("partition" AS VARCHAR) || ':' || CAST("offset" AS VARCHAR) AS key,
       topic, "partition", "offset", f1, label, attack_name
FROM {_ENV}""",

    "confusion_window": f"""
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(w + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
       CAST(sum(CAST(fp_b AS INTEGER)) AS BIGINT) AS fp,
       CAST(sum(CAST(fn_b AS INTEGER)) AS BIGINT) AS fn,
       CAST(sum(CAST(tp_b AS INTEGER)) AS BIGINT) AS tp,
       CAST(sum(CAST(tn_b AS INTEGER)) AS BIGINT) AS tn,
       count(*) AS total,
       round(sum(CAST(fp_b AS INTEGER)) / count(*), 9) AS fp_rate,
       round(sum(CAST(fn_b AS INTEGER)) / count(*), 9) AS fn_rate,
       round(sum(CAST(is_attack_true AS INTEGER)) / count(*), 9) AS attack_true_rate,
       round(sum(CAST(is_attack_pred AS INTEGER)) / count(*), 9) AS attack_pred_rate
FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, kafka_ts) AS w FROM {_SCORED_EVENTS})
GROUP BY w""",

    "soft_alerts": f"""
SELECT vec_id, predicted_attack, round(confidence, 9) AS confidence,
       round(p_benign, 9) AS p_benign, round(anomaly_score, 9) AS anomaly_score,
       suspect, rule_alert,
       CASE rule_alert WHEN 'ALERT_HIGH' THEN 'high' WHEN 'ALERT_LOW' THEN 'medium'
            ELSE 'none' END AS severity
FROM {_ALERTS}""",

    "confusion_flags": f"""
SELECT vec_id, predicted_attack, label, attack_name,
       CASE WHEN label = 0 THEN 'benign' ELSE COALESCE(attack_name, 'attack') END AS true_class,
       t AS is_attack_true, p AS is_attack_pred,
       CAST(p AND NOT t AS INTEGER) AS fp, CAST(NOT p AND t AS INTEGER) AS fn,
       CAST(p AND t AS INTEGER) AS tp, CAST(NOT p AND NOT t AS INTEGER) AS tn
FROM (SELECT *, label = 1 AS t, predicted_attack <> 'benign' AS p FROM {_SOFT})""",

    "class_name": f"""
SELECT vec_id, label, COALESCE(label, 1) AS label_filled,
       COALESCE(attack_name, 'unknown') AS attack_name_filled,
       CASE WHEN COALESCE(label, 1) = 0 THEN 'benign' ELSE COALESCE(attack_name, 'unknown') END
         AS class_name,
       CASE WHEN label = 0 THEN 'benign' ELSE COALESCE(attack_name, 'attack') END AS true_class
FROM {_SOFT}""",

    "class_counts": """
SELECT CASE WHEN label = 0 THEN 'benign' ELSE 'attack_' || CAST(label AS VARCHAR) END
         AS class_name, count(*) AS n
FROM embeddings GROUP BY 1""",

    "label_vocab": """
SELECT class_name, n,
       CAST(row_number() OVER (ORDER BY n DESC, class_name) - 1 AS INTEGER) AS freq_index,
       CAST(row_number() OVER (ORDER BY class_name) - 1 AS INTEGER) AS alpha_index
FROM (SELECT CASE WHEN label = 0 THEN 'benign' ELSE 'attack_' || CAST(label AS VARCHAR) END
               AS class_name, count(*) AS n
      FROM embeddings GROUP BY 1)""",

    "multiclass_metrics": f"""
WITH pairs AS (
  SELECT label AS t, CAST(list_position(prob, list_max(prob)) - 1 AS INTEGER) AS p
  FROM (SELECT label, [x / list_sum(ex) for x in ex] AS prob
        FROM (SELECT label, [exp(20.0 * x) for x in {_fold('embedding')}] AS ex
              FROM embeddings)))
SELECT * FROM {_MC}""",

    "pair_metrics": f"""
WITH pairs AS (SELECT quality AS t, toxic AS p FROM labels)
SELECT * FROM {_MC}""",

    "decision_cascade": f"""
SELECT vec_id, iso_is_anom, rule_alert, pred_xgb, pred_lr,
       CASE WHEN iso_is_anom = 0 AND rule_alert = 0 THEN 'benign'
            ELSE COALESCE(pred_xgb, pred_lr, 'attack') END AS pred_final
FROM (SELECT vec_id,
             CAST(anomaly_score >= 0.7 AS INTEGER) AS iso_is_anom,
             CASE WHEN f1 > 0.1 OR f2 > 0.1 THEN 1 ELSE 0 END AS rule_alert,
             CASE WHEN vec_id % 3 = 0 THEN NULL ELSE predicted_attack END AS pred_xgb,
             CASE WHEN vec_id % 5 = 0 THEN NULL
                  ELSE {_VOCAB}[list_position(lp, list_max(lp))] END AS pred_lr
      FROM (SELECT s.*, CAST(e.embedding[2] AS DOUBLE) AS f1, CAST(e.embedding[3] AS DOUBLE) AS f2,
                   [x / list_sum(lx) for x in lx] AS lp
            FROM {_SOFT} s
            JOIN (SELECT vec_id, embedding,
                         [exp(20.0 * x) for x in {_fold('list_reverse(embedding)')}] AS lx
                  FROM embeddings) e USING (vec_id)))""",

    "feature_stats": """
SELECT 'f' || CAST(i - 1 AS VARCHAR) AS feature, count(x) AS n,
       round(avg(CAST(x AS DOUBLE)), 9) AS mean, round(stddev_samp(CAST(x AS DOUBLE)), 9) AS std
FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
GROUP BY i""",

    "standardize": """
WITH long AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
              FROM embeddings),
     st AS (SELECT i, avg(CAST(x AS DOUBLE)) AS m, stddev_samp(CAST(x AS DOUBLE)) AS s
            FROM long GROUP BY i)
SELECT vec_id, 'f' || CAST(i - 1 AS VARCHAR) AS feature,
       round(CASE WHEN s = 0 THEN 0.0 ELSE (CAST(x AS DOUBLE) - m) / s END, 9) AS z_center,
       round(CASE WHEN s = 0 THEN 0.0 ELSE CAST(x AS DOUBLE) / s END, 9) AS z_scale
FROM long JOIN st USING (i)""",

    "hash_sample": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       round({_KEY_U}, 9) AS u
FROM lineitem WHERE {_KEY_U} < 0.1""",

    "hash_split": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       CASE WHEN {_KEY_U} < 0.8 THEN 'train' ELSE 'test' END AS split
FROM lineitem""",

    "class_capped_sample": f"""
SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {_KEY_U}, l_orderkey,
             l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
      FROM lineitem)
WHERE rn <= 5000""",

    "ordered_limit": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value
FROM events ORDER BY event_id LIMIT 500""",

    "duplicate_sample": """
SELECT l_returnflag, count(*) AS n_rows, count(*) FILTER (WHERE l_orderkey % 3 = 0) AS n_copies,
       least(count(*), 2000) AS n_sampled, TRUE AS candidates_ok, TRUE AS salts_ok, TRUE AS proportion_ok
FROM lineitem GROUP BY l_returnflag""",
    "benign_cap": """
SELECT event_id, value FROM events WHERE event_type <> 'error'
ORDER BY ((((event_id % 2147483648) * 1103515245 + 12345) % 2147483648) / 2147483648.0), event_id
LIMIT 3000""",

    "clean_features": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(CASE WHEN {_f32ok('q')} THEN q ELSE 0.0 END, 9) AS q,
       round(CASE WHEN {_f32ok('e')} THEN e ELSE 0.0 END, 9) AS e,
       {_f32ok('q')} AND {_f32ok('e')} AS row_finite
FROM {_PLANTED}""",

    "finite_rows": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(q, 9) AS q, round(e, 9) AS e
FROM {_PLANTED} WHERE {_f32ok('q')} AND {_f32ok('e')}""",
}


def _window_sql(size_sql: str, tail: str = "", extra: str = "") -> str:
    return f"""
SELECT {extra}strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(w + INTERVAL {size_sql}, '%Y-%m-%d %H:%M:%S') AS window_end,
       CAST(sum(CAST(fp_b AS INTEGER)) AS BIGINT) AS fp,
       CAST(sum(CAST(fn_b AS INTEGER)) AS BIGINT) AS fn,
       CAST(sum(CAST(tp_b AS INTEGER)) AS BIGINT) AS tp,
       CAST(sum(CAST(tn_b AS INTEGER)) AS BIGINT) AS tn,
       count(*) AS total,
       round(sum(CAST(fp_b AS INTEGER)) / count(*), 9) AS fp_rate,
       round(sum(CAST(fn_b AS INTEGER)) / count(*), 9) AS fn_rate,
       round(sum(CAST(is_attack_true AS INTEGER)) / count(*), 9) AS attack_true_rate,
       round(sum(CAST(is_attack_pred AS INTEGER)) / count(*), 9) AS attack_pred_rate
FROM (SELECT *, time_bucket(INTERVAL {size_sql}, kafka_ts) AS w FROM {_SCORED_EVENTS})
GROUP BY w {tail}"""


_CLOSED = "HAVING w + INTERVAL {s} <= (SELECT max(ts) FROM events) - INTERVAL 5 MINUTE"

SQL["confusion_window_stream"] = _window_sql("1 HOUR", _CLOSED.format(s="1 HOUR"))
SQL["daily_metrics"] = _window_sql("1 MINUTE", _CLOSED.format(s="1 MINUTE"),
                                   extra="strftime(w, '%Y.%m.%d') AS day, ")
SQL["replay_payload"] = """
SELECT l_orderkey, l_linenumber,
       CASE l_orderkey % 7 WHEN 1 THEN 0.0 WHEN 2 THEN 0.0 WHEN 3 THEN 0.0 WHEN 4 THEN 0.0
            ELSE CAST(l_quantity AS DOUBLE) END AS l_quantity,
       CAST(l_discount AS DOUBLE) AS l_discount,
       CASE l_linenumber % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS label,
       l_returnflag AS attack_name, TRUE AS has_ts
FROM lineitem"""
# late rows change nothing: the same closed windows with the same counts
SQL["late_rows"] = _window_sql("1 HOUR", _CLOSED.format(s="1 HOUR"))
SQL["rate_limited_stream"] = """
SELECT event_id % 4 AS batch, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
FROM events GROUP BY event_id % 4"""
SQL["stream_dedup"] = f"""
SELECT topic || ':' || CAST("partition" AS VARCHAR) || ':' || CAST("offset" AS VARCHAR) AS event_id,
       topic, "partition", "offset", f1
FROM {_ENV}"""
SQL["daily_upsert"] = f"""
WITH writes AS (
  SELECT kafka_ts, topic, "partition", "offset", f1, 0 AS v FROM {_ENV}
  UNION ALL
  SELECT kafka_ts, topic, "partition", "offset", f1 * 2, 1 AS v FROM {_ENV} WHERE topic = 'error'
  UNION ALL
  SELECT kafka_ts, topic, "partition", "offset", f1 * 3, 2 AS v FROM {_ENV} WHERE topic = 'error')
SELECT strftime(kafka_ts, '%Y.%m.%d') AS day,
       topic || ':' || CAST("partition" AS VARCHAR) || ':' || CAST("offset" AS VARCHAR) AS event_id,
       topic, "partition", "offset", f1
FROM (SELECT *, row_number() OVER (PARTITION BY topic, "partition", "offset" ORDER BY v DESC) AS rn
      FROM writes)
WHERE rn = 1"""

SQL["positional_label_join"] = """
SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS pos, event_id, value,
       CAST(event_type = 'error' AS INTEGER) AS label
FROM events"""
SQL["label_parse_guard"] = """
SELECT 'A' AS layout, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS pos,
       quality AS label FROM labels
UNION ALL
SELECT 'B' AS layout, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS pos,
       toxic AS label FROM labels"""
SQL["build_dataset"] = """
SELECT value AS f0, CAST(json_extract(props, '$.k') AS DOUBLE) AS f1,
       CAST(value > 100 AS INTEGER) AS label, event_type AS attack_name
FROM events"""
SQL["source_counts"] = """
SELECT event_type AS attack_name, count(*) AS n FROM events GROUP BY 1"""

SQL["union_tagged_sources"] = """
SELECT value AS f0, CAST(json_extract(props, '$.k') AS DOUBLE) AS f1, event_type AS attack_name
FROM events"""
SQL["score_quantile"] = f"""
SELECT round(quantile_cont(anomaly_score, 0.01), 9) AS quantile FROM {_SOFT}"""
SQL["label_domain"] = """
SELECT quality AS label FROM labels UNION SELECT toxic FROM labels"""

SQL["labelled_csv"] = """
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DOUBLE) AS price,
       CAST(l_quantity > 25 AS INTEGER) AS label, l_returnflag AS attack_name
FROM lineitem"""
SQL["inferred_capture"] = """
SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DOUBLE) AS price, 3 AS width FROM orders"""
SQL["feature_array"] = """
SELECT l_orderkey, l_linenumber, 3 AS n, CAST(l_quantity AS DOUBLE) AS x0,
       CAST(l_discount AS DOUBLE) AS x1,
       CASE WHEN l_linenumber IN (3, 4) THEN 0.0 ELSE CAST(l_tax AS DOUBLE) END AS x2
FROM lineitem"""
SQL["enriched_json"] = f"""
WITH a AS ({SQL["soft_alerts"]}), c AS ({SQL["confusion_flags"]})
SELECT 'embeddings:0:' || CAST(vec_id AS VARCHAR) AS key, TRUE AS has_time,
       '2024-01-02 03:04:05' AS kafka_ts, 'embeddings:0:' || CAST(vec_id AS VARCHAR) AS event_id,
       'embeddings' AS topic, 0 AS "partition", vec_id AS "offset",
       '{{"vec_id":' || CAST(vec_id AS VARCHAR) || '}}' AS raw_input, 'vigil_v1' AS model_version,
       a.predicted_attack, confidence, p_benign, anomaly_score, suspect, rule_alert, severity,
       label, attack_name, true_class, is_attack_true, is_attack_pred, fp, fn, tp, tn
FROM a JOIN c USING (vec_id)"""
SQL["ensemble_json"] = f"""
SELECT '2024-01-02 03:04:05' AS kafka_ts, 'embeddings' AS kafka_topic, 0 AS kafka_partition,
       vec_id AS kafka_offset, CAST(vec_id AS VARCHAR) AS kafka_key, rule_alert,
       vec_id / 8.0 AS iso_score, iso_is_anom, pred_lr, pred_xgb, pred_final
FROM ({SQL["decision_cascade"]})"""
SQL["metrics_json"] = SQL["confusion_window"]
SQL["feature_stats_incremental"] = SQL["feature_stats"]
SQL["class_index"] = """
WITH c AS (SELECT vec_id, CASE WHEN label = 0 THEN 'benign' ELSE 'attack_' || CAST(label AS VARCHAR) END
             AS class_name FROM embeddings),
n AS (SELECT class_name, count(*) AS n FROM c GROUP BY class_name),
i AS (SELECT class_name, CAST(row_number() OVER (ORDER BY n DESC, class_name) - 1 AS INTEGER) AS freq_index,
             CAST(row_number() OVER (ORDER BY class_name) - 1 AS INTEGER) AS alpha_index FROM n)
SELECT vec_id, class_name, freq_index, alpha_index, class_name AS back FROM c JOIN i USING (class_name)"""

# every verdict of the model checks holds for every row
for _name, _facts in {
        "rf_check": ["probabilities_ok", "bundle_ok", "prediction_ok", "alert_ok"],
        "iforest_check": ["score_ok", "flag_ok"], "lr_check": ["largest_logit", "class_known"],
        "artifacts_check": ["same_scores", "decided"],
        "gbt_check": ["scores_ok", "class_ok", "leaves_ok", "loss_falls"],
        "stream_score_check": ["scored_once", "like_batch", "ids_unique"]}.items():
    SQL[_name] = "SELECT vec_id, " + ", ".join(f"TRUE AS {f}" for f in _facts) + " FROM embeddings"

SQL["score_metrics"] = """
WITH e AS (SELECT 1704067200 + vec_id * 7 AS t FROM embeddings),
w AS (SELECT t - t % 60 AS w, count(*) AS total FROM e GROUP BY 1)
SELECT strftime(to_timestamp(w) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS window_start, total,
       TRUE AS metrics_ok, TRUE AS counts_ok
FROM w WHERE w + 60 <= (SELECT max(t) FROM e) - 300"""

SQL["paced_replay"] = """
WITH r AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS pos, count(*) OVER () AS n FROM events)
SELECT event_id, pos, CAST(pos // ((n + 7) // 8) AS INTEGER) AS batch FROM r"""
