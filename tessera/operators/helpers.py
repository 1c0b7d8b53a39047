"""Smaller helpers (h01-h34) as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import num
from ..registry import query, sql_query

sql_query(
    "h01_split_index",
    "SELECT source, CASE WHEN source RLIKE '^src[0-9]+$' THEN CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) ELSE CAST(raise_error('bad split') AS INT) END AS idx FROM {documents} GROUP BY source",
    "SELECT source, CASE WHEN regexp_matches(source, '^src[0-9]+$') THEN CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) ELSE error('bad split')::INT END AS idx FROM {documents} GROUP BY source",
)
sql_query("h02_split_display", "SELECT source, coalesce(element_at(map('src1', 'First', 'src2', 'Second'), source), source) AS display FROM {documents} GROUP BY source", "SELECT source, CASE source WHEN 'src1' THEN 'First' WHEN 'src2' THEN 'Second' ELSE source END AS display FROM {documents} GROUP BY source")
sql_query("h03_label_after_slash", "SELECT event_id, lower(regexp_extract(concat('zh/<', event_type, '>'), '/(.*)$', 1)) AS label FROM {events}", "SELECT event_id, lower(regexp_extract('zh/<' || event_type || '>', '/(.*)$', 1)) AS label FROM {events}")
sql_query("h04_top1_first_max", "SELECT vec_id, top1, round(top1_prob, 6) AS p FROM {score}")
sql_query("h05_cached_transcripts", "SELECT e.event_id, CASE WHEN l.doc_id IS NOT NULL THEN 'cached' ELSE 'model' END AS source FROM {events} e LEFT JOIN {labels} l ON l.doc_id = e.event_id AND l.quality = 1")
sql_query("h06_tokens", "SELECT n_nationkey, size(split(lower(n_name), ' ')) AS words, size(filter(split(n_name, ''), x -> x <> '')) AS chars FROM {nation}", "SELECT n_nationkey, len(string_split(lower(n_name), ' '))::INTEGER AS words, length(n_name)::INTEGER AS chars FROM {nation}")
sql_query("h07_nested_metric", "SELECT event_id, CAST(try_variant_get(try_parse_json(props), '$.k', 'bigint') AS BIGINT) AS k, try_variant_get(try_parse_json(props), '$.k.deep', 'double') AS deep FROM {events}", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.k.deep') AS DOUBLE) AS deep FROM {events}")
sql_query("h09_new_over_legacy", "SELECT lang, min(source) AS name FROM {documents} WHERE source LIKE 'src1%' GROUP BY lang")
sql_query("h10_numeric_accessor", "SELECT event_id, try_cast(nullif(CASE WHEN event_id % 6 = 0 THEN '' WHEN event_id % 6 = 1 THEN 'x' ELSE CAST(event_id AS STRING) END, '') AS DOUBLE) AS v FROM {events}", "SELECT event_id, try_cast(nullif(CASE WHEN event_id % 6 = 0 THEN '' WHEN event_id % 6 = 1 THEN 'x' ELSE CAST(event_id AS VARCHAR) END, '') AS DOUBLE) AS v FROM {events}")
sql_query("h11_rounded_mean", "SELECT source, bround(avg(n_chars), 4) AS mean, bround(percentile(n_chars, 0.5), 4) AS median FROM {documents} GROUP BY source", "SELECT source, round_even(avg(n_chars), 4) AS mean, round_even(quantile_cont(n_chars::DOUBLE, 0.5), 4) AS median FROM {documents} GROUP BY source")
sql_query(
    "h12_speech_frames",
    "SELECT user_id, CAST(i AS BIGINT) AS i, CASE WHEN 20 * log10(greatest(value, 1e-6D) / max(value) OVER (PARTITION BY user_id)) > -6 THEN 1 ELSE 0 END AS speech FROM {frames}",
    "SELECT user_id, CAST(i AS BIGINT) AS i, CASE WHEN 20 * log10(greatest(value, 1e-6) / max(value) OVER (PARTITION BY user_id)) > -6 THEN 1 ELSE 0 END AS speech FROM {frames}",
)
sql_query("h13_cluster_durations", "SELECT label AS cluster, count(*) AS windows, CAST(sum(vec_id % 7) AS BIGINT) AS total FROM {embeddings} GROUP BY label")
sql_query("h22_score_column", "SELECT original_idx, CASE WHEN gender = 'BUILDING' THEN coalesce(sim, 0) ELSE coalesce(sim / 2, 0) END AS score FROM {base}")


@query("h23_scoring_rule", "SELECT j.source_row_index, round(list_cosine_similarity(r.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) AS sim FROM {joined} j JOIN {embeddings} r ON r.vec_id = j.r_vec JOIN {embeddings} e ON e.vec_id = j.e_vec")
def h23(t):
    e = t["embeddings"].select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    rows = t["joined"].join(e.select(F.col("vec_id").alias("r_vec"), F.col("v").alias("rv")), "r_vec").join(e.select(F.col("vec_id").alias("e_vec"), F.col("v").alias("ev")), "e_vec")
    return rows.select("source_row_index", F.round(num.cosine(F.col("rv"), F.col("ev")), 6).alias("sim"))


sql_query("h24_tag_scores", "SELECT vec_id, 'dual' AS grp, concat('s/', CAST(vec_id AS STRING)) AS source_path FROM {score}", "SELECT vec_id, 'dual' AS grp, 's/' || vec_id AS source_path FROM {score}")
sql_query("h25_link_names", "SELECT page_id, concat(substr(sha1(url), 1, 16), CASE WHEN url LIKE '%.wav' THEN '' ELSE '.wav' END) AS link FROM {pages}")
sql_query("h26_zip_timestamps", "SELECT n_nationkey, count(*) AS kept FROM (SELECT n_nationkey, explode(filter(arrays_zip(split(n_name, '') AS ch, sequence(1, length(n_name) + 2) AS ts), x -> x.ch IS NOT NULL AND x.ch <> '')) AS z FROM {nation}) GROUP BY n_nationkey".replace("split(n_name, '') AS ch, sequence(1, length(n_name) + 2) AS ts), x -> x.ch IS NOT NULL AND x.ch <> ''", "split(n_name, ''), sequence(1, length(n_name) + 2)), x -> x['0'] IS NOT NULL AND x['0'] <> ''"), "SELECT n_nationkey, length(n_name) AS kept FROM {nation}")
sql_query("h28_duration_ms", "SELECT doc_id, coalesce(CAST(bround(try_divide(n_chars * 1000, CASE WHEN doc_id % 9 = 0 THEN 0 ELSE 160 END)) AS BIGINT), 0) AS ms FROM {documents}", "SELECT doc_id, coalesce(CAST(round_even(n_chars * 1000 / nullif(CASE WHEN doc_id % 9 = 0 THEN 0 ELSE 160 END, 0), 0) AS BIGINT), 0) AS ms FROM {documents}")
sql_query("h30_name_resolution", "SELECT n.n_nationkey, coalesce(min(CASE WHEN r.r_name = n.n_name THEN r.r_regionkey END), min(CASE WHEN n.n_name LIKE concat('%', r.r_name, '%') THEN r.r_regionkey END), -1) AS region FROM {nation} n JOIN {region} r ON r.r_regionkey = n.n_regionkey GROUP BY n.n_nationkey")
sql_query("h31_listening_sample", "SELECT original_idx, concat('file://', original_audio) AS src FROM {base} WHERE original_idx < 50")
sql_query("h32_latest_per_name", "SELECT c_name, o.o_orderkey FROM {customer} c JOIN (SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM {orders} GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey")
sql_query("h34_language_config", "SELECT lang, CASE lang WHEN 'en' THEN 'default_en' ELSE 'default' END AS config, count(*) AS n FROM {documents} GROUP BY lang")
