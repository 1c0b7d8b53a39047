"""Aggregations (a01-a25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.num import pearson
from ..registry import query, sql_query

sql_query(
    "a01_distinct_audio_first_language",
    """SELECT audio, min_by(lang, ord) AS lang FROM (SELECT r_vec AS audio, gender AS lang, source_row_index AS ord FROM {joined} UNION ALL SELECT o_vec AS audio, edit_tag AS lang, source_row_index + 0 AS ord FROM {joined} WHERE o_vec >= 200) GROUP BY audio""",
)
sql_query(
    "a02_qc_summary",
    """SELECT e_top1 AS pair_type, count(*) AS n, CAST(sum(CASE WHEN e_neutral >= 0.12 THEN 1 ELSE 0 END) AS BIGINT) AS passed, round(avg(CASE WHEN e_neutral >= 0.12 THEN 1.0D ELSE 0.0D END), 6) AS pass_rate,
  round(avg(CASE WHEN source_row_index % 3 = 0 THEN NULL ELSE e_prob END), 6) AS mean_prob FROM {joined_scored} GROUP BY e_top1""",
    """SELECT e_top1 AS pair_type, count(*) AS n, CAST(sum(CASE WHEN e_neutral >= 0.12 THEN 1 ELSE 0 END) AS BIGINT) AS passed, round(avg(CASE WHEN e_neutral >= 0.12 THEN 1 ELSE 0 END), 6) AS pass_rate,
  round(avg(CASE WHEN source_row_index % 3 = 0 THEN NULL ELSE e_prob END), 6) AS mean_prob FROM {joined_scored} GROUP BY e_top1""",
)
sql_query(
    "a03_flag_histogram",
    """SELECT flag, count(*) AS n FROM (SELECT explode(array_compact(array(CASE WHEN e_prob < 0.2 THEN 'prob_low' END, CASE WHEN e_neutral < 0.05 THEN 'neutral_low' END, CASE WHEN e_top1 = 'unk' THEN 'unknown' END, CASE WHEN sim < 0.2 THEN 'sim_low' END))) AS flag FROM {joined_scored})
GROUP BY flag ORDER BY n DESC, flag LIMIT 10""",
    """SELECT flag, count(*) AS n FROM (SELECT unnest([CASE WHEN e_prob < 0.2 THEN 'prob_low' END, CASE WHEN e_neutral < 0.05 THEN 'neutral_low' END, CASE WHEN e_top1 = 'unk' THEN 'unknown' END, CASE WHEN sim < 0.2 THEN 'sim_low' END]) AS flag FROM {joined_scored})
WHERE flag IS NOT NULL GROUP BY flag ORDER BY n DESC, flag LIMIT 10""",
)


@query(
    "a04_index_aggregate",
    """WITH g AS (SELECT d.source, d.lang, count(*) AS c FROM {documents} d GROUP BY 1, 2),
m AS (SELECT source, '{' || string_agg('"' || lang || '":' || c, ',' ORDER BY lang) || '}' AS langs FROM g GROUP BY source)
SELECT d.source, count(*) AS n, m.langs, round(avg(n_chars), 6) AS mean, round(quantile_cont(n_chars::DOUBLE, 0.25), 6) AS p25, round(quantile_cont(n_chars::DOUBLE, 0.5), 6) AS p50, round(quantile_cont(n_chars::DOUBLE, 0.75), 6) AS p75, round(sum(n_chars) / 3600.0, 6)::DOUBLE AS hours
FROM {documents} d JOIN m ON m.source = d.source GROUP BY d.source, m.langs""".replace("'{'", "chr(123)").replace("'}'", "chr(125)"),
)
def a04(t):
    d = t["documents"]
    langs = d.groupBy("source", "lang").count().groupBy("source").agg(F.array_sort(F.collect_list(F.struct("lang", "count"))).alias("pairs"))
    langs = langs.select("source", F.to_json(F.map_from_entries("pairs")).alias("langs"))
    q = F.percentile("n_chars", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    g = d.groupBy("source").agg(F.count("*").alias("n"), F.round(F.avg("n_chars"), 6).alias("mean"), q.alias("q"), F.round(F.sum("n_chars") / 3600.0, 6).alias("hours"))
    return g.join(langs, "source").select("source", "n", "langs", "mean", *[F.round(F.col("q")[i], 6).alias(p) for i, p in enumerate(("p25", "p50", "p75"))], "hours")


sql_query(
    "a05_rows_and_hours_per_file",
    "SELECT source AS file, count(*) AS n, round(CAST(sum(n_chars) AS DOUBLE) / 3600, 6) AS hours FROM {documents} GROUP BY source",
)
sql_query(
    "a06_mode_comparison",
    """WITH g AS (SELECT edit_tag, avg(e_prob) AS mean, percentile(e_prob, 0.5) AS med, avg(CAST(coalesce(e_top1 = 'neutral', false) AS INT)) AS neutral FROM {joined_scored} GROUP BY edit_tag)
SELECT edit_tag, round(mean, 6) AS mean, round(med, 6) AS median, round(neutral, 6) AS neutral_share, round(mean - (SELECT avg(r_prob) FROM {joined_scored}), 6) AS delta FROM g""",
    """WITH g AS (SELECT edit_tag, avg(e_prob) AS mean, quantile_cont(e_prob, 0.5) AS med, avg(CAST(coalesce(e_top1 = 'neutral', false) AS INT)) AS neutral FROM {joined_scored} GROUP BY edit_tag)
SELECT edit_tag, round(mean, 6) AS mean, round(med, 6) AS median, round(neutral, 6) AS neutral_share, round(mean - (SELECT avg(r_prob) FROM {joined_scored}), 6) AS delta FROM g""",
)
sql_query(
    "a07_eval_summary",
    """SELECT coalesce(source, 'ALL') AS task, coalesce(lang, 'ALL') AS lang, count(*) AS n, round(avg(n_chars), 6) AS mean, round(percentile(n_chars, 0.5), 6) AS median, min(n_chars) AS least FROM {documents} GROUP BY GROUPING SETS ((source, lang), ())""",
    """SELECT coalesce(source, 'ALL') AS task, coalesce(lang, 'ALL') AS lang, count(*) AS n, round(avg(n_chars), 6) AS mean, round(quantile_cont(n_chars::DOUBLE, 0.5), 6) AS median, min(n_chars) AS least FROM {documents} GROUP BY GROUPING SETS ((source, lang), ())""",
)
sql_query(
    "a08_gpu_stats",
    """SELECT event_type AS job, count(v) AS n, round(avg(v), 6) AS mean, round(percentile(v, 0.9), 6) AS p90, round(max(v), 6) AS peak FROM (SELECT event_type, try_cast(CASE WHEN event_id % 11 = 0 THEN '[N/A]' ELSE CAST(value AS STRING) END AS DOUBLE) AS v FROM {events}) WHERE v IS NOT NULL GROUP BY event_type""",
    """SELECT event_type AS job, count(v) AS n, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.9), 6) AS p90, round(max(v), 6) AS peak FROM (SELECT event_type, try_cast(CASE WHEN event_id % 11 = 0 THEN '[N/A]' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS v FROM {events}) WHERE v IS NOT NULL GROUP BY event_type""",
)
sql_query(
    "a09_throughput_total",
    """SELECT coalesce(event_type, 'TOTAL') AS lang, count(*) AS cases, round((unix_micros(CAST(max(ts) AS TIMESTAMP)) - unix_micros(CAST(min(ts) AS TIMESTAMP))) / 3.6e9D, 6) AS hours,
  round(try_divide(count(*), (unix_micros(CAST(max(ts) AS TIMESTAMP)) - unix_micros(CAST(min(ts) AS TIMESTAMP))) / 3.6e9D), 6) AS per_hour FROM {events} GROUP BY ROLLUP (event_type)""",
    """SELECT coalesce(event_type, 'TOTAL') AS lang, count(*) AS cases, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9::DOUBLE, 6) AS hours, round(count(*) / nullif((epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9::DOUBLE, 0), 6) AS per_hour FROM {events} GROUP BY ROLLUP (event_type)""",
)
sql_query(
    "a10_pairwise_stats",
    """WITH p AS (SELECT a.conv_id, a.turn AS i, b.turn AS j, length(a.text) * 1.0D / (length(a.text) + length(b.text) + 1) AS s FROM {conversations} a JOIN {conversations} b ON a.conv_id = b.conv_id AND a.turn < b.turn)
SELECT conv_id, count(*) AS n, round(min(s), 6) AS least, round(percentile(s, 0.25), 6) AS p25, round(percentile(s, 0.5), 6) AS median, round(avg(s), 6) AS mean, round(max(s), 6) AS most FROM p GROUP BY conv_id""",
    """WITH p AS (SELECT a.conv_id, a.turn AS i, b.turn AS j, length(a.text)::DOUBLE / (length(a.text) + length(b.text) + 1) AS s FROM {conversations} a JOIN {conversations} b ON a.conv_id = b.conv_id AND a.turn < b.turn)
SELECT conv_id, count(*) AS n, round(min(s), 6) AS least, round(quantile_cont(s, 0.25), 6) AS p25, round(quantile_cont(s, 0.5), 6) AS median, round(avg(s), 6) AS mean, round(max(s), 6) AS most FROM p GROUP BY conv_id""",
)
sql_query("a11_metric_means", "SELECT count(CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END) AS n, round(avg(CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END), 6) AS mean FROM {events}")
sql_query(
    "a12_score_pass_summary",
    "SELECT count(*) AS n, count(l.doc_id) AS kept, CAST(sum(CASE WHEN l.doc_id IS NULL AND d.n_chars > 100 THEN 1 ELSE 0 END) AS BIGINT) AS new, CAST(sum(CASE WHEN l.doc_id IS NULL AND d.n_chars <= 100 THEN 1 ELSE 0 END) AS BIGINT) AS failed, round(avg(l.quality), 6) AS mean FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id",
)
sql_query("a13_transition_histogram", "SELECT r_top1, o_top1, count(*) AS n FROM {base_scored} GROUP BY r_top1, o_top1 ORDER BY n DESC, r_top1, o_top1 LIMIT 10")
sql_query(
    "a14_set_join_capped",
    """SELECT user_id, array_join(array_sort(collect_set(event_type)), '|') AS tags, array_join(slice(transform(array_sort(collect_list(struct(ts, event_id))), x -> CAST(x.event_id AS STRING)), 1, 8), ',') AS first_ids FROM {events} GROUP BY user_id""",
    """SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), '|') AS tags, array_to_string(list_transform(list(event_id ORDER BY ts, event_id)[1:8], lambda x: x::VARCHAR), ',') AS first_ids FROM {events} GROUP BY user_id""",
)
sql_query("a15_language_counts", "SELECT lang, count(*) AS n FROM {documents} GROUP BY lang")
sql_query("a16_remaining", "SELECT source, lang, total, done, greatest(total - done, 0) AS remaining FROM {doc_plan}")
sql_query(
    "a17_two_system_comparison",
    """SELECT gender, round(avg(r_prob), 6) AS first, round(avg(o_prob), 6) AS second, CASE WHEN avg(r_prob) > avg(o_prob) THEN 'first' WHEN avg(r_prob) < avg(o_prob) THEN 'second' ELSE 'tie' END AS winner FROM {base_scored} GROUP BY gender""",
)
sql_query(
    "a18_three_dimension_rates",
    """SELECT edit_tag, count(*) AS n, round(avg(CASE WHEN e_top1 = r_top1 THEN 1.0D ELSE 0.0D END), 6) AS emotion_rate, round(avg(CASE WHEN sim >= 0.5 THEN 1.0D ELSE 0.0D END), 6) AS sim_rate, round(avg(CASE WHEN e_prob >= 0.2 THEN 1.0D ELSE 0.0D END), 6) AS mos_rate FROM {joined_scored} GROUP BY edit_tag""",
    """SELECT edit_tag, count(*) AS n, round(avg(CASE WHEN e_top1 = r_top1 THEN 1 ELSE 0 END), 6) AS emotion_rate, round(avg(CASE WHEN sim >= 0.5 THEN 1 ELSE 0 END), 6) AS sim_rate, round(avg(CASE WHEN e_prob >= 0.2 THEN 1 ELSE 0 END), 6) AS mos_rate FROM {joined_scored} GROUP BY edit_tag""",
)
sql_query("a19_rejection_summary", "SELECT count(*) AS n, CAST(sum(quality) AS BIGINT) AS kept, CAST(sum(1 - quality) AS BIGINT) AS rejected FROM {labels}")
sql_query(
    "a20_distinct_lists",
    "SELECT lang, count(DISTINCT source) AS sources, array_join(array_sort(collect_set(source)), ',') AS names FROM {documents} GROUP BY lang",
    "SELECT lang, count(DISTINCT source) AS sources, array_to_string(list_sort(list(DISTINCT source)), ',') AS names FROM {documents} GROUP BY lang",
)
sql_query(
    "a21_shard_merge_check",
    """SELECT j.shard, j.n AS jobs, coalesce(r.n, 0) AS results, CASE WHEN j.n = coalesce(r.n, 0) THEN 1 ELSE 0 END AS complete FROM (SELECT doc_id % 8 AS shard, count(*) AS n FROM {documents} GROUP BY 1) j
LEFT JOIN (SELECT doc_id % 8 AS shard, count(*) AS n FROM {labels} GROUP BY 1) r ON r.shard = j.shard""",
)
sql_query(
    "a22_windowed_mean",
    """SELECT user_id, round(avg(m), 9) AS score FROM (SELECT user_id, floor(i / 4) AS w, avg(value) AS m FROM {frames} GROUP BY user_id, floor(i / 4)) GROUP BY user_id""",
)
sql_query("a23_group_totals", "SELECT lang, CAST(sum(total) AS BIGINT) AS total, CAST(sum(done) AS BIGINT) AS done, CAST(sum(total - done) AS BIGINT) AS remaining, count(*) AS rows FROM {doc_plan} GROUP BY lang")
sql_query(
    "a25_batch_totals",
    """SELECT floor(event_id / 500) AS batch, count(*) AS n, round(sum(value), 4) AS sec, round(try_divide(count(*), sum(value)), 6) AS per_sec FROM {events} GROUP BY 1""".replace("floor(event_id / 500)", "event_id div 500"),
    """SELECT event_id // 500 AS batch, count(*) AS n, round(sum(value), 4) AS sec, round(count(*) / nullif(sum(value), 0), 6) AS per_sec FROM {events} GROUP BY 1""",
)


@query(
    "v10_pearson",
    """SELECT user_id, CASE WHEN count(*) >= 3 AND stddev_pop(value) >= 1e-8 AND stddev_pop(i) >= 1e-8 THEN round(covar_pop(i, value) / (stddev_pop(i) * stddev_pop(value)), 6) END AS r FROM {frames} GROUP BY user_id""",
)
def v10(t):
    return t["frames"].groupBy("user_id").agg(F.round(pearson(F.col("i").cast("double"), F.col("value")), 6).alias("r"))
