"""Window and sequence operators (w01-w22), sort and limit (t01-t06), set operations (u01-u07)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq
from ..registry import query, sql_query
from .relational import first_wins, islands, last_wins, merged_intervals, numbered


@query("w01_gap_free_sequence", "SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS seq FROM {events} WHERE event_type = 'click'")
def w01(t):
    return numbered(t["events"].where("event_type = 'click'").select("event_id"), "event_id", "seq")


@query("w02_sequence_shared_by_tags", "SELECT event_id, tag, dense_rank() OVER (ORDER BY event_id) - 1 AS seq FROM (SELECT event_id FROM {events} WHERE event_type = 'view') e, (VALUES ('fast'), ('slow')) v(tag)")
def w02(t):
    rows = numbered(t["events"].where("event_type = 'view'").select("event_id"), "event_id", "seq")
    return rows.select("event_id", F.explode(F.array(F.lit("fast"), F.lit("slow"))).alias("tag"), "seq")


@query("w03_last_wins", "SELECT user_id, event_id, event_type FROM {events} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def w03(t):
    return last_wins(t["events"], ["user_id"], "event_id").select("user_id", "event_id", "event_type")


@query("w04_first_wins", "SELECT user_id, event_type, event_id FROM {events} QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def w04(t):
    return first_wins(t["events"], ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")


@query(
    "w05_silence_runs",
    """WITH c AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, silent ORDER BY i) AS g FROM {frames})
SELECT user_id, min(i) AS first, max(i) AS last, count(*) AS n FROM c WHERE silent GROUP BY user_id, g HAVING count(*) >= 3""",
)
def w05(t):
    runs = islands(t["frames"], ["user_id"], "i", F.col("silent"))
    return runs.where("silent").groupBy("user_id", "island").agg(F.min("i").cast("long").alias("first"), F.max("i").cast("long").alias("last"), F.count("*").alias("n")).where("n >= 3").drop("island")


sql_query(
    "w06_leading_trailing_silence",
    """SELECT user_id, CAST(coalesce(min(CASE WHEN NOT silent THEN i END), count(*)) AS BIGINT) AS leading, CAST(count(*) - 1 - coalesce(max(CASE WHEN NOT silent THEN i END), -1) AS BIGINT) AS trailing FROM {frames} GROUP BY user_id""",
)


@query(
    "w07_interval_merge",
    """WITH s AS (SELECT c_nationkey AS k, c_custkey * 10 AS a, c_custkey * 10 + 100 + abs(floor(c_acctbal))::BIGINT % 200 AS b FROM {customer}),
n AS (SELECT *, CASE WHEN a - max(b) OVER (PARTITION BY k ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 40 THEN 0 ELSE 1 END AS new FROM s),
g AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY a, b) AS g FROM n)
SELECT k, min(a) AS a, max(b) AS b FROM g GROUP BY k, g HAVING max(b) - min(a) >= 150""",
)
def w07(t):
    s = t["customer"].selectExpr("c_nationkey as k", "c_custkey * 10 as a", "c_custkey * 10 + 100 + abs(floor(c_acctbal)) % 200 as b")
    return merged_intervals(s, ["k"], "a", "b", 40, 150)


sql_query(
    "w08_pauses",
    """SELECT * FROM (SELECT user_id, event_id, round((unix_micros(CAST(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS TIMESTAMP)) - unix_micros(CAST(ts AS TIMESTAMP))) / 1e6D, 3) AS pause FROM {events}) WHERE pause >= 3600""",
    """SELECT * FROM (SELECT user_id, event_id, round((epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts)) / 1e6::DOUBLE, 3) AS pause FROM {events}) WHERE pause >= 3600""",
)
sql_query(
    "w09_proportional_timing",
    """WITH w AS (SELECT doc_id, pos, length(token) AS u, sum(length(token)) OVER (PARTITION BY doc_id ORDER BY pos) AS upto, sum(length(token)) OVER (PARTITION BY doc_id) AS total, max(pos) OVER (PARTITION BY doc_id) AS last FROM {words})
SELECT doc_id, pos, CAST(bround((upto - u) * 10000 / total) AS BIGINT) AS start_ms, CASE WHEN pos = last THEN 10000 ELSE greatest(CAST(bround(upto * 10000 / total) AS BIGINT), CAST(bround((upto - u) * 10000 / total) AS BIGINT) + 1) END AS end_ms FROM w""",
    """WITH w AS (SELECT doc_id, pos, length(token) AS u, sum(length(token)) OVER (PARTITION BY doc_id ORDER BY pos) AS upto, sum(length(token)) OVER (PARTITION BY doc_id) AS total, max(pos) OVER (PARTITION BY doc_id) AS last FROM {words})
SELECT doc_id, pos, CAST(round_even((upto - u) * 10000 / total, 0) AS BIGINT) AS start_ms, CASE WHEN pos = last THEN 10000 ELSE greatest(CAST(round_even(upto * 10000 / total, 0) AS BIGINT), CAST(round_even((upto - u) * 10000 / total, 0) AS BIGINT) + 1) END AS end_ms FROM w""",
)
sql_query("w10_char_offsets", "SELECT doc_id, pos, CAST(sum(length(token)) OVER (PARTITION BY doc_id ORDER BY pos) - length(token) AS BIGINT) AS start FROM {words}")


@query(
    "w11_max_equal_run",
    """WITH l AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS g FROM {lines}), r AS (SELECT doc_id, line, g, count(*) AS n FROM l GROUP BY 1, 2, 3) SELECT doc_id, max(n)::INTEGER AS run FROM r GROUP BY doc_id""",
)
def w11(t):
    return t["documents"].select("doc_id", seq.max_run(F.split("text", "\n")).alias("run"))


sql_query(
    "w12_sort_within_windows",
    """SELECT event_id, bucket, CAST(row_number() OVER (PARTITION BY bucket ORDER BY value, event_id) AS BIGINT) AS place FROM (SELECT event_id, value, event_id div 64 AS bucket FROM {events})""",
    """SELECT event_id, bucket, CAST(row_number() OVER (PARTITION BY bucket ORDER BY value, event_id) AS BIGINT) AS place FROM (SELECT event_id, value, event_id // 64 AS bucket FROM {events})""",
)


@query("w13_fixed_batches", "SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 32 AS batch FROM {events} WHERE event_type = 'view'")
def w13(t):
    rows = numbered(t["events"].where("event_type = 'view'").select("event_id"), "event_id", "n")
    return rows.selectExpr("event_id", "n div 32 as batch")


sql_query("w14_round_robin_shards", "SELECT event_id, event_id % 8 AS shard FROM {events}")
sql_query(
    "w16_hop_windows",
    """SELECT doc_id, explode(array_union(sequence(0L, greatest(n_chars - 200, 0L), 400L), array(greatest(n_chars - 200, 0L)))) AS start FROM {documents}""",
    """SELECT DISTINCT doc_id, start FROM (SELECT doc_id, unnest(list_append(range(0, greatest(n_chars - 200, 0) + 1, 400), greatest(n_chars - 200, 0))) AS start FROM {documents})""",
)


@query(
    "w17_frame_rms",
    """SELECT vec_id, s // 16 AS frame, round(sqrt(list_sum(list_transform(embedding[s + 1 : s + 32], lambda x: x::DOUBLE * x::DOUBLE)) / 32), 6) AS rms FROM (SELECT vec_id, embedding, unnest(range(0, len(embedding), 16)) AS s FROM {embeddings})""",
)
def w17(t):
    rms = seq.frames(F.col("embedding").cast("array<double>"), 32, 16)
    return t["embeddings"].select("vec_id", F.posexplode(rms).alias("frame", "rms")).select("vec_id", F.col("frame").cast("long").alias("frame"), F.round("rms", 6).alias("rms"))


sql_query(
    "w18_repeat_pad",
    """SELECT vec_id, start, round(aggregate(slice(p, start + 1, 90), 0D, (a, x) -> a + x), 5) AS total FROM (SELECT vec_id, p, explode(sequence(0, size(p) - 90, 10)) AS start FROM (SELECT vec_id, slice(flatten(array_repeat(transform(embedding, x -> CAST(x AS DOUBLE)), 2)), 1, 110) AS p FROM {embeddings}))""",
    """SELECT vec_id, start::INTEGER AS start, round(list_sum(p[start + 1 : start + 90]), 5) AS total FROM (SELECT vec_id, p, unnest(range(0, len(p) - 90 + 1, 10)) AS start FROM (SELECT vec_id, list_concat(embedding::DOUBLE[], embedding::DOUBLE[])[1:110] AS p FROM {embeddings}))""",
)
sql_query(
    "w19_rank_by_mean",
    "SELECT edit_tag, CAST(row_number() OVER (ORDER BY m DESC, edit_tag) AS BIGINT) AS place, CASE WHEN row_number() OVER (ORDER BY m DESC, edit_tag) = 1 THEN 1 ELSE 0 END AS best FROM (SELECT edit_tag, avg(e_prob) AS m FROM {joined_scored} GROUP BY edit_tag)",
)
sql_query(
    "w20_cumulative_counter",
    "SELECT batch, n, CAST(sum(n) OVER (ORDER BY batch) AS BIGINT) AS processed FROM (SELECT event_id div 500 AS batch, count(*) AS n FROM {events} GROUP BY 1)",
    "SELECT batch, n, CAST(sum(n) OVER (ORDER BY batch) AS BIGINT) AS processed FROM (SELECT event_id // 500 AS batch, count(*) AS n FROM {events} GROUP BY 1)",
)
sql_query(
    "w21_top_n_per_language",
    """SELECT lang, source, doc_id, place FROM (SELECT lang, source, doc_id, CAST(row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS BIGINT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS rn FROM {documents}) WHERE rn = 1) WHERE place <= 5""",
)
sql_query(
    "w22_split_interval",
    """SELECT c_custkey, pos, round(10 + pos * 2.0D / n, 6) AS begin_s, round(10 + (pos + 1) * 2.0D / n, 6) AS end_s FROM (SELECT c_custkey, posexplode(split(c_mktsegment, '')) AS (pos, ch), length(c_mktsegment) AS n FROM {customer})""",
    """SELECT c_custkey, pos, round(10 + pos * 2.0::DOUBLE / n, 6) AS begin_s, round(10 + (pos + 1) * 2.0::DOUBLE / n, 6) AS end_s FROM (SELECT c_custkey, unnest(range(0, length(c_mktsegment)))::INTEGER AS pos, length(c_mktsegment) AS n FROM {customer})""",
)

sql_query("t01_first_groups", "SELECT ref_audio, count(*) AS n FROM {edit} GROUP BY ref_audio ORDER BY ref_audio LIMIT 20")
sql_query("t02_head", "SELECT event_id, event_type FROM {events} ORDER BY event_id LIMIT 100")
sql_query("t03_top_histogram", "SELECT source, count(*) AS n FROM {documents} GROUP BY source ORDER BY n DESC, source LIMIT 10")
sql_query("t04_sort_by_time_text", "SELECT o_orderkey, o_orderdate FROM {orders} ORDER BY CAST(o_orderdate AS STRING) DESC, o_orderkey LIMIT 50", "SELECT o_orderkey, o_orderdate FROM {orders} ORDER BY CAST(o_orderdate AS VARCHAR) DESC, o_orderkey LIMIT 50")
sql_query("t05_plan_order", "SELECT source, lang, total - done AS remaining, CAST(row_number() OVER (ORDER BY total - done DESC, source, lang) AS BIGINT) AS place FROM {doc_plan}")
sql_query(
    "t06_clusters_by_size",
    "SELECT label, array_join(transform(slice(array_sort(collect_list(vec_id)), 1, 5), x -> CAST(x AS STRING)), ',') AS members, count(*) AS n FROM {embeddings} GROUP BY label ORDER BY n DESC, min(vec_id)",
    "SELECT label, array_to_string(list_transform(list(vec_id ORDER BY vec_id)[1:5], lambda x: x::VARCHAR), ',') AS members, count(*) AS n FROM {embeddings} GROUP BY label",
)

sql_query("u01_concat_tag_streams", "SELECT source_row_index, edit_tag, 0 AS tag_rank FROM {edit} WHERE edit_tag = 'click' UNION ALL SELECT source_row_index, edit_tag, 1 AS tag_rank FROM {edit} WHERE edit_tag = 'view'")
sql_query("u02_concat_groups", "SELECT 'nation' AS grp, n_name AS name FROM {nation} UNION ALL SELECT 'region' AS grp, r_name AS name FROM {region}")


@query("u03_union_differing_columns", "SELECT doc_id, lang, NULL::INTEGER AS quality FROM {documents} UNION ALL SELECT doc_id, NULL AS lang, quality FROM {labels}")
def u03(t):
    return t["documents"].select("doc_id", "lang").unionByName(t["labels"].select("doc_id", F.col("quality").cast("int").alias("quality")), allowMissingColumns=True)


sql_query("u04_shard_concat", "SELECT doc_id, 0 AS shard FROM {documents} WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 1 AS shard FROM {documents} WHERE doc_id % 2 = 1")
sql_query(
    "u05_disjoint",
    "SELECT a.user_id, CASE WHEN arrays_overlap(a.t, b.t) THEN 0 ELSE 1 END AS disjoint FROM (SELECT user_id, collect_set(event_type) AS t FROM {events} WHERE event_id % 2 = 0 GROUP BY user_id) a JOIN (SELECT user_id, collect_set(event_type) AS t FROM {events} WHERE event_id % 2 = 1 AND value > 9 GROUP BY user_id) b ON a.user_id = b.user_id",
    "SELECT a.user_id, CASE WHEN list_has_any(a.t, b.t) THEN 0 ELSE 1 END AS disjoint FROM (SELECT user_id, list(DISTINCT event_type) AS t FROM {events} WHERE event_id % 2 = 0 GROUP BY user_id) a JOIN (SELECT user_id, list(DISTINCT event_type) AS t FROM {events} WHERE event_id % 2 = 1 AND value > 9 GROUP BY user_id) b ON a.user_id = b.user_id",
)
sql_query("u06_pairs_and_reversed", "SELECT tag_a, tag_b FROM {tag_pair} UNION SELECT tag_b AS tag_a, tag_a AS tag_b FROM {tag_pair}")
sql_query("u07_summary_merge", "SELECT lang, count(*) AS n, 'new' AS state FROM {documents} WHERE lang = 'en' GROUP BY lang UNION ALL SELECT lang, count(*) AS n, 'old' AS state FROM {documents} WHERE lang NOT IN ('en') GROUP BY lang")
