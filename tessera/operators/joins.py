"""Joins with their duplicate policies (j01-j21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import query, sql_query
from .relational import last_wins, lookup_table, negatives, overlay, resume, upsert_by_any_key, with_fallback


@query("j01_edit_base_join", "SELECT e.source_row_index, e.edit_tag, b.original_idx, round(b.sim, 6) AS sim FROM {edit} e JOIN {base_last} b USING (ref_audio)")
def j01(t):
    base = last_wins(t["base"], ["ref_audio"], "original_idx")
    return t["edit"].join(base, "ref_audio").select("source_row_index", "edit_tag", "original_idx", F.round("sim", 6).alias("sim"))


_ALIASES = "SELECT vec_id, 'p/' || vec_id AS path, 'p/' || (vec_id + 1) AS link, 'a/' || (vec_id // 2) AS alias, round(p_neutral, 6) AS p FROM {score}"


@query(
    "j02_score_lookup",
    f"""WITH s AS ({_ALIASES}), k AS (
  SELECT path AS k, p, 0 AS tier, 0 AS rank, vec_id FROM s UNION ALL SELECT link, p, 1, 0, vec_id FROM s UNION ALL SELECT alias, p, 1, 1, vec_id FROM s
), best AS (SELECT k, p FROM k QUALIFY row_number() OVER (PARTITION BY k ORDER BY tier, CASE WHEN tier = 0 THEN -vec_id ELSE vec_id END, rank) = 1)
SELECT e.source_row_index, r.p AS ref_p, a.p AS alias_p FROM {{edit}} e LEFT JOIN best r ON r.k = 'p/' || e.e_vec LEFT JOIN best a ON a.k = 'a/' || e.e_vec""",
)
def j02(t):
    s = t["score"].select("vec_id", F.concat(F.lit("p/"), "vec_id").alias("path"), F.concat(F.lit("p/"), F.col("vec_id") + 1).alias("link"), F.concat(F.lit("a/"), F.floor(F.col("vec_id") / 2).cast("long")).alias("alias"), F.round("p_neutral", 6).alias("p"))
    best = lookup_table(s, "path", ["link", "alias"], "vec_id").select("path", "p")
    e = t["edit"].select("source_row_index", F.concat(F.lit("p/"), "e_vec").alias("ref"), F.concat(F.lit("a/"), "e_vec").alias("tgt"))
    e = e.join(best.select(F.col("path").alias("ref"), F.col("p").alias("ref_p")), "ref", "left")
    return e.join(best.select(F.col("path").alias("tgt"), F.col("p").alias("alias_p")), "tgt", "left").select("source_row_index", "ref_p", "alias_p")


sql_query(
    "j03_link_aliases",
    """WITH m AS (SELECT concat('l/', CAST(c_custkey AS STRING)) AS link, concat('p/', CAST(c_custkey % 50 AS STRING)) AS target FROM {customer}),
s AS (SELECT concat('p/', CAST(vec_id AS STRING)) AS path, round(p_neutral, 6) AS p FROM {score})
SELECT path, p FROM s UNION ALL SELECT m.link AS path, s.p FROM m JOIN s ON s.path = m.target""",
    """WITH m AS (SELECT 'l/' || c_custkey AS link, 'p/' || (c_custkey % 50) AS target FROM {customer}), s AS (SELECT 'p/' || vec_id AS path, round(p_neutral, 6) AS p FROM {score})
SELECT path, p FROM s UNION ALL SELECT m.link AS path, s.p FROM m JOIN s ON s.path = m.target""",
)


@query(
    "j04_fallback_scores",
    """WITH l AS (SELECT doc_id, quality FROM {labels}), f AS (SELECT min_by(d.n_chars, d.n_chars) AS n, d.doc_id FROM {documents} d GROUP BY d.doc_id)
SELECT doc_id, quality::BIGINT AS v FROM l UNION ALL SELECT doc_id, n AS v FROM f WHERE doc_id NOT IN (SELECT doc_id FROM l)""",
)
def j04(t):
    main = t["labels"].select("doc_id", F.col("quality").cast("long").alias("v"))
    fallback = t["documents"].select("doc_id", F.col("n_chars").alias("v"))
    return with_fallback(main, fallback, "doc_id", "v")


sql_query(
    "j05_job_status",
    """WITH r AS (SELECT o_custkey, max_by(o_orderstatus, o_orderkey) AS st FROM {orders} GROUP BY o_custkey)
SELECT c.c_custkey, CASE WHEN r.o_custkey IS NULL THEN 'missing' WHEN r.st = 'F' THEN 'failed' ELSE 'ok' END AS status FROM {customer} c LEFT JOIN r ON r.o_custkey = c.c_custkey""",
)
sql_query(
    "j06_generation_case_asr",
    """WITH a AS (SELECT user_id, max_by(event_type, event_id) AS asr FROM {events} WHERE event_type = 'view' GROUP BY user_id)
SELECT g.event_id, c.c_name, a.asr FROM {events} g LEFT JOIN {customer} c ON c.c_custkey = g.user_id LEFT JOIN a ON a.user_id = g.user_id""",
)


@query(
    "j07_scored_overlay",
    "SELECT d.doc_id, d.lang, CASE WHEN l.doc_id IS NOT NULL THEN l.quality END AS quality, CASE WHEN l.doc_id IS NOT NULL THEN 'scored' ELSE d.source END AS source FROM {documents} d LEFT JOIN {labels} l USING (doc_id)",
)
def j07(t):
    return overlay(t["documents"].select("doc_id", "lang", "source"), t["labels"].select("doc_id", "quality", F.lit("scored").alias("source")), ["doc_id"])


sql_query(
    "j08_tag_pairs",
    """WITH e AS (SELECT ref_audio, edit_tag, max(source_row_index) AS idx FROM {edit} GROUP BY ref_audio, edit_tag)
SELECT a.ref_audio, p.tag_a, p.tag_b, a.idx AS a_idx, b.idx AS b_idx FROM {tag_pair} p JOIN e a ON a.edit_tag = p.tag_a JOIN e b ON b.edit_tag = p.tag_b AND b.ref_audio = a.ref_audio""",
)

_HASH = "('0x' || substr(md5(concat_ws(':', '42', i.c_custkey::VARCHAR, k::VARCHAR)), 1, 8))::BIGINT"


@query(
    "j09_negative_sampling",
    f"""WITH i AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS r, count(*) OVER () AS n FROM {{customer}}), k AS (SELECT unnest([0, 1]) AS k)
SELECT i.c_custkey AS anchor, k AS pick, j.c_custkey AS negative FROM i, k JOIN i j ON j.r = (i.r + 1 + {_HASH} % (i.n - 1)) % i.n""",
)
def j09(t):
    out = negatives(t["customer"].select("c_custkey"), "c_custkey", "42", 2)
    return out.select(F.col("c_custkey").alias("anchor"), F.col("k").alias("pick"), F.col("at_c_custkey").alias("negative"))


@query(
    "j09_negative_sampling_other_gender",
    """WITH i AS (SELECT c_custkey, c_mktsegment AS g, row_number() OVER (ORDER BY c_mktsegment, c_custkey) - 1 AS r, count(*) OVER () AS n, count(*) OVER (PARTITION BY c_mktsegment) AS ng,
  min(0) OVER () AS z FROM {customer}), s AS (SELECT g, min(r) AS g0 FROM i GROUP BY g)
SELECT i.c_custkey AS anchor, j.c_custkey AS negative FROM i JOIN s USING (g) JOIN i j ON j.r = (s.g0 + i.ng + ('0x' || substr(md5(concat_ws(':', '42', i.c_custkey::VARCHAR, '0')), 1, 8))::BIGINT % (i.n - i.ng)) % i.n""",
)
def j09_gender(t):
    return t.sql("""
WITH g AS (SELECT c_mktsegment AS g, count(*) AS ng FROM {customer} GROUP BY c_mktsegment),
s AS (SELECT g, ng, coalesce(sum(ng) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g0, sum(ng) OVER () AS n FROM g),
i AS (SELECT c.c_custkey, s.g0, s.ng, s.n, s.g0 + row_number() OVER (PARTITION BY c.c_mktsegment ORDER BY c.c_custkey) - 1 AS r FROM {customer} c JOIN s ON s.g = c.c_mktsegment),
p AS (SELECT c_custkey, (g0 + ng + CAST(conv(substr(md5(concat_ws(':', '42', CAST(c_custkey AS STRING), '0')), 1, 8), 16, 10) AS BIGINT) % (n - ng)) % n AS at FROM i)
SELECT p.c_custkey AS anchor, j.c_custkey AS negative FROM p JOIN i j ON j.r = p.at""")


# the first row with another audio: the first of all, or for rows that share its audio the first with a different one; -1 if there is none
sql_query(
    "j10_next_other",
    """SELECT original_idx, CASE WHEN ref_audio <> (SELECT min_by(ref_audio, original_idx) FROM {base}) THEN (SELECT min(original_idx) FROM {base})
  ELSE coalesce((SELECT min(original_idx) FROM {base} WHERE ref_audio <> (SELECT min_by(ref_audio, original_idx) FROM {base})), -1) END AS partner FROM {base}""",
)
@query(
    "j11_neighbor_pick",
    """WITH i AS (SELECT original_idx, row_number() OVER (ORDER BY original_idx) - 1 AS r, count(*) OVER () AS n FROM {base_last}),
p AS (SELECT original_idx, (r + 1 + ('0x' || substr(md5(concat_ws(':', '7', original_idx::VARCHAR, '0')), 1, 8))::BIGINT % (n - 1)) % n AS at FROM i)
SELECT p.original_idx, i.original_idx AS neighbor FROM p JOIN i ON i.r = p.at""",
)
def j11(t):
    return negatives(t["base_last"].select("original_idx"), "original_idx", "7", 1).select("original_idx", F.col("at_original_idx").alias("neighbor"))


@query("j12_resume", "SELECT doc_id FROM {documents} WHERE doc_id NOT IN (SELECT doc_id FROM {labels})")
def j12(t):
    return resume(t["documents"], t["labels"], ["doc_id"]).select("doc_id")


_MAIN = "SELECT doc_id AS id, 'd/' || doc_id AS k1, CASE WHEN doc_id % 2 = 0 THEN 'e/' || (doc_id // 2) ELSE '' END AS k2 FROM {documents}"
_NEW = "SELECT 100000 + doc_id AS id, 'd/' || (3 * doc_id) AS k1, 'e/' || (2 * doc_id) AS k2 FROM {labels}"


@query(
    "j13_upsert_any_key",
    f"""WITH m AS ({_MAIN}), n AS ({_NEW}), k AS (SELECT k1 AS k FROM n UNION SELECT k2 FROM n)
SELECT * FROM m WHERE NOT (k1 IN (SELECT k FROM k) OR (k2 <> '' AND k2 IN (SELECT k FROM k))) UNION ALL SELECT * FROM n""",
)
def j13(t):
    d, n = t["documents"], t["labels"]
    main = d.selectExpr("doc_id as id", "concat('d/', doc_id) as k1", "case when doc_id % 2 = 0 then concat('e/', doc_id div 2) else '' end as k2")
    new = n.selectExpr("100000 + doc_id as id", "concat('d/', 3 * doc_id) as k1", "concat('e/', 2 * doc_id) as k2")
    return upsert_by_any_key(main, new, ["k1", "k2"], "id")


sql_query(
    "j14_duration_both_sides",
    """SELECT j.source_row_index, round(coalesce(a.value, 0) + coalesce(b.c_acctbal, 0), 4) AS total FROM {joined} j LEFT JOIN {events} a ON a.event_id = j.source_row_index AND a.value > 5 LEFT JOIN {customer} b ON b.c_custkey = j.original_idx""",
)
sql_query(
    "j15_asof_start",
    """WITH e AS (SELECT user_id, event_id, ts, event_type, max(CASE WHEN event_type = 'signup' THEN struct(ts, event_id) END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM {events})
SELECT event_id, user_id, s.event_id AS start_id FROM e WHERE event_type = 'purchase' AND s IS NOT NULL""",
    """WITH e AS (SELECT user_id, event_id, ts, event_type, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM {events})
SELECT event_id, user_id, s AS start_id FROM e WHERE event_type = 'purchase' AND s IS NOT NULL""",
)
sql_query(
    "j16_join_on_parsed_index",
    "SELECT e.source_row_index, c.c_name FROM {edit} e JOIN {customer} c ON CAST(regexp_extract(e.ref_audio, '([0-9]+)', 1) AS BIGINT) = c.c_custkey",
)
sql_query(
    "j17_cache_or_compute",
    "SELECT d.doc_id, coalesce(CAST(c.quality AS DOUBLE), round(d.n_chars / 1000, 6)) AS score FROM {documents} d LEFT JOIN {labels} c ON c.doc_id = d.doc_id",
)
sql_query(
    "j18_span_overlap",
    """WITH w AS (SELECT doc_id, pos, token, sum(length(token)) OVER (PARTITION BY doc_id ORDER BY pos) - length(token) AS a, sum(length(token)) OVER (PARTITION BY doc_id ORDER BY pos) AS b FROM {words} WHERE doc_id < 300),
m AS (SELECT doc_id, 10 AS s, 25 AS e FROM {documents} WHERE doc_id < 300)
SELECT w.doc_id, w.pos FROM w JOIN m ON m.doc_id = w.doc_id AND m.s < w.b AND m.e > w.a""".replace(" WHERE doc_id < 300", ""),
)
sql_query(
    "j19_missing_metrics",
    """WITH a AS (SELECT r_vec AS v, 'ref' AS side, original_idx FROM {joined} UNION ALL SELECT o_vec AS v, 'org' AS side, original_idx FROM {joined})
SELECT v, array_join(array_sort(collect_set(side)), '|') AS sides, count(*) AS n FROM a WHERE NOT EXISTS (SELECT 1 FROM {score} s WHERE s.vec_id = a.v AND s.p_neutral >= 0.05) GROUP BY v""",
    """WITH a AS (SELECT r_vec AS v, 'ref' AS side, original_idx FROM {joined} UNION ALL SELECT o_vec AS v, 'org' AS side, original_idx FROM {joined})
SELECT v, array_to_string(list_sort(list(DISTINCT side)), '|') AS sides, count(*) AS n FROM a WHERE NOT EXISTS (SELECT 1 FROM {score} s WHERE s.vec_id = a.v AND s.p_neutral >= 0.05) GROUP BY v""",
)
sql_query(
    "j20_plan_actual",
    "SELECT p.source, p.lang, p.total, coalesce(a.n, 0) AS actual FROM {doc_plan} p LEFT JOIN (SELECT d.source, d.lang, count(*) AS n FROM {documents} d JOIN {labels} l ON l.doc_id = d.doc_id WHERE l.quality = 1 GROUP BY d.source, d.lang) a ON a.source = p.source AND a.lang = p.lang",
)
sql_query("j21_both_side_stats", "SELECT j.source_row_index, round(r.p_neutral, 6) AS ref_stat, round(o.p_neutral, 6) AS tgt_stat FROM {joined} j LEFT JOIN {score} r ON r.vec_id = j.r_vec LEFT JOIN {score} o ON o.vec_id = j.o_vec")
