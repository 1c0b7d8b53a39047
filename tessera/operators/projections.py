"""Projections and normalisation (p01-p23)."""

from __future__ import annotations

from ..functions import text as X
from ..registry import query, sql_query
from .relational import overlay
from pyspark.sql import functions as F

sql_query(
    "p01_base_normalize",
    """SELECT format_string('zh:%06d', c_custkey) AS sample_id, c_custkey AS original_idx, coalesce(nullif(concat('local/', c_name), 'local/'), 'none') AS original_audio,
  named_struct('gender', c_mktsegment, 'tone', c_name).gender AS caption_gender, round((c_acctbal + 1000) / 11000, 6) AS speaker_similarity FROM {customer}""",
    """SELECT printf('zh:%06d', c_custkey) AS sample_id, c_custkey AS original_idx, coalesce(nullif('local/' || c_name, 'local/'), 'none') AS original_audio,
  c_mktsegment AS caption_gender, round((c_acctbal + 1000) / 11000, 6) AS speaker_similarity FROM {customer}""",
)

sql_query(
    "p02_edit_normalize",
    """SELECT format_string('%s:%06d', event_type, k) AS sample_id, event_id, k AS source_row_index, coalesce(nullif(event_type, ''), 'none') AS edit_tag
FROM (SELECT event_id, event_type, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM {events}) WHERE k IS NOT NULL""",
    """SELECT printf('%s:%06d', event_type, k) AS sample_id, event_id, k AS source_row_index, coalesce(nullif(event_type, ''), 'none') AS edit_tag
FROM (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM {events}) WHERE k IS NOT NULL""",
)


@query(
    "p03_source_row_normalize",
    """SELECT doc_id AS source_row_index, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END, ''), nullif(source, '')) AS audio, text AS body
FROM {documents} WHERE coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END, ''), nullif(source, '')) IS NOT NULL AND nullif(text, '') IS NOT NULL""",
)
def p03(t):
    first = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang"))
    rows = t["documents"].select(F.col("doc_id").alias("source_row_index"), X.first_nonempty(first, F.col("source")).alias("audio"), X.nonempty(F.col("text")).alias("text"))
    return rows.where("audio is not null and text is not null").select("source_row_index", "audio", F.col("text").alias("body"))


@query("p04_infer_language", "SELECT doc_id, CASE WHEN text = '' THEN 'auto' WHEN regexp_matches(text, '[一-鿿]') THEN 'zh' ELSE 'en' END AS language FROM {documents}")
def p04(t):
    return t["documents"].select("doc_id", X.language(F.col("text")).alias("language"))


sql_query(
    "p05_language_from_split",
    """SELECT doc_id, CASE WHEN source RLIKE '(^|[^a-z])zh' THEN 'zh' WHEN source RLIKE '5$' THEN 'en' WHEN concat('/data/', lang, '/x') LIKE '%/fr/%' THEN 'fr' ELSE 'unknown' END AS language FROM {documents}""",
    """SELECT doc_id, CASE WHEN regexp_matches(source, '(^|[^a-z])zh') THEN 'zh' WHEN regexp_matches(source, '5$') THEN 'en' WHEN '/data/' || lang || '/x' LIKE '%/fr/%' THEN 'fr' ELSE 'unknown' END AS language FROM {documents}""",
)
sql_query(
    "p06_source_from_path",
    """SELECT page_id, coalesce(get(filter(split(url, '/'), x -> x LIKE '%.%'), 0), 'unknown') AS site FROM {pages}""",
    """SELECT page_id, coalesce(list_filter(string_split(url, '/'), lambda x: x LIKE '%.%')[1], 'unknown') AS site FROM {pages}""",
)
sql_query(
    "p07_jobs_per_tag",
    """SELECT event_id AS source_row_index, tag, concat('s', CAST(event_id AS STRING), '_', tag) AS job_id FROM {events} LATERAL VIEW explode(array('speed_faster', 'speed_slower')) t AS tag""",
    """SELECT event_id AS source_row_index, tag, 's' || event_id || '_' || tag AS job_id FROM {events}, (VALUES ('speed_faster'), ('speed_slower')) t(tag)""",
)


@query(
    "p08_speed_pair_projection",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'J_fast' WHEN 'purchase' THEN 'J_slow' END AS pair_type,
  (['speak faster', 'quicken', 'go on'])[(('0x' || substr(md5('7' || event_id::VARCHAR), 1, 8))::BIGINT % 3 + 1)::INTEGER] AS instruction
FROM {events} WHERE event_type IN ('click', 'purchase')""",
)
def p08(t):
    kind = F.create_map(F.lit("click"), F.lit("J_fast"), F.lit("purchase"), F.lit("J_slow"))
    rows = t["events"].where(F.col("event_type").isin("click", "purchase"))
    return rows.select("event_id", F.element_at(kind, F.col("event_type")).alias("pair_type"), X.picked(("speak faster", "quicken", "go on"), "7", F.col("event_id")).alias("instruction"))


sql_query(
    "p09_transfer_job",
    """SELECT concat('job_', lpad(CAST(o_orderkey AS STRING), 8, '0')) AS job_id, o_custkey AS prosody_idx, named_struct('audio', o_orderstatus, 'text', o_orderpriority).audio AS timbre_audio FROM {orders}""",
    """SELECT 'job_' || lpad(o_orderkey::VARCHAR, 8, '0') AS job_id, o_custkey AS prosody_idx, o_orderstatus AS timbre_audio FROM {orders}""",
)
sql_query(
    "p10_flatten_pair",
    """SELECT source_row_index, coalesce(e_top1, r_top1) AS top1, CASE WHEN e_neutral IS NOT NULL THEN round(e_neutral, 6) ELSE round(r_neutral, 6) END AS p_neutral FROM {joined_scored}""",
)
sql_query(
    "p11_fill_old_rows",
    """SELECT d.doc_id, coalesce(l.quality, -1) AS qc_pass, coalesce(CAST(l.toxic AS STRING), 'none') AS flags FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id""",
    """SELECT d.doc_id, coalesce(l.quality, -1) AS qc_pass, coalesce(CAST(l.toxic AS VARCHAR), 'none') AS flags FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id""",
)


@query(
    "p12_record_overlay",
    """SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN nullif(l.toxic, 0)::BIGINT ELSE d.n_chars END AS n_chars, d.lang, l.quality FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id""",
)
def p12(t):
    b = t["labels"].select("doc_id", F.nullif(F.col("toxic"), F.lit(0)).cast("long").alias("n_chars"), "quality")
    return overlay(t["documents"].select("doc_id", "n_chars", "lang"), b, ["doc_id"])


sql_query(
    "p13_emotion_overlay",
    """SELECT source_row_index, coalesce(nullif(CASE WHEN source_row_index % 4 = 0 THEN '' WHEN source_row_index % 4 = 1 THEN NULL ELSE 'given' END, ''), e_top1) AS top1 FROM {joined_scored}""",
)
sql_query(
    "p14_pair_ids",
    """SELECT format_string('%s_%06d', edit_tag, source_row_index) AS pair_id, source_row_index FROM {edit}""",
    """SELECT printf('%s_%06d', edit_tag, source_row_index) AS pair_id, source_row_index FROM {edit}""",
)
sql_query(
    "p15_report_row",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN concat(event_type, ':', CAST(user_id AS STRING)) ELSE event_type END AS prompt FROM {events}""",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_type || ':' || user_id ELSE event_type END AS prompt FROM {events}""",
)


@query(
    "p16_slug",
    r"""SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'item') AS slug FROM {pages}""",
)
def p16(t):
    return t["pages"].select("page_id", X.slug(F.col("url")).alias("slug"))


sql_query(
    "p18_template_fill",
    """SELECT event_id, replace('keep the voice, read as <tag>', '<tag>', coalesce(element_at(map('click', 'news', 'view', 'chat'), event_type), event_type)) AS instruction FROM {events}""",
    """SELECT event_id, replace('keep the voice, read as <tag>', '<tag>', CASE event_type WHEN 'click' THEN 'news' WHEN 'view' THEN 'chat' ELSE event_type END) AS instruction FROM {events}""",
)
sql_query(
    "p19_language_name",
    """SELECT doc_id, CASE WHEN lower(trim(upper(lang))) IN ('en', 'english', 'en-us') THEN 'English' WHEN lower(lang) IN ('zh', 'cn', 'chinese') THEN 'Chinese' ELSE lang END AS language FROM {documents}""",
)
sql_query(
    "p20_benchmark_cases",
    """SELECT doc_id AS case_id, lang AS language, coalesce(nullif(source, ''), 'edit') AS task FROM {documents} WHERE lang IN ('en', 'de')""",
)
sql_query(
    "p21_eval_case_projection",
    """SELECT event_id AS case_id, event_type AS task, CAST(get_json_object(props, '$.k') AS BIGINT) AS wanted, round(value, 4) AS got, CASE WHEN value > 0 THEN 1 ELSE 0 END AS ok FROM {events}""",
    """SELECT event_id AS case_id, event_type AS task, CAST(json_extract_string(props, '$.k') AS BIGINT) AS wanted, round(value, 4) AS got, CASE WHEN value > 0 THEN 1 ELSE 0 END AS ok FROM {events}""",
)


@query(
    "p22_tagged_label",
    r"""SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_type END AS label FROM {events}""",
)
def p22(t):
    raw = F.concat(F.lit("<|en|><|"), F.upper("event_type"), F.lit("|><|Speech|>text"))
    return t["events"].select("event_id", X.tagged_label(raw, ("click", "view")).alias("label"))


sql_query("p23_asr_manifest", "SELECT event_id AS uid, edited AS audio, 'en' AS language FROM (SELECT event_id, concat('e/', CAST(event_id AS STRING)) AS edited, value FROM {events}) WHERE value > 5", "SELECT event_id AS uid, 'e/' || event_id AS audio, 'en' AS language FROM {events} WHERE value > 5")
