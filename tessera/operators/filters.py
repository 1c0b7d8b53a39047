"""Filters and predicates (f01-f22); the null policy is part of each."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..registry import query, sql_query

sql_query("f01_sim_floor", "SELECT original_idx, round(sim, 6) AS sim FROM {base} WHERE coalesce(CASE WHEN original_idx % 7 = 0 THEN NULL ELSE sim END, 0) >= 0.2")
sql_query(
    "f02_flag_ok",
    "SELECT doc_id FROM (SELECT d.doc_id, CASE l.quality WHEN 1 THEN 'OK' WHEN 0 THEN 'BAD' END AS flag FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id) WHERE flag <=> 'OK'",
    "SELECT doc_id FROM (SELECT d.doc_id, CASE l.quality WHEN 1 THEN 'OK' WHEN 0 THEN 'BAD' END AS flag FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id) WHERE flag IS NOT DISTINCT FROM 'OK'",
)
sql_query("f03_tag_whitelist", "SELECT source_row_index, edit_tag FROM {edit} WHERE edit_tag IN ('click', 'purchase')")
sql_query("f04_forbidden_label", "SELECT source_row_index FROM {joined_scored} WHERE NOT (coalesce(e_top1 IN ('unk', 'other'), false) OR coalesce(r_top1 IN ('unk', 'other'), false))")
sql_query("f05_neutrality_bounds", "SELECT source_row_index FROM {joined_scored} WHERE e_neutral >= 0.12 AND (r_neutral IS NULL OR r_neutral <= 0.2)")
sql_query(
    "f06_same_top1",
    "SELECT original_idx, CASE WHEN r_top1 <=> o_top1 THEN 1 ELSE 0 END AS same FROM {base_scored} WHERE r_top1 IS NOT NULL AND o_top1 IS NOT NULL",
    "SELECT original_idx, CASE WHEN r_top1 IS NOT DISTINCT FROM o_top1 THEN 1 ELSE 0 END AS same FROM {base_scored} WHERE r_top1 IS NOT NULL AND o_top1 IS NOT NULL",
)
sql_query("f07_more_neutral", "SELECT source_row_index FROM {joined_scored} WHERE e_neutral > r_neutral + 0.05")
sql_query(
    "f08_duration_range",
    "SELECT event_id FROM {events} WHERE try_cast(CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE CAST(value AS STRING) END AS DOUBLE) IS NULL OR value BETWEEN 2.0 AND 12.0",
    "SELECT event_id FROM {events} WHERE try_cast(CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE) IS NULL OR value BETWEEN 2.0 AND 12.0",
)
sql_query("f09_ordinal_window", "SELECT event_id FROM (SELECT * FROM {events} WHERE event_id >= 100 AND event_id < 600) WHERE event_type <> 'view'")


@query("f10_exists", "SELECT doc_id FROM {documents} d WHERE EXISTS (SELECT 1 FROM {labels} l WHERE l.doc_id = d.doc_id)")
def f10(t):
    return t["documents"].join(t["labels"], "doc_id", "left_semi").select("doc_id")


sql_query("f11_both_floors", "SELECT source_row_index FROM {joined_scored} WHERE (CASE WHEN source_row_index % 9 = 0 THEN NULL ELSE e_prob END) >= 0.2 AND r_prob >= 0.2")


def index_facets(df: DataFrame, **facets) -> DataFrame:
    """Rows whose columns are in the given lists; a facet of None or an empty list doesn't filter."""
    for column, wanted in facets.items():
        if wanted:
            df = df.where(F.col(column).isin(*wanted))
    return df


def pair_facets(df: DataFrame, labels: dict[str, list], ranges: dict[str, tuple[float, float]], text: tuple[list[str], str] | None = None) -> DataFrame:
    """Lists may name None to let nulls through; ranges let nulls through; the text is a pattern, any case, in any of the columns."""
    for column, wanted in labels.items():
        if wanted:
            keep = F.col(column).isin(*[w for w in wanted if w is not None])
            df = df.where(keep | F.col(column).isNull() if None in wanted else keep)
    for column, (low, high) in ranges.items():
        df = df.where(F.col(column).isNull() | F.col(column).between(low, high))
    if text and text[1]:
        hit = F.lit(False)
        for column in text[0]:
            hit = hit | F.coalesce(F.col(column).rlike(f"(?i){text[1]}"), F.lit(False))
        df = df.where(hit)
    return df


@query("f12_index_facets", "SELECT doc_id FROM {documents} WHERE lang IN ('en', 'fr') AND source IN ('src1', 'src2', 'src3')")
def f12(t):
    return index_facets(t["documents"], lang=["en", "fr"], source=["src1", "src2", "src3"], n_chars=None).select("doc_id")


@query(
    "f13_pair_facets",
    """SELECT d.doc_id FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id
WHERE (l.quality IN (1) OR l.quality IS NULL) AND (l.toxic IS NULL OR l.toxic BETWEEN 0 AND 0) AND (regexp_matches(text, '(?i)th[ae]nd') OR regexp_matches(source, '(?i)th[ae]nd'))""",
)
def f13(t):
    rows = t["documents"].join(t["labels"], "doc_id", "left")
    return pair_facets(rows, {"quality": [1, None], "lang": []}, {"toxic": (0, 0)}, (["text", "source"], "th[ae]nd")).select("doc_id")


sql_query(
    "f14_job_filter",
    "SELECT o_orderkey, o_totalprice FROM {orders} WHERE array_contains(array('1-URGENT', '2-HIGH'), o_orderpriority) AND o_orderstatus = 'O' AND o_totalprice > 1000 ORDER BY o_totalprice DESC, o_orderkey",
    "SELECT o_orderkey, o_totalprice FROM {orders} WHERE list_contains(['1-URGENT', '2-HIGH'], o_orderpriority) AND o_orderstatus = 'O' AND o_totalprice > 1000",
)
sql_query(
    "f15_metadata_hint",
    """SELECT page_id, array_join(array_compact(array(CASE WHEN lower(html) LIKE '%<script%' THEN 'script' END, CASE WHEN lower(html) LIKE '%<nav%' THEN 'nav' END, CASE WHEN url LIKE '%?%' THEN 'query' END)), '|') AS reasons FROM {pages}""",
    """SELECT page_id, array_to_string(list_filter([CASE WHEN lower(html) LIKE '%<script%' THEN 'script' END, CASE WHEN lower(html) LIKE '%<nav%' THEN 'nav' END, CASE WHEN url LIKE '%?%' THEN 'query' END], lambda x: x IS NOT NULL), '|') AS reasons FROM {pages}""",
)
sql_query("f16_route_flagged", "SELECT doc_id, CASE WHEN toxic = 1 OR quality = 0 THEN 'flagged' ELSE 'kept' END AS route FROM {labels}")
sql_query(
    "f17_language_route",
    "SELECT doc_id, CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'romance' WHEN 'es' THEN 'romance' WHEN 'de' THEN 'german' ELSE raise_error(concat('language ', lang)) END AS route FROM {documents}",
    "SELECT doc_id, CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'romance' WHEN 'es' THEN 'romance' WHEN 'de' THEN 'german' ELSE error('language ' || lang) END AS route FROM {documents}",
)
sql_query(
    "f18_file_route",
    "SELECT source, CASE WHEN CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) < 10 THEN 'low' ELSE 'high' END AS route, count(*) AS n FROM {documents} GROUP BY 1, 2",
    "SELECT source, CASE WHEN CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) < 10 THEN 'low' ELSE 'high' END AS route, count(*) AS n FROM {documents} GROUP BY 1, 2",
)
sql_query("f19_all_metrics_present", "SELECT d.doc_id, CASE WHEN l.quality IS NOT NULL AND l.toxic IS NOT NULL AND d.n_chars IS NOT NULL THEN 1 ELSE 0 END AS complete FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id")
sql_query(
    "f20_split_complete",
    "SELECT source, expected, actual, CASE WHEN expected > 0 AND actual = expected THEN 1 ELSE 0 END AS complete FROM (SELECT source, CAST(sum(total) AS BIGINT) AS expected, CAST(sum(done) AS BIGINT) AS actual FROM {doc_plan} GROUP BY source)",
)
sql_query("f21_qc_pass", "SELECT doc_id FROM {labels} WHERE quality = 1 AND toxic = 0")


def require_subset(wanted: list[str], known: list[str]) -> list[str]:
    """wanted, or ValueError naming what isn't known (f22)."""
    unknown = sorted(set(wanted) - set(known))
    if unknown:
        raise ValueError(f"unknown: {', '.join(unknown)}")
    return wanted
