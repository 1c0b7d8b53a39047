"""Work planning: greedy group assignment (w15), completeness and resume (h14-h21)."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..registry import Inputs, query, sql_query


def assign_groups(plan: DataFrame, weight: str, keys: list[str], groups: int) -> DataFrame:
    """plan with `grp`: largest first, each row to the group with the least load so far, ties to the lowest number.

    The order makes this sequential. It runs over (keys, weight) of a plan, a row for each file of a run, in one task.
    """
    fields = ", ".join(f"{k} {t}" for k, t in plan.select(*keys, weight).dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([weight, *keys], ascending=[False, *[True] * len(keys)], kind="stable").reset_index(drop=True)
        loads = [(0, g) for g in range(groups)]
        out = []
        for w in pdf[weight]:
            load, g = heapq.heappop(loads)
            heapq.heappush(loads, (load + int(w), g))
            out.append(g)
        return pdf[[*keys, weight]].assign(grp=pd.Series(out, dtype="int64"))

    return plan.select(*keys, weight, F.lit(1).alias("_all")).groupBy("_all").applyInPandas(run, f"{fields}, grp long")


_LPT = """WITH RECURSIVE s AS (SELECT source, total, row_number() OVER (ORDER BY total DESC, source) AS rn FROM (SELECT source, sum(total)::BIGINT AS total FROM {doc_plan} GROUP BY source)),
a(rn, source, total, grp, l0, l1, l2) AS (
  SELECT 0::BIGINT, NULL::VARCHAR, 0::BIGINT, -1::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT
  UNION ALL
  SELECT s.rn, s.source, s.total, (CASE WHEN l0 <= l1 AND l0 <= l2 THEN 0 WHEN l1 <= l2 THEN 1 ELSE 2 END)::BIGINT,
    l0 + CASE WHEN l0 <= l1 AND l0 <= l2 THEN s.total ELSE 0 END, l1 + CASE WHEN NOT (l0 <= l1 AND l0 <= l2) AND l1 <= l2 THEN s.total ELSE 0 END, l2 + CASE WHEN NOT (l0 <= l1 AND l0 <= l2) AND NOT l1 <= l2 THEN s.total ELSE 0 END
  FROM a JOIN s ON s.rn = a.rn + 1
)
SELECT source, total, grp FROM a WHERE rn > 0"""


@query("w15_greedy_groups", _LPT)
def w15(t: Inputs) -> DataFrame:
    plan = t["doc_plan"].groupBy("source").agg(F.sum("total").alias("total"))
    return assign_groups(plan, "total", ["source"], 3)


sql_query("h14_count_per_shard", "SELECT source AS path, count(*) AS n FROM {documents} GROUP BY source")
sql_query("h16_pending_inputs", "SELECT d.source, d.lang FROM (SELECT DISTINCT source, lang FROM {documents}) d WHERE NOT EXISTS (SELECT 1 FROM {doc_plan} p WHERE p.source = d.source AND p.lang = d.lang AND p.done * 2 >= p.total)")
sql_query("h17_pending_edit_work", "SELECT source, CAST(sum(total * 3 - done) AS BIGINT) AS pending FROM {doc_plan} GROUP BY source HAVING sum(total * 3 - done) > 0")
sql_query("h18_latest_batch", "SELECT o_orderpriority AS kind, max_by(o_orderkey, struct(o_orderdate, o_orderkey)) AS batch FROM {orders} GROUP BY o_orderpriority", "SELECT o_orderpriority AS kind, arg_max(o_orderkey, {'d': o_orderdate, 'k': o_orderkey}) AS batch FROM {orders} GROUP BY o_orderpriority".replace("{'d': o_orderdate, 'k': o_orderkey}", "row(o_orderdate, o_orderkey)"))
sql_query("h19_group_tags", "SELECT source, concat('g', lpad(regexp_extract(source, '([0-9]+)$', 1), 2, '0')) AS tag FROM {documents} GROUP BY source", "SELECT source, 'g' || lpad(regexp_extract(source, '([0-9]+)$', 1), 2, '0') AS tag FROM {documents} GROUP BY source")
sql_query(
    "h20_not_submitted",
    "SELECT t.tag FROM (SELECT DISTINCT concat('g', lpad(regexp_extract(source, '([0-9]+)$', 1), 2, '0')) AS tag FROM {documents}) t WHERE NOT EXISTS (SELECT 1 FROM (SELECT regexp_extract(concat('job-g0', CAST(n_nationkey AS STRING)), '-(g[0-9]+)$', 1) AS tag FROM {nation}) s WHERE s.tag = t.tag)",
    "SELECT t.tag FROM (SELECT DISTINCT 'g' || lpad(regexp_extract(source, '([0-9]+)$', 1), 2, '0') AS tag FROM {documents}) t WHERE NOT EXISTS (SELECT 1 FROM (SELECT regexp_extract('job-g0' || n_nationkey, '-(g[0-9]+)$', 1) AS tag FROM {nation}) s WHERE s.tag = t.tag)",
)
sql_query("h21_batch_split", "SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'generate' ELSE 'reuse' END AS status FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id")
