"""The data folder's tables in the shape of the engine's manifests, for Spark and for DuckDB."""

from __future__ import annotations

CLASSES = ("angry", "disgusted", "fearful", "happy", "neutral", "other", "sad", "surprised", "unk")
_LIST = ", ".join(f"'{c}'" for c in CLASSES)



def _scores(left: str, sides: str) -> str:
    cols = ", ".join(f"{s}.top1 AS {s}_top1, {s}.top1_prob AS {s}_prob, {s}.p_neutral AS {s}_neutral, {s}.v9 AS {s}_v9" for s in sides)
    joins = " ".join(f"LEFT JOIN {{score}} {s} ON {s}.vec_id = {left}.{s}_vec" for s in sides)
    return f"SELECT {left}.*, {cols} FROM {{{left}}} {left} {joins}"


_WORDS = r"""SELECT doc_id, CAST(pos AS INT) AS pos, token FROM (
  SELECT doc_id, posexplode(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)) AS (pos, token) FROM {documents})"""

SPARK = {
    "score": f"""
SELECT vec_id, v9, element_at(v9, 5) / total AS p_neutral, array_max(v9) / total AS top1_prob,
  element_at(array({_LIST}), CAST(array_position(v9, array_max(v9)) AS INT)) AS top1
FROM (SELECT vec_id, v9, aggregate(v9, 0D, (a, x) -> a + x) AS total
  FROM (SELECT vec_id, transform(slice(embedding, 1, 9), x -> abs(CAST(x AS DOUBLE))) AS v9 FROM {{embeddings}}))""",
    "base": """
SELECT c_custkey AS original_idx, concat('r/', CAST(c_custkey % 120 AS STRING)) AS ref_audio, concat('o/', CAST(c_custkey AS STRING)) AS original_audio,
  c_custkey % 120 AS r_vec, (7 * c_custkey + 3) % (SELECT count(*) FROM {embeddings}) AS o_vec, (c_acctbal + 1000) / 11000 AS sim, c_mktsegment AS gender
FROM {customer}""",
    "edit": """
SELECT event_id AS source_row_index, event_type AS edit_tag, concat('r/', CAST(user_id AS STRING)) AS ref_audio,
  event_id % (SELECT count(*) FROM {embeddings}) AS e_vec, concat('e/', CAST(event_id AS STRING)) AS edited_audio, user_id, ts, value
FROM {events}""",
    "base_last": """
SELECT original_idx, ref_audio, original_audio, r_vec, o_vec, sim, gender
FROM (SELECT *, row_number() OVER (PARTITION BY ref_audio ORDER BY original_idx DESC) AS rn FROM {base}) WHERE rn = 1""",
    "joined": """
SELECT e.source_row_index, e.edit_tag, e.ref_audio, e.e_vec, e.edited_audio, b.original_idx, b.original_audio, b.r_vec, b.o_vec, b.sim, b.gender
FROM {edit} e JOIN {base_last} b ON e.ref_audio = b.ref_audio""",
    "joined_scored": _scores("joined", "ero"),
    "base_scored": _scores("base", "ro"),
    "words": _WORDS,
    "pair_text": r"""
SELECT u.conv_id, u.turn, trim(regexp_replace(lower(u.text), '[^a-z0-9 ]+', ' ')) AS reference, trim(regexp_replace(lower(a.text), '[^a-z0-9 ]+', ' ')) AS hypothesis
FROM {conversations} u JOIN {conversations} a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'""",
    "frames": """
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, value, value < 5 AS silent FROM {events}""",
    "doc_plan": """
SELECT d.source, d.lang, count(*) AS total, count(l.doc_id) AS done FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id GROUP BY d.source, d.lang""",
    "lines": r"""
SELECT doc_id, CAST(pos AS INT) AS pos, line FROM (SELECT doc_id, posexplode(split(text, '\n')) AS (pos, line) FROM {documents})""",
    "tag_pair": """
SELECT * FROM VALUES ('click', 'purchase'), ('purchase', 'click'), ('click', 'view'), ('view', 'click'), ('purchase', 'view'), ('view', 'purchase') AS t(tag_a, tag_b)""",
}

DUCK = {
    "score": f"""
SELECT vec_id, v9, v9[5] / list_sum(v9) AS p_neutral, list_max(v9) / list_sum(v9) AS top1_prob, ([{_LIST}])[list_position(v9, list_max(v9))] AS top1
FROM (SELECT vec_id, list_transform(embedding[1:9], lambda x: abs(x::DOUBLE)) AS v9 FROM {{embeddings}})""",
    "base": """
SELECT c_custkey AS original_idx, 'r/' || (c_custkey % 120) AS ref_audio, 'o/' || c_custkey AS original_audio,
  c_custkey % 120 AS r_vec, (7 * c_custkey + 3) % (SELECT count(*) FROM {embeddings}) AS o_vec, (c_acctbal + 1000) / 11000 AS sim, c_mktsegment AS gender
FROM {customer}""",
    "edit": """
SELECT event_id AS source_row_index, event_type AS edit_tag, 'r/' || user_id AS ref_audio,
  event_id % (SELECT count(*) FROM {embeddings}) AS e_vec, 'e/' || event_id AS edited_audio, user_id, ts, value
FROM {events}""",
    "base_last": """
SELECT * FROM {base} QUALIFY row_number() OVER (PARTITION BY ref_audio ORDER BY original_idx DESC) = 1""",
    "joined": SPARK["joined"],
    "joined_scored": SPARK["joined_scored"],
    "base_scored": SPARK["base_scored"],
    "words": r"""
SELECT doc_id, (generate_subscripts(w, 1) - 1)::INTEGER AS pos, unnest(w) AS token FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM {documents})""",
    "pair_text": r"""
SELECT u.conv_id, u.turn, trim(regexp_replace(lower(u.text), '[^a-z0-9 ]+', ' ', 'g')) AS reference, trim(regexp_replace(lower(a.text), '[^a-z0-9 ]+', ' ', 'g')) AS hypothesis
FROM {conversations} u JOIN {conversations} a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'""",
    "frames": SPARK["frames"],
    "doc_plan": SPARK["doc_plan"],
    "lines": r"""
SELECT doc_id, (generate_subscripts(w, 1) - 1)::INTEGER AS pos, unnest(w) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS w FROM {documents})""",
    "tag_pair": """
SELECT * FROM (VALUES ('click', 'purchase'), ('purchase', 'click'), ('click', 'view'), ('view', 'click'), ('purchase', 'view'), ('view', 'purchase')) t(tag_a, tag_b)""",
}
