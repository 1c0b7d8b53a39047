"""Word alignments: fallback timing, pauses, and the spans to edit (n01-n05, h27)."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as X
from ..registry import Inputs, query

FALLBACK = "fallback_ref_text_equal_duration"


def fallback_alignment(rows: DataFrame, words: tuple[str, ...] = ()) -> DataFrame:
    """(audio_id, words) from rows (audio_id, ref_text, duration_ms): the text's segments share the duration by syllables, each at least 1 ms, the last
    to the end. words are kept whole. A text without segments has an empty array."""
    parts = rows.select("audio_id", "duration_ms", F.posexplode_outer(X.segments(F.col("ref_text"), words)).alias("idx", "text"))
    parts = parts.withColumn("syllables", F.when(F.col("text").isNotNull(), X.syllables(F.col("text"))))
    whole = Window.partitionBy("audio_id")
    parts = parts.withColumns({"total": F.sum("syllables").over(whole), "last": F.max("idx").over(whole), "upto": F.sum("syllables").over(whole.orderBy("idx"))})
    at = lambda units: F.bround(units * F.col("duration_ms") / F.col("total")).cast("long")
    start = at(F.col("upto") - F.col("syllables"))
    end = F.when(F.col("idx") == F.col("last"), F.col("duration_ms")).otherwise(at(F.col("upto")))
    word = F.struct("idx", "text", start.alias("start_ms"), F.greatest(end, start + 1).alias("end_ms"), "syllables")
    out = parts.groupBy("audio_id").agg(F.sort_array(F.collect_list(F.when(F.col("text").isNotNull(), word))).alias("words"))
    return out.withColumn("words", F.transform("words", lambda w: w.dropFields("idx")))


def pauses(words: Column, threshold_ms: int = 100) -> Column:
    """(after_word_idx, start_ms, duration_ms) of gaps of the threshold or more between consecutive words."""
    gap = lambda i: F.get(words, i + 1)["start_ms"] - F.get(words, i)["end_ms"]
    one = lambda i: F.struct(i.alias("after_word_idx"), F.get(words, i)["end_ms"].alias("start_ms"), gap(i).alias("duration_ms"))
    places = F.when(F.size(words) > 1, F.sequence(F.lit(0), F.size(words) - 2)).otherwise(F.array().cast("array<int>"))
    return F.transform(F.filter(places, lambda i: gap(i) >= threshold_ms), one)


def backend_detail(backend: Column, detail: Column, words: Column) -> Column:
    """What is known of where the words came from: the backend's own detail, and the fallback's behind it where the backend gave none."""
    none = F.coalesce(F.size(words), F.lit(0)) <= 0
    return F.when(none, F.concat(F.coalesce(X.nonempty(detail), backend), F.lit(f"; fallback={FALLBACK}"))).otherwise(detail)


def aligned(rows: DataFrame, words: tuple[str, ...] = (), threshold_ms: int = 100) -> DataFrame:
    """rows (audio_id, ref_text, duration_ms, backend, backend_detail, asr_text, words array<struct<text, start_ms, end_ms, syllables>>) with the fallback's words
    and detail where a backend found none, the reference for a missing transcript, and pauses."""
    missing = F.coalesce(F.size("words"), F.lit(0)) <= 0
    own = fallback_alignment(rows.where(missing), words).withColumnRenamed("words", "_own")
    out = rows.join(own, "audio_id", "left").withColumn("backend_detail", backend_detail(F.col("backend"), F.col("backend_detail"), F.col("words")))
    out = out.withColumns({"asr_text": F.coalesce(X.nonempty(F.col("asr_text")), X.unpunctuated(F.col("ref_text"))), "words": F.when(missing, F.col("_own")).otherwise(F.col("words"))})
    return out.drop("_own").withColumn("pauses", pauses(F.col("words"), threshold_ms))


def _any_of(words: list[str | None]) -> str:
    """A pattern of all texts that are, without punctuation, one of the words without theirs; empty ones match nothing. One search for a text, without making its
    clean form."""
    spaces = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"  # what \\s is in Java with (?U)
    clean = {re.sub(f"[{X.PUNCTUATION.replace(chr(92) + 's', spaces)}]+", "", w or "") for w in words} - {""}
    between = f"[{X.PUNCTUATION}]*"
    one = lambda w: between.join(f"\\x{{{ord(c):x}}}" for c in w)
    return rf"(?U)\A{between}(?:{'|'.join(map(one, sorted(clean)))}){between}\z" if clean else "(?!)"


def _touched(words: Column, before: Column, matched: Column) -> Column:
    """For each match the first word that it touches and the one behind the last, in one array: lengths of words, of what stands before each match since the
    one before, and of matches; null without matches. Both ends come from a search in running sums, so a row takes time in proportion to its words and matches."""

    @F.pandas_udf("array<int>")
    def run(words: pd.Series, before: pd.Series, matched: pd.Series) -> pd.Series:
        out = []
        for n, p, m in zip(words, before, matched, strict=True):
            if m is None:
                out.append(None)
                continue
            n, p, m = (np.asarray(x, np.int64) for x in (n, p, m))
            upto, end = np.cumsum(n), np.cumsum(p[: len(m)] + m)
            bounds = np.stack([np.searchsorted(upto, end - m, side="right"), np.searchsorted(upto - n, end)], axis=1)
            out.append(bounds.ravel().astype(np.int32))
        return pd.Series(out, dtype=object)

    return run(words, before, matched)


def select_spans(alignments: DataFrame, mode: str, **params) -> DataFrame:
    """(audio_id, span, start_ms, end_ms, anchor_words, anchor_word_indices) of alignments (audio_id, words array<struct<text, start_ms, end_ms>>), spans in order.

    manual_span: the given start_ms and end_ms for every audio; anchor_word: the first word equal to anchor_word; filler_words: every word of
    filler_word_list; regex: the words that each match of `regex`, which must not match the empty string, in the joined words touches. Words are compared
    without punctuation. Spans are found within a row; only words that are hit are shuffled, for their numbers where rows share an audio_id. For regex each
    audio_id has one row.
    """
    if mode == "manual_span":
        bounds = [F.lit(int(params[k])).cast("long").alias(k) for k in ("start_ms", "end_ms")]
        return alignments.select("audio_id", F.lit(0).alias("span"), *bounds, F.array().cast("array<string>").alias("anchor_words"), F.array().cast("array<int>").alias("anchor_word_indices"))
    if mode in ("anchor_word", "filler_words"):
        wanted = [params.get("anchor_word")] if mode == "anchor_word" else params.get("filler_word_list", [])
        hits = F.transform("words", lambda w, i: F.when(w["text"].rlike(_any_of(wanted)), F.struct(i.alias("idx"), w["text"].alias("text"), w["start_ms"].alias("start_ms"), w["end_ms"].alias("end_ms"))))
        hits = F.array_compact(hits)
        hits = F.slice(hits, 1, 1) if mode == "anchor_word" else hits
        # explode would have all of it computed once more, for a filter of rows without hits
        hit = alignments.select("audio_id", F.explode_outer(hits).alias("w")).where("w is not null").select("audio_id", "w.*")
        hit = hit.withColumn("span", F.row_number().over(Window.partitionBy("audio_id").orderBy("idx")) - 1)
        hit = hit.where("span = 0") if mode == "anchor_word" else hit
        return hit.select("audio_id", "span", "start_ms", "end_ms", F.array("text").alias("anchor_words"), F.array("idx").alias("anchor_word_indices"))
    if mode == "regex":
        regex = f"(?s){params['regex']}"
        clean = F.transform("words", lambda w: F.when(w["text"].rlike("[^A-Za-z0-9]"), X.unpunctuated(w["text"])).otherwise(w["text"]))
        rows = alignments.withColumn("clean", clean).withColumn("flat", F.array_join("clean", "")).withColumn("found", F.regexp_extract_all("flat", F.lit(regex), F.lit(0)))
        sizes = lambda c: F.when(F.size("found") > 0, F.transform(c, lambda x: F.length(x)))
        rows = rows.select("audio_id", "words", _touched(sizes(F.col("clean")), sizes(F.split("flat", regex)), sizes(F.col("found"))).alias("ends"))
        spans = F.when(F.size("ends") > 0, F.sequence(F.lit(0), F.expr("size(ends) div 2 - 1").cast("int")))
        rows = rows.select("audio_id", "words", "ends", F.explode_outer(spans).alias("span")).where("span is not null")
        first = F.get("ends", F.col("span") * 2)
        rows = rows.select("audio_id", "span", first.alias("first"), F.slice("words", first + 1, F.get("ends", F.col("span") * 2 + 1) - first).alias("w"))
        indices = F.transform("w", lambda w, i: F.col("first") + i)
        return rows.select("audio_id", "span", F.array_min("w.start_ms").alias("start_ms"), F.array_max("w.end_ms").alias("end_ms"), F.col("w.text").alias("anchor_words"), indices.alias("anchor_word_indices"))
    raise ValueError(f"unsupported selection mode: {mode}")


def _alignments(t: Inputs) -> DataFrame:
    """Words of documents, 100 ms each."""
    tokens = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    at = lambda i, ms: (i.cast("long") * 100 + ms)
    words = F.transform(tokens, lambda w, i: F.struct(w.alias("text"), at(i, 0).alias("start_ms"), at(i, 100).alias("end_ms")))
    return t["documents"].where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(F.col("doc_id").alias("audio_id"), words.alias("words"))


def _shown(spans: DataFrame) -> DataFrame:
    return spans.select("audio_id", "span", "start_ms", "end_ms", F.array_join("anchor_words", " ").alias("words"), F.array_join(F.transform("anchor_word_indices", lambda i: i.cast("string")), " ").alias("indices"))


_QUOTED = X.PUNCTUATION.replace("'", "''")
_CLEAN = f"regexp_replace(token, '[{_QUOTED}]+', '', 'g')"


@query("n01_span_manual", "SELECT DISTINCT doc_id AS audio_id, 0 AS span, 600::BIGINT AS start_ms, 1500::BIGINT AS end_ms, '' AS words, '' AS indices FROM {words}")
def n01(t: Inputs) -> DataFrame:
    return _shown(select_spans(_alignments(t), "manual_span", start_ms=600, end_ms=1500)).distinct()


@query("n02_span_anchor", f"SELECT doc_id AS audio_id, 0 AS span, min(pos) * 100::BIGINT AS start_ms, min(pos) * 100 + 100::BIGINT AS end_ms, arg_min(token, pos) AS words, min(pos)::VARCHAR AS indices FROM {{words}} WHERE {_CLEAN} = 'the' GROUP BY doc_id")
def n02(t: Inputs) -> DataFrame:
    return _shown(select_spans(_alignments(t), "anchor_word", anchor_word="the,"))


@query("n03_span_filler", f"SELECT doc_id AS audio_id, (row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1)::INTEGER AS span, pos * 100::BIGINT AS start_ms, pos * 100 + 100::BIGINT AS end_ms, token AS words, pos::VARCHAR AS indices FROM {{words}} WHERE {_CLEAN} IN ('of', 'de', 'der')")
def n03(t: Inputs) -> DataFrame:
    return _shown(select_spans(_alignments(t), "filler_words", filler_word_list=["of", "de!", "der", "?"]))


@query(
    "n04_span_regex",
    f"""WITH k AS (SELECT doc_id, pos, token, {_CLEAN} AS c FROM {{words}}), o AS (SELECT *, sum(length(c)) OVER (PARTITION BY doc_id ORDER BY pos) AS b FROM k),
j AS (SELECT doc_id, string_split(string_agg(c, '' ORDER BY pos), 'andthe') AS parts FROM k GROUP BY doc_id),
p AS (SELECT doc_id, generate_subscripts(parts, 1) - 1 AS span, length(unnest(parts)) AS n, len(parts) AS m FROM j),
s AS (SELECT doc_id, span, sum(n) OVER (PARTITION BY doc_id ORDER BY span) + 6 * span AS a FROM p WHERE span < m - 1)
SELECT o.doc_id AS audio_id, span::INTEGER AS span, min(pos) * 100::BIGINT AS start_ms, max(pos) * 100 + 100::BIGINT AS end_ms, string_agg(token, ' ' ORDER BY pos) AS words, string_agg(pos::VARCHAR, ' ' ORDER BY pos) AS indices
FROM o JOIN s USING (doc_id) WHERE o.b - length(o.c) < s.a + 6 AND o.b > s.a GROUP BY o.doc_id, span""",
)
def n04(t: Inputs) -> DataFrame:
    return _shown(select_spans(_alignments(t), "regex", regex="andthe"))


@query(
    "n05_align_fallback",
    """WITH w AS (SELECT *, (generate_subscripts(list, 1) - 1) AS idx, unnest(list) AS text FROM (SELECT n_nationkey, regexp_extract_all(regexp_replace(n_name, '[\\s,.]+', '', 'g'), 'NATION|[A-Za-z0-9]+|.') AS list FROM {nation}))
SELECT n_nationkey AS audio_id, CASE WHEN n_nationkey % 2 = 0 THEN 'first; fallback=fallback_ref_text_equal_duration' ELSE 'own' END AS backend_detail,
  CASE WHEN n_nationkey % 2 = 0 THEN string_agg(text || '@' || round_even(idx * 1000 / len(list), 0)::BIGINT || '-' || round_even((idx + 1) * 1000 / len(list), 0)::BIGINT, ' ' ORDER BY idx) ELSE 'x@0-400 y@500-1000' END AS words,
  CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE '0:400+100' END AS pauses FROM w GROUP BY n_nationkey""",
)
def n05(t: Inputs) -> DataFrame:
    own = "array(named_struct('text', 'x', 'start_ms', 0L, 'end_ms', 400L, 'syllables', 1), named_struct('text', 'y', 'start_ms', 500L, 'end_ms', 1000L, 'syllables', 1))"
    rows = t["nation"].selectExpr("n_nationkey as audio_id", "n_name as ref_text", "1000L as duration_ms", "'first' as backend", "case when n_nationkey % 2 = 1 then 'own' end as backend_detail", "cast(null as string) as asr_text", f"case when n_nationkey % 2 = 1 then {own} end as words")
    shown = lambda w: F.concat_ws("", w["text"], F.lit("@"), w["start_ms"], F.lit("-"), w["end_ms"])
    gap = lambda p: F.concat_ws("", p["after_word_idx"], F.lit(":"), p["start_ms"], F.lit("+"), p["duration_ms"])
    return aligned(rows, ("NATION",)).select("audio_id", "backend_detail", F.array_join(F.transform("words", shown), " ").alias("words"), F.array_join(F.transform("pauses", gap), " ").alias("pauses"))


@query("h27_backend_fallback", "SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN nullif(lang, 'fr') ELSE coalesce(nullif(lang, 'fr'), source) || '; fallback=fallback_ref_text_equal_duration' END AS detail FROM {documents}")
def h27(t: Inputs) -> DataFrame:
    found = F.expr("case when doc_id % 3 > 0 then array(text) when doc_id % 2 = 0 then array() end").cast("array<string>")
    return t["documents"].select("doc_id", backend_detail(F.col("source"), F.when(F.col("lang") != "fr", F.col("lang")), found).alias("detail"))
