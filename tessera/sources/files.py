"""Sources and sinks (s01-s27)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as X
from ..operators.relational import first_wins, numbered
from ..registry import Inputs, query, sql_query


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """JSON lines with a given schema. Blank lines are skipped; a bad line raises, or is left out if not strict."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(f"{schema}, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path).where("_bad is null").drop("_bad")


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines that keep null fields. The commit protocol makes the write atomic; mode append adds files."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_csv(spark: SparkSession, path: str, floats: tuple[str, ...] = (), sep: str = ",", header: bool = True) -> DataFrame:
    """All columns as text, except those named, which become doubles where they can be read as such."""
    df = spark.read.option("header", header).option("escape", '"').option("multiLine", True).option("sep", sep).csv(path)
    return df.withColumns({c: X.to_float(F.col(c)) for c in floats if c in df.columns})


def write_csv(parts: list[DataFrame], path: str, lists: tuple[str, ...] = (), sep: str = ",") -> None:
    """One CSV over rows with differing columns; lists are joined by |."""
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p, allowMissingColumns=True)
    df = df.withColumns({c: F.array_join(c, "|") for c in lists})
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("sep", sep).csv(path)


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """A headerless TSV of lang, file, remaining, total and maybe more; lines with fewer fields are left out."""
    parts = spark.read.text(path).select(F.split("value", "\t").alias("f")).where("size(f) >= 4")
    return parts.select(F.col("f")[0].alias("lang"), F.col("f")[1].alias("file"), F.col("f")[2].try_cast("long").alias("remaining"), F.col("f")[3].try_cast("long").alias("total"))


def last_completion(attempts: DataFrame, ordinal: str, pending: str) -> DataFrame:
    """The last row with nothing pending, else the last row."""
    names = [c for c in attempts.columns]
    best = F.max_by(F.struct(*names), F.struct((F.col(pending) == 0).cast("int").alias("z"), F.col(ordinal)))
    return attempts.agg(best.alias("row")).where("row is not null").select("row.*")


def captured(lines: DataFrame, pattern: str, names: list[str]) -> DataFrame:
    """Lines of text that match, with the pattern's groups as columns."""
    return lines.where(F.col("value").rlike(pattern)).select("*", *[F.regexp_extract("value", pattern, i + 1).alias(n) for i, n in enumerate(names)])


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Paths and sizes of the files below root; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")


def audio_index(files: DataFrame, patterns: list[str]) -> DataFrame:
    """(idx, path): for each number that a pattern captures in a path, the file of the first pattern, then of the smallest path."""
    rank, idx = F.lit(None).cast("int"), F.lit(None).cast("string")
    for i, p in reversed(list(enumerate(patterns))):
        hit = F.col("path").rlike(p)
        rank, idx = F.when(hit, i).otherwise(rank), F.when(hit, F.regexp_extract("path", p, 1)).otherwise(idx)
    rows = files.select("path", rank.alias("rank"), idx.cast("long").alias("idx")).where("rank is not null").withColumn("order", F.struct("rank", "path"))
    return first_wins(rows, ["idx"], "order").select("idx", "path")


def preferred(rows: DataFrame, local: str, fallback: str, files: DataFrame) -> DataFrame:
    """rows with `audio`: the local path if it is among the files, else the fallback."""
    there = files.select(F.col("path").alias(local), F.lit(True).alias("_there")).distinct()
    return rows.join(there, local, "left").withColumn("audio", F.when(F.col("_there"), F.col(local)).otherwise(F.col(fallback))).drop("_there")


def pair_files(files: DataFrame) -> DataFrame:
    """(stem, path): of JSONL pair files, a scored one before a raw one; derived files (_filtered, _bakfilt) are left out."""
    rows = files.select("path", F.regexp_extract("path", r"([^/]+)\.jsonl$", 1).alias("stem"), F.when(F.col("path").contains("/scored/"), 0).otherwise(1).alias("rank"))
    rows = rows.where("stem <> '' and not stem rlike '_(filtered|bakfilt)$'").withColumn("order", F.struct("rank", "path"))
    return first_wins(rows, ["stem"], "order").select("stem", "path")


def split_of(path: str = "path") -> tuple:
    """Columns lang and split of a path laid out as root/split/x or root/lang/split/x."""
    lang = F.regexp_extract(path, r"/(zh|en)/[^/]+/[^/]+$", 1)
    return X.nonempty(lang).alias("lang"), F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1).alias("split")


def cached(keys: DataFrame, cache: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """(hits, misses) of a cache keyed by a fingerprint."""
    return keys.join(cache, on), keys.join(cache, on, "left_anti")


def in_batches(df: DataFrame, run, schema: str, size: int = 32) -> DataFrame:
    """df through run(list of rows) -> list of dicts, in batches; a batch that fails is retried row by row, and a row that fails
    comes back with its error in the column `error`."""
    names = [p.strip().split()[0] for p in schema.split(",")]

    def work(frames):
        import pandas as pd

        for pdf in frames:
            rows = pdf.to_dict("records")
            out = []
            for i in range(0, len(rows), size):
                part = rows[i : i + size]
                try:
                    out += run(part)
                except Exception:
                    for r in part:
                        try:
                            out += run([r])
                        except Exception as e:
                            out.append({**r, "error": str(e)})
            yield pd.DataFrame([{n: o.get(n) for n in names} for o in out], columns=names)

    return df.mapInPandas(work, schema)


def markdown(df: DataFrame, title: str, most: int = 1000) -> str:
    """A report of an aggregate of at most `most` rows."""
    rows = df.limit(most).collect()
    lines = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]) + "\n"


def publish(staged: str, final: str, expected: int, spark: SparkSession) -> bool:
    """Move a staged folder of JSON lines to its final place if it has as many rows as expected and was committed."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(f"{staged}/_SUCCESS")) or spark.read.text(staged).count() != expected:
        return False
    fs.delete(path(final), True)
    return bool(fs.rename(path(staged), path(final)))


def load_or_build(spark: SparkSession, path: str, build, force: bool = False) -> DataFrame:
    """A Parquet index, built by build() where it is missing or force is set."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if force or not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_json(spark: SparkSession, path: str, document: dict) -> None:
    """One document, keys sorted, as a file of its own in a folder."""
    spark.createDataFrame([(json.dumps(document, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def first_column(df: DataFrame, names: tuple[str, ...]) -> str:
    """The first of the names that the table has; ValueError if it has none."""
    found = next((n for n in names if n in df.columns), None)
    if found is None:
        raise ValueError(f"none of {', '.join(names)} in {', '.join(df.columns)}")
    return found


def without_private(df: DataFrame) -> DataFrame:
    """df without columns whose name starts with an underscore."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def file_ordinal(df: DataFrame, key: str, name: str = "ordinal") -> DataFrame:
    """df with gap-free numbers from 0 in the order of the manifest's integer key, null last. A row's place in its file would start anew in each file of a
    table of several."""
    some = numbered(df.where(F.col(key).isNotNull()), key, name, sparse=True)
    count = F.broadcast(df.agg(F.count(key).alias("_some")))  # one row
    rest = numbered(df.where(F.col(key).isNull()).withColumn("_at", F.monotonically_increasing_id()), "_at", name, sparse=True)
    return some.unionByName(rest.join(count).withColumn(name, F.col(name) + F.col("_some")).drop("_at", "_some"))


def _place(spark: SparkSession, name: str) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return f"{root.rstrip('/')}/tessera-files-{uuid.uuid4().hex}/{name}"


@query("s01_jsonl_scan", "SELECT c_custkey, c_name, c_acctbal FROM {customer}")
def s01(t: Inputs) -> DataFrame:
    at = _place(t.spark, "rows")
    write_jsonl(t["customer"].select("c_custkey", "c_name", "c_acctbal"), at)
    return read_jsonl(t.spark, at, "c_custkey long, c_name string, c_acctbal double")


@query("s02_lenient_jsonl_scan", "SELECT c_custkey, c_name FROM {customer} WHERE c_custkey % 10 <> 0")
def s02(t: Inputs) -> DataFrame:
    at = _place(t.spark, "rows")
    line = F.when(F.col("c_custkey") % 10 == 0, "{bad").otherwise(F.to_json(F.struct("c_custkey", "c_name")))
    t["customer"].select(line.alias("value")).write.text(at)
    return read_jsonl(t.spark, at, "c_custkey long, c_name string", strict=False)


@query("s03_file_ordinal", "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal FROM {documents}")
def s03(t: Inputs) -> DataFrame:
    return file_ordinal(t["documents"].select("doc_id"), "doc_id")


@query("s04_jsonl_sink_keeps_nulls", "SELECT doc_id, CASE WHEN quality = 1 THEN quality END AS quality, true AS written FROM {labels}")
def s04(t: Inputs) -> DataFrame:
    at = _place(t.spark, "rows")
    write_jsonl(t["labels"].select("doc_id", F.when(F.col("quality") == 1, F.col("quality")).alias("quality")), at)
    raw = t.spark.read.text(at)
    return raw.select(F.from_json("value", "doc_id long, quality int").alias("r"), F.col("value").contains('"quality"').alias("written")).select("r.*", "written")


@query("s06_append_sink", "SELECT doc_id FROM {labels}")
def s06(t: Inputs) -> DataFrame:
    at = _place(t.spark, "rows")
    for rest in (0, 1):
        write_jsonl(t["labels"].where(F.col("doc_id") % 2 == rest).select("doc_id"), at, "append")
    return read_jsonl(t.spark, at, "doc_id long")


@query("s07_csv_lenient_floats", "SELECT event_id::VARCHAR AS event_id, CASE WHEN event_id % 5 > 0 THEN value END AS value, 'a \"q\" ' || event_type AS note FROM {events}")
def s07(t: Inputs) -> DataFrame:
    at = _place(t.spark, "rows")
    value = F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.col("value").cast("string"))
    write_csv([t["events"].select("event_id", value.alias("value"), F.concat(F.lit('a "q" '), "event_type").alias("note"))], at)
    return read_csv(t.spark, at, ("value",))


@query("s08_csv_header_union", "SELECT doc_id::VARCHAR AS doc_id, lang, NULL AS quality FROM {documents} UNION ALL SELECT doc_id::VARCHAR, NULL, quality::VARCHAR FROM {labels}")
def s08(t: Inputs) -> DataFrame:
    at = _place(t.spark, "rows")
    write_csv([t["documents"].select("doc_id", "lang"), t["labels"].select("doc_id", "quality")], at)
    return read_csv(t.spark, at)


@query("s09_csv_list_columns", "SELECT user_id::VARCHAR AS user_id, array_to_string(list_sort(list(DISTINCT event_type)), '|') AS tags FROM {events} GROUP BY user_id")
def s09(t: Inputs) -> DataFrame:
    at = _place(t.spark, "rows")
    write_csv([t["events"].groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("tags"))], at, lists=("tags",))
    return read_csv(t.spark, at)


@query("s10_tsv_plan", "SELECT lang, source AS file, total - done AS remaining, total FROM {doc_plan}")
def s10(t: Inputs) -> DataFrame:
    at = _place(t.spark, "rows")
    full = t["doc_plan"].select(F.concat_ws("\t", "lang", "source", (F.col("total") - F.col("done")).cast("string"), F.col("total").cast("string")).alias("value"))
    full.unionByName(t["nation"].select(F.concat_ws("\t", "n_name", F.lit("x")).alias("value"))).write.text(at)
    return read_plan(t.spark, at)


@query("s11_last_completion", "SELECT event_id, event_id % 50 AS pending FROM {events} ORDER BY CASE WHEN event_id % 50 = 0 THEN 0 ELSE 1 END, event_id DESC LIMIT 1")
def s11(t: Inputs) -> DataFrame:
    return last_completion(t["events"].select("event_id", (F.col("event_id") % 50).alias("pending")), "event_id", "pending")


@query("s12_log_capture", "SELECT event_id::VARCHAR AS id, event_type AS kind FROM {events} WHERE event_type <> 'view'")
def s12(t: Inputs) -> DataFrame:
    at = _place(t.spark, "rows")
    line = F.when(F.col("event_type") == "view", "noise").otherwise(F.concat(F.lit("[INFO] start id="), "event_id", F.lit(" kind="), "event_type"))
    t["events"].select(line.alias("value")).write.text(at)
    return captured(t.spark.read.text(at), r"start id=(\d+) kind=(\w+)", ["id", "kind"]).select("id", "kind")


@query("s14_parquet_round_trip", "SELECT p_partkey, p_size FROM {part} WHERE p_size >= 15")
def s14(t: Inputs) -> DataFrame:
    at = _place(t.spark, "rows")
    t["part"].write.parquet(at)
    return t.spark.read.parquet(at).where(F.col("p_size") >= 10 + 5).select("p_partkey", "p_size")


@query("s18_local_or_fallback", "SELECT c_custkey, CASE WHEN c_custkey IN (SELECT user_id FROM {events}) THEN 'r/' || c_custkey ELSE 'o/' || c_custkey END AS audio FROM {customer}")
def s18(t: Inputs) -> DataFrame:
    rows = t["customer"].select("c_custkey", F.concat(F.lit("r/"), "c_custkey").alias("local"), F.concat(F.lit("o/"), "c_custkey").alias("fallback"))
    return preferred(rows, "local", "fallback", t["edit"].select(F.col("ref_audio").alias("path"))).select("c_custkey", "audio")


@query("s19_pair_file_discovery", "SELECT lang || '_' || source AS stem, CASE WHEN bool_or(doc_id % 2 = 0) THEN '/p/scored/' ELSE '/p/' END || lang || '_' || source || '.jsonl' AS path FROM {documents} GROUP BY lang, source")
def s19(t: Inputs) -> DataFrame:
    stem = F.concat_ws("_", "lang", "source")
    place = F.when(F.col("doc_id") % 2 == 0, "/p/scored/").otherwise("/p/")
    d = t["documents"]
    files = d.select(F.concat(place, stem, F.lit(".jsonl")).alias("path")).unionByName(d.select(F.concat(F.lit("/p/"), stem, F.lit("_filtered.jsonl")).alias("path"))).distinct()
    return pair_files(files)


@query("s20_two_layouts", "SELECT doc_id, CASE WHEN lang = 'en' THEN 'en' END AS lang, source AS split FROM {documents}")
def s20(t: Inputs) -> DataFrame:
    path = F.when(F.col("lang") == "en", F.concat(F.lit("root/en/"), "source", F.lit("/A.jsonl"))).otherwise(F.concat(F.lit("root/"), "source", F.lit("/A.jsonl")))
    return t["documents"].select("doc_id", path.alias("path")).select("doc_id", *split_of())


@query("s22_embedding_cache", "SELECT d.doc_id, l.doc_id IS NOT NULL AS hit FROM {documents} d LEFT JOIN {labels} l USING (doc_id)")
def s22(t: Inputs) -> DataFrame:
    hits, misses = cached(t["documents"].select("doc_id"), t["labels"].select("doc_id"), ["doc_id"])
    return hits.withColumn("hit", F.lit(True)).unionByName(misses.withColumn("hit", F.lit(False)))


@query("s23_batched_calls", "SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN upper(event_type) END AS text, CASE WHEN event_id % 97 = 0 THEN 'no audio' END AS error FROM {events}")
def s23(t: Inputs) -> DataFrame:
    def run(rows):
        if any(r["event_id"] % 97 == 0 for r in rows):
            raise ValueError("no audio")
        return [{"event_id": r["event_id"], "text": r["event_type"].upper(), "error": None} for r in rows]

    return in_batches(t["events"].select("event_id", "event_type"), run, "event_id long, text string, error string")


@query("s26_partitioned_sink", "SELECT doc_id, lang FROM {documents} WHERE lang = 'fr'")
def s26(t: Inputs) -> DataFrame:
    at = _place(t.spark, "rows")
    t["documents"].select("doc_id", "lang").write.partitionBy("lang").parquet(at)
    return t.spark.read.schema("doc_id long, lang string").parquet(at).where("lang = 'fr'")


@query("s27_publish_after_check", "SELECT doc_id FROM {labels}")
def s27(t: Inputs) -> DataFrame:
    at = _place(t.spark, "rows")
    write_jsonl(t["labels"].select("doc_id"), f"{at}-staged")
    if not publish(f"{at}-staged", at, t["labels"].count(), t.spark):
        raise RuntimeError("counts differ")
    return read_jsonl(t.spark, at, "doc_id long")


sql_query("s05_atomic_replace", "SELECT doc_id, quality FROM {labels}")


@query("s16_audio_index", "SELECT DISTINCT regexp_extract(source, '([0-9]+)$', 1)::BIGINT AS idx, '/a/b_' || source || '.wav' AS path FROM {documents} WHERE source <> 'src3' UNION ALL SELECT 3::BIGINT AS idx, '/a/src3.wav' AS path")
def s16(t: Inputs) -> DataFrame:
    d = t["documents"].select("source").distinct()
    paths = d.select(F.concat(F.lit("/a/"), "source", F.lit(".wav")).alias("path")).unionByName(d.where("source <> 'src3'").select(F.concat(F.lit("/a/b_"), "source", F.lit(".wav")).alias("path")))
    return audio_index(paths, [r"b_src(\d+)", r"/src(\d+)"])


@query("v04_item_clusters")
def v04(t: Inputs) -> DataFrame:
    from .audio import item_clusters

    rows = t["embeddings"].selectExpr("vec_id div 8 as item", "vec_id as idx", "cast(embedding as array<double>) as v")
    return item_clusters(rows, "item", "idx", "v", 0.1)


# Signals for the audio figures: the elements of an embedding at a rate of 100, silent from the 17th on for a while.
_SIGNALS = "SELECT vec_id, list_transform(embedding, lambda x, i: CASE WHEN i > 16 AND i <= 16 + vec_id % 32 THEN 0::DOUBLE ELSE x::DOUBLE END) AS x FROM {embeddings}"
_LEVELS = f"""WITH s AS ({_SIGNALS}), a AS (SELECT vec_id, x, greatest(1e-4, 0.02 * list_aggregate(list_transform(x, lambda v: abs(v)), 'quantile_cont', 0.95)) AS th FROM s),
f AS (SELECT *, l <= th AS silent FROM (SELECT vec_id, th, k, sqrt((x[k + 1] * x[k + 1] + x[k + 2] * x[k + 2]) / 2 + 1e-12) AS l FROM (SELECT *, unnest(range(0, 63)) AS k FROM a)))"""


def _signals(t: Inputs) -> DataFrame:
    return t["embeddings"].selectExpr("vec_id as id", "transform(embedding, (x, i) -> case when i >= 16 and i < 16 + vec_id % 32 then 0D else cast(x as double) end) as samples")


@query(
    "v07_audio_health",
    f"""{_LEVELS}, w AS (SELECT vec_id, th, list(l ORDER BY k) FILTER (WHERE k % 2 = 0) AS l FROM f GROUP BY vec_id, th), z AS (SELECT vec_id, list_transform(l, lambda v: v <= th) AS q FROM w)
SELECT s.vec_id AS id, true AS load_ok, round(list_max(list_transform(x, lambda v: abs(v))), 6) AS peak, round(sqrt(list_sum(list_transform(x, lambda v: v * v)) / 64), 6) AS rms,
  round(len(list_filter(x, lambda v: abs(v) >= 0.999)) / 64, 6) AS clip_ratio, round(len(list_filter(q, lambda v: v)) / 32, 6) AS silence_ratio, round((coalesce(list_position(q, false), 33) - 1) / 50, 6) AS leading,
  round((coalesce(list_position(list_reverse(q), false), 33) - 1) / 50, 6) AS trailing, round(sqrt(list_sum(list_transform(x[45:64], lambda v: v * v)) / 20) / sqrt(list_sum(list_transform(x, lambda v: v * v)) / 64), 6) AS tail
FROM s JOIN z USING (vec_id)""",
)
def v07(t: Inputs) -> DataFrame:
    from . import audio

    r = lambda c, n=None: F.round(c, 6).alias(n or c)
    out = audio.of_signals(_signals(t), audio.health, 100, audio.HEALTH)
    return out.select("id", "load_ok", r("peak"), r("rms"), r("clip_ratio"), r("silence_ratio"), r("leading_silence_sec", "leading"), r("trailing_silence_sec", "trailing"), r("tail_rms_ratio", "tail"))


@query(
    "v08_tail_silence",
    """WITH s AS (SELECT vec_id, list_transform(embedding, lambda x, i: CASE WHEN i > 40 THEN 0::DOUBLE ELSE x::DOUBLE END) AS x FROM {embeddings}),
p AS (SELECT *, list_max(list_transform(x, lambda v: abs(v))) AS peak FROM s), e AS (SELECT *, 64 - coalesce(list_max(list_filter(range(1, 65), lambda i: abs(x[i]) > greatest(0.01, 0.01 * peak))), 0) AS n FROM p)
SELECT vec_id AS id, round(peak, 6) AS peak, round(n / 100, 4) AS tail_silence_sec, round_even(n / 64, 4) AS tail_silence_ratio FROM e""",
)
def v08(t: Inputs) -> DataFrame:
    from . import audio

    signals = t["embeddings"].selectExpr("vec_id as id", "transform(embedding, (x, i) -> case when i >= 40 then 0D else cast(x as double) end) as samples")
    return audio.of_signals(signals, audio.tail_stats, 100, audio.TAIL).select("id", "peak", "tail_silence_sec", "tail_silence_ratio")


@query(
    "v12_prosody_features",
    f"""{_LEVELS}, g AS (SELECT *, k - row_number() OVER (PARTITION BY vec_id, silent ORDER BY k) AS run FROM f), r AS (SELECT vec_id, count(*) / 100 AS n FROM g WHERE silent GROUP BY vec_id, run HAVING count(*) >= 15),
p AS (SELECT vec_id, count(*) AS c, sum(n) AS total, avg(n) AS mean, max(n) AS most FROM r GROUP BY vec_id)
SELECT f.vec_id AS id, round(avg(l), 6) AS rms_mean, round(stddev_pop(l), 6) AS rms_std, round(avg(silent::INTEGER), 6) AS silence_ratio, coalesce(max(c), 0)::INTEGER AS pause_count,
  round(coalesce(max(total), 0), 6)::DOUBLE AS pause_total_sec, round(coalesce(max(mean), 0), 6)::DOUBLE AS pause_mean_sec, round(coalesce(max(most), 0), 6)::DOUBLE AS pause_max_sec FROM f LEFT JOIN p USING (vec_id) GROUP BY f.vec_id""",
)
def v12(t: Inputs) -> DataFrame:
    from . import audio

    out = audio.of_signals(_signals(t), audio.prosody, 100, audio.PROSODY)
    return out.select("id", *[F.round(c, 6).alias(c) for c in ("rms_mean", "rms_std", "silence_ratio")], "pause_count", *[F.round(c, 6).alias(c) for c in ("pause_total_sec", "pause_mean_sec", "pause_max_sec")])


@query(
    "v13_pair_prosody",
    f"""{_LEVELS}, c AS (SELECT a.vec_id AS reference, b.vec_id AS target, sum(least(a.silent::INTEGER, b.silent::INTEGER)) AS low, sum(greatest(a.silent::INTEGER, b.silent::INTEGER)) AS high,
  corr(ln(a.l + 1e-6), ln(b.l + 1e-6)) AS e, avg(b.silent::INTEGER) - avg(a.silent::INTEGER) AS delta FROM f a JOIN f b ON b.vec_id = a.vec_id + 1 AND b.k = a.k GROUP BY 1, 2)
SELECT reference, target, 1::DOUBLE AS ratio, round(delta, 6) AS pause_ratio_delta, round(CASE WHEN high > 0 THEN low / high END, 6)::DOUBLE AS jaccard, round(e, 6) AS energy, round(CASE WHEN high > 0 THEN (low / high + e) / 2 ELSE e END, 6) AS proxy FROM c""",
)
def v13(t: Inputs) -> DataFrame:
    from functools import partial

    from . import audio

    features = audio.of_signals(_signals(t), partial(audio.prosody, points=63), 100, audio.PROSODY)
    pairs = t["embeddings"].selectExpr("vec_id as reference", "vec_id + 1 as target").join(t["embeddings"].selectExpr("vec_id as target"), "target").select("reference", "target")
    r = lambda c, n=None: F.round(c, 6).alias(n or c)
    return audio.pair_prosody(pairs, features).select("reference", "target", F.col("duration_ratio_tgt_over_ref").alias("ratio"), r("pause_ratio_delta"), r("pause_pattern_jaccard", "jaccard"), r("energy_contour_corr", "energy"), r("prosody_similarity_proxy", "proxy"))
