"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .runtime import Scratch, prepare, table

#: Weights of the sources in order, repeating; share of all sizes to take; most epochs of a source.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Sampling weight of a document by its quality label (1, 0, none).
GOOD, BAD, UNKNOWN = 2.0, 0.5, 1.0
WORD = r"[^\x20\x09-\x0D]+"


def ranked(scratch: Scratch, df: DataFrame, name: str, *order) -> DataFrame:
    """df with `part` and `place`: rows with a smaller part, or the same and a smaller place, come first in the order.
    Dealt by ranges, so the order is global and no task holds more than its share."""
    n = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return scratch.save(dealt.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()), name)


def targets(scratch: Scratch, sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): sources by code point, null last, get the weights in turn and share
    `share` of all sizes by weight; what exceeds `most` times a source's size is reshared among the others until none is above.

    The level, words for each unit of weight, rises by one aggregation over sources at a time until it stays.
    """
    # a byte-wise order of UTF-8 is the order of code points
    rows = ranked(scratch, sources, "sources", F.col("source").asc_nulls_last())
    counts = {r[0]: r[1] for r in rows.groupBy("part").count().collect()}  # a row for each partition
    before, pairs = 0, []
    for part in sorted(counts):
        pairs += [F.lit(part), F.lit(before)]
        before += counts[part]
    start = F.element_at(F.create_map(*pairs), F.col("part")) if pairs else F.lit(0)
    place = start + F.expr("row_number() over (partition by part order by place)") - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = scratch.save(rows.select("source", "source_size", weight.alias("weight")), "weights")
    total, level = rows.agg(F.sum("source_size"), F.sum("weight")).first(), 0.0
    amount = share * (total[0] or 0)
    if amount:
        level = amount / total[1]
        while True:
            full = F.col("source_size") * most <= F.col("weight") * level
            capped, rest = rows.agg(F.sum(F.when(full, F.col("source_size") * most)), F.sum(F.when(~full, F.col("weight")))).first()
            new = (amount - (capped or 0)) / rest if rest else level
            if new <= level:
                break
            level = new
    return rows.select("source", "source_size", F.round(F.least(F.col("source_size") * float(most), F.col("weight") * level), 6).alias("target"))


def mix(docs: DataFrame, labels: DataFrame | None = None, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) for each row of docs (doc_id, text, source; other columns are ignored).

    size is the number of words; a null text has 0. A source that has its target's words e times over is taken e times whole
    (complete epochs); for the rest its documents come in the order of -ln(u)/w, with u drawn from doc_id and w from the quality
    label, and are taken while their running sum stays within the rest; the one that crosses is taken if that ends nearer.
    A null source is a source of its own; empty documents take nothing; repeated rows are drawn one after the other;
    an empty table gives an empty one.
    """
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    weight = F.lit(UNKNOWN)
    if labels is not None:
        rows = rows.join(labels.where("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id", "left")
        weight = F.when(F.col("quality") >= 1, GOOD).when(F.col("quality") < 1, BAD).otherwise(UNKNOWN)
    u = (F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    sizes = scratch.save(rows.select("doc_id", "source", "size", (-F.log(u) / weight).alias("key")), "sizes")
    order = (F.col("source").asc_nulls_last(), F.col("key").asc(), F.col("doc_id").asc(), F.col("size").asc())
    rows = ranked(scratch, sizes, "ordered", *order)
    scratch.drop(sizes)
    sums = scratch.save(rows.groupBy("source", "part").agg(F.sum("size").alias("words")), "sums")
    goals = targets(scratch, sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    sums = sums.withColumn("before", F.expr("coalesce(sum(words) over (partition by source order by part rows between unbounded preceding and 1 preceding), 0L)"))
    sums = sums.alias("s").join(goals.alias("g"), F.expr("s.source <=> g.source")).select("s.source", "part", "before", "source_size", "target")
    rows = rows.withColumn("upto", F.expr("sum(size) over (partition by source, part order by place)"))
    rows = rows.alias("r").join(sums.alias("s"), F.expr("r.source <=> s.source and r.part = s.part"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rows = rows.select("doc_id", "size", "source_size", "target", epochs.alias("epochs"), (F.col("target") - epochs * F.col("source_size")).alias("rest"), (F.col("before") + F.col("upto")).alias("upto"))
    extra = F.expr("case when size > 0 and (upto <= rest or (upto - size < rest and upto - rest < rest - (upto - size))) then 1L else 0L end")
    rows = rows.withColumn("copies", F.col("epochs") + extra)
    return rows.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Rows that share a doc_id, or have none, are all taken as often as the one of them taken most; null and empty
    texts come with each complete epoch of their source; an empty table gives an empty one."""
    copies = mix(docs, table(spark, sf_dir, "labels")).groupBy(F.col("doc_id").alias("__doc_id")).agg(F.max("copies").alias("__copies")).where("__copies > 0")
    out = docs.join(copies, F.col("doc_id").eqNullSafe(F.col("__doc_id"))).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return out.select(*docs.columns)


ORACLE_OP1 = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    -ln((('0x' || substr(md5('mix:' || doc_id::VARCHAR), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656::DOUBLE)
      / CASE WHEN quality >= 1 THEN 2.0::DOUBLE WHEN quality < 1 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS key
  FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id)
), s AS MATERIALIZED (
  SELECT source, size AS source_size, ([5, 2, 1])[((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)::INTEGER]::DOUBLE AS weight
  FROM (SELECT source, sum(size)::BIGINT AS size FROM d GROUP BY source)
), o AS (
  SELECT *, coalesce(sum(2 * source_size) OVER w, 0)::DOUBLE AS capped, (SELECT sum(weight) FROM s) - coalesce(sum(weight) OVER w, 0) AS rest,
    (SELECT 1.5 * sum(source_size)::DOUBLE FROM s) AS amount
  FROM s WINDOW w AS (ORDER BY 2 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), lv AS (SELECT max((amount - capped) / rest) AS level FROM o),
t AS (SELECT source, source_size, round(least(2.0::DOUBLE * source_size, weight * level), 6)::DOUBLE AS target FROM s, lv),
r AS (
  SELECT doc_id, size, source_size, target, floor(target / source_size)::BIGINT AS epochs,
    target - floor(target / source_size) * source_size AS rest, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size)::BIGINT AS upto
  FROM d JOIN t USING (source)
)
SELECT doc_id, size, source_size, target, size * (epochs + CASE WHEN size > 0 AND (upto <= rest OR (upto - size < rest AND upto - rest < rest - (upto - size))) THEN 1 ELSE 0 END) AS taken
FROM r
"""
