"""Relational building blocks with an explicit policy for duplicates, nulls and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def last_wins(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """One row of each key: the one with the largest ordinal, null before all. Reduced before the shuffle, so a hot key is no burden."""
    row = F.max_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(F.col(ordinal).isNotNull(), F.col(ordinal)))
    return df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(row.alias("_row")).select("_row.*")


def first_wins(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """One row of each key: the one with the smallest ordinal, null before all. Reduced before the shuffle, so a hot key is no burden."""
    row = F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(F.col(ordinal).isNotNull(), F.col(ordinal)))
    return df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(row.alias("_row")).select("_row.*")


def numbered(df: DataFrame, ordinal: str, name: str, width: int = 65536, sparse: bool = False) -> DataFrame:
    """df with gap-free numbers from 0 in the order of a unique non-negative ordinal.

    Rows are numbered within ranges of `width` ordinals, and a running count of the ranges is added: no task gets more than a range,
    and the one ordered pass is over a row for each range. File-order ordinals are dense; for sparse ones, such as hashes or timestamps, the ranges
    are as wide as rows are apart (an aggregate of one row), so that they hold about `width` rows again.
    """
    part = (F.col(ordinal) / width).cast("long")
    if sparse:
        all_ = df.agg(F.min(ordinal).alias("_least"), ((F.max(ordinal) - F.min(ordinal)) / F.greatest(F.count("*") / width, F.lit(1.0))).alias("_wide"))
        df = df.join(F.broadcast(all_))  # one row
        part = F.floor((F.col(ordinal) - F.col("_least")) / F.greatest(F.col("_wide"), F.lit(1.0))).cast("long")
    df = df.withColumn("_part", part)
    counts = df.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_part", before.alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(ordinal)) - 1
    return df.withColumn("_own", own).join(counts, "_part").withColumn(name, (F.col("_own") + F.col("_before")).cast("long")).drop("_own", "_before", "_part", "_least", "_wide")


def ordered_part(df: DataFrame, column: str, parts: int = 256) -> Column:
    """A number that rises with the column's value, for as many parts of about equal numbers of distinct values: its place among the values with the
    least hashes, `parts` of them, which are read once."""
    some = df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(F.xxhash64(column)).limit(parts)
    cuts = sorted(r[0] for r in some.collect())
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x <= F.col(column))) if cuts else F.lit(0)


def resume(jobs: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Jobs that aren't done."""
    return jobs.join(done.select(*keys).distinct(), keys, "left_anti")


def overlay(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left with right's columns where a row of right matches, even its nulls; left's own elsewhere. right is unique by keys."""
    other = right.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in right.columns if c not in keys])
    both = left.join(other, keys, "left")
    out = [F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in right.columns and c not in keys else F.col(c) for c in left.columns]
    out += [F.col(f"_new_{c}").alias(c) for c in right.columns if c not in left.columns]
    return both.select(*out)


def upsert_by_any_key(main: DataFrame, new: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """main without rows that share a non-empty value of any key column with new, and new."""

    def values(df: DataFrame) -> DataFrame:
        return df.select(F.explode(F.array(*[F.nullif(F.col(k), F.lit("")) for k in keys])).alias("_key"), *([row_id] if row_id in df.columns else [])).where("_key is not null")

    hit = values(main).join(values(new).select("_key").distinct(), "_key", "left_semi").select(row_id).distinct()
    return main.join(hit, row_id, "left_anti").unionByName(new, allowMissingColumns=True)


def lookup_table(scores: DataFrame, path: str, aliases: list[str], ordinal: str) -> DataFrame:
    """scores by every path they are known under: the direct path (last wins) before aliases (first wins)."""
    direct = last_wins(scores.withColumn("_path", F.col(path)), ["_path"], ordinal)
    stacked = scores.select("*", F.posexplode(F.array(*[F.col(a) for a in aliases])).alias("_rank", "_path")).where("_path is not null and _path <> ''")
    stacked = first_wins(stacked.withColumn("_order", F.struct(ordinal, "_rank")), ["_path"], "_order").drop("_rank", "_order")
    return direct.unionByName(stacked.join(direct.select("_path"), "_path", "left_anti")).drop(path).withColumnRenamed("_path", path)


def with_fallback(main: DataFrame, fallback: DataFrame, key: str, ordinal: str) -> DataFrame:
    """main, and of fallback the first row of each key that main lacks."""
    extra = first_wins(fallback, [key], ordinal).join(main.select(key), key, "left_anti")
    return main.unionByName(extra.select(*main.columns))


def drop_reasons(df: DataFrame, rules: list[tuple[str, str]]) -> Column:
    """The first rule in order that a row breaks, null for survivors. A rule is (reason, SQL condition to keep); unknown counts as broken."""
    out = F.lit(None).cast("string")
    for reason, keep in reversed(rules):
        out = F.when(~F.coalesce(F.expr(keep), F.lit(False)), reason).otherwise(out)
    return out


def islands(df: DataFrame, partition: list[str], order: str, flag: Column) -> DataFrame:
    """df with `island`: rows of a partition in order get a new number whenever flag changes."""
    w = Window.partitionBy(*partition).orderBy(order)
    changed = F.coalesce((flag != F.lag(flag).over(w)).cast("int"), F.lit(1))
    return df.withColumn("_changed", changed).withColumn("island", F.sum("_changed").over(w)).drop("_changed")


def merged_intervals(df: DataFrame, partition: list[str], start: str, end: str, gap: float, least: float) -> DataFrame:
    """Intervals joined where the next begins within gap of the furthest end so far; those shorter than least go."""
    w = Window.partitionBy(*partition).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col(start) - reach > gap).cast("int"), F.lit(1))
    out = df.withColumn("_new", new).withColumn("_group", F.sum("_new").over(w)).groupBy(*partition, "_group").agg(F.min(start).alias(start), F.max(end).alias(end))
    return out.where(F.col(end) - F.col(start) >= least).drop("_group")


def ring_pick(df: DataFrame, rank: str, total: Column, seed: str, key: str, k: int) -> Column:
    """The rank of the k-th random partner among total rows ranked from 0: any but the row itself, the same at every run."""
    text = F.concat_ws(":", F.lit(seed), F.col(key).cast("string"), F.lit(str(k)))
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (F.col(rank) + 1 + h % F.greatest(total - 1, F.lit(1))) % total


def negatives(rows: DataFrame, key: str, seed: str, picks: int) -> DataFrame:
    """rows with k and at_<column> for every column of a partner: `picks` times any other row, the same at every run."""
    rows = numbered(rows, key, "r")
    total = F.broadcast(rows.agg(F.count("*").alias("n")))  # one row
    wide = rows.join(total)
    chosen = [wide.withColumn("k", F.lit(k)).withColumn("at", ring_pick(wide, "r", F.col("n"), seed, key, k)) for k in range(picks)]
    both = chosen[0]
    for c in chosen[1:]:
        both = both.unionByName(c)
    return both.drop("n", "r").join(rows.select(*[F.col(c).alias(f"at_{c}") for c in rows.columns if c != "r"], F.col("r").alias("at")), "at").drop("at")
