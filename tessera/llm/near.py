"""MinHash near-duplicates with sequential Bayesian verification of banded candidates.

1. Documents with the same set of shingles form a class; only classes go on.
2. Signatures of 40 bands of 6 rows. Two sets of similarity 0.8 share no band with probability under 6e-6.
3. In each bucket of the first 8 bands every class is compared with its leader, the smallest: linear in the bucket, whatever its
   size. Links found join components. The same follows for buckets of all bands that still hold several components.
4. In buckets that even then hold several components, all pairs across components are compared, in cells of two blocks of
   about 1024 classes, inside the workers, a pair in the first of its common buckets only. Cells hold the sets as 32-bit hashes beside the
   signatures; a pair leaves its worker only if it is a link or within SLACK shingles of one.
5. Comparing goes through the signatures batch by batch; a pair goes when the posterior probability (uniform prior)
   that its similarity reaches the threshold is below MISS. Survivors are verified on the full sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .graph import components
from .runtime import Scratch, prepare, table
from .words import chunks, shingle_sets

BANDS, ROWS, BATCH = 40, 6, 16
HASHES = BANDS * ROWS
#: Probability at which a pair that is a link may be pruned at one batch.
MISS = 1e-6
BLOCK, FIRST = 1024, 8
#: Shingles by which collisions of 32-bit hashes may hide a link: so many, and so many more for each (2^16)^2 pairs of shingles. Sets of n and m
#: shingles have (n + m)^2 / 2^33 collisions in the mean, an eighth of what the second allows.
SLACK, COLLISIONS = 3, 4
#: Most documents looked up by a broadcast of their ids (8 bytes each); more are joined by shuffles.
FEW = 200_000
_rng = np.random.default_rng(20240229)
_A = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]


def signature(s: np.ndarray) -> np.ndarray:
    """The upper 16 bits of the least value of each of the hash functions over the set s."""
    out = np.full((HASHES, 1), 0xFFFFFFFF, np.uint32)
    x = (s >> np.uint64(32)).astype(np.uint32) ^ s.astype(np.uint32)
    for i in range(0, len(x), 2048):
        h = x[None, i : i + 2048] * _A + _B
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        out = np.minimum(out, h.min(axis=1, keepdims=True))
    return (out[:, 0] >> np.uint32(16) ^ out[:, 0] & np.uint32(0xFFFF)).astype(np.uint16)


def least_matches(threshold: float, miss: float) -> dict[int, int]:
    """For each number of compared rows, the least number of matches with P(similarity >= threshold | matches) >= miss."""
    out = {}
    for n in range(BATCH, HASHES + 1, BATCH):
        # with a uniform prior the posterior is Beta(m+1, n-m+1); P(S >= t) = P(Binomial(n+1, t) <= m)
        total, m = 0.0, 0
        while True:
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= miss or m == n:
                break
            m += 1
        out[n] = m
    return out


def surviving(a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Indices of the rows of a and b (signatures) that no batch prunes."""
    alive, got = np.arange(len(a)), np.zeros(len(a), np.int32)
    for n in range(BATCH, HASHES + 1, BATCH):
        if not len(alive):
            break
        got = got + (a[alive, n - BATCH : n] == b[alive, n - BATCH : n]).sum(axis=1)
        ok = got >= least[n]
        alive, got = alive[ok], got[ok]
    return alive


def _sketch(k: int):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            n, key, sig = [], [], []
            for part in chunks(texts):
                for s in shingle_sets(part, k):
                    n.append(len(s))
                    key.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "n_shingles", "set_key", "sig"])

    return run


def _bands(batches):
    for batch in batches:
        nodes = batch.column(0).to_numpy(zero_copy_only=False)
        sigs = batch.column(1).to_pylist()
        keys = np.fromiter((xxhash.xxh3_64_intdigest(s[i : i + 2 * ROWS], seed=i) - (1 << 63) for s in sigs for i in range(0, 2 * HASHES, 2 * ROWS)), np.int64, len(sigs) * BANDS)
        band = np.tile(np.arange(BANDS, dtype=np.int32), len(sigs))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(nodes, BANDS)), pa.array(band)], names=["bucket", "node", "band"])


def _prune(least):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, HASHES) for i in (2, 3))
                kept = pa.array(surviving(a, b, least))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept)], names=["u", "v"])

    return run


def _bags(k: int):
    """The sets of the texts as sorted 32-bit hashes."""

    def run(batches):
        for batch in batches:
            bags = [np.unique(x.astype(np.uint32)).tobytes() for part in chunks(batch.column(1).to_pylist()) for x in shingle_sets(part, k)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bags, pa.binary())], names=["node", "bag"])

    return run


def _cell(least, percent: int):
    def run(t: pa.Table) -> pa.Table:
        node, comp, block = (t.column(c).to_numpy() for c in ("node", "comp", "block"))
        i, j, band = (t.column(c)[0].as_py() for c in ("i", "j", "band"))
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)
        bags = [np.frombuffer(b, np.uint32) for b in t.column("bag").to_pylist()]
        size = np.array([len(b) for b in bags])
        left = np.flatnonzero(block == i)
        right = left if i == j else np.flatnonzero(block == j)
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x in left:
            y = right[(comp[right] != comp[x]) & ((right > x) | (i != j))]
            y = y[surviving(np.broadcast_to(sig[x], (len(y), HASHES)), sig[y], least)]
            if band and len(y):
                y = y[~(sig[x, : band * ROWS] == sig[y, : band * ROWS]).reshape(len(y), band, ROWS).all(axis=2).any(axis=1)]
            if len(y):
                flat, mine = np.concatenate([bags[v] for v in y]), bags[x]
                hit = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat
                both = np.add.reduceat(hit, np.concatenate([[0], np.cumsum(size[y])[:-1]]), dtype=np.int64) + SLACK
                both += (COLLISIONS * ((size[x] + size[y]) / 65536) ** 2).astype(np.int64)
                y = y[100 * both >= percent * (size[x] + size[y] - both)]
                us.append(np.full(len(y), node[x]))
                vs.append(node[y])
        return pa.table({"u": np.concatenate(us), "v": np.concatenate(vs)})

    return run


def _similar(k: int, percent: int):
    def run(batches):
        text, b = None, None  # the pairs of one v follow one another: its set is made once for many of them
        for batch in batches:
            u, v = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            sets = [s for part in chunks(batch.column(2).to_pylist()) for s in shingle_sets(part, k)]
            ok = []
            for a, other in zip(sets, batch.column(3).to_pylist(), strict=True):
                if b is None or other != text:
                    text, b = other, shingle_sets([*chunks([other])][0], k)[0]
                both = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(bool(len(a) and len(b)) and 100 * both >= percent * (len(a) + len(b) - both))
            ok = np.array(ok, bool)
            yield pa.RecordBatch.from_arrays([pa.array(u[ok]), pa.array(v[ok])], names=["u", "v"])

    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text; other columns are ignored).

    Documents are linked when the Jaccard similarity of their sets of k-word shingles is percent/100 or more.
    Null and empty texts have an empty set and no link; texts of fewer than k words have their sequence as one shingle.
    Rows with the same doc_id count as one document of that id; one without doc_id belongs to its class but is never kept;
    an empty table gives an empty table.
    """
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark)
    least = least_matches(percent / 100, miss)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = scratch.save(docs.mapInArrow(_sketch(k), "doc_id long, n_shingles long, set_key binary, sig binary"), "sketches")
    reps = scratch.save(rows.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("node"), F.min("sig").alias("sig")), "classes")
    member = scratch.save(rows.select("doc_id", "n_shingles", "set_key").join(reps.select("set_key", "node"), "set_key", "left").select("doc_id", "n_shingles", "node"), "members")
    sigs = reps.select("node", "sig")
    placed = sigs.mapInArrow(_bands, "bucket long, node long, band int")
    full = scratch.save(placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("leader")).where("n > 1"), "leaders")
    placed = scratch.save(placed.join(full, "bucket").select("bucket", "node", "band", "leader"), "buckets")

    def checked(pairs: DataFrame) -> DataFrame:
        """Of pairs (u, v), those that the posterior bounds let through."""
        both = pairs.join(sigs.select(F.col("node").alias("u"), F.col("sig").alias("a")), "u").join(sigs.select(F.col("node").alias("v"), F.col("sig").alias("b")), "v")
        return both.select("u", "v", "a", "b").mapInArrow(_prune(least), "u long, v long")

    def looked_up(ids: DataFrame) -> DataFrame:
        """The rows of docs with these doc_ids, a written table."""
        return docs.join(F.broadcast(ids) if ids.count() <= FEW else ids, "doc_id", "left_semi")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = scratch.save(pairs.distinct(), "survivors")
        texts = looked_up(scratch.save(pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), "wanted"))
        both = pairs.join(texts.select(F.col("doc_id").alias("u"), F.col("text").alias("a")), "u").join(texts.select(F.col("doc_id").alias("v"), F.col("text").alias("b")), "v")
        return scratch.save(both.select("u", "v", "a", "b").mapInArrow(_similar(k, percent), "u long, v long").distinct(), "verified")

    def star(rows: DataFrame) -> DataFrame:
        return rows.where("node <> leader").select(F.greatest("node", "leader").alias("u"), F.least("node", "leader").alias("v")).distinct()

    def with_components(comp: DataFrame) -> DataFrame:
        return placed.join(comp, "node", "left").select("bucket", "node", "band", "leader", F.coalesce("component", "node").alias("comp"))

    links = verified(checked(star(placed.where(F.col("band") < FIRST))))
    comp = scratch.save(components(scratch, links), "components")
    led = with_components(comp).join(comp.select(F.col("node").alias("leader"), F.col("component").alias("other")), "leader", "left")
    links = links.unionByName(verified(checked(star(led.where("comp <> coalesce(other, leader)")))))
    comp = scratch.save(components(scratch, links), "components")
    placed = with_components(comp)
    mixed = scratch.save(placed.groupBy("bucket").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.count("*").alias("n")).where("a <> b and n > 2").select("bucket", "n"), "mixed")
    cells = (
        placed.join(mixed, "bucket")
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "comp", "block")
    )
    cells = scratch.save(cells, "cells")
    wanted = scratch.save(cells.select("node").distinct(), "wanted")
    bags = looked_up(wanted.withColumnRenamed("node", "doc_id")).mapInArrow(_bags(k), "node long, bag binary").distinct()
    cells = cells.join(sigs.join(bags, "node"), "node")
    rest = cells.groupBy("bucket", "i", "j").applyInArrow(_cell(least, percent), "u long, v long").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = links.unionByName(verified(rest))
    comp = scratch.save(components(scratch, links), "components")
    scratch.keep(member, comp)
    out = member.join(comp, "node", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "node", "doc_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=2)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicates: the one with the smallest doc_id, rows without one last.

    Each row is compared by itself, whatever its doc_id: of rows that share one and have near-duplicate texts one stays, different texts all stay,
    and rows without a doc_id are kept or dropped as others are. Null texts and those without words are alone in their groups and stay.
    An empty table gives an empty one.
    """
    scratch = Scratch(prepare(spark))
    rows = scratch.save(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text")).select(F.col("doc_id").alias("__row"), "component_id")
    both = found.join(rows.select("__row", "doc_id"), "__row")
    kept = both.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row")).alias("best")).select(F.col("best.__row").alias("__row"))
    return rows.join(kept, "__row", "left_semi").select(docs.columns)


ORACLE_OP3 = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(s) AS s FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) < 2 THEN [array_to_string(words, ' ')]
      ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS s FROM w)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS m FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT u, v FROM pairs JOIN n nu ON nu.doc_id = u JOIN n nv ON nv.doc_id = v WHERE 100 * m >= 80 * (nu.n + nv.n - m)
), both_ways AS MATERIALIZED (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT b.v, reach.r FROM reach JOIN both_ways b ON b.u = reach.doc_id WHERE reach.r < b.v
), c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""
