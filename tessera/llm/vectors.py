"""Exact top-k search by multi-resolution segment statistics, and near-duplicate embeddings by spherical-cap filters."""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .graph import components
from .runtime import Scratch, prepare, table

#: Queries searched by one pass over the candidates, in expectation.
QUERY_BLOCK = 4096
#: Numbers of segments, coarse to fine.
LEVELS = (4, 16)
#: For tables of a few vectors: codewords of each half of the product code, and the cap's distance from the origin in standard deviations.
CODEWORDS, CAP = 96, 2.8
#: Vectors of a filter, about, where directions are random, in any larger table, and filters that a pair at the threshold then shares in the mean.
FILTER, SHARED = 128, 16
#: Least number of filters of a vector, rows of a block.
LEAST, CELL = 24, 1024

WHOLE = "embedding is not null and size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Scaled means and deviations of each row's segments. For two rows the dot product of their features bounds their
    inner product from above (Cauchy-Schwarz on the deviations), hence |a|^2 + |b|^2 - 2 * it bounds their squared distance from below."""
    cuts = [c for c in np.array_split(np.arange(x.shape[1]), segments) if len(c)]
    out = np.empty((len(x), 2 * len(cuts)))
    for i, c in enumerate(cuts):
        part = x[:, c[0] : c[-1] + 1]
        mean = part.mean(axis=1)
        out[:, i] = mean * math.sqrt(len(c))
        out[:, len(cuts) + i] = np.sqrt(np.maximum(((part - mean[:, None]) ** 2).sum(axis=1), 0))
    return out


class Best:
    """The k best candidates so far of each query: higher score first, then smaller id."""

    def __init__(self, n: int, k: int):
        self.k, self.n = k, n
        self.q = np.zeros(0, np.int64)
        self.id, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.floor = np.full(n, -np.inf)

    def add(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        q, ids, score = np.concatenate([self.q, q]), np.concatenate([self.id, ids]), np.concatenate([self.score, score])
        order = np.lexsort((ids, -score, q))
        q, ids, score = q[order], ids[order], score[order]
        first = np.searchsorted(q, q)
        rank = np.arange(len(q)) - first
        keep = rank < self.k
        self.q, self.id, self.score = q[keep], ids[keep], score[keep]
        full = rank[keep] == self.k - 1
        self.floor[self.q[full]] = self.score[full]


def search_chunk(best: Best, q_ids, q, q_features, ids, x) -> None:
    """Search the candidates x for all queries: bounds of each level prune pairs, exact scores decide among survivors."""
    slack = 1e-9
    alive = None
    for level, fq in zip(LEVELS, q_features, strict=True):
        fx = segment_features(x, level)
        norm = np.linalg.norm(fq, axis=1)[:, None] * np.linalg.norm(fx, axis=1)[None, :]
        if alive is None or len(alive[0]) > len(q) * len(x) // 8:
            mask = fq @ fx.T + slack * norm + 0.5 >= best.floor[:, None]
            if alive is not None:
                keep = mask[alive]
                alive = (alive[0][keep], alive[1][keep])
            else:
                alive = np.nonzero(mask)
        else:
            a, b = alive
            keep = np.einsum("ij,ij->i", fq[a], fx[b]) + slack * norm[a, b] + 0.5 >= best.floor[a]
            alive = (a[keep], b[keep])
    a, b = alive
    other = q_ids[a] != ids[b]
    a, b = a[other], b[other]
    if len(a) > len(q) * len(x) // 16:
        score = (q @ x.T)[a, b] if max(abs(q).max(initial=0), 1) * max(abs(x).max(initial=0), 1) * q.shape[1] < 2**52 else (q.astype(np.int64) @ x.astype(np.int64).T)[a, b]
    else:
        score = np.einsum("ij,ij->i", q[a].astype(np.int64), x[b].astype(np.int64))
    score = score.astype(np.int64)
    keep = score >= best.floor[a]
    best.add(a[keep], ids[b][keep], score[keep])


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k best candidates by integer inner product, exactly.

    Both tables have vec_id and ints (array<long>; |ints| < 2^31, scores within 64 bits). Rows with null ints or vec_id take no part.
    A candidate with the query's own vec_id isn't one of its candidates; only vectors of the same length are compared; ties go to
    the smaller vec_id; repeated rows are candidates each; a query id that occurs twice counts once. Empty tables give an empty one.
    Queries go in blocks of about QUERY_BLOCK: each is sent to the workers that scan all candidates once.
    """
    spark = prepare(candidates.sparkSession)
    scratch = Scratch(spark)
    queries = queries.where("ints is not null and vec_id is not null").groupBy("vec_id").agg(F.min("ints").alias("ints"))
    candidates = candidates.where("ints is not null and vec_id is not null").select("vec_id", "ints")
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    out = None
    for block in range(blocks):
        here = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow()
        sent = spark.sparkContext.broadcast((here.column("vec_id").to_numpy(), here.column("ints").to_pylist()))
        part = candidates.mapInArrow(_searcher(sent, k), "query_id long, vec_id long, score long")
        rank = F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
        part = scratch.save(part.withColumn("rank", rank).where(F.col("rank") <= k), f"block{block}")
        sent.unpersist()
        out = part if out is None else out.unionByName(part)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _searcher(sent, k: int):
    def run(batches):
        ids, vectors = sent.value
        groups = {}
        for n in {len(v) for v in vectors}:
            at = [i for i, v in enumerate(vectors) if len(v) == n]
            q = np.array([vectors[i] for i in at], float).reshape(len(at), n)
            groups[n] = (ids[at], q, [segment_features(q, s) for s in LEVELS], Best(len(at), k))
        for batch in batches:
            lists = batch.column(1)
            size = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
            start = lists.offsets.to_numpy() - (lists.offsets[0].as_py() if len(lists) else 0)
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for n in np.unique(size):
                if n in groups and n:
                    at = np.flatnonzero(size == n)
                    x = flat[start[at][:, None] + np.arange(n)]
                    q_ids, q, features, best = groups[n]
                    for lo, hi in ((0, 64), (64, 256), *((i, i + 1024) for i in range(256, len(at), 1024))):
                        if lo < len(at):
                            search_chunk(best, q_ids, q, features, own[at][lo:hi], x[lo:hi])
        for q_ids, _, _, best in groups.values():
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[best.q]), pa.array(best.id), pa.array(best.score)], names=["query_id", "vec_id", "score"])

    return run


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    ints = F.when(F.expr(WHOLE), F.expr("transform(embedding, x -> floor(256 * cast(x as double)))")).alias("ints")
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), ints)
    return top_k(rows.where("vec_id % 50 = 0"), rows, 5)


ORACLE_OP4 = """
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@cache
def book_size(vectors: int, d: int, threshold: float) -> tuple[int, float]:
    """Codewords of each half and the cap for a table of so many vectors of d dimensions.

    The cap rises with the table, so that a filter's share of random directions is FILTER / vectors at most, and the codewords with it, so that a pair at
    the threshold shares SHARED filters in the mean: filters hold as many vectors however large the table, and a vector joins but few more of them.
    Both follow from the exact distribution of one coordinate of a random direction. Under 8 dimensions there is no room for more filters.
    """
    if d < 8 or not 0 < threshold < 1 or vectors * 0.0026 <= FILTER:
        return CODEWORDS, CAP
    s = np.linspace(-1, 1, 20_001)
    with np.errstate(divide="ignore"):
        density, other = ((1 - s * s) ** ((n - 3) / 2) for n in (d, d - 1))
    density, other = density / density.sum(), other / other.sum()
    beyond = np.cumsum(other[::-1])[::-1]  # of a coordinate in d - 1 dimensions

    def shares(cap: float) -> tuple[float, float]:
        """Of random directions that exceed the cap, and that two vectors at the threshold both exceed."""
        level = cap / math.sqrt(d)
        at = s[s >= level][:-1]
        need = (level - threshold * at) / (math.sqrt(1 - threshold**2) * np.sqrt(1 - at * at))
        return float(density[s >= level].sum()), float((density[s >= level][:-1] * np.where(need > 1, 0, beyond[np.searchsorted(s, np.clip(need, -1, 1)).clip(max=len(s) - 1)])).sum())

    cap = CAP
    while shares(cap)[0] * vectors > FILTER and cap < 0.9 * math.sqrt(d):
        cap += 0.05
    return max(CODEWORDS, math.ceil(math.sqrt(SHARED / max(shares(cap)[1], 1e-12)))), cap


def codebook(n: int, codewords: int) -> list[np.ndarray]:
    """Random codewords for each half of the dimensions; a pair of one from each is a unit vector, a filter's direction."""
    rng = np.random.default_rng(n * 1_000_003 + codewords)
    halves = [h for h in np.array_split(np.arange(n), 2) if len(h)]
    out = []
    for h in halves:
        c = rng.standard_normal((codewords, len(h)))
        out.append(c / np.linalg.norm(c, axis=1, keepdims=True) * math.sqrt(len(h) / n))
    return out


@cache
def rotation(n: int) -> np.ndarray:
    """A fixed random orthogonal matrix. It spreads the energy of any vector over both halves of the dimensions, and keeps cosines."""
    q, r = np.linalg.qr(np.random.default_rng(n * 1_000_003 + 1).standard_normal((n, n)))
    return q * np.where(np.diag(r) < 0, -1.0, 1.0)


def decode(x: np.ndarray, books: list[np.ndarray], cap: float, least: int = LEAST) -> list[np.ndarray]:
    """For each unit row of x the numbers of all filters whose direction it exceeds by the cap, ascending; the `least` best ones at least,
    since halves of unequal length leave some vectors with few. Only codewords of the first half that reach the cap with the best of the second are
    paired, each with a beginning of the second's in the order of their products; the best pairs lie among the best of either half."""
    n = x.shape[1]
    level = cap / math.sqrt(n)
    cut = books[0].shape[1]
    out = []
    for at in range(0, len(x), max(1, (1 << 20) // len(books[0]))):
        part = x[at : at + max(1, (1 << 20) // len(books[0]))]
        first = part[:, :cut] @ books[0].T
        second = part[:, cut:] @ books[1].T if len(books) > 1 else np.zeros((len(part), 1))
        m = second.shape[1]
        order = np.argsort(-second, axis=1)
        for one, two, best in zip(first, second, order, strict=True):
            falling = -two[best]
            a = np.flatnonzero(one + two[best[0]] >= level)
            many = np.searchsorted(falling, one[a] - level, side="right")
            k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            codes = np.repeat(a, many) * m + best[k]
            if len(codes) < least:
                head = np.argsort(-one)[:least]
                some = (one[head][:, None] + two[best[:least]][None, :]).ravel()
                numbers = (head[:, None] * m + best[:least][None, :]).ravel()
                codes = numbers[np.lexsort((numbers, -some))[:least]]
            out.append(np.sort(codes))
    return out


def _filters(book):
    """Each vector as it came, in bytes, with its filters. book: codewords and cap for a number of dimensions."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            size, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False)
            start = np.concatenate([[0], np.cumsum(size)])
            filters: list[np.ndarray] = [None] * len(size)
            for n in np.unique(size).tolist():
                at = np.flatnonzero(size == n)
                x = flat[start[at][:, None] + np.arange(n)].astype(float)
                unit = x / np.abs(x).max(axis=1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                codewords, cap = book(n)
                for i, own in zip(at, decode(unit @ rotation(n), codebook(n, codewords), cap), strict=True):
                    filters[i] = (n << 40) + own.astype(np.int64)
            vec = pa.array([flat[a:b].tobytes() for a, b in zip(start[:-1], start[1:], strict=True)], pa.binary())
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in filters])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), vec, pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(filters) if filters else np.zeros(0, np.int64)))], names=["node", "mult", "vec", "filters"])

    return run


def _forest(mask: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph with this symmetric adjacency."""
    left, out = mask.any(axis=1), []
    while left.any():
        root = int(left.argmax())
        left[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            new = np.flatnonzero(mask[at] & left)
            left[new] = False
            out += [(at, int(x)) for x in new]
            queue += new.tolist()
    return out


def _linked(threshold: float, kind: str):
    def run(t: pa.Table) -> pa.Table:
        node, mult, block = (t.column(c).to_numpy() for c in ("node", "mult", "block"))
        i, j = (t.column(c)[0].as_py() for c in ("i", "j"))
        x = np.frombuffer(b"".join(t.column("vec").to_pylist()), kind).reshape(len(node), -1).astype(float)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        norm = np.sqrt((x * x).sum(axis=1))
        cosine = (x @ x.T) / (norm[:, None] * norm[None, :])
        mask = cosine >= threshold
        for a, b in np.argwhere(np.abs(np.triu(cosine, 1) - threshold) < 1e-12):  # the same value in either order
            mask[a, b] = mask[b, a] = float(np.dot(x[a], x[b])) / (norm[a] * norm[b]) >= threshold
        mask &= (block[:, None] != block[None, :]) | (i == j)
        np.fill_diagonal(mask, False)
        at = np.flatnonzero(mask.any(axis=1))
        if not len(at):
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        node, mult, mask = node[at], mult[at], mask[np.ix_(at, at)]
        edges = _forest(mask.copy())
        codes = [np.array(c, np.int64) for c in t.column("filters").take(pa.array(at)).to_pylist()]
        low = np.unique(np.concatenate(codes))
        if len(low):  # a pair counts in the first of its common filters only
            one = np.zeros((len(at), len(low)), np.float32)
            for r, c in enumerate(codes):
                one[r, np.searchsorted(low, c)] = 1
            mask = mask & ~(one @ one.T > 0)
        n = mask @ mult
        own = np.flatnonzero(n)
        u = np.concatenate([node[own], node[[a for a, _ in edges]]])
        v = pa.array([None] * len(own) + node[[b for _, b in edges]].tolist(), pa.int64())
        return pa.table({"u": pa.array(u), "v": v, "n": pa.array(np.concatenate([n[own], np.zeros(len(edges), np.int64)]))})

    return run


def near_vectors(rows: DataFrame, threshold: float = 0.9, codewords: int | None = None, cap: float | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of rows (vec_id, embedding; other columns are ignored).

    Vectors that share a spherical-cap filter after a random rotation are compared by cosine in double precision; filters follow from the number of
    different vectors (book_size) unless codewords and cap are given. Equal vectors form one class with a count, so a
    large group of copies costs as one vector; a filter's vectors are compared in cells of two blocks of about CELL. A pair with the
    threshold's cosine is missed when no filter holds both; the README has the recall by brute force.
    Null, zero, empty and partly null or non-finite vectors link with nothing, nor do vectors of different lengths.
    Repeated rows link with each other; a row without vec_id counts among its equals but is never kept; an empty table gives an empty table.
    """
    spark = prepare(rows.sparkSession)
    scratch = Scratch(spark)
    kind = "f4" if dict(rows.dtypes)["embedding"] == "array<float>" else "f8"
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.expr(f"case when {WHOLE} and exists(embedding, x -> x <> 0) then embedding end").alias("embedding"))
    if kind == "f8":
        rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    classes = scratch.save(rows.where("embedding is not null").groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("mult")), "classes")
    member = rows.join(classes, "embedding", "left").select("vec_id", "node", "mult")
    size = classes.count()

    def book(d: int) -> tuple[int, float]:
        return (codewords, cap) if codewords and cap else book_size(size, d, threshold)

    coded = scratch.save(classes.where("node is not null").select("node", "embedding", "mult").mapInArrow(_filters(book), "node long, mult long, vec binary, filters array<long>"), "filters")
    hits = coded.select("node", F.explode("filters").alias("filter"))
    sizes = scratch.save(hits.groupBy("filter").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    cells = (
        hits.join(sizes, "filter")
        .withColumn("blocks", F.ceil(F.col("n") / CELL).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("filter", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "block")
    )
    # of a vector's filters only those before the cell's own are asked for
    whole = cells.join(coded, "node").withColumn("filters", F.expr("filter(filters, x -> x < filter)"))
    found = scratch.save(whole.groupBy("filter", "i", "j").applyInArrow(_linked(threshold, kind), "u long, v long, n long"), "links")
    scratch.drop(coded)
    counts = scratch.save(found.where("v is null").groupBy("u").agg(F.sum("n").alias("far")), "counts")
    comp = scratch.save(components(scratch, found.where("v is not null").select("u", "v")), "components")
    scratch.keep(classes, counts, comp)
    out = member.join(counts, member.node == counts.u, "left").join(comp, "node", "left")
    return out.select("vec_id", F.expr("coalesce(far, 0L) + coalesce(mult - 1, 0L)").alias("n_links"), F.coalesce("component", "node", "vec_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE_OP8 = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach(vec_id, r) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT l.v, reach.r FROM reach JOIN links l ON l.u = reach.vec_id WHERE reach.r < l.v
), c AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id)
SELECT c.vec_id, (SELECT count(*) FROM links WHERE u = c.vec_id)::BIGINT AS n_links, component_id, c.vec_id = component_id AS kept FROM c
"""
