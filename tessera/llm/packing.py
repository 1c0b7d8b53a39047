"""Best-fit packing by exact-complement hashing."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .runtime import Scratch, prepare, table
from .tokens import END, encoder

LENGTH = 1024
#: Parts in which pieces of one length are numbered.
SALTS = 1024


def plan(counts: list[int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """The plan with the fewest sequences among those that fill gaps by up to three, two or one pieces."""
    return min((filled(counts, length, depth) for depth in (3, 2, 1)), key=lambda p: sum(n for _, n in p))


def filled(counts: list[int], length: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of the pieces of a sequence) with how many sequences follow each, from the number of pieces of each length.

    The longest pieces come first. The gap behind one is looked up among single lengths, sums of two and sums of three (up to `depth`), under
    what is still available, and each combination that fills it exactly is used as often as it can be. What is left goes, longest first,
    into the sequence with the smallest gap that holds it. Work depends on the distinct lengths only, never on the number of pieces.
    """
    left = np.array(counts, np.int64)
    out: list[tuple[tuple[int, ...], int]] = []

    def times(pattern) -> int:
        return int(min(left[x] // n for x, n in Counter(pattern).items()))

    def combinations(size: int, gap: int):
        there = left > 0
        if gap <= length and there[gap]:
            yield (size, gap)
        if depth < 2:
            return
        for a in np.flatnonzero(there[(gap + 1) // 2 : gap] & there[gap // 2 : 0 : -1][: gap - (gap + 1) // 2])[::-1] + (gap + 1) // 2 if gap > 1 else ():
            yield (size, int(a), gap - int(a))
        if depth < 3:
            return
        sums = np.convolve(there.astype(np.float32), there.astype(np.float32))[: length + 1] > 0.5
        for a in np.flatnonzero(there[:gap] & sums[gap : 0 : -1])[::-1]:
            rest = gap - int(a)
            for b in range((rest + 1) // 2, rest):
                if there[b] and there[rest - b]:
                    yield (size, int(a), b, rest - b)

    if left[length]:
        out.append(((length,), int(left[length])))
        left[length] = 0
    for size in range(length - 1, 0, -1):
        while left[size]:
            for pattern in combinations(size, length - size):
                if n := times(pattern):
                    out.append((pattern, n))
                    for x in pattern:
                        left[x] -= n
                    break
            else:
                break
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for size in range(length - 1, 0, -1):
        while left[size]:
            gap = next((g for g in range(size, length) if open_.get(g)), None)
            if gap is None:
                fits = length // size if left[size] >= length // size else int(left[size])
                pattern, n = (size,) * fits, int(left[size]) // fits
            else:
                base, many = open_[gap].pop()
                n = min(many, int(left[size]))
                if many > n:
                    open_[gap].append((base, many - n))
                pattern = (*base, size)
            left[size] -= n * (len(pattern) if gap is None else 1)
            open_.setdefault(length - sum(pattern), []).append((pattern, n))
    return out + [x for group in open_.values() for x in group]


def slots(patterns: list[tuple[tuple[int, ...], int]], length: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: ranks from which the pieces of that length go to consecutive sequences, the first such sequence, and the offset."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    used, sequence = Counter(), 0
    for pattern, n in patterns:
        offset = 0
        for size in pattern:
            out.setdefault(size, []).append((used[size], sequence, offset))
            used[size] += n
            offset += size
        sequence += n
    return {size: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for size, rows in out.items()}


def _placed(sent):
    def run(batches):
        where = sent.value
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                first, base, place = where[int(n)]
                i = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at], offset[at] = base[i] + rank[at] - first[i], place[i]
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[n for n in batch.schema.names if n != "rank"] + ["sequence_id", "offset"])

    return run


def pack(scratch: Scratch, pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """pieces, a written table with doc_id, piece and length (1 to `length`), with sequence_id and offset.

    Only the number of pieces of each length goes to the driver, at most `length` numbers, and the plan for them comes back.
    Pieces of a length are numbered in SALTS parts, so one frequent length is spread over as many tasks.
    """
    counts = [0] * (length + 1)
    for size, n in pieces.groupBy("length").count().collect():
        counts[size] = n
    sent = scratch.spark.sparkContext.broadcast(slots(plan(counts, length), length))
    rows = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)))
    parts = rows.groupBy(F.col("length").alias("_length"), F.col("_salt").alias("_part")).count()
    parts = parts.withColumn("_before", F.expr("coalesce(sum(count) over (partition by _length order by _part rows between unbounded preceding and 1 preceding), 0L)"))
    rows = rows.withColumn("_own", F.expr("row_number() over (partition by length, _salt order by doc_id, piece)"))
    rows = rows.join(parts, (F.col("length") == F.col("_length")) & (F.col("_salt") == F.col("_part")))
    rows = rows.select(*pieces.columns, (F.col("_before") + F.col("_own") - 1).alias("rank"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return rows.mapInArrow(_placed(sent), f"{fields}, sequence_id long, offset long")


def _pieces(path: str, glue: str, length: int):
    def run(batches):
        encode = encoder(path, glue)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            out = ([], [], [], [], [])
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                a, piece = 0, 0
                while a < n:
                    b = a + ((n - a) % length or length)
                    for column, value in zip(out, (doc_id, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])), strict=True):
                        column.append(value)
                    a, piece = b, piece + 1
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *(pa.array(x, pa.int64()) for x in out[2:])], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pack_documents(docs: DataFrame, path: str, glue: str = " ", length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row of docs (doc_id, text).

    A document is its text's ids and an end id; null and empty texts are the end id alone. One longer than `length` is cut so that all
    pieces but the first are full. Repeated rows are packed each; an empty table gives an empty one; other columns are ignored.
    """
    scratch = Scratch(prepare(docs.sparkSession))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pieces(path, glue, length), "doc_id long, piece int, start long, length long, ids_crc32 long")
    return pack(scratch, scratch.save(rows, "pieces"), length)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences, as pack_documents() says, rows without a doc_id and repeated ones included."""
    return pack_documents(docs, tokenizer_path())
