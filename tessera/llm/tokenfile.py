"""Token-id files: documents' ids in ascending doc_id order, range-coded, written and read back by Spark."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .rangecoder import decode_frame, encode_frame
from .runtime import Scratch, prepare, table
from .tokens import END, encoder

#: Ids in a frame, about; a frame is held in memory. Frames in a file, which is read whole.
FRAME, FRAMES = 1 << 23, 4
#: What a null doc_id is in a file.
NULL = -(1 << 63)


def _frames(path: str, glue: str, frame: int):
    def run(batches):
        encode = encoder(path, glue)
        end = np.array([END], "<u4").tobytes()
        docs, lengths, ids, n = [], [], [], 0
        for batch in batches:
            for doc_id, own in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                docs.append(NULL if doc_id is None else doc_id)
                lengths.append(len(own) // 4 + 1)
                ids += (own, end)
                n += len(own) // 4 + 1
                if n >= frame:
                    yield _packed(docs, lengths, ids)
                    docs, lengths, ids, n = [], [], [], 0
            ids = [_narrow(ids)] if ids else []
        if docs:
            yield _packed(docs, lengths, ids)

    return run


def _narrow(ids: list[bytes | np.ndarray]) -> np.ndarray:
    """Ids of 16 bits, of which the first entry may hold some already, and the others as bytes of 32 bits."""
    head = [ids[0]] if isinstance(ids[0], np.ndarray) else []
    wide = np.frombuffer(b"".join(ids[len(head) :]), "<u4")
    if wide.max(initial=0) > 0xFFFF:
        raise ValueError("ids over 65535 can't be written")
    return np.concatenate([*head, wide.astype(np.uint16)])


def _packed(docs, lengths, ids):
    return pa.RecordBatch.from_arrays([pa.array([encode_frame(np.array(docs, np.int64), np.array(lengths, np.int64), _narrow(ids))], pa.binary())], names=["frame"])


def write_token_files(docs: DataFrame, at: str, path: str, glue: str = "", frame: int = FRAME) -> None:
    """Files part-00000-...-c000, ... of at most FRAMES frames with a line feed after each, in the order of doc_id: first by the part's number, then by c.

    docs has doc_id and text; other columns are ignored; a null text is empty; each document ends with the end id. Rows without a doc_id come
    first; rows that share one follow one another in the order of a hash of their texts, each written. A frame ends with the document that fills it, so a very
    long text makes a longer frame. An empty table gives no frame.
    """
    spark = prepare(docs.sparkSession)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows.mapInArrow(_frames(path, glue, frame), "frame binary").select(F.col("frame").cast("string").alias("value")).write.option("maxRecordsPerFile", FRAMES).text(at)


def frames(data: bytes):
    """doc_ids, lengths and ids of each frame of a file; raises ValueError if one is damaged."""
    at = 0
    while at < len(data):
        *out, at = decode_frame(data, at)
        if data[at : at + 1] != b"\n":
            raise ValueError("no line feed behind a frame")
        at += 1
        yield out


def _read(batches):
    for batch in batches:
        for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part, c = re.search(r"part-(\d+).*-c(\d+)", name).groups()
            file, before = (int(part) << 32) + int(c), 0
            for doc_ids, lengths, ids in frames(data.as_py()):
                wide, bounds = ids.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
                crc = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                known = pa.array(doc_ids, mask=doc_ids == NULL)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(lengths), file)), known, pa.array(before + bounds[:-1]), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())], names=["file", "doc_id", "at", "n_tokens", "ids_crc32"])
                before += int(bounds[-1])


def read_token_files(scratch: Scratch, at: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, start being the ids of all documents before it: a row for each
    row written, those without a doc_id first, repeated ones each; empty texts have the end id alone; no file or frame gives no row."""
    files = scratch.spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(at).select("path", "content")
    rows = scratch.save(files.mapInArrow(_read, "file long, doc_id long, at long, n_tokens long, ids_crc32 long"), "read")
    sums = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))  # a row for each file
    sums = sums.selectExpr("file", "coalesce(sum(n) over (order by file rows between unbounded preceding and 1 preceding), 0L) as before")
    return rows.join(sums, "file").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    at = scratch.path("token-files")
    write_token_files(table(spark, sf_dir, "documents"), at, tokenizer_path())
    return read_token_files(scratch, at)
