"""What every operator of this subpackage shares: scratch tables on the cluster's shared folder and input reading."""

from __future__ import annotations

import atexit
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bounds of one Arrow batch sent to a Python worker, so that very long texts stay within its memory.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20
#: Spark's setting that a query's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Set the bounds of an Arrow batch for the session from here on, which change no result, and let local Python workers find this package
    (on a cluster, ship it with --py-files)."""
    home, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{home}".strip(":")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); where that is unset, in local mode as in tests, one in the warehouse."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return at or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


class Scratch:
    """Intermediate tables, written once to the shared folder and read back: they cut lineage, outlive executors,
    and go when the application ends or when drop() is called."""

    def __init__(self, spark: SparkSession):
        self.spark = prepare(spark)
        self.root = f"{shared_dir(spark).rstrip('/')}/tessera-{uuid.uuid4().hex}"
        self.n = 0
        self.saved: list[str] = []
        atexit.register(self._end)

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """df written as Parquet and read back; .scratch_path names the folder. Shuffle files of the write, which nothing reads again, go with its end
        and don't wait for the driver's garbage collection."""
        at = self.path(name)
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(at)
        finally:
            self.spark.conf.set(CLEANUP, before)
        back = self.spark.read.schema(df.schema).parquet(at)
        back.scratch_path = at
        self.saved.append(at)
        return back

    def save_parts(self, df: DataFrame, column: str, parts: int, name: str) -> list[DataFrame]:
        """df written once, as one table for each value from 0 to parts - 1 of the column, without it; each can be dropped by itself. The writers of a task are
        all open at once, so that nothing is sorted."""
        conf, key, root = self.spark.conf, "spark.sql.maxConcurrentOutputFileWriters", self.path(name)
        before = conf.get(key)
        conf.set(key, str(parts + 1))
        try:
            df.write.partitionBy(column).parquet(root)
        finally:
            conf.set(key, before)
        schema, out = df.drop(column).schema, []
        for part in range(parts):
            at = f"{root}/{column}={part}"
            path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(path)  # a part without rows has no folder
            back = self.spark.read.schema(schema).parquet(at)
            back.scratch_path = at
            self.saved.append(at)
            out.append(back)
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table made by save() that nothing will read again."""
        self.saved.remove(df.scratch_path)
        self._delete(df.scratch_path)

    def keep(self, *tables: DataFrame) -> None:
        """Delete all tables made by save() but these, on which the result rests."""
        kept = {t.scratch_path for t in tables}
        for at in [x for x in self.saved if x not in kept]:
            self.saved.remove(at)
            self._delete(at)

    def _delete(self, at: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _end(self) -> None:
        if self.spark.sparkContext._jsc is not None:
            try:
                self._delete(self.root)
            except Exception:  # the JVM may be gone already at interpreter exit
                pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
