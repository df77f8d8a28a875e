"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
# Order lines take a third less disk than in Spark's default, for about the same time.
CODEC = "zstd"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder; a cluster without one is an error,
    because no machine-local folder outlives a lost executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillroll-"))
    return spark.sparkContext.getCheckpointDir()


class Scratch:
    """A folder of its own for the intermediate tables of one job.

    What nobody has cleared by then goes when the driver's Python ends: the result of a query
    may read its folder until that time.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/tillroll-{uuid.uuid4()}"
        self._tables = 0
        atexit.register(self._clear_at_exit)

    def new_path(self, name: str) -> str:
        self._tables += 1
        return f"{self.path}/{self._tables:03d}-{name}"

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and go on from the files: later reads neither recompute the plan nor
        depend on executors that may be gone."""
        path = self.new_path(name)
        write_compact(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Delete this job's folder, and nothing else."""
        atexit.unregister(self._clear_at_exit)
        delete_folder(self.spark, self.path)

    def _clear_at_exit(self) -> None:
        if self._tables and SparkContext._active_spark_context is not None:
            delete_folder(self.spark, self.path)


def _bytes(size: str) -> int:
    """A size as settings have it: 134217728b, 128m, 1g."""
    number, unit = re.fullmatch(r"([0-9]+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def write_compact(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet, holding no more disk than the rows take.

    What the write has shuffled goes when it ends; otherwise it stays until the driver happens to
    collect garbage, next to the tables written from it. The frame is planned anew for each write,
    so no other job reads these shuffles. As a split of such files holds more rows, splits are half
    as large as the session has them: sorts of whole lines spill no sooner.
    """
    conf = df.sparkSession.conf
    settings = {FREE_SHUFFLES: "true", SPLIT_BYTES: str(max(_bytes(conf.get(SPLIT_BYTES)) // 2, 1))}
    before = {name: conf.get(name) for name in settings}
    for name, value in settings.items():
        conf.set(name, value)
    try:
        df.write.option("compression", CODEC).parquet(path)
    finally:
        for name, value in before.items():
            conf.set(name, value)


def delete_folder(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    filesystem.delete(hadoop_path, True)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; empty if it does not exist."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not filesystem.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in filesystem.listStatus(hadoop_path) if s.isDirectory())


def list_files(spark: SparkSession, path: str, ending: str) -> list[str]:
    """Paths of the files directly in ``path`` whose names end so; none if it does not exist."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not filesystem.exists(hadoop_path):
        return []
    files = [s.getPath() for s in filesystem.listStatus(hadoop_path) if s.isFile()]
    return sorted(f.toString() for f in files if f.getName().endswith(ending) and f.getName()[0] not in "._")
