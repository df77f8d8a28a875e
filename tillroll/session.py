"""Session settings: one set for a cluster, sized from the input, and one for local runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

MIB = 1 << 20

# Strict casts, runtime re-planning and skew splitting are part of the semantics and the
# scaling of the jobs, whatever the size of the cluster.
BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


# Defaults of ``cluster_conf``: what a driver keeps track of comfortably.
MAX_SCAN_TASKS = 100_000
MAX_SHUFFLE_PARTITIONS = 40_000


def cluster_conf(
    input_bytes: int,
    cores: int,
    max_scan_tasks: int = MAX_SCAN_TASKS,
    max_shuffle_partitions: int = MAX_SHUFFLE_PARTITIONS,
) -> dict[str, str]:
    """Settings for an input of ``input_bytes`` on a cluster with ``cores`` task slots.

    Scans and shuffles get 256 MiB per task until that would mean more tasks than the two
    bounds; beyond, tasks grow and sorts spill. Adaptive execution merges small shuffle
    partitions, so starting with many costs little.
    """
    split_bytes = max(256 * MIB, input_bytes // max_scan_tasks)
    shuffle_partitions = min(max(2 * cores, input_bytes // (256 * MIB)), max_shuffle_partitions)
    return {
        **BASE_CONF,
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MIB),
        # A table is broadcast only below this size on disk.
        "spark.sql.autoBroadcastJoinThreshold": str(32 * MIB),
        # Beyond 2000 partitions only blocks above this size are reported one by one; it has
        # to be below what a hot key leaves per scan task, or its skew goes unnoticed.
        "spark.shuffle.accurateBlockThreshold": str(16 * MIB),
        "spark.sql.parquet.compression.codec": "zstd",
    }


def local_session(cores: int | str = "*", app_name: str = "tillroll", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder; only their listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return int(files.agg({"length": "sum"}).first()[0] or 0)


def require_strict_casts(spark: SparkSession) -> None:
    """Refuse a session in which a bad value would turn into NULL without notice."""
    if spark.conf.get("spark.sql.ansi.enabled", "true").lower() != "true":
        raise RuntimeError("spark.sql.ansi.enabled must be true: bad values have to fail the load")


def require_session(spark: SparkSession) -> None:
    """Refuse a session without strict casts, or one that can not split hot keys."""
    require_strict_casts(spark)
    for name in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        if spark.conf.get(name, "true").lower() != "true":
            raise RuntimeError(f"{name} must be true: joins rely on it to split hot keys")
