"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Python functions go to the executors with their code, which need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules["scenetrail"])

# Settings that every operator relies on; all can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join keys even where the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keep the state of streams on disk, so that it is not limited by executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 50_000
ROOM = 16  # times the bytes of stored, compressed columns that rows take in a task


def configure(spark: SparkSession, data: str | None = None) -> SparkSession:
    """Apply the runtime settings to an existing session.

    With the folder of the input data, also raise the shuffle partitions to fit the room that its rows take. Adaptive
    execution puts partitions together again that turn out small.
    """
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if data is not None:
        fitting = shuffle_partitions(stored_bytes(spark, data) * ROOM, spark.sparkContext.defaultParallelism)
        if fitting > int(spark.conf.get("spark.sql.shuffle.partitions")):
            spark.conf.set("spark.sql.shuffle.partitions", str(fitting))
    return spark


_sizes: dict[tuple[str, str], int] = {}


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files below a folder; their content is not read. Asked once per application."""
    asked = (spark.sparkContext.applicationId, path)
    if asked not in _sizes:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        _sizes[asked] = files.agg(F.sum("length")).first()[0] or 0
    return _sizes[asked]


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle partitions of about 128 MB, not fewer than the cores.

    Above 50,000 the partitions grow instead and spill, because the blocks of a shuffle multiply with them.
    """
    return min(MAX_SHUFFLE_PARTITIONS, max(cores, math.ceil(input_bytes / TARGET_PARTITION_BYTES)))


def local_session(app: str = "scenetrail", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="scenetrail-wh-"))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_scratch: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors can reach, taken from ``spark.checkpoint.dir``.

    A temporary folder stands in only on a local master, as in tests.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    already_set = sc.getCheckpointDir()
    if already_set:
        return already_set.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    if sc.applicationId not in _local_scratch:
        _local_scratch[sc.applicationId] = tempfile.mkdtemp(prefix="scenetrail-")
        sc.setCheckpointDir(_local_scratch[sc.applicationId])
    return _local_scratch[sc.applicationId]


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/scenetrail-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below this application's part of the shared folder."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; its earlier results become unreadable."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(scan: DataFrame) -> DataFrame:
    """Repartition a plain file scan that has fewer partitions than there are cores.

    For work that multiplies its input, such as unnesting documents. A large table has more partitions
    than cores and is left as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def cluster(rows: DataFrame, *keys: str, per_task: int = 50_000, rows_known: int | None = None) -> DataFrame:
    """Repartition rows by keys, before work that multiplies them or groups them often, so that this shuffles no more.

    The number of tasks follows from the number of rows, because the size of the files tells nothing of what is made of them.
    All rows of the same keys go to one task. The number of rows is counted unless it is given.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    n = rows.count() if rows_known is None else rows_known
    return rows.repartition(min(MAX_SHUFFLE_PARTITIONS, max(cores, math.ceil(n / per_task))), *keys)


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This ends the lineage like a checkpoint, survives lost executors, and keeps column pruning and
    file sizes available to the optimizer. Shuffle files of the write are removed as soon as it is done.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def cut_in_buckets(df: DataFrame, keys: list[str], label: str = "buckets", placed: bool = False) -> DataFrame:
    """``cut`` with the rows in buckets by the keys: joins on just these keys read them without a shuffle.

    Rows that Spark has ``placed`` by these keys already, as a grouping by them does, are not shuffled again.
    The table's name is dropped at once, its files stay in the scratch folder like those of other cuts.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"scenetrail_{uuid.uuid4().hex}", scratch_path(spark, label)
    by_keys = (df if placed else df.repartition(n, *keys)).sortWithinPartitions(*keys)
    by_keys.write.bucketBy(n, *keys).sortBy(*keys).option("compression", "zstd").option("path", path).saveAsTable(name, format="parquet")
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored
