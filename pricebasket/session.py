"""Session settings and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_DIRS: dict[str, str] = {}
_AREA: ContextVar[list[str] | None] = ContextVar("work_area", default=None)


def build_session(app: str = "pricebasket", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every job here assumes.

    Partition counts are left to AQE, which coalesces small shuffle partitions and
    splits skewed join partitions; callers override any key through ``conf``
    (``spark.sql.shuffle.partitions`` should be a small multiple of the core count).
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
    }
    settings.update({key: str(value) for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own: on a cluster a
    machine-local folder would vanish with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="pricebasket-")
    return _LOCAL_DIRS[app]


def new_dir(spark: SparkSession, label: str) -> str:
    """A path no other run uses, below the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    made = _AREA.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def work_area(spark: SparkSession) -> Iterator[None]:
    """Delete the folders made inside the block when it ends, so that a job leaves only its results.

    Nothing computed in the block may be read lazily after it.
    """
    made: list[str] = []
    token = _AREA.set(made)
    try:
        yield
    finally:
        _AREA.reset(token)
        for path in made:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders that a reader lists inside the block are shared out over as many tasks as a shuffle has, not over one each."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where two or more branches of a plan need the same expensive result: the
    branches then prune columns of a Parquet table instead of each recomputing the
    scan and shuffles, and a lost executor costs a re-read, not the whole lineage.
    """
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of Parquet, compressed, that a broadcast table may have.
BROADCAST_BYTES = 16 << 20


def stored_bytes(staged: DataFrame) -> int:
    """The size of a staged table's files, from a listing."""
    paths = staged.inputFiles()
    if not paths:
        return 0
    listing = staged.sparkSession.read.format("binaryFile").load(paths)
    return listing.agg(F.sum("length")).first()[0] or 0


def is_small(staged: DataFrame, max_rows: int = 1_000_000, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a staged table's files and its number of rows allow a broadcast. Only file footers and a listing are read."""
    return stored_bytes(staged) <= max_bytes and staged.count() <= max_rows


def broadcast_if_small(staged: DataFrame, max_rows: int = 1_000_000, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a staged table for broadcast, if it is small. Past either bound it is left to Spark's shuffle joins."""
    return F.broadcast(staged) if is_small(staged, max_rows, max_bytes) else staged


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by ``keys`` into the session's full number of shuffle partitions.

    For rows about to fan out in a join: AQE would size partitions by the few bytes before it.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
