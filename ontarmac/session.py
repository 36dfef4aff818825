"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster spark-submit provides the settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ontarmac")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def own_session(spark: SparkSession) -> SparkSession:
    """A further session of the same application with the same settings, for jobs that leave traces in theirs."""
    other = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            other.conf.set(name, value)
    return other


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because there driver and executors are
    one process.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="ontarmac-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FILES = 100
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _set_to(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def without_sorting(spark: SparkSession):
    """Writes by folder within it keep up to ``OPEN_FILES`` files of a task open in place of sorting its rows by folder.

    A task with more folders sorts what is left. Sorting would hold or spill all rows of a task, and most tasks have a few months.
    """
    return _set_to(spark, WRITERS, str(OPEN_FILES))


def freeing_shuffles(spark: SparkSession):
    """Writes within it drop their shuffle files when they end, not when the driver next collects its garbage.

    What reads such a shuffle again computes it again.
    """
    return _set_to(spark, FREED, "true")


_job_paths: ContextVar[list[str] | None] = ContextVar("job_paths", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (paths := _job_paths.get()) is not None:
        paths.append(path)
    return path


@contextmanager
def scratch_job(spark: SparkSession):
    """Removes what is written to scratch within it, for jobs whose results do not read it any more."""
    paths: list[str] = []
    token = _job_paths.set(paths)
    try:
        yield
    finally:
        _job_paths.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    What follows starts from files: it survives the loss of executors, reads the columns it needs only, and
    Spark knows the real size when it chooses joins.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
