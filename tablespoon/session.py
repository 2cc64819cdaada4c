"""Session factory and the shared folder for intermediates."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

_scratch: dict[str, list[str]] = {}
_ending: set[str] = set()


def get_spark(app_name: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Return the running session, or start one. On a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a folder of the warehouse where that is unset."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(given or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate")
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; :func:`release` removes all of a session's."""
    path = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    paths = _scratch.setdefault(spark.sparkContext.applicationId, [])
    if spark.sparkContext.applicationId not in _ending:
        _ending.add(spark.sparkContext.applicationId)
        atexit.register(release, spark)
    paths.append(path)
    return path


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold inside the block only."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: For writes of a table that is read back: shuffle files go when the write ends, instead of when the driver happens to collect
#: its garbage. What is not written but returned keeps its files, since the caller may run it twice.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


#: Parquet options for rows of megabytes: a writer looks at its size after 100 rows by default, and a reader takes a row group at a time.
LARGE_ROWS = {"parquet.block.size": 8 << 20, "parquet.block.row.count.limit": 16, "parquet.page.size.row.check.min": 1}


def stored(df: DataFrame, purpose: str, options: Mapping[str, int] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder, with these ``options``, and read it back.

    Later passes read the same rows and only their columns, the optimizer knows the size, and a lost executor costs
    one read. The shuffle files behind it go at once; the table lives until :func:`release` or the end of the driver.
    """
    path = scratch_dir(df.sparkSession, purpose)
    with settings(df.sparkSession, FREE_SHUFFLES):
        df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin(df: DataFrame) -> DataFrame:
    """:func:`stored` under a common name, for frames without a name of their own."""
    return stored(df, "pin")


def _remove(spark: SparkSession, paths: list[str]) -> None:
    for path in map(spark.sparkContext._jvm.org.apache.hadoop.fs.Path, paths):
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def intermediates(spark: SparkSession, keep: tuple[str, ...] = ()) -> Iterator[None]:
    """Scratch tables made inside go when the block ends well, but for those of the purposes in ``keep``."""
    shared_dir(spark)
    before = len(_scratch.setdefault(spark.sparkContext.applicationId, []))
    yield
    made = _scratch[spark.sparkContext.applicationId][before:]
    gone = [path for path in made if path.rpartition("/")[2].rpartition("-")[0] not in keep]
    _remove(spark, gone)
    _scratch[spark.sparkContext.applicationId] = [x for x in _scratch[spark.sparkContext.applicationId] if x not in gone]


def release(spark: SparkSession) -> None:
    """Remove the session's scratch tables; to be called when nothing reads them any more."""
    paths = _scratch.pop(spark.sparkContext.applicationId, []) if spark.sparkContext._jsc else []
    with contextlib.suppress(Exception):  # the JVM may have ended before this
        _remove(spark, paths)
