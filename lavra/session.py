"""Session helpers: tables by name, the shared folder and cut lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_OWN_FOLDER: dict[str, str] = {}
_WRITTEN: dict[str, SparkSession] = {}
_PATHS: dict[int, str] = {}


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lavra")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Only in a local session without the setting is a temporary folder made, and the setting with it; on a cluster
    its absence is an error, as a machine's own folder holds only what that machine's executors wrote.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not is_local(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDER:
        _OWN_FOLDER[app] = tempfile.mkdtemp(prefix="lavra-")
        spark.sparkContext.setCheckpointDir(_OWN_FOLDER[app])
    return _OWN_FOLDER[app]


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores.

    Tables of one small file come as one partition; rows are only moved where that would leave cores idle, never
    on inputs of many files.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder as Parquet and read again.

    Used where a result feeds several later stages: the lineage ends there, a lost executor costs no
    recomputation beyond its own tasks, and later scans read only the columns they need. ``released`` gives the
    space back when the last reader is done.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[id(out)] = path
    weakref.finalize(out, _PATHS.pop, id(out), None)
    return out


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder for files of other formats; removed when the interpreter ends."""
    path = f"{shared_folder(spark)}/lavra-{uuid.uuid4().hex}/{label}"
    _WRITTEN[path] = spark
    return path


def released(*tables: DataFrame) -> None:
    """Removes tables of :func:`written` whose readers have all run; nothing derived from them may run again."""
    for t in tables:
        if (path := _PATHS.pop(id(t), None)) in _WRITTEN:
            _remove(_WRITTEN.pop(path), path)


def _remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent()
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def forget_written() -> None:
    """Removes all tables of :func:`written`; called when the interpreter ends."""
    while _WRITTEN:
        path, spark = _WRITTEN.popitem()
        _remove(spark, path)


@atexit.register
def _at_exit() -> None:
    try:
        forget_written()
    except Exception:  # the JVM may already have gone
        pass
