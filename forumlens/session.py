"""Sessions for tests and benchmarks, and the folder for tables Spark must keep.

The library itself changes no setting of the session it is given.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def local_session(cpus: int = 8, **settings: str) -> SparkSession:
    """A local session; a cluster brings its own through spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("forumlens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary folder instead: on a cluster
    a folder of one machine would be lost with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="forumlens-")
    return _local_folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; ``release`` deletes what is there."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.conf.get("spark.app.id"), []).append(path)
    return path


def release(spark: SparkSession, since: int = 0) -> int:
    """Delete the tables that this application has kept, and count them.

    Call it when no frame is in use that reads one. ``since`` leaves the first
    so many, as ``made`` tells them, where they are.
    """
    paths = _made.get(spark.conf.get("spark.app.id"), [])
    gone = paths[since:]
    for path in gone:
        delete(spark, path)
    del paths[since:]
    return len(gone)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, path: str) -> list[str]:
    """What a folder of any file system holds, in order; nothing if there is no such folder."""
    files, place = _place(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def written(spark: SparkSession, path: str) -> bool:
    """Whether a table at ``path`` is whole."""
    return "_SUCCESS" in names_in(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def made(spark: SparkSession) -> int:
    """How many tables this application has kept and not released."""
    return len(_made.get(spark.conf.get("spark.app.id"), []))


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage, outlives lost executors, and gives the optimizer the
    true size of the data, by which it decides whether to broadcast it. The
    table stays until ``release``.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
