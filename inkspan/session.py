"""Session for tests and the bench, and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "inkspan", **conf: str) -> SparkSession:
    """A single-machine session. On a cluster the caller brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Query contexts walk the Python stack for every column operation.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for one written table, under ``spark.checkpoint.dir``.

    Every executor must reach the folder, so outside local mode the setting
    is required; a local session without it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/inkspan/{purpose}-{uuid.uuid4().hex}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="inkspan-")


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders that ``shared_folder`` named and nothing reads any more."""
    for name in paths:
        if "/inkspan/" not in name:
            raise ValueError(f"not a folder of this package: {name}")
        delete_folder(spark, name)


def file_system(spark: SparkSession, name: str):
    """The Hadoop file system of a path, and the path as its object."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def delete_folder(spark: SparkSession, name: str) -> None:
    system, path = file_system(spark, name)
    system.delete(path, True)


def write_file(spark: SparkSession, name: str, content: str) -> None:
    system, path = file_system(spark, name)
    stream = system.create(path, True)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()


def rename_file(spark: SparkSession, name: str, to: str) -> None:
    """Give a file a name that no other has."""
    system, path = file_system(spark, name)
    if not system.rename(path, file_system(spark, to)[1]):
        raise OSError(f"{name} cannot be renamed to {to}")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows over all cores, for a costly step on a table of few row groups.

    A scan that already has enough partitions, as that of any large table, is
    returned as it is; so at most some partitions per core are ever shuffled.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() >= 2 * cores:
        return rows
    return rows.repartition(cores, key)
