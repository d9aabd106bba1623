"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the expressions in this package rely on, or that suit them. All of
# them can be changed at run time, so they also apply to a session handed in.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM leaves methods over 8000 bytes interpreted. Above that, plain
    # projections, which Spark splits into small methods, are much faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Folders listed by tasks, as many in one task as it takes. By default each folder is a task of its own,
    # which costs far more than the listing where a table or a backlog has a folder per file.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the package's settings to a session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    The cluster names that folder, because every executor must reach it. Only a
    local master may fall back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tallyline-", dir="/tmp")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the work folder and read it back.

    Cuts the lineage with a table that outlives any executor. The folder is the
    caller's to :func:`delete` once no plan reads it any more.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
