"""Session helpers shared by queries, tests and the bench."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "hearthline") -> SparkSession:
    """A local session with the settings that the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("HEARTHLINE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables written in this process, by session, for ``drop_written``.
_written: list[str] = []


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage: the cluster's own setting; a temporary folder only on a local master, where it is removed at the end."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    jsc = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jsc.isDefined():
        return jsc.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="hearthline-ckpt-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(root)
    return root


def written(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut in the lineage that survives the loss of executors."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> int:
    """Remove the tables that this process has written; call it when no result that reads them is needed any more."""
    jvm = spark.sparkContext._jvm
    count = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        count += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return count


def spread(df: DataFrame, per_core: int = 1) -> DataFrame:
    """Redistribute rows only if the scan yields fewer partitions than there are cores."""
    want = df.sparkSession.sparkContext.defaultParallelism * per_core
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)
