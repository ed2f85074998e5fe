"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Correctness relies on the first entry only; the rest are scale settings.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JIT compiler skips methods beyond 8000 bytes: rather split such a stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # No Python stack trace per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "mendwork",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the library expects.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset, so that
    spark-submit decides; locally pass ``local[8]`` and about the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder (``spark.checkpoint.dir``).

    It has to be set. Only in local mode, where driver and executors are one process,
    an unset one becomes a folder that goes with the process.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="mendwork-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


# Tables written by this process, for ``drop_tables``.
WRITTEN: list[str] = []


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a parquet table in the shared folder and read it back.

    Cuts the lineage without computing the plan twice, keeps column pruning for the
    readers, and survives the loss of executors. It also lets Spark know the size of
    an aggregated table before it plans a join: a small one is then broadcast and the
    large side stays where it is, a large one is not. ``drop_tables`` removes them.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession) -> int:
    """Remove the intermediate tables written so far, once all results are saved; returns their number."""
    count = len(WRITTEN)
    while WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(WRITTEN.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count
