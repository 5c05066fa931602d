"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "voxlake", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; partition counts are left to AQE unless given."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="voxlake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting, as in tests, gets a temporary folder, which goes with the process.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if not folder and spark.sparkContext.master.startswith("local"):
        folder = _own_folder()
    if not folder:
        raise ValueError(f"{CHECKPOINT_KEY} is not set")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_folder(spark)}/voxlake-{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, and unlike cached blocks the result outlives a lost executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in any store that Spark reaches; an absent one is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def discard(*frames: DataFrame) -> None:
    """Delete the files behind staged frames that nothing reads any more."""
    for df in frames:
        for file in df.inputFiles()[:1]:
            folder = file.rsplit("/", 2)[0]
            if folder.rsplit("/", 1)[-1].startswith("voxlake-"):
                delete_path(df.sparkSession, folder)
