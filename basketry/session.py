"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits the hot partition of a sort-merge or hash join (a left join may split its left side).
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keep the split even when it costs one more exchange: a hot key is worse than a second shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
#: Removes the shuffle files of an execution when it ends (Spark 4.1; other versions ignore it).
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "basketry", master: str | None = None, **conf: str) -> SparkSession:
    """Create or get a session. On a cluster leave `master` out and pass sizes through `conf`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_settings(spark: SparkSession) -> None:
    """Apply the settings to a session that was made elsewhere.

    Dates are cut in UTC after an explicit zone conversion, so the session zone has to be UTC, and hot keys are only
    split under these settings.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`.

    Only a local-mode session without that setting gets a temporary folder of its own; on a cluster a
    machine-local folder would be lost with its machine, so a missing setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    global _LOCAL_FOLDER
    _LOCAL_FOLDER = _LOCAL_FOLDER or tempfile.mkdtemp(prefix="basketry-")
    return _LOCAL_FOLDER


_LOCAL_FOLDER: str | None = None


def stage_table(df: DataFrame, *by: str) -> DataFrame:
    """Write a frame that is used several times as a column file in the shared folder, in folders of `by`, and read it back.

    Cuts the lineage and survives lost executors. Unlike a checkpoint the copy keeps column pruning,
    filter pushdown and a known size, so a small stage can be broadcast later. The shuffle files behind the copy are
    removed as soon as it is written; otherwise they lie on the disks until the driver's next garbage collection.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        (df.write.partitionBy(*by) if by else df.write).parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more. `df` may be a selection of its columns."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
