"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "skyledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` overrides any of them.

    Adaptive execution picks the post-shuffle partition count and splits skewed join partitions, so
    ``spark.sql.shuffle.partitions`` only has to be large enough for the biggest exchange.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # The JVM does not compile methods above 8000 bytes of code; a fused stage that long would be
        # interpreted, so Spark runs its operators one by one instead.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.ui.enabled": "false",
        # Call-site capture for every column operation doubles the time to build a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written intermediates and stream checkpoints.

    It lies under ``spark.checkpoint.dir``, which every executor can reach. Where that is unset, it lies under
    the warehouse, the other folder that all executors share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/skyledger/{purpose}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder that is no longer read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _folder(spark: SparkSession, path: str) -> tuple:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def make_folder(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.mkdirs(folder)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder; nothing where there is no such folder."""
    files, folder = _folder(spark, path)
    return [s.getPath().toString() for s in files.listStatus(folder)] if files.exists(folder) else []


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Puts a folder in the place of another, or where there is none."""
    files, folder = _folder(spark, source)
    old = _folder(spark, target)[1]
    files.delete(old, True)
    files.mkdirs(old.getParent())
    if not files.rename(folder, old):
        raise OSError(f"{source} could not be moved to {target}")


def read_small(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    files, file = _folder(spark, path)
    stream = files.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file, in place of one that is there."""
    files, file = _folder(spark, path)
    stream = files.create(file, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
