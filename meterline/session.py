"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot partitions of a plain rebalance as well
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results and plans rely on; all of it can be set at run time."""
    for key, value in _RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "meterline") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only where that setting is absent (a local session) a temporary folder is made and set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="meterline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


_RUN_FOLDERS: set[str] = set()


def run_folder(spark: SparkSession) -> str:
    """Folder of this application below the shared one; it is deleted when the application ends."""
    context = spark.sparkContext
    folder = f"{shared_folder(spark)}/meterline-{context.applicationId}"
    if folder not in _RUN_FOLDERS:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(context._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _RUN_FOLDERS.add(folder)
    return folder
