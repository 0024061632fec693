"""Session set-up and the shared scratch folder."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_fallback = {}


def build_session(cores=None, app="bandlore", **extra):
    """A session with the settings that the library relies on. Master, memory and partitions are the launcher's.

    ``cores`` makes it a local session, as in tests; ``extra`` holds further settings, dots written as ``__``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.compress", "true")
    )
    if cores is not None:
        builder = builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", "8").config(
            "spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark):
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine, which goes when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_fallback:
        _local_fallback[app] = tempfile.mkdtemp(prefix="bandlore-")
        atexit.register(shutil.rmtree, _local_fallback[app], ignore_errors=True)
    return _local_fallback[app]


def scratch_path(spark, name):
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def removed(spark, path):
    """Delete a path below the shared folder, whatever file system that is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stable(df):
    """Cut the lineage of ``df`` into the shared folder (survives executor loss)."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")
    return df.checkpoint(eager=True)
