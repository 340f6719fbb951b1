"""Session helpers: a local builder for tests and the shared-folder rules."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "hourgrid") -> SparkSession:
    """A single-JVM session for tests and the benchmark; clusters bring their own.

    The broadcast threshold is lower than Spark's default because the fixture files are
    single row groups: joining them through a shuffle is what spreads them over the cores.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", "2m")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # wide rows give generated methods beyond 8000 bytecodes, which the JVM would
        # otherwise interpret for ever; executors of a cluster profit from the same option
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    machine-local folder would lose data with its executor, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="hourgrid-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-path of the shared folder, with its scheme.

    A folder named without one is in Spark's default file system. Qualified here once, on the
    driver, it is the same place for Spark and for code that opens files in tasks.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    full = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    return f"{full.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage (reliable checkpoint)."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where it runs from a checkout instead of being installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    return spark
