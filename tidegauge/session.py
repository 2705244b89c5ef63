"""Session defaults and the shared scratch folder.

Nothing here is a global: every operator takes the session (or a DataFrame) as
an argument.  Local defaults only fill settings the cluster left unset.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "tidegauge") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call-site capture costs several gateway calls per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # the wide indicator plan needs several hundred generated classes; the default
        # cache of 100 makes every task compile them again
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's checkpoint folder.

    Only a local master may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0] if _is_context_folder(current) else current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="tidegauge-")
    spark.sparkContext.setCheckpointDir("file://" + base)
    return "file://" + base


def _is_context_folder(path: str) -> bool:
    """setCheckpointDir appends a UUID folder to the path it was given."""
    try:
        uuid.UUID(path.rstrip("/").rsplit("/", 1)[1])
    except ValueError:
        return False
    return True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/tidegauge-{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor."""
    sc = spark.sparkContext
    if any(name.startswith("tidegauge-src") for name in map(os.path.basename, sc._python_includes)):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="tidegauge-"), "tidegauge-src")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sc.addPyFile(shutil.make_archive(base, "zip", root, "tidegauge"))


def spread(df: DataFrame) -> DataFrame:
    """Give row-wise heavy work one partition per core when the scan has fewer.

    Only for plain scans; a large table has many more partitions than cores and
    is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
