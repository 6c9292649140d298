"""Session helpers: a local session for tests, and the shared scratch folder of a cluster."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of rows that an executor gathers before it sends them to a Python worker; Spark's own bound is 64 MB.
ARROW_BYTES = 4 << 20


def local_session(app: str = "larder", cores: str = "8", shared: str | None = None) -> SparkSession:
    """Session for tests and the local benchmark. On a cluster, pass the cluster's own session instead.

    ``shared`` is the folder for intermediate tables; the default is a fresh temporary folder of this machine.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        # small local files: splits of 1 MB at least instead of one split for the whole file
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.files.openCostInBytes", "1m")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared or tempfile.mkdtemp(prefix="larder-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def small_batches(spark: SparkSession, size: int = ARROW_BYTES) -> None:
    """Rows go to Python workers in Arrow batches of at most ``size`` bytes, or of one longer row, from now on in this session.

    An executor and its worker each hold a batch whole, so this bounds what they hold; it changes no result. A smaller
    bound that the session has already stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(key).strip().lower()).groups()
    if int(number) << 10 * " kmgtp".index(unit or " ") > size:
        spark.conf.set(key, f"{size}b")


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read: ``spark.checkpoint.dir`` of the session.

    Only a session within one process may go without it, such as the tests'; there a fresh temporary folder is chosen
    once and kept in the session. A cluster never falls back to a disk that dies with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("larder.scratch.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="larder-")
    spark.conf.set("larder.scratch.dir", path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/larder/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: later stages read files, not the plan that made them."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back (columnar, prunable, fault-safe)."""
    path = fresh_path(df.sparkSession, name)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
