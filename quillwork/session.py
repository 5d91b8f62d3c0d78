"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_TEMPORARY: list[tempfile.TemporaryDirectory] = []


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quillwork")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediates, reachable by every executor.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a session with
    no executors of its own (master ``local``) may do without: it gets a temporary
    folder, remembered in the session and removed when the program ends.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    folder = tempfile.TemporaryDirectory(prefix="quillwork-", ignore_cleanup_errors=True)
    _TEMPORARY.append(folder)
    spark.conf.set(CHECKPOINT_CONF, folder.name)
    return folder.name


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/quillwork/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage after scorers that are dear or not repeatable. Unlike a
    persisted frame the written table survives the loss of executors, and unlike
    an RDD checkpoint it keeps column pruning, filter pushdown and statistics.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def widen(scan: DataFrame, *key: str) -> DataFrame:
    """Spread a table scan over all cores when it has fewer partitions than that.

    Few files or one huge row group give few tasks, whatever is done per row. With
    at least as many partitions as cores, the usual case for a large table, the
    scan is returned as it is. Only for plain scans: the partitions of a shuffled
    frame are not known before it runs.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, *key)
