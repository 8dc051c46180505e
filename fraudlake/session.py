"""Session settings the jobs rely on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the package expects (time as TIMESTAMP_NTZ, AQE on).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, total_cores: int, partition_mb: int = 256) -> dict[str, str]:
    """Partition sizing for a cluster run.

    Shuffle partitions are sized so that each holds about ``partition_mb``
    of the largest input (at least two waves of tasks); AQE then coalesces
    small ones and splits skewed ones. Scan splits use the same target.
    """
    target = partition_mb * 1024 * 1024
    shuffle = max(2 * total_cores, -(-input_bytes // target))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "fraudlake",
                  extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = {**SESSION_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **(extra or {})}
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A folder is set here only when the session names none and the caller
    passes one, as tests do; otherwise a missing setting is an error, since
    a machine-local folder would not survive the loss of that machine.
    """
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if fallback is None:
            raise ValueError("spark.checkpoint.dir is not set; name a shared folder")
        d = fallback
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def checkpoint_base(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names; a local session without the
    setting gets a temporary one, on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        local = spark.sparkContext.master.startswith("local")
        base = checkpoint_dir(spark, tempfile.mkdtemp(prefix="fraudlake-") if local else None)
    return base.rstrip("/")


def cut_lineage(df, name: str = "table"):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    One job computes and writes (``DataFrame.checkpoint`` would compute the
    plan twice unless it is persisted first); the re-read plan is a plain
    scan with file statistics for the planner. Used for dimension-sized
    intermediates that several plans reuse. Without a checkpoint folder a
    local session gets a temporary one; on a cluster that is an error.
    """
    spark = df.sparkSession
    path = f"{checkpoint_base(spark)}/fraudlake-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
