"""Session helpers.

The library never creates a session behind the caller's back: operators take
DataFrames.  ``get_spark`` is a convenience for scripts, tests and the bench.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings the operators rely on for parity with the SQL oracle.
REQUIRED_CONF = {
    # Naive timestamps are UTC wall-clock times; keep the session in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_spark(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session configured for the library.

    ``master`` defaults to ``local[$BENCH_CPUS or *]`` only for a plain Python
    process; under ``spark-submit`` (or ``pyspark``) the launcher's master is kept.
    """
    builder = SparkSession.builder.appName(app_name)
    launched = os.environ.get("PYSPARK_GATEWAY_PORT") or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    if master is None and not launched:
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf["spark.ui.enabled"] = "false"
    # no call-site capture per Column call: it is most of the time plans take to build
    conf["spark.python.sql.dataFrameDebugging.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    # checkpoint files of dropped DataFrames are removed
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, default: str | None = None) -> str | None:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to shared storage; only when it is unset
    (tests, local runs) is ``default`` installed.  Never a machine-local folder
    on a cluster: the caller passes ``default`` only in local mode.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if default:
        sc.setCheckpointDir(default)
        return sc.getCheckpointDir() or default
    return None


def recommended_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a given input size (bytes of Parquet scanned).

    The first shuffle of the batch (the per-entity rollup of the input) carries
    at most about the input's size, so start with one shuffle partition per
    ``target_partition_bytes`` of input and let AQE coalesce the later, much
    smaller shuffles (rankings and rollups are bounded by the number of groups).
    Scan splits follow the same target.  Example: 100 TB -> ~410k initial
    partitions of 256 MB.
    """
    n = max(1, -(-int(input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
