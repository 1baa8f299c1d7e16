"""Session helpers: a local session for tests and benches, and the shared
folder (``spark.checkpoint.dir``) that every materialised table lives in."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "propensa") -> SparkSession:
    """Local session used by tests and ``bench.py``; on a cluster the
    session comes from the job launcher instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoints of dropped DataFrames are removed from the shared folder
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # one JVM: every task is local, so never wait for a better locality
        .config("spark.locality.wait", "0s")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session_key(spark: SparkSession) -> str:
    """Identity of the running application (memo key for per-session work)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        return spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - static confs may be hidden from SQL conf
        return None


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and materialised layers.

    Uses the cluster's ``spark.checkpoint.dir``.  Only when that is unset and
    the master is local (tests, bench) a fresh folder under the temp dir is
    made and registered as the checkpoint dir.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext on a Connect client
        sc = None
    if sc is None:
        configured = _conf(spark, "spark.checkpoint.dir")
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master or ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="propensa-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def table_path(spark: SparkSession, *parts: str) -> str:
    """Place of a layer table or artifact: below ``spark.propensa.layers.dir``
    if that is set, so that it outlives the application, else below the shared folder."""
    return "/".join([(_conf(spark, "spark.propensa.layers.dir") or shared_dir(spark)).rstrip("/"), "propensa", *parts])


ROWS_PER_BUCKET = 1_000_000
_bucket_hints: dict[str, int] = {}


def cores(spark: SparkSession) -> int:
    """Task slots of the application (executor cores in total)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no SparkContext on a Connect client
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def buckets_for_rows(rows: int, slots: int = 1, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """At most about ``rows_per_bucket`` entity rows (some 50-200 MB) per
    bucket, and at least one bucket per task slot so that bucketed scans
    use the whole cluster."""
    return max(1, slots, -(-int(rows) // rows_per_bucket))


def set_bucket_hint(spark: SparkSession, buckets: int) -> None:
    _bucket_hints[session_key(spark)] = int(buckets)


def default_buckets(spark: SparkSession) -> int:
    """Bucket count for entity tables: the count sized for the seed table
    of this session when there is one (tables of the same entities then
    share their bucketing), else the session's shuffle partitions."""
    hint = _bucket_hints.get(session_key(spark))
    return hint if hint else int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume.

    Scan splits and shuffle partitions target ``partition_bytes`` each (so a
    task's working set fits executor memory with room to spill), with at
    least two waves of tasks over all cores; AQE coalesces small shuffle
    partitions and splits skewed ones at run time.
    """
    slots = max(1, executors * cores_per_executor)
    shuffle = max(2 * slots, input_bytes // partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
