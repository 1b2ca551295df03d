"""Session construction and shared-folder handling."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces shuffle
# partitions at runtime; skew-join splitting protects the fact-to-dimension
# joins when one institution or department holds a large share of rows.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # reliable checkpoints of intermediate tables are removed once unused
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # AQE coalesces shuffle output towards this size and splits skewed
    # partitions above it, so the initial partition count can be generous
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

SHUFFLE_TARGET_BYTES = 128 << 20


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Initial shuffle partitions for an input volume: enough that each
    partition of a full-width shuffle stays near 128 MB (spill-friendly at
    100 TB: ~800k partitions is capped to 200k; AQE coalesces what is
    smaller), and never fewer than twice the cores."""
    return int(min(200_000, max(2 * cores, -(-input_bytes // SHUFFLE_TARGET_BYTES))))


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of input files/folders via the Hadoop file system API."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        total += jp.getFileSystem(conf).getContentSummary(jp).getLength()
    return total


def get_spark(master: str | None = None, app: str = "aulaframe",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only set for local runs; on a cluster the launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the operator (a shared file system);
    only when it is unset (local tests) do we create a scratch folder.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            d = None
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="aulaframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
