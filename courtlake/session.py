"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime re-planning picks join strategies and splits hot partitions from measured sizes,
# so the library places no broadcast hint on a side that can grow with the data.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Also the target size of rebalanced writes; 64 MB would leave very many small files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def builder(app_name: str = "courtlake") -> SparkSession.Builder:
    """A session builder with this package's settings; the cluster supplies the rest."""
    out = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        out = out.config(key, value)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="courtlake-")
    context.setCheckpointDir(made)
    return context.getCheckpointDir()
