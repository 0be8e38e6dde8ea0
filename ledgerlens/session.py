"""Spark session settings shared by tests, the bench and the report job."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings a report job wants on any cluster: adaptive execution (runtime
# coalescing, broadcast conversion, skew-join splitting), UTC timestamps so
# dates do not move with the executor's zone, and no web UI.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # split a hot join key even when that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # at run time, hash-join instead of sort-merge when every build-side
    # partition is measured under this size (no sort; bounded hash map)
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
    # plans are built once per report from many Column calls; skip capturing
    # a Python call site for each of them
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "ledgerlens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for lineage cuts.

    On a cluster this is ``spark.checkpoint.dir`` as the cluster sets it. Only
    when it is unset (tests, a laptop) do we set ``fallback`` ourselves.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if cur:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(cur)
        return cur
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set; pass a shared fallback folder")
    p = spark._jvm.org.apache.hadoop.fs.Path(fallback)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback
