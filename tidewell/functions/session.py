"""Session settings the plans rely on."""

from pyspark.sql import DataFrame, SparkSession

# AQE splits a join partition that one hot key has blown up. Without the
# "force" switch it declines to do so whenever the split costs one more
# shuffle, e.g. when a groupBy on the join key follows.
# A shuffled row of a few packed numbers takes several times its shuffled size
# in a join's sorts and an aggregate's map, and a stage may hold some of these at
# once: partitions are merged up to 16 MB, not 64, which is 1 GB in a task.
# HotSpot never compiles a method above 8000 bytes of bytecode; a fused stage
# beyond that would run interpreted. With the limit set, Spark splits the
# stage's expressions into smaller methods instead.
_SQL_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# For the session builder or the cluster's defaults: building a plan costs
# several times more driver time while call sites are recorded per column.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings; static ones belong to the cluster."""
    for key, value in _SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The reliable checkpoint folder, which all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a
    folder inside the warehouse serves, the other place that is shared.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse}/_checkpoints")
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write a result once to the shared folder, so that later passes read it back."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
