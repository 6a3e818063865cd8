"""Session helpers: a local session for tests and lineage cutting.

Lineage is cut with reliable ``checkpoint()`` into the shared folder named by
``spark.checkpoint.dir``. The library never picks a folder itself: without one it
raises. Tests, the benchmark and the driver's entry points name theirs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "tessera",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """Session for tests and benchmarks: local mode, AQE on, no UI. Checkpoints
    that nothing refers to any more are removed as the session goes on."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    if checkpoint_dir:
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from the session.

    Order: the folder already set on the context, then the
    ``spark.checkpoint.dir`` setting. With neither it raises: a folder of this
    machine would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and return it.

    Reliable checkpoint, so a lost executor re-reads the files instead of
    replaying the whole iteration history.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the cluster's cores when its scan has fewer
    splits than that (a single-row-group file is one task). A scan that
    already has enough splits is returned unchanged, so large inputs pay no
    extra shuffle."""
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df
