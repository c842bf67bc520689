"""Session settings the library relies on."""

from pyspark.sql import SparkSession

# The SQL settings results depend on, and the adaptive settings the plans count on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JVM never compiles larger methods; Spark then splits the projection instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Up to this many rows per key, "the newest n of each" is cut off before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that somebody else started."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", memory: str = "8g", **extra: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("logloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        # Recording the Python call site of every column doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
