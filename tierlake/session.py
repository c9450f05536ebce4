"""Session settings the jobs rely on. A cluster supplies its own master and memory."""

from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the jobs compute depends on these, so they set them themselves.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Rows of few kinds (kept or refused, some buckets) are written without a sort.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}

# A job's shuffle files go when it ends, not when the driver happens to collect its garbage. For jobs
# that run no plan twice.
CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Bytes of a file that are worth a task, as Spark weighs opening one.
LEAST_SPLIT = 4 * 1024**2

SETTINGS = {
    **REQUIRED,
    "spark.sql.adaptive.enabled": "true",
    "spark.ui.enabled": "false",
}


def required_settings(spark: SparkSession):
    """The required settings and the cleanup for the block, whatever the caller's session has."""
    return settings(spark, REQUIRED | CLEANUP)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def splits_of_text(spark: SparkSession, expansion: int) -> dict[str, str]:
    """Setting by which a task reads as much text from files that hold ``expansion`` times their size as from plain ones."""
    key = "spark.sql.files.maxPartitionBytes"
    most = byte_count(spark, key)
    return {key: str(min(most, max(LEAST_SPLIT, most // max(expansion, 1))))}


def byte_count(spark: SparkSession, key: str) -> int:
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)))


def local_session(cpus: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tierlake")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
