"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Correctness needs only the UTC session zone.  The rest is what a large cluster
# wants: many small shuffle partitions that AQE coalesces, and skew splitting.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins whose partitions turn out small skip the sort of both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}

# The validation rules compile to more code than the JVM compiles in one method
# by default.  With this JVM option they run fused; without it Spark has to
# split the stage, which costs about half the speed but beats interpreting it.
JVM_OPTION = "-XX:-DontCompileHugeMethods"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    local = spark.sparkContext.master.startswith("local")
    options = spark.conf.get(f"spark.{'driver' if local else 'executor'}.extraJavaOptions", "")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535" if JVM_OPTION in options else "8000")
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pitbars")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.driver.extraJavaOptions", JVM_OPTION)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def require_utc(spark: SparkSession) -> None:
    """Instants are compared and rendered in the session zone, so it must be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone}")
