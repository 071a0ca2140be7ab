"""Session defaults for local runs, tests and the benchmark."""

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "trivet", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session; on a cluster use the session that is given instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
