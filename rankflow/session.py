"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution coalesces small shuffle partitions and splits skewed ones at run
# time, so the number of partitions below is an upper bound to start from.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def local_session(cpus: str = "*", partitions: int = 8, **settings: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("rankflow")
               .config("spark.sql.shuffle.partitions", str(partitions))
               .config("spark.driver.memory", "12g")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, under `spark.checkpoint.dir`, which every executor can reach.

    Only a local master may do without the setting.
    """
    app = spark.sparkContext.applicationId
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return f"{folder.rstrip('/')}/rankflow/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="rankflow-")
    return _local_folder[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and go on from the written table.

    Cuts the lineage in a way that survives lost executors, and pins whatever
    depends on the physical layout, such as partition numbers.  `drop_written`
    removes these tables when the application is done with them.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; frames that read them end with it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
