"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The dense panel is spread by (store, item), evenly, because each series has
    # one row per day. A join on (store, item, week) may keep that spread and move
    # only its other side.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # The JVM interprets, and never compiles, a method of more than 8000 bytecodes.
    # The wide feature projection goes past that when it is fused into one method;
    # with this limit Spark splits it instead, which is several times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str, partitions: int, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("shelfcast")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """A session of the same application with the settings; the caller's stays as it is."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in SETTINGS.items():
        own.conf.set(key, value)
    return own


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session that names none, as in local tests, gets a temporary one.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not folder:
        if context.getCheckpointDir():
            return context.getCheckpointDir()
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="shelfcast-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once into the shared folder and go on from the written table.

    For tables several later steps read: each reads only the columns it needs, and
    a lost executor costs a re-read, not the steps before.
    """
    spark = df.sparkSession
    application = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/{application}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


STAGED_TABLE = "staged_"


def stage_by_series(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Like `stage`, but keeps the rows spread by `keys`: windows, groups and joins on them
    read the table without a shuffle. A series is in one file, in order of date."""
    spark = df.sparkSession
    number = uuid.uuid4().hex
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{number}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [c for c in (*keys, "date") if c in df.columns]
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*order)
    writer.option("path", path).format("parquet").saveAsTable(f"{STAGED_TABLE}{number}")
    return spark.table(f"{STAGED_TABLE}{number}")


def release(spark: SparkSession) -> None:
    """Delete what `stage` wrote for this application, once nobody reads it any more."""
    for held in spark.catalog.listTables(pattern=f"{STAGED_TABLE}*"):
        spark.sql(f"DROP TABLE IF EXISTS {held.name}")
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{context.applicationId}")
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
