"""Session settings and the shared working folder."""

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app_name: str = "stagedoor", master: str | None = None, **settings) -> SparkSession:
    """A session with the settings the library relies on; ``settings`` override them.

    Sources carry zone-less times, hence UTC. Adaptive execution sizes shuffles at run time and
    splits skewed join partitions, also where that costs one more shuffle.
    """
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else one in the session's warehouse."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def opened(spark: SparkSession, path: str):
    """A path and its file system, as Spark itself would open it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none where there is no folder."""
    folder, system = opened(spark, path)
    if not system.exists(folder) or not system.getFileStatus(folder).isDirectory():
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(folder))


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        folder, system = opened(spark, path)
        system.delete(folder, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file within its file system; the folder it goes to is made."""
    before, system = opened(spark, source)
    after, _ = opened(spark, target)
    system.mkdirs(after.getParent())
    if not system.rename(before, after):
        raise OSError(f"{source} can't be moved to {target}")


def read_text(spark: SparkSession, path: str) -> str | None:
    file, system = opened(spark, path)
    if not system.exists(file):
        return None
    stream = system.open(file)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, content: str) -> None:
    file, system = opened(spark, path)
    stream = system.create(file, True)
    try:
        stream.write(bytearray(content.encode("utf-8")))
    finally:
        stream.close()


def fresh_path(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    For reduced results that several branches read: the expensive scan runs once, the lineage ends
    here, and a lost executor costs a re-read of the table instead of a recomputation.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
