"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str = "local[*]", app: str = "tracklake", partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the operators rely on, whatever session they are given."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    # Emitters build long arrays. HotSpot never compiles methods over 8000 bytes, so let Spark fall back
    # to split projection code there instead of one huge interpreted method.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. A session that names none gets a temporary one if it runs in one process;
    executors on other machines would each write to a disk of their own, so there it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = os.path.join(tempfile.gettempdir(), "tracklake-checkpoints")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write `df` once as a table in the shared folder and continue from there.

    Used where a result is read by several later jobs and is much smaller than its inputs. A table, unlike
    a row checkpoint, lets the later jobs read only the columns they need. `compression="zstd"` is for texts.
    """
    path = fresh_path(df.sparkSession, "stage")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal a table that comes in fewer pieces than there are cores out evenly.

    For jobs that turn each row into dozens without a shuffle of their own. A large table has more pieces
    than cores and is left as it is. Looking at the pieces only plans the scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fan_out(df: DataFrame, key: str) -> DataFrame:
    """Deal few and small rows by a key to all tasks, before each becomes many times as large in its row.

    A plain shuffle of so little data would be put together into one task again.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), key)


def deal(df: DataFrame, key: str, rows: int = 50_000) -> DataFrame:
    """Deal a table by a key to tasks of about `rows` rows, before each row becomes dozens.

    What a task holds then does not grow with the table, and whatever groups the many rows by that key, alone or with
    other columns, finds them in place: only the narrow rows are shuffled. Counting a table's rows reads its footers.
    """
    return df.repartition(tasks_for(df, rows), key)


def tasks_for(df: DataFrame, rows: int = 50_000) -> int:
    """Tasks of about `rows` rows for a table, at least one for each core."""
    return max(-(-df.count() // rows), df.sparkSession.sparkContext.defaultParallelism)
