"""Session helpers every operator shares: table access, spreading, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table as a column-prunable parquet scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def width(spark: SparkSession) -> int:
    """Partitions for a CPU-bound stage: every core busy, more once the shuffle width asks for it."""
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, *cols) -> DataFrame:
    """Redistribute before a CPU-bound stage. Hashes the given columns, or round robin without any."""
    return df.repartition(width(df.sparkSession), *cols)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors share; one of our own only on a single machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="pagewright-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of the session."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def store(df: DataFrame) -> DataFrame:
    """The rows written once as a compressed table in the shared folder and read back; gone when the session ends."""
    spark = df.sparkSession
    at = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(at)
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(at)


def once(df: DataFrame, key: str) -> DataFrame:
    """Rows repeated whole share their key, so one row per key; rows with a null key are left out.

    Repeats are dropped before the shuffle as well, so a row repeated very often is no hot key.
    """
    rest = [c for c in df.columns if c != key]
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.first(F.struct(*rest)).alias("_row"))
        .select(key, *[F.col("_row")[c].alias(c) for c in rest])
    )
