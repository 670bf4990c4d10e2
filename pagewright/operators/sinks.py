"""Writing results: whole or not at all, finished runs never overwritten, and plans that write nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

RUN = ["run_id", "doc_id"]


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def replace_table(df: DataFrame, path: str) -> None:
    """Write beside the target and rename, so a reader sees the old rows or the new ones and a failed job leaves the old."""
    spark = df.sparkSession
    staged, old = f"{path}.part", f"{path}.old"
    df.write.mode("overwrite").parquet(staged)
    (new, fs), (target, _), (kept, _) = _folder(spark, staged), _folder(spark, path), _folder(spark, old)
    fs.delete(kept, True)
    if fs.exists(target):
        fs.rename(target, kept)
    if not fs.rename(new, target):
        fs.rename(kept, target)
        raise OSError(f"{path} could not be replaced")
    fs.delete(kept, True)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where there is none yet; any other error is raised."""
    at, fs = _folder(spark, path)
    if not fs.exists(at):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            return None
        raise


def plan_runs(rows: DataFrame, path: str) -> DataFrame:
    """The rows of runs that the folder does not hold yet: what ``write_runs`` would write, and nothing is written."""
    have = read_or_none(rows.sparkSession, path)
    return rows if have is None else rows.join(have.select(*RUN).distinct(), RUN, "left_anti")


def write_runs(rows: DataFrame, path: str, compression: str = "zstd") -> None:
    """Append new runs under run_id; a run and filing that is there already stays as it is."""
    plan_runs(rows, path).write.mode("append").option("compression", compression).partitionBy("run_id").parquet(path)


def write_documents(rows: DataFrame, path: str) -> None:
    """Extraction documents as gzip-compressed JSON lines, one folder a run."""
    rows.write.mode("append").option("compression", "gzip").partitionBy("run_id").json(path)


def write_triage(tiers: DataFrame, path: str, policy_version: int) -> None:
    """Pages with a tier, under the version of the policy that sorted them; another version's stay beside them."""
    replace_table(tiers.where(F.size("tiers") > 0), f"{path}/policy_version={policy_version}")


def upsert(target: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """The table after the changes: a changed key takes the new row, with null for columns the change lacks; keys are unique in ``changes``."""
    return target.join(changes.select(*key), key, "left_anti").unionByName(changes, allowMissingColumns=True)
