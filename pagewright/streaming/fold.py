"""An extension: new files folded into a table as they arrive, with the batch result.

Each micro-batch drops repeats within itself and rows the target has, so that a replayed batch
changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pagewright.operators.sinks import read_or_none


def fold_new(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, key: list[str], form: str = "parquet") -> None:
    """Append rows of new files under ``source`` to the parquet table ``target``, once per key, then stop."""

    def merge(batch: DataFrame, _id: int) -> None:
        fresh = batch.dropDuplicates(key)
        have = read_or_none(spark, target)
        (fresh if have is None else fresh.join(have.select(*key), key, "left_anti")).write.mode("append").parquet(target)

    query = spark.readStream.schema(schema).format(form).load(source).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
