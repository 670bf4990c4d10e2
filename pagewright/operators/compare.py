"""Differences between two copies of a keyed dataset.

Rows of both copies are sorted by key within shared key ranges and cut into chunks where a
rolling hash over the last keys meets a condition, so a missing row moves only the cuts beside
it. Chunks with the same fingerprint on both sides are equal and leave by an anti-join; only
rows of the other chunks meet in a full outer join that is diffed field by field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.session import cut, width

ROLL = 4  # keys under the rolling hash
MEAN_CHUNK = 32  # one position in so many ends a chunk


def chunked(sides: DataFrame, fields: list[str], mean_chunk: int = MEAN_CHUNK) -> DataFrame:
    """``sides`` (side, key, fields) with the fingerprint of the chunk each row falls in."""
    df = sides.repartitionByRange(width(sides.sparkSession), "key").withColumn("block", F.spark_partition_id())
    w = Window.partitionBy("block", "side").orderBy("key")
    keyed = df.withColumn("_k", F.xxhash64("key"))
    rolling = F.xxhash64(*[F.coalesce(F.lag("_k", i).over(w), F.lit(0)) for i in range(ROLL)])
    marked = keyed.withColumn("_cut", (F.pmod(rolling, F.lit(mean_chunk)) == 0).cast("int"))
    # A cut closes its chunk, so a row's chunk is the number of cuts before it.
    numbered = marked.withColumn("_chunk", F.coalesce(F.sum("_cut").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    text = F.to_json(F.struct("key", *fields), {"ignoreNullFields": "false"})
    signed = numbered.withColumn("_h1", F.shiftright(F.xxhash64(text), 24)).withColumn("_h2", F.shiftright(F.xxhash64(text, F.lit(7)), 24))
    node = Window.partitionBy("block", "side", "_chunk")
    fingerprint = F.concat_ws(":", F.sum("_h1").over(node), F.sum("_h2").over(node), F.count(F.lit(1)).over(node))
    return signed.withColumn("fingerprint", fingerprint).select("side", "key", *fields, "fingerprint")


def differences(here: DataFrame, there: DataFrame, fields: list[str], mean_chunk: int = MEAN_CHUNK) -> DataFrame:
    """(key, field, kind, here, there): kind is missing_there, missing_here or differs.

    Both inputs have ``key`` and ``fields``; further columns are ignored. Keys must be unique on
    each side (rows repeated whole are dropped here). A null field against a value differs, two
    nulls do not; rows with a null key cannot be matched and are left out. A missing row gives one
    output row with field ``row``. Empty sides make every row of the other one missing.
    """
    pick = lambda df, side: df.where(F.col("key").isNotNull()).select(F.lit(side).alias("side"), "key", *fields)
    both = pick(here, 0).unionByName(pick(there, 1)).distinct()
    rows = cut(chunked(both, fields, mean_chunk))  # both sides must see the same cuts
    prints = rows.select("side", "fingerprint").distinct()
    left, right = (rows.where(F.col("side") == s).join(prints.where(F.col("side") == 1 - s).select("fingerprint"), "fingerprint", "left_anti") for s in (0, 1))
    whole = F.struct(*fields)
    paired = left.select("key", whole.alias("a")).join(right.select("key", whole.alias("b")), "key", "full")
    a, b = F.col("a"), F.col("b")

    def entry(field: str, kind: str, x: Column, y: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), F.lit(kind).alias("kind"), x.cast("string").alias("here"), y.cast("string").alias("there"))

    none = F.lit(None)
    diffs = F.filter(F.array(*[F.when(~a[f].eqNullSafe(b[f]), entry(f, "differs", a[f], b[f])) for f in fields]), lambda x: x.isNotNull())
    found = F.when(b.isNull(), F.array(entry("row", "missing_there", none, none))).when(a.isNull(), F.array(entry("row", "missing_here", none, none))).otherwise(diffs)
    return paired.select("key", F.explode(found).alias("d")).select("key", "d.field", "d.kind", "d.here", "d.there")
