"""Versioned history of slowly changing attributes out of repeated snapshots.

Each snapshot gets a Merkle tree over buckets of its keys: rows hash into leaves, leaves into
branches, branches into a root. A node whose digest equals the one of its previous delivery
holds the same rows with the same values, so nothing under it can open a version. Roots and
branches are compared first, their unchanged rows are gone before the shuffle by leaf; leaves
are compared next, and only rows of changed leaves are diffed and appended as versions.

Rows travel as hashes of their normalised values; the values themselves come along only where
the result shows them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.text import blank_to_null, folded
from pagewright.session import cut, width

LEAF_BITS = 20
BRANCH_BITS = 8


def _latest_delivery(rows: DataFrame, key: str, snapshot: str, loaded: str, tiebreak: str, attrs: list[str], values: bool) -> DataFrame:
    """One row per key and snapshot; combined before the shuffle, so a row delivered very often is no hot key."""
    keep = rows.where(F.col(key).isNotNull() & F.col(snapshot).isNotNull())
    norm = [F.when(blank_to_null(c).isNotNull(), F.xxhash64(c)).alias(f"_n{i}") for i, c in enumerate(folded(*attrs))]
    shown = [F.col(a).alias(f"_v{i}") for i, a in enumerate(attrs) if values]
    keep = keep.select(F.col(key).alias("_key"), F.col(snapshot).alias("_snap"), F.col(loaded).alias("_loaded"), F.col(tiebreak).alias("_tie"), *shown, *norm)
    names = [f"{p}{i}" for p in ("_n", *(["_v"] if values else [])) for i in range(len(attrs))]
    return (
        keep.groupBy("_key", "_snap")
        .agg(F.max_by(F.struct(*names), F.struct("_loaded", "_tie")).alias("_r"))
        .select("_key", "_snap", *[F.col("_r")[n].alias(n) for n in names])
    )


def _changed(nodes: DataFrame, *by: str) -> DataFrame:
    """Nodes whose digest differs from their previous delivery, or that have none."""
    w = Window.partitionBy(*by).orderBy("_snap") if by else Window.orderBy("_snap")
    now = F.struct("_d1", "_d2", "_dc")
    return nodes.withColumn("_before", F.lag(now).over(w)).where(~now.eqNullSafe(F.col("_before")))


def history(
    rows: DataFrame, key: str, snapshot: str, attrs: list[str], loaded: str, tiebreak: str,
    leaf_bits: int = LEAF_BITS, branch_bits: int = BRANCH_BITS, values: bool = True,
) -> DataFrame:
    """All versions of ``attrs`` per ``key``: (key, from_snapshot, to_snapshot, attrs...).

    Of several rows of one key and snapshot the one loaded last counts (ties: the larger
    ``tiebreak``; a null load time loses). Blank values keep the last known value, white space,
    case and Unicode composition are no change, a snapshot without the key changes nothing.
    Values are shown as spelled where they came up. ``to_snapshot`` is null for the open version. Rows with a null key or snapshot belong to no
    item and give nothing; an empty table gives no row; extra columns are ignored.
    ``leaf_bits`` should put a handful of keys into a leaf. Without ``values`` only the periods come out.
    """
    n = len(attrs)
    normal, shown = [f"_n{i}" for i in range(n)], [f"_v{i}" for i in range(n) if values]
    signed = (
        _latest_delivery(rows, key, snapshot, loaded, tiebreak, attrs, values)
        .withColumn("_leaf", F.pmod(F.xxhash64("_key"), F.lit(1 << leaf_bits)))
        .withColumn("_branch", F.shiftright("_leaf", leaf_bits - branch_bits))
    )
    signed = cut(signed)  # the trees and the rows under them are read from it, which would otherwise mean a second scan and shuffle
    # Fields are hashed with their place, as a null leaves a hash unchanged. Half the range keeps the sums from overflowing.
    fields = F.array(*[F.coalesce(F.col(c), F.lit(0)) for c in normal])
    signed = signed.withColumn("_h1", F.shiftright(F.xxhash64("_key", fields), 24)).withColumn("_h2", F.shiftright(F.xxhash64("_key", fields, F.lit(7)), 24))
    branches = signed.groupBy("_snap", "_branch").agg(F.sum("_h1").alias("_d1"), F.sum("_h2").alias("_d2"), F.count(F.lit(1)).alias("_dc"))
    roots = branches.groupBy("_snap").agg(F.sum("_d1").alias("_d1"), F.sum("_d2").alias("_d2"), F.sum("_dc").alias("_dc"))
    open_roots = _changed(roots).select("_snap")
    open_branches = _changed(branches, "_branch").select("_snap", "_branch").join(open_roots, "_snap", "left_semi")
    # At most 2 ** branch_bits nodes a snapshot, whatever the data.
    below = signed.join(F.broadcast(open_branches), ["_snap", "_branch"], "left_semi").repartition(width(rows.sparkSession), "_leaf")

    in_node = Window.partitionBy("_leaf", "_snap")
    earlier = Window.partitionBy("_leaf").orderBy("_snap").rangeBetween(Window.unboundedPreceding, -1)
    digest = F.struct(F.sum("_h1").over(in_node), F.sum("_h2").over(in_node), F.count(F.lit(1)).over(in_node))
    below = below.withColumn("_d", digest)
    changed = below.withColumn("_before", F.last("_d").over(earlier)).where(~F.col("_d").eqNullSafe(F.col("_before")))

    item = Window.partitionBy("_leaf", "_key").orderBy("_snap")
    so_far = item.rowsBetween(Window.unboundedPreceding, 0)
    until = item.rowsBetween(Window.unboundedPreceding, -1)
    changed = changed.select("_leaf", "_key", "_snap", *normal, *shown, *[F.last(f"_n{i}", ignorenulls=True).over(until).alias(f"_p{i}") for i in range(n)])
    # A value is shown as spelled where it came up, which no pruned row can be.
    fresh = lambda i: F.col(f"_n{i}").isNotNull() & ~F.col(f"_n{i}").eqNullSafe(F.col(f"_p{i}"))
    known = changed.select(
        "_leaf", "_key", "_snap",
        *[F.last(f"_n{i}", ignorenulls=True).over(so_far).alias(f"_n{i}") for i in range(n)],
        *[F.last(F.when(fresh(i), F.col(v)), ignorenulls=True).over(so_far).alias(v) for i, v in enumerate(shown)],
    )
    now = F.struct(*normal)
    versions = known.withColumn("_now", now).withColumn("_before", F.lag("_now").over(item)).where(~F.col("_now").eqNullSafe(F.col("_before")))
    return versions.select(
        F.col("_key").alias(key), F.col("_snap").alias("from_snapshot"), F.lead("_snap").over(item).alias("to_snapshot"),
        *[F.col(v).alias(a) for v, a in zip(shown, attrs)],
    )
