"""Sources mixed to target shares along a time-varying curriculum.

Each source has a weight over training time t in [0, 1]; its integral is the source's demand of
tokens up to t. A document whose source has supplied c tokens before it belongs at the t where
that demand reaches c, so inverting the integral gives every draw its position, and sorting by
position in ranges gives the training order. Nothing is drawn by chance.

Weights are linear, share x (1 + slope x (2t - 1)). Slopes that sum to zero under the shares
keep the weights adding up to one at all times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.session import cut, width

BUCKETS = 256  # prefix sums run over at least so many hash buckets a source, then within each
BUCKET_ROWS = 50_000  # and over so many that a bucket has about this many rows
TILT = 0.5  # how strongly weights move over training: scarce sources come late


def plan(supply: DataFrame, targets: DataFrame, total_tokens: int | None = None, tilt: float = TILT) -> DataFrame:
    """One row per target: supply, tokens wanted, the schedule's slope.

    Without ``total_tokens`` the mix is as large as the capped supplies allow at exact shares;
    targets without supply or share can contribute nothing and the others share their part.
    With ``total_tokens`` a source whose capped supply falls short gives all it may.
    """
    t = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("target_share"), F.max(F.struct(F.col("max_repeats").isNull().alias("open"), "max_repeats")).alias("m"))
    t = t.join(supply, "source", "left").select(
        "source", F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0)).alias("target_share"), F.when(~F.col("m.open"), F.greatest(F.col("m.max_repeats"), F.lit(0))).alias("cap"),
        F.coalesce("supply", F.lit(0)).alias("supply"), F.coalesce("docs", F.lit(0)).alias("docs"),
    )
    every = Window.partitionBy(F.lit(1))  # as many rows as targets
    live = (F.col("supply") > 0) & (F.col("target_share") > 0) & (F.col("cap").isNull() | (F.col("cap") > 0))
    t = t.withColumn("share", F.when(live, F.col("target_share") / F.sum(F.when(live, F.col("target_share"))).over(every)).otherwise(0.0))
    most = F.when(F.col("share") > 0, F.col("supply") * F.col("cap") / F.col("share"))
    # Open-ended sources alone would never end: then every document is drawn once on average.
    t = t.withColumn("total", F.lit(float(total_tokens)) if total_tokens else F.coalesce(F.min(most).over(every), F.sum(F.when(live, F.col("supply"))).over(every).cast("double")))
    t = t.withColumn("want", F.least(F.col("share") * F.col("total"), F.coalesce(F.col("supply") * F.col("cap"), F.lit(float("inf"))).cast("double")))
    # Scarcity centred under the shares, scaled into [-tilt, tilt].
    scarce = F.when(F.col("share") > 0, F.log1p(F.col("want") / F.col("supply"))).otherwise(0.0)
    t = t.withColumn("_s", scarce).withColumn("_s", F.col("_s") - F.sum(F.col("_s") * F.col("share")).over(every))
    t = t.withColumn("slope", F.when(F.col("share") > 0, F.lit(tilt) * F.col("_s") / F.greatest(F.max(F.abs("_s")).over(every), F.lit(1e-9))).otherwise(0.0))
    return t.select("source", "target_share", "cap", "supply", "docs", "share", "total", "want", "slope")


def position(done: Column, want: Column, slope: Column) -> Column:
    """Inverse of want x (t + slope x (t^2 - t)) at ``done``: t in [0, 1]."""
    y = F.least(done / want, F.lit(1.0))
    b = 1 - slope
    root = (F.sqrt(b * b + 4 * slope * y) - b) / (2 * slope)
    return F.when(F.abs(slope) < 1e-9, y).otherwise(F.least(F.greatest(root, F.lit(0.0)), F.lit(1.0)))


def draw(docs: DataFrame, targets: DataFrame, key: str = "doc_id", tokens: str = "tokens", total_tokens: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(draws, shares). draws: source, key, repeat_no, tokens, position, in training order.
    shares: source, target_share, docs, draws, tokens, max_repeat, cap, wanted (tokens), sets_total
    (whether the source's cap is what the size of the mix goes by), reached_share.

    Documents come in the order of a hash of their key, so each prefix of a source is a fair
    sample. A document is drawn in epoch e if the tokens drawn before it leave at least half of
    it wanted. Documents without tokens, source or key, or of a source without target, are not
    drawn; ties in position fall to source and key. Empty tables give empty results.
    """
    named = docs.where(F.col("source").isNotNull() & F.col(key).isNotNull() & (F.col(tokens) > 0)).select("source", F.col(key).alias("key"), F.col(tokens).cast("long").alias("tokens"))
    named = cut(named.withColumn("h", F.xxhash64("key")))
    named = named.withColumn("bucket", F.pmod(F.shiftright("h", 20), F.lit(max(BUCKETS, -(-named.count() // BUCKET_ROWS)))).cast("int"))
    buckets = named.groupBy("source", "bucket").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    supply = buckets.groupBy("source").agg(F.sum("t").alias("supply"), F.sum("n").alias("docs"))
    goal = cut(plan(supply, targets, total_tokens))  # as many rows as targets
    # Cumulative tokens without a task per source: sums before the bucket, then within it.
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("source", "bucket", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("source", "bucket").orderBy("h", "key").rowsBetween(Window.unboundedPreceding, -1)
    placed = named.withColumn("_in", F.coalesce(F.sum("tokens").over(within), F.lit(0))).join(offsets, ["source", "bucket"]).withColumn("start", F.col("_in") + F.col("offset"))
    wanted = placed.join(goal.where("want > 0"), "source")
    # Epoch e holds the document at e x supply + start; it is drawn while at least half of it is wanted.
    last = F.ceil((F.col("want") - F.col("start") - F.col("tokens") / 2) / F.col("supply"))
    times = F.least(F.greatest(last, F.lit(0)), F.coalesce(F.col("cap"), F.lit(2**31 - 1)).cast("long")).cast("int")
    drawn = wanted.withColumn("_n", times).where("_n > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("repeat_no"))
    done = F.col("repeat_no") * F.col("supply") + F.col("start") + F.col("tokens") / 2
    draws = drawn.select("source", F.col("key").alias(key), "repeat_no", "tokens", F.round(position(done, F.col("want"), F.col("slope")), 12).alias("position"))
    ordered = draws.repartitionByRange(width(docs.sparkSession), "position", "source", key).sortWithinPartitions("position", "source", key)
    got = draws.groupBy("source").agg(F.count(F.lit(1)).alias("draws"), F.sum("tokens").alias("tokens"), (F.max("repeat_no") + 1).alias("max_repeat"))
    every = Window.partitionBy(F.lit(1))
    shares = goal.join(got, "source", "left").select(
        "source", "target_share", "docs", F.coalesce("draws", F.lit(0)).alias("draws"), F.coalesce(got["tokens"], F.lit(0)).alias("tokens"), F.coalesce("max_repeat", F.lit(0)).alias("max_repeat"), "cap",
        F.round("want").cast("long").alias("wanted"), (F.lit(total_tokens is None) & (F.col("share") > 0) & F.col("cap").isNotNull() & (F.col("supply") * F.col("cap") <= F.col("want") * (1 + 1e-9))).alias("sets_total"),
    ).withColumn("reached_share", F.round(F.col("tokens") / F.sum("tokens").over(every), 6))
    return ordered, shares
