"""How much of an independent reference's characters our text holds, page by page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.scalars import coverage_norm
from pagewright.session import spread as over_cores

LETTERS = "0123456789abcdefghijklmnopqrstuvwxyz"
LEAST = 100  # characters under which a reference page says nothing


def _histogram(norm: Column) -> list:
    """Counts of the 36 characters that can occur in ``norm``; fixed columns instead of a row per character."""
    return [(F.length(norm) - F.length(F.replace(norm, F.lit(ch), F.lit("")))).alias(f"_{ch}") for ch in LETTERS]


def page_coverage(ours: DataFrame, reference: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, page_no, ref_chars, shared): multiset overlap; reference pages under ``least`` characters are skipped.

    ``ours`` has doc_id, page_no and text, any number of rows a page; counts add up before the
    join. ``reference`` has doc_id, page_no, text and ``place``: of several entries of a page the
    last counts. Texts are normalised once and spread, as the counting is bound by CPU.
    """
    pre = lambda df: df.select("doc_id", "page_no", *_histogram(F.col("norm")))
    norm = lambda df: over_cores(df, "doc_id", "page_no").withColumn("norm", coverage_norm(F.col("text")))
    last = over_cores(reference, "doc_id", "page_no").groupBy("doc_id", "page_no").agg(F.max_by("text", "place").alias("text")).withColumn("norm", coverage_norm(F.col("text"))).where(F.length("norm") >= least)
    a = pre(norm(ours)).groupBy("doc_id", "page_no").agg(*[F.sum(f"_{ch}").alias(f"o_{ch}") for ch in LETTERS])
    b = pre(last)
    total = sum((F.col(f"_{ch}") for ch in LETTERS), F.lit(0))
    shared = sum((F.least(F.col(f"_{ch}"), F.coalesce(F.col(f"o_{ch}"), F.lit(0))) for ch in LETTERS), F.lit(0))
    return b.withColumn("ref_chars", total).join(a, ["doc_id", "page_no"], "left").select("doc_id", "page_no", F.col("ref_chars").cast("long"), shared.cast("long").alias("shared"))


def summary(pages: DataFrame) -> DataFrame:
    """Per filing and over all pages (doc_id ALL): pages, mean, median and how many fall in each band."""
    c = F.col("shared") / F.col("ref_chars")
    return (
        pages.withColumn("c", c).withColumn("doc", F.explode(F.array(F.col("doc_id"), F.lit("ALL")))).groupBy(F.col("doc").alias("doc_id"))
        .agg(
            F.count(F.lit(1)).alias("pages"), F.round(F.avg("c"), 6).alias("mean"), F.round(F.percentile("c", F.lit(0.5)), 6).alias("median"), F.count_if(F.col("c") >= 0.95).alias("ge95"),
            F.count_if((F.col("c") >= 0.8) & (F.col("c") < 0.95)).alias("ge80"), F.count_if((F.col("c") >= 0.5) & (F.col("c") < 0.8)).alias("ge50"), F.count_if(F.col("c") < 0.5).alias("lt50"),
        )
    )
