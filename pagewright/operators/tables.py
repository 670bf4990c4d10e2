"""Checks of table columns: one-character confusions, lone non-numbers, dropped cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.scalars import NUMERIC_CELL

COLUMN = ["gz_id", "t", "c"]


def suspect_confusions(cells: DataFrame) -> DataFrame:
    """Values of one column that differ from another in one place, a digit against a letter.

    Equi-join on the value with each place masked in turn, so no pair of values is compared that
    does not already agree everywhere else. The side with the digit is the suspect.
    """
    v = cells.where(~F.col("header") & (F.length("text") >= 3)).select(*COLUMN, F.trim("text").alias("value")).where(F.length("value") >= 3).distinct()
    places = F.sequence(F.lit(1), F.length("value"))
    masked = v.select(*COLUMN, "value", F.explode(places).alias("i")).select(*COLUMN, "value", "i", F.substr("value", F.col("i"), F.lit(1)).alias("ch"), F.concat(F.substr("value", F.lit(1), F.col("i") - 1), F.lit("\x01"), F.substr("value", F.col("i") + 1)).alias("mask"))
    a = masked.where(F.col("ch").rlike(r"^\p{Nd}$")).select(*COLUMN, "mask", "i", F.col("value").alias("suspect"))
    b = masked.where(F.col("ch").rlike(r"^\p{L}$")).select(*COLUMN, "mask", "i", F.col("value").alias("sibling"))
    return a.join(b, [*COLUMN, "mask", "i"]).select(*COLUMN, "suspect", "sibling").distinct()


def numeric_column_outliers(cells: DataFrame, least: int = 10) -> DataFrame:
    """Columns of at least ``least`` body values where exactly one is no number."""
    body = cells.where(~F.col("header") & (F.trim("text") != "")).withColumn("ok", F.trim("text").rlike(NUMERIC_CELL))
    g = body.groupBy(*COLUMN).agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok")).alias("bad"), F.max(F.when(~F.col("ok"), F.trim("text"))).alias("value"))
    return g.where((F.col("n") >= least) & (F.col("bad") == 1)).select(*COLUMN, "n", "value")


def listed(suspects: DataFrame, key: list[str], most: int) -> DataFrame:
    """Suspects in reading order, numbered per ``key``: by page, unknown pages last, then column; ``most`` at most, ``over`` says how many more there are."""
    w = Window.partitionBy(*key)
    ranked = suspects.select("*", F.row_number().over(w.orderBy(F.col("page").asc_nulls_last(), "c", "suspect", "sibling")).alias("n"), F.greatest(F.count(F.lit(1)).over(w) - most, F.lit(0)).alias("over"))
    return ranked.where(F.col("n") <= most)


def mode_choice(modes: DataFrame, key: list[str]) -> DataFrame:
    """Whether the alternate table mode is kept: only tried where the first dropped cells."""
    better = (F.col("alt_dropped") < F.col("dropped")) | ((F.col("alt_dropped") == F.col("dropped")) & (F.col("alt_text") > F.col("text")))
    return modes.where("dropped > 0").select(*key, F.when(better, "alternate").otherwise("first").alias("kept"), (F.col("shape") == F.col("alt_shape")).alias("shapes_agree"))
