"""Scoring and choosing among several readings of a page, and how far they agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.scalars import alnum_count, number_tokens, words
from pagewright.session import spread as over_cores

MARGIN = 0.02
MOST = 8  # readings of a page that are compared
PAGE = ["doc_id", "page_no"]


def page_quality(readings: DataFrame) -> DataFrame:
    """Adds chars, alnum (which is also the score) and the alphanumeric share; nulls count as empty."""
    text = F.coalesce("text", F.lit(""))
    q = readings.withColumn("chars", F.length(text)).withColumn("alnum", alnum_count(text))
    return q.withColumn("alnum_ratio", F.when(F.col("chars") > 0, F.round(F.col("alnum") / F.col("chars"), 4)).otherwise(0.0))


def looks_broken(chars: Column, ratio: Column) -> Column:
    return (chars < 50) | (ratio < 0.35)


def select_reading(scored: DataFrame, margin: float = MARGIN) -> DataFrame:
    """The winner per page: a fold in trial order where a challenger must beat the incumbent by the margin.

    Readings of one page are few, so the fold runs over an array built with map-side combine.
    """
    tried = F.array_sort(F.collect_list(F.struct("ord", "variant", F.col("alnum").alias("score"))))
    fold = F.reduce(F.slice("tried", 2, 1000), F.element_at("tried", 1), lambda best, x: F.when(x["score"] > best["score"] * (1 + margin), x).otherwise(best))
    return scored.groupBy(*PAGE).agg(tried.alias("tried")).select(*PAGE, fold.alias("w"), F.size("tried").alias("attempts"), F.element_at("tried", 1)["variant"].alias("first_tried")).select(*PAGE, F.col("w.variant").alias("variant"), F.col("w.score").alias("score"), "attempts", "first_tried")


def excluded(scored: DataFrame, winners: DataFrame) -> DataFrame:
    """Other readings that are no credible witness, with the reason."""
    w = winners.select(*PAGE, F.col("variant").alias("winner"))
    return scored.join(w, PAGE).where((F.col("variant") != F.col("winner")) & looks_broken(F.col("chars"), F.col("alnum_ratio"))).select(*PAGE, "variant", F.when(F.col("chars") < 50, "almost_no_text").otherwise("not_character_like").alias("reason"))


def numeric_tokens(readings: DataFrame) -> DataFrame:
    """(page, variant, token, n): numbers as written, however often."""
    return readings.select(*PAGE, "variant", F.explode(number_tokens(F.col("text"))).alias("token")).groupBy(*PAGE, "variant", "token").agg(F.count(F.lit(1)).alias("n"))


def compared(readings: DataFrame, margin: float = MARGIN) -> DataFrame:
    """One row per page that has a credible reading beside the winner: (page, winner, others, texts).

    ``winner`` and ``others`` are variants, ``texts`` the (variant, text) of all of them, the winner first; no more than ``MOST``. The
    readings of a page are brought together once, over all cores; everything that compares them
    stays in the partition they came to, so no comparison costs another exchange.
    """
    scored = page_quality(over_cores(readings.select(*PAGE, "ord", "variant", "text"), *PAGE))
    reading = F.struct("ord", "variant", F.col("alnum").alias("score"), (~looks_broken(F.col("chars"), F.col("alnum_ratio"))).alias("credible"), F.coalesce("text", F.lit("")).alias("text"))
    g = scored.groupBy(*PAGE).agg(F.array_sort(F.collect_list(reading)).alias("rs"))
    fold = F.reduce(F.slice("rs", 2, 1000), F.element_at("rs", 1), lambda best, x: F.when(x["score"] > best["score"] * (1 + margin), x).otherwise(best))
    g = g.select(*PAGE, "rs", fold["variant"].alias("winner"))
    slim = lambda rs: F.transform(rs, lambda r: F.struct(r["variant"].alias("variant"), r["text"].alias("text")))
    own = F.filter("rs", lambda r: r["variant"] == F.col("winner"))
    rest = F.filter("rs", lambda r: r["credible"] & (r["variant"] != F.col("winner")))
    texts = g.select(*PAGE, "winner", F.concat(slim(F.slice(own, 1, 1)), slim(rest)).alias("texts")).where(F.size("texts") > 1)
    return texts.select(*PAGE, "winner", F.transform(F.slice("texts", 2, MOST), lambda r: r["variant"]).alias("others"), F.when(F.size("texts") > MOST, F.raise_error(F.lit(f"more than {MOST} readings of a page"))).otherwise(F.col("texts")).alias("texts"))


def token_counts(pages: DataFrame) -> DataFrame:
    """(page, winner, others, kind, token, wn, on) of ``compared`` pages: how often a word or number stands in the winner and in each of the others."""
    each = pages.select(*PAGE, "winner", "others", F.posexplode("texts").alias("i", "r")).select(*PAGE, "winner", "others", "i", F.col("r.text").alias("text"))
    tagged = lambda kind, tokens: F.transform(tokens, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("token")))
    tokens = each.select(*PAGE, "winner", "others", "i", F.explode(F.concat(tagged("word", words(F.col("text"))), tagged("number", number_tokens(F.col("text"))))).alias("t"))
    # Plain sums, one for each place among the texts, stay in a hash aggregate; the winner is first.
    held = tokens.groupBy(*PAGE, "winner", "others", "t.kind", "t.token").agg(*[F.sum(F.when(F.col("i") == k, 1).otherwise(0)).alias(f"_{k}") for k in range(MOST)])
    return held.select(*PAGE, "winner", "others", "kind", "token", F.col("_0").alias("wn"), F.slice(F.array(*[f"_{k}" for k in range(1, MOST)]), F.lit(1), F.size("others")).alias("on"))


DIRECTIONS = ("winner_missing", "others_missing", "bidirectional")


def _kind() -> tuple[Column, Column, Column]:
    """Whether the token of a ``token_counts`` row is a number counted differently, the conflict's kind and its direction."""
    apart = F.filter("on", lambda n: n != F.col("wn"))
    conflict = (F.col("kind") == "number") & (F.size(apart) > 0)
    token = (F.col("wn") == 0) | F.exists(apart, lambda n: n == 0)
    direction = F.when(token, F.when(F.col("wn") == 0, DIRECTIONS[0]).when(F.forall(apart, lambda n: n == 0), DIRECTIONS[1]).otherwise(DIRECTIONS[2]))
    return conflict, F.when(token, "token_difference").otherwise("count_difference"), direction


def _per_variant(tokens: DataFrame, *extra: Column) -> DataFrame:
    each = tokens.select(*PAGE, "kind", "wn", *extra, F.posexplode(F.arrays_zip("others", "on")).alias("i", "z"))
    one = lambda kind, c: F.sum(F.when(F.col("kind") == kind, c).otherwise(0))
    counts = {"shared": F.least("wn", "z.on"), "total": F.col("z.on"), "winner_total": F.col("wn")}
    # What concerns the token and not the variant is counted with the first variant only.
    once = [F.sum(F.when(F.col("i") == 0, F.col(n))).alias(n) for n in (*(["_token", "_count", *DIRECTIONS] if extra else []),)]
    g = each.groupBy(*PAGE, F.col("z.others").alias("variant")).agg(*[one("word", c).alias(n) for n, c in counts.items()], *[one("number", c).alias(f"_{n}") for n, c in counts.items()], *once)
    ratio = lambda p: F.when(F.greatest(f"{p}total", f"{p}winner_total") == 0, 1.0).otherwise(F.round(F.col(f"{p}shared") / F.greatest(f"{p}total", f"{p}winner_total"), 4))
    return g.withColumn("ratio", ratio("")).withColumn("numeric_ratio", ratio("_"))


def text_agreement(tokens: DataFrame) -> DataFrame:
    """Shared words and numbers of the winner and each credible other reading: shared, both totals, ratio of either."""
    return _per_variant(tokens).select(*PAGE, "variant", "shared", "total", "winner_total", "ratio", "numeric_ratio")


def conflicts(tokens: DataFrame) -> DataFrame:
    """(page, token, winner_count, other_counts, kind, direction) of numbers that a credible reading counts differently.

    ``other_counts`` holds the readings that differ. A number that one side lacks is a token
    difference, whoever lacks it; its direction says which way it runs.
    """
    conflict, kind, direction = _kind()
    apart = F.map_from_entries(F.filter(F.zip_with("others", "on", lambda o, n: F.struct(o.alias("variant"), n.alias("n"))), lambda x: x["n"] != F.col("wn")))
    c = tokens.where(conflict).select(*PAGE, "token", F.col("wn").alias("winner_count"), apart.alias("other_counts"), kind.alias("kind"), direction.alias("direction"))
    return c.select("*", F.array_min(F.map_values("other_counts")).alias("least_other"), F.size("other_counts").alias("variants"))


def page_agreement(tokens: DataFrame, same: float = 0.98, keep: int = 40) -> DataFrame:
    """One row per page: least ratios, kinds and directions of its conflicts counted, the verdict, conflicts beyond ``keep``."""
    conflict, kind, direction = _kind()
    flag = lambda c, n: F.when(conflict & c, 1).otherwise(0).alias(n)
    per = _per_variant(tokens, flag(kind == "token_difference", "_token"), flag(kind == "count_difference", "_count"), *[flag(direction == d, d) for d in DIRECTIONS])
    g = per.groupBy(*PAGE).agg(
        F.array_join(F.array_sort(F.collect_list("variant")), "+").alias("compared_against"), F.min("ratio").alias("text_min"), F.min("numeric_ratio").alias("numeric_min"),
        F.sum("_token").alias("token_differences"), F.sum("_count").alias("count_differences"), *[F.sum(d).alias(d) for d in DIRECTIONS],
    )
    verdict = F.when(F.col("token_differences") > 0, "numbers_differ").when(F.col("text_min") < same, "text_differs_numbers_agree").otherwise("agree")
    return g.select("*", F.greatest(F.col("token_differences") + F.col("count_differences") - keep, F.lit(0)).alias("truncated"), verdict.alias("verdict"))


def conflict_top(directed: DataFrame, keep: int = 40) -> DataFrame:
    """The first conflicts per page by severity, ties by token, with how many were left out."""
    w = Window.partitionBy(*PAGE)
    ranked = directed.withColumn("rank", F.row_number().over(w.orderBy((F.col("kind") != "token_difference").cast("int"), -F.abs(F.col("winner_count") - F.col("least_other")), "token")))
    return ranked.withColumn("truncated", F.greatest(F.count(F.lit(1)).over(w) - keep, F.lit(0))).where(F.col("rank") <= keep)


def spread(scores: DataFrame, key: list[str]) -> DataFrame:
    """Spread and winning margin over a score map: (max - min) / max and (first - second) / first."""
    s = F.sort_array(F.map_values("scores"), asc=False)
    top, low, second = F.try_element_at(s, F.lit(1)), F.try_element_at(s, F.lit(-1)), F.try_element_at(s, F.lit(2))
    return scores.select(*key, F.when(top > 0, (top - low) / top).otherwise(0.0).alias("spread"), F.when(top > 0, (top - second) / top).alias("margin"))


def thin_pages(pages: DataFrame, share: float = 0.3) -> DataFrame:
    """Pages far below the median of the filing's pages of the same shape; a null shape is a group of its own.

    Medians come from a grouped aggregate and a null-safe join rather than a window, so a filing of any length stays distributed.
    """
    med = pages.groupBy("meta_id", "shape").agg(F.percentile(F.coalesce(F.when(F.col("chars") != 0, F.col("chars"))), F.lit(0.5)).alias("peer"))
    m = med.select(F.col("meta_id").alias("_m"), F.col("shape").alias("_s"), "peer")
    return pages.join(m, (F.col("meta_id") == F.col("_m")) & F.col("shape").eqNullSafe(F.col("_s"))).where((F.col("peer") > 0) & (F.col("chars") < share * F.col("peer"))).drop("_m", "_s")


def pairing(conflicts: DataFrame, key: list[str]) -> DataFrame:
    """Opposing conflicts of one page joined into candidate substitutions, with operation, priority, cause and the variants that hold and lack.

    ``conflicts`` has token, direction, other_counts and ``ix``, its place among the page's.
    Blocked on the page and the shared variant, so the pairs formed are those that can count;
    a page carries a bounded number of recorded conflicts. Tokens are taken apart before they are
    paired and each pair is judged once.
    """
    from pagewright.functions.scalars import COMMON, OPERATIONS, magnitude_cause, number_parts, operation

    rare = conflicts.where(~F.col("token").rlike(COMMON))
    # Spread by the join's keys before the tokens are taken apart, so that neither side waits for one task.
    side = lambda df, name: over_cores(df.select(*key, "ix", "token", "variant"), *key, "variant").select(*key, F.struct("ix", "token", *number_parts(F.col("token"))).alias(name), "variant")
    holds = rare.where("direction = 'winner_missing'").select("*", F.explode(F.map_keys(F.map_filter("other_counts", lambda k, v: v > 0))).alias("variant"))
    lacks = rare.where("direction = 'others_missing'").select("*", F.explode(F.map_keys(F.map_filter("other_counts", lambda k, v: v == 0))).alias("variant"))
    both = side(holds, "b").join(side(lacks, "a"), [*key, "variant"]).groupBy(*key, "a", "b").agg(F.array_sort(F.collect_set("variant")).alias("variants"))
    # Through a generator the operation is evaluated once, not again in a filter.
    judged = both.select("*", F.explode(F.array_compact(F.array(operation(F.col("a"), F.col("b"))))).alias("operation"))
    priority = F.array_position(F.array(*[F.lit(o) for o in OPERATIONS]), F.col("operation")).cast("int") - 1
    cause = F.when(F.col("operation") == "magnitude_shift", magnitude_cause(F.col("a"), F.col("b")))
    return judged.select(*key, F.col("a.token").alias("kept"), F.col("b.token").alias("other"), "operation", priority.alias("priority"), cause.alias("cause"), F.array_join("variants", "+").alias("variants"), F.col("b.ix").alias("holder"), F.col("a.ix").alias("lacker"))
