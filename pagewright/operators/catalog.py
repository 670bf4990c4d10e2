"""Catalogue upkeep: crawl dedupe, container walks, and folding observations into records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.scalars import stripped
from pagewright.session import cut, width

MAX_DEPTH = 20


def first_seen(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in crawl order, by map-side combine rather than a sort per key."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*key, "r.*")


def container_walk(edges: DataFrame, seeds: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(root, node, depth): everything reachable from each seed container, shallowest depth, cycles cut.

    ``edges`` (parent, child), ``seeds`` (root). One join and one anti-join a level; the frontier
    is checkpointed so that neither the plan nor a lost executor's work grows with the depth.
    """
    levels = [cut(seeds.select("root", F.col("root").alias("node"), F.lit(0).alias("depth")).distinct())]
    links = edges.where("parent IS NOT NULL AND child IS NOT NULL").select(F.col("parent").alias("node"), "child").distinct()
    for depth in range(1, max_depth + 1):
        nxt = levels[-1].select("root", "node").join(links, "node").select("root", F.col("child").alias("node")).distinct()
        # Each level is written once; what was seen is the union of the levels.
        frontier = cut(nxt.join(_union(levels).select("root", "node"), ["root", "node"], "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        levels.append(frontier)
    return _union(levels)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merge(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Records after an observation: non-empty values replace, everything else stays; with the status."""
    a, b = old.select(key, *[F.col(f).alias(f"_o_{f}") for f in fields], F.lit(True).alias("_old")), new.select(key, *[F.col(f).alias(f"_n_{f}") for f in fields], F.lit(True).alias("_new"))
    j = a.join(b, key, "full")
    pick = lambda f: F.coalesce(stripped(F.col(f"_n_{f}")), F.col(f"_o_{f}"))
    changed = F.lit(False)
    for f in fields:
        changed = changed | ~pick(f).eqNullSafe(F.col(f"_o_{f}"))
    status = F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "absent").when(changed, "updated").otherwise("unchanged")
    return j.select(key, *[pick(f).alias(f) for f in fields], status.alias("status"))


def changes(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, old, new) of every replaced value; a new record logs none."""
    j = old.select(key, *[F.col(f).alias(f"_o_{f}") for f in fields]).join(new.select(key, *[stripped(F.col(f)).alias(f"_n_{f}") for f in fields]), key)
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_o_{f}").alias("old"), F.col(f"_n_{f}").alias("new")) for f in fields])
    return j.select(key, F.explode(each).alias("x")).select(key, "x.*").where(F.col("new").isNotNull() & ~F.col("new").eqNullSafe(F.col("old")))


def grown(old: Column, new: Column) -> Column:
    """The old list and what the new one adds, each in its order."""
    return F.array_distinct(F.concat(F.coalesce(old, F.array().cast("array<string>")), F.coalesce(new, F.array().cast("array<string>"))))


def merge_facets(old: Column, seen: Column, done: Column) -> Column:
    """facets (map of category to labels) after a scrape.

    ``seen`` holds the categories searched. A category in ``done`` (every search of it finished and
    the item in range) is replaced, any other only grows; categories that were not searched stay.
    """
    none = F.create_map().cast("map<string,array<string>>")
    old, seen, done = F.coalesce(old, none), F.coalesce(seen, none), F.coalesce(done, F.array().cast("array<string>"))
    after = F.transform_values(seen, lambda k, v: F.when(F.array_contains(done, k), v).otherwise(grown(F.try_element_at(old, k), v)))
    return F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(seen, k)), after)


def merge_containers(old: Column, seen: Column, cleared: Column) -> Column:
    """Memberships after a scrape: those of containers traversed in full drop out unless seen, new ones follow."""
    none = F.array().cast("array<string>")
    return grown(F.array_except(F.coalesce(old, none), F.coalesce(cleared, none)), seen)


def completeness(pages: DataFrame, members: DataFrame) -> DataFrame:
    """(box, members, total, complete) of containers read page by page.

    ``pages``: box, page_no, ok, total, empty; ``members``: box, member. Complete is a container of
    which every page was read and that has as many members, itself apart, as the largest total
    printed; one that only says it is empty has a total of 0.
    """
    m = members.where(F.col("member") != F.col("box")).groupBy("box").agg(F.countDistinct("member").alias("members"))
    g = pages.groupBy("box").agg(F.bool_and("ok").alias("ok"), F.max("total").alias("total"), F.bool_or("empty").alias("empty")).join(m, "box", "left").withColumn("members", F.coalesce("members", F.lit(0)))
    g = g.withColumn("total", F.when(F.col("total").isNull() & (F.col("members") == 0) & F.col("empty"), 0).otherwise(F.col("total")))
    return g.select("box", "members", "total", (F.col("ok") & F.col("total").isNotNull() & (F.col("members") >= F.coalesce("total", F.lit(0)))).alias("complete"))


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows numbered from 1 in a total order: range partitions, each counted on from those before it, so no task sees all rows."""
    keys = [f"_o{i}" for i in range(len(order))]
    placed = cut(rows.select("*", *[c.alias(k) for c, k in zip(order, keys)]).repartitionByRange(width(rows.sparkSession), *keys).withColumn("_p", F.spark_partition_id()))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as partitions
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")).withColumn("_b", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_p", "_b")
    own = F.row_number().over(Window.partitionBy("_p").orderBy(*keys))
    return placed.withColumn("_r", own).join(F.broadcast(sizes), "_p").withColumn(name, (F.col("_r") + F.col("_b")).cast("bigint")).drop("_p", "_b", "_r", *keys)


def by_priority(sources: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """(doc_id, source, files) of the best source of a filing: ``sources`` has doc_id, prio, name, part_no.

    Of the best priority 0 only the last name is used; files of any other are listed in part order.
    """
    best = sources.groupBy("doc_id").agg(F.min("prio").alias("best"))
    g = sources.join(best, "doc_id").where("prio = best").groupBy("doc_id", "best").agg(F.max("name").alias("last"), F.array_sort(F.collect_list(F.struct("part_no", "name"))).alias("x"))
    source = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("best") + 1)
    return g.select("doc_id", source.alias("source"), F.when(F.col("best") == 0, F.col("last")).otherwise(F.array_join(F.transform("x", lambda v: v["name"]), " ")).alias("files"))


def latest(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key, nulls oldest."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*key, "r.*")


def retention(runs: DataFrame, key: str, order: list[str], pinned: str) -> DataFrame:
    """keep, remove or untouched for each run: one finished run per key stays, a pinned one first."""
    f = runs.withColumn("_n", F.when(F.col("finished"), F.row_number().over(Window.partitionBy(key, "finished").orderBy(F.col(pinned).desc(), *[F.col(c).desc() for c in order]))))
    return f.withColumn("action", F.when(~F.col("finished"), "untouched").when(F.col("_n") == 1, "keep").otherwise("remove")).drop("_n")
