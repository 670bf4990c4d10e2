"""Items of varying length into containers of fixed capacity by minimum bin slack.

Items are dealt at random into blocks of bounded size, so every block sees the same mix of
lengths. In a block, each bin takes the largest item left and then the combination of the
lengths still available that fills the rest best, found by a subset-sum program over a bitset.
What a block cannot fill is dealt anew over fewer blocks until one block is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.session import cut

BLOCK_ITEMS = 4000  # items of one block, the bound of a task's group
FULL = 0.995  # bins filled less are opened again in the next round
ROUNDS = 3
GROUP = 64  # budgets packed at a time, as each takes every document once


def fullest(stock: list[int], capacity: int) -> list[int]:
    """A combination of lengths with the largest sum within ``capacity``.

    ``stock[n]`` is how many items of length n are left. Lengths enter the bitset from the
    longest down; the walk ends as soon as the capacity itself is reached.
    """
    if capacity <= 0:
        return []
    reach, mask, trail = 1, (1 << (capacity + 1)) - 1, []
    goal = 1 << capacity
    for n in range(min(capacity, len(stock) - 1), 0, -1):
        have = min(stock[n], capacity // n)
        # Copies in powers of two: any number up to ``have`` can be put together from them.
        k = 1
        while have > 0:
            take = min(k, have)
            grown = (reach | reach << (take * n)) & mask
            if grown != reach:
                trail.append((n, take, reach))
                reach = grown
            have -= take
            k *= 2
            if reach & goal:
                break
        if reach & goal:
            break
    left = reach.bit_length() - 1
    chosen: list[int] = []
    for n, take, before in reversed(trail):
        if not before >> left & 1:
            chosen += [n] * take
            left -= n * take
    return chosen


def pack(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices into ``lengths``; every length is at most ``capacity``. Empty items join the first bin."""
    by: list[list[int]] = [[] for _ in range(capacity + 1)]
    zero: list[int] = []
    for i, n in enumerate(lengths):
        (by[n] if n > 0 else zero).append(i)
    stock = [len(x) for x in by]
    bins: list[list[int]] = []
    top = capacity
    while True:
        while top > 0 and not stock[top]:
            top -= 1
        if top == 0:
            break
        stock[top] -= 1
        mine = [top]
        for n in fullest(stock, capacity - top):
            stock[n] -= 1
            mine.append(n)
        bins.append([by[n].pop() for n in mine])
    if zero:
        if bins:
            bins[0] += zero
        else:
            bins.append(zero)
    return bins


def packets(docs: DataFrame, budgets: DataFrame, key: str = "doc_id", tokens: str = "tokens", block_items: int = BLOCK_ITEMS, group: int = GROUP) -> DataFrame:
    """(budget_id, capacity_tokens, packet_id, key, part, tokens): the members of every packet.

    A text longer than the capacity gives full packets of its own (part 0, 1, ...) and its rest
    is packed like a short text; no other text is split. Texts without tokens ride along in a
    packet of their block. Null capacities and capacities below 1 take no part; null keys too.
    Any number of budgets is packed, ``group`` at a time.
    """
    usable = sorted((r.budget_id, r.capacity_tokens) for r in budgets.where((F.col("capacity_tokens") > 0) & F.col("budget_id").isNotNull()).select("budget_id", "capacity_tokens").distinct().collect())
    out = _packets(docs, usable[:group], key, tokens, block_items)
    for at in range(group, len(usable), group):
        out = out.unionByName(_packets(docs, usable[at : at + group], key, tokens, block_items))
    return out


def _packets(docs: DataFrame, usable: list[tuple[int, int]], key: str, tokens: str, block_items: int) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()
    items = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.coalesce(F.col(tokens), F.lit(0)).cast("int").alias("tokens"))
    kinds = F.array(*[F.struct(F.lit(b).cast("int").alias("budget_id"), F.lit(c).cast("int").alias("capacity_tokens")) for b, c in usable]).cast("array<struct<budget_id:int,capacity_tokens:int>>")
    each = items.select("key", "tokens", F.explode(kinds).alias("b")).select("key", "tokens", "b.*")
    whole = F.floor(F.col("tokens") / F.col("capacity_tokens")).cast("int")
    rest = F.col("tokens") - whole * F.col("capacity_tokens")
    each = cut(each.withColumn("_whole", whole).withColumn("_rest", rest))
    full = each.where("_whole > 0").select("budget_id", "capacity_tokens", "key", F.explode(F.sequence(F.lit(0), F.col("_whole") - 1)).alias("part"), F.col("capacity_tokens").alias("tokens"))
    done = full.withColumn("packet_id", F.concat_ws("-", F.lit("w"), "key", "part"))
    open_items = each.where("_whole = 0 OR _rest > 0").select("budget_id", "capacity_tokens", "key", F.col("_whole").alias("part"), F.col("_rest").alias("tokens"))

    schema = f"budget_id int, capacity_tokens int, key {kind}, part int, tokens int, packet_id string, fill int"

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["key", "part"], kind="stable").reset_index(drop=True)
        capacity = int(g["capacity_tokens"].iloc[0])
        name = f"{int(g['_round'].iloc[0])}-{int(g['_block'].iloc[0])}"
        ids, fill = [""] * len(g), [0] * len(g)
        sizes = g["tokens"].tolist()
        for b, members in enumerate(pack(sizes, capacity)):
            total = sum(sizes[i] for i in members)
            for i in members:
                ids[i], fill[i] = f"{name}-{b}", total
        return g.assign(packet_id=ids, fill=fill)[["budget_id", "capacity_tokens", "key", "part", "tokens", "packet_id", "fill"]]

    for turn in range(ROUNDS):
        n = open_items.count()
        blocks = max(1, -(-n // (max(len(usable), 1) * block_items)))
        last = blocks == 1 or turn == ROUNDS - 1
        dealt = open_items.withColumn("_round", F.lit(turn)).withColumn("_block", F.pmod(F.xxhash64("key", "part", F.lit(turn)), F.lit(blocks)).cast("int"))
        packed = cut(dealt.groupBy("budget_id", "_block").applyInPandas(run, schema))
        keep = packed if last else packed.where(F.col("fill") >= F.col("capacity_tokens") * FULL)
        done = done.unionByName(keep.drop("fill"))
        if last:
            break
        open_items = packed.where(F.col("fill") < F.col("capacity_tokens") * FULL).drop("packet_id", "fill")
    return done.select("budget_id", "capacity_tokens", "packet_id", F.col("key").alias(key), "part", "tokens")
