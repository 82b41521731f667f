"""Connected components of a graph given by its edges, as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_table, table

HUB = 100_000  # edges of a node that one join task takes
ROWS = 200_000  # edges of a written file


def with_least(edges: DataFrame, hub: int = HUB, few: int = 1, parts: int | None = None, own: Column | None = None, more: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """edges (u, v, more) with m, the least v of their u, and the table (u, m) of every u, both of u with `few` edges or more.

    own: which edges can be the least; a u without one has no m and is left out.

    The minimum is aggregated before the shuffle. A node with n edges, n over `hub`, is dealt to ceil(n / hub) keys of the
    join, each with a copy of its minimum; these nodes are at most edges / hub, and are broadcast.
    """
    least = F.min("v") if own is None else F.min(F.when(own, F.col("v")))
    low = edges.groupBy("u").agg(least.alias("m"), F.count("*").alias("n")).where((F.col("n") >= few) & F.col("m").isNotNull())
    low = table(low.select("u", "m", F.ceil(F.col("n") / hub).alias("deals")), "low", parts)
    hubs = low.where("deals > 1").select("u", "deals")
    copies = low.select("u", "m", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)).alias("deal"))
    dealt = edges.join(F.broadcast(hubs), "u", "left").select("u", "v", *more, F.pmod(F.xxhash64("v"), F.coalesce("deals", F.lit(1).cast("long"))).alias("deal"))
    return dealt.join(copies, ["u", "deal"]).select("u", "v", *more, "m"), low


def components(edges: DataFrame, hub: int = HUB) -> DataFrame:
    """(node, component) of every node of edges (u, v): component is the smallest node that u reaches.

    Alternates two steps on edges whose u is larger than v, until none changes: every neighbour
    above a node is linked to the node's smallest neighbour, then every one below. Each round is
    written to the shared folder, as a file for every ROWS edges; the driver gets a count and a checksum. Nodes with very many edges are dealt to
    several tasks (with_least). No edges give no rows.
    """

    def checked(df: DataFrame):
        return df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()

    u, v = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = table(edges.where("u != v").select(u, v).distinct(), "edges")
    mark = checked(now)
    while True:
        parts = 1 + 2 * mark.n // ROWS
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        known, low = with_least(both, hub, parts=parts)
        large = table(known.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "edges", parts)
        known, least = with_least(large, hub, parts=parts)
        small = known.select(F.greatest("v", "m").alias("u"), F.col("m").alias("v"))
        after = table(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "edges", parts)
        for old in (now, low, large, least):
            drop_table(old)
        now, before, mark = after, mark, checked(after)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
