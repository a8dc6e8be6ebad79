"""Connected components of a large link table, by alternating large-star and small-star steps.

Each step is two pre-aggregated groupings and two joins; nothing is gathered per node, so a hub
with a third of all links stays a sum of partial minima, and the joins on it are left to the
engine's skew handling. Each round is written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handoff.llm.common import write_shared


def _star(links: DataFrame, emit_larger: bool) -> DataFrame:
    """Links (u, v) re-hung below the smallest node next to each u (u itself included).

    Large star looks at all neighbours and moves the larger ones; small star looks at the smaller
    neighbours only (links are stored with v < u) and moves those and u.
    """
    if emit_larger:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = links.groupBy("u").agg(F.min("v").alias("m"))
        hung = links.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = hung.unionByName(low.select("u", F.col("m").alias("v")))
    return moved.where(F.col("u") != F.col("v")).distinct()


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): component is the smallest node reachable; nodes without a link are left out.

    ``a`` and ``b`` are of one orderable type; null ends and self links are dropped. Repeated links
    count once. An empty table gives an empty table.
    """
    x, y = F.col(a), F.col(b)
    links = (links.where(x.isNotNull() & y.isNotNull() & (x != y))
             .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct())
    links = write_shared(links, "links")
    state = None
    for _ in range(max_rounds):
        links = write_shared(_star(_star(links, True), False), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = tuple(now)
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")
