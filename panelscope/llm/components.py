"""Connected components of links, as DataFrame iterations.

Rounds of the large-star and small-star steps (Kiveris et al., "Connected components in MapReduce and
beyond") on the table of links: every round links each node's larger neighbours, then its smaller ones, to
the least node near it, until each component is a star. Rounds grow with the logarithm of the size of a
component. Each round is a table in the shared folder, which cuts the lineage; whether any node is
not yet in a star is all that comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.stash import stash

#: A round's tasks are as many as the cluster runs twice over, or more if a task would get more links than this.
LINKS_PER_TASK = 100_000


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    near = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(links: DataFrame, tasks: int) -> bool:
    """Whether each node is linked to one root, and no root to another node."""
    ends = links.select(F.col("u").alias("id"), F.lit(1).alias("up")).unionByName(links.select(F.col("v").alias("id"), F.lit(0).alias("up")).distinct())
    odd = ends.groupBy("id").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n")).where("up > 1 or (up = 1 and n > 1)")
    return odd.coalesce(tasks).agg(F.count(F.lit(1))).first()[0] == 0


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(id, root) for each node that has a link to another: root is the least node reachable, for roots their own.

    Nulls and links of a node to itself are no links; repeated links count once; no links give no rows.
    """
    known = links.where(F.col(u).isNotNull() & F.col(v).isNotNull())
    at = known.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u > v")
    at = stash(at.distinct())
    # Few links need few tasks, whatever the number of shuffle partitions; rounds do not add links.
    tasks = max(2 * links.sparkSession.sparkContext.defaultParallelism, -(-at.count() // LINKS_PER_TASK))
    while not _are_stars(at, tasks):
        at = stash(_small_star(_large_star(at).coalesce(tasks)).coalesce(tasks))
    roots = at.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return at.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)
