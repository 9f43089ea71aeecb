"""Connected components of a table of links, by large-star and small-star rounds.

Each round is a few joins and aggregates on the links, written to the shared folder; the driver sees one number of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteweave.llm.common import remove, written


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for each id in the links (a, b); the component is the smallest id that can be reached.

    Null ids, links of an id with itself and repeated links are left out. No links give no rows.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.withColumn("m", F.least("m", "u"))
        # Large star: link the larger neighbours of a vertex with the smallest one.
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: link the smaller neighbours, and the vertex itself, with the smallest one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = written(small, "links")
        # Done when each vertex has one link, to a vertex that has none to a smaller one: stars.
        heads = after.select(F.col("v").alias("u")).distinct()
        loose = after.join(heads, "u", "left_semi").limit(1).count()
        many = 0 if loose else after.groupBy("u").count().where("count > 1").limit(1).count()
        remove(edges)
        edges = after
        if not loose and not many:
            break
    else:
        raise RuntimeError("components did not settle")
    heads = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(heads)

