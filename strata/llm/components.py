"""Connected components of a link table, by alternating large and small stars.

Every round keeps the components and brings each node nearer to the least of
its component; the table never grows beyond its links.  Rounds are cut by
checkpoints.  Joins on a much-linked node are left to Spark's skew splitting;
the minima are pre-aggregated before their shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _least(links: DataFrame, node: str, of: str) -> DataFrame:
    return links.groupBy(F.col(node).alias("u")).agg(F.min(of).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (the least node of its component) of every node that
    ``links`` (columns ``a``, ``b``; both long) names."""
    named = links.where("a is not null and b is not null")
    links = checkpointed(
        named.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a > b")
        .distinct()
    )
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both, "a", "b")
        # large star: larger neighbours go to the least of the neighbourhood
        large = (
            both.join(least, F.col("a") == F.col("u"))
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        # small star: the node and its smaller neighbours go to the least of these
        least = _least(large, "a", "b")
        small = large.join(least, F.col("a") == F.col("u")).select(
            F.explode(
                F.array(
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                )
            ).alias("x")
        )
        nxt = checkpointed(small.select("x.*").where("a > b").distinct())
        # done when every link leads from a node without other links to a root
        roots = nxt.select(F.col("b").alias("r")).distinct()
        inner = nxt.join(roots, F.col("a") == F.col("r"), "left_semi")
        several = nxt.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
        links = nxt
        if inner.isEmpty() and several.isEmpty():
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
