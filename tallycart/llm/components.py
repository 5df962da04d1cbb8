"""Connected components of a graph given as a table of links, by alternating large and small stars.

Every round writes its links to the shared folder, so a lost executor costs one round at most. A node with very many
links is met by partial minima and by joins that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.session import staged


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the least of them: the larger neighbours, or the smaller ones and itself."""
    if large:
        near = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = staged(near.distinct(), "neighbours")
    least = staged(near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
    joined = near.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return staged(moved.where("u != v").distinct(), "links")


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node with a link; the label is the smallest node of its component. ``links`` has columns
    u and v of one orderable type."""
    links = staged(links.where("u != v").select("u", "v"), "links")
    before = None
    while (now := _state(links)) != before:
        before = now
        links = _stars(_stars(links, True), False)
    labels = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
    return staged(labels.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()), "labels")
