"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import Stages


def components(stages: Stages, links: DataFrame, label: str) -> DataFrame:
    """``node, component`` of every node in ``links`` (``a``, ``b``, long);
    ``component`` is the smallest node of its component.

    Each round points every node to its smallest neighbour (or itself), takes
    that pointer twice, and goes on with the links between the nodes pointed
    to. At least half of the nodes that have links go in each round. Rounds
    are written tables, so a lost executor costs one round at most."""
    links = stages.write(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), f"{label}-links")
    members, n = None, 0
    while not links.isEmpty():
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = stages.write(both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to")), f"{label}-point-{n}")
        far = point.select(F.col("a").alias("to"), F.col("to").alias("further"))
        point = stages.write(point.join(far, "to").select("a", F.col("further").alias("to")), f"{label}-point2-{n}")
        if members is None:
            moved = point.select(F.col("a").alias("node"), F.col("to").alias("component"))
        else:
            moved = members.join(point.withColumnRenamed("a", "component"), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        members = stages.write(moved, f"{label}-members-{n}")
        to_a, to_b = (point.select(F.col("a").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab")
        moved = links.join(to_a, "a").join(to_b, "b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).where("a <> b").distinct()
        links = stages.write(moved, f"{label}-links-{n}")
        n += 1
    if members is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # pointers of later rounds may still lead on: the smallest node of each
    least = members.groupBy("component").agg(F.min("node").alias("least"))
    return stages.write(members.join(least, "component").select("node", F.col("least").alias("component")), f"{label}-components")
