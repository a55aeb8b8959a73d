"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.tables import save


def components(links: DataFrame, folder: str) -> DataFrame:
    """``links(a, b)``: (id, label), the smallest id reachable, for every id
    that has a link.

    Each round hooks every node to the smallest node next to it, follows
    those pointers to their roots, and contracts the links to links between
    roots, so the links shrink by half at least per round.  Only counts reach
    the driver.
    """
    links = save(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), folder)
    labels = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("id"), F.col("b").alias("to")).union(links.select("b", "a"))
        hooks = save(both.groupBy("id").agg(F.min("to").alias("to")).select("id", F.least("id", "to").alias("to")), folder)
        while True:
            up = hooks.select(F.col("id").alias("to"), F.col("to").alias("up"))
            hooks, before = save(hooks.join(up, "to").select("id", F.col("up").alias("to"), (F.col("up") < F.col("to")).alias("moved")), folder), hooks
            moved = not hooks.where("moved").isEmpty()
            hooks = hooks.select("id", "to")
            if not moved:
                break
        root = hooks.withColumnRenamed("to", "label")
        if labels is None:
            labels = root
        else:
            further = root.select(F.col("id").alias("label"), F.col("label").alias("further"))
            labels = save(labels.join(further, "label", "left").select("id", F.coalesce("further", "label").alias("label")), folder)
        links = (
            links.join(root.select(F.col("id").alias("a"), F.col("label").alias("ra")), "a")
            .join(root.select(F.col("id").alias("b"), F.col("label").alias("rb")), "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
        )
        links = save(links, folder)
    return labels if labels is not None else links.select(F.col("a").alias("id"), F.col("b").alias("label"))
