"""Connected components of links, as Spark joins.

Each round hooks every node to its smallest neighbour, follows the hooks to
their roots by doubling, and contracts the links to those between roots.  The
number of rounds and doublings is logarithmic.  Rounds are written to the shared
folder; nothing but the number of links left comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long); the root is the smallest node of its component."""

    def between(df: DataFrame) -> DataFrame:
        return common.staged(df.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")

    left = between(links)
    found = None
    while not left.isEmpty():
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = common.staged(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "hooks")
        while True:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("above"))
            hooks = common.staged(hooks.join(up, "root").selectExpr("node", "above as root", "above <> root as moved"), "hooks")
            if hooks.where("moved").isEmpty():
                hooks = hooks.select("node", "root")
                break
            hooks = hooks.select("node", "root")
        if found is None:
            found = hooks
        else:
            higher = hooks.select(F.col("node").alias("root"), F.col("root").alias("above"))
            found = common.staged(found.join(higher, "root", "left").select("node", F.coalesce("above", "root").alias("root")), "roots")
        a, b = (hooks.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root")) for side in ("a", "b"))
        left = between(left.join(a, "a").join(b, "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b")))
    return found if found is not None else links.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
