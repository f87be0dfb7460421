"""Connected components of a link table, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignals.llm.common import materialize


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``id, component`` (smallest id reachable) of every end of a link.

    Each round a node takes the smallest label among its own and its
    neighbours', then the label of that label.  Labels are written once a
    round; the loop ends when no label changes.  Null ends are ignored; links
    may repeat and may be loops.
    """
    both = links.select(F.col(a).alias("src"), F.col(b).alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL")
    both = materialize(both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = materialize(both.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("m")).select("id", F.least("id", "m").alias("component")))
    for _ in range(max_rounds):
        told = both.join(labels.withColumnRenamed("id", "src"), "src").groupBy(F.col("dst").alias("id")).agg(F.min("component").alias("heard"))
        lower = labels.join(told, "id").select("id", "component", F.least("component", "heard").alias("now"))
        jump = labels.select(F.col("id").alias("now"), F.col("component").alias("next"))
        moved = materialize(lower.join(jump, "now").select("id", F.least("now", "next").alias("component"), (F.least("now", "next") < F.col("component")).alias("changed")))
        labels = moved.select("id", "component")
        if not moved.where("changed").limit(1).count():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
