"""Connected components of a links table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, c): every linked vertex and the smallest vertex it can reach.

    links: (a, b) of any direction, bigint.  Each round takes the smallest
    label among a vertex and its neighbours, then the label of that label;
    it ends when no label changes.
    """
    both = scratch.save(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    label = scratch.save(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("a")).alias("c")), "labels")
    total = label.agg(F.sum(F.col("c").cast("decimal(38,0)"))).first()[0]
    while total is not None:
        near = both.join(label, F.col("b") == F.col("v")).groupBy("a").agg(F.min("c").alias("m"))
        hooked = scratch.save(label.join(near, F.col("v") == F.col("a")).select("v", F.least("c", "m").alias("c")), "hooked")
        head = hooked.select(F.col("v").alias("h"), F.col("c").alias("hc"))
        label_ = scratch.save(hooked.join(head, F.col("c") == F.col("h")).select("v", F.col("hc").alias("c")), "labels")
        now = label_.agg(F.sum(F.col("c").cast("decimal(38,0)"))).first()[0]
        scratch.drop(label, hooked)
        label = label_
        if now == total:
            break
        total = now
    return label
