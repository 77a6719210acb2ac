"""Connected components of pairs of integer ids, without collecting any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, drop


def components(pairs: DataFrame) -> DataFrame:
    """(id, component) of every id in pairs(a, b); the component is the smallest id that can be reached.

    Each round takes the smallest label of all neighbours and then the label of that label, so paths halve.  Both joins
    read written tables on both sides, so that adaptive execution can split a label or an id that has very many rows.
    Null ids are ignored; repeated pairs and pairs of equal ids do no harm.
    """
    known = pairs.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    # all directions of a pair at once, so that whatever finds the pairs runs once
    ways = F.array(*(F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x in "ab" for y in "ab"))
    edges = cut(known.select(F.explode(ways).alias("way")).select("way.a", "way.b").distinct(), "edges")
    labels = cut(edges.groupBy("a").agg(F.min("b").alias("label")), "labels")
    seen = None
    while True:
        total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if total == seen:
            drop(edges)
            return labels.select(F.col("a").alias("id"), F.col("label").alias("component"))
        seen = total
        near = labels.select(F.col("a").alias("b"), "label")
        hooked = cut(edges.join(near, "b").groupBy("a").agg(F.min("label").alias("label")), "labels")
        drop(labels)
        of = hooked.select(F.col("a").alias("label"), F.col("label").alias("next"))
        labels = cut(hooked.join(of, "label").select("a", F.col("next").alias("label")), "labels")
        drop(hooked)
