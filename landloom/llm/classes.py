"""Connected classes of nodes from links, by distributed label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landloom.session import cut

#: Rounds after which propagation that still changes labels is an error.
MOST_ROUNDS = 40


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest node of its component for every linked node: `node`, `label`.

    Each round every node takes the smallest label among its own, its
    neighbours', and the label of its label, so a path of length n settles in
    about log n rounds. Self links and repeated links are harmless.
    """
    pairs = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = cut(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    labels = cut(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("node")).alias("label")), "labels")
    for _ in range(MOST_ROUNDS):
        heard = both.join(labels, both.y == labels.node).groupBy("x").agg(F.min("label").alias("heard"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        new = labels.join(heard, labels.node == heard.x, "left").join(jump, labels.label == jump.via, "left")
        new = cut(new.select("node", F.least("label", "heard", "far").alias("label"), (F.least("label", "heard", "far") < F.col("label")).alias("moved")), "labels")
        labels = new.select("node", "label")
        if new.filter("moved").isEmpty():
            return labels
    raise RuntimeError("label propagation did not settle")
