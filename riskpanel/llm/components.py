"""Connected components of links by alternating star contraction, on DataFrames only.

Each round hangs a node's larger neighbours on its smallest one, then its smaller ones too.
The links stay as many or become fewer, and a long chain halves in every round. Each round
is a stored table, so lineage stays short and lost executors cost a round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.functions import splittable_join
from riskpanel.llm.common import stored


def _hang(pairs: DataFrame, smaller: bool) -> DataFrame:
    """Hangs neighbours v of u on the least node among u and them: those above u, or else all of them and u itself."""
    least = pairs.groupBy("u").agg(F.min("v").alias("other")).select("u", F.least("u", "other").alias("least"))
    hung = splittable_join(pairs, least, ["u"]).select("u", "v", "least")
    if smaller:
        out = hung.select(F.explode(F.array("v", "u")).alias("u"), F.col("least").alias("v"))
    else:
        out = hung.filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return out.filter("u <> v").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Repeated and reversed links and loops do no harm; null ends are ignored; no links give no rows.
    """
    edges = stored(
        links.dropna().filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    state = None
    for _ in range(most_rounds):
        mark = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct()
            )
        state = mark
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = stored(_hang(_hang(both, smaller=False), smaller=True), "edges")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
