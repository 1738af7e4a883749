"""Connected components of a link table, as a chain of Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.tables import materialize, recorded, remove

#: A round at least halves the longest path to a root; this is far above any
#: real depth and only stops a loop that cannot end.
MAX_ROUNDS = 60


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(node, component)`` for every linked node; the
    component is the smallest node that links reach.

    Alternates the large-star and small-star steps (Kiveris et al., 2014):
    each hangs a node's neighbours on the smallest of them, so links never
    grow in number and the graph turns into stars in a logarithmic number of
    rounds.  The smallest neighbour comes from a partial aggregate and is
    joined back, so a node with very many links is not gathered in one task.
    Both steps of every round are written to the shared folder, so no plan
    holds more than one of them; what a round has read is then removed.
    """
    spark = links.sparkSession
    with recorded() as old:
        edges = materialize(
            links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
            "cc-links")
    for _ in range(MAX_ROUNDS):
        with recorded() as large_path:
            large = materialize(_large_star(edges), "cc-large")
        with recorded() as written:
            edges = materialize(_small_star(large), "cc-round")
        remove(spark, old + large_path)
        old = written
        if _settled(edges):
            break
    else:
        raise RuntimeError("connected components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct()
    found = materialize(roots.select("node", F.col("node").alias("component")).union(
        edges.select(F.col("u").alias("node"), F.col("v").alias("component"))), "cc-components")
    remove(spark, old)
    return found


def _pairs(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Rows ``(u, v)``: of every row one for each of the named pairs of columns."""
    each = F.explode(F.array(*(F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in pairs)))
    return rows.select(each.alias("e")).select("e.u", "e.v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node on the smallest of it and its neighbours;
    in ``edges(u, v)`` and in the result ``u > v``."""
    low = (_pairs(edges, ("u", "v"), ("v", "u")).groupBy("u").agg(F.min("v").alias("m"))
           .select(F.col("u").alias("v"), F.least("u", "m").alias("m")))
    return edges.join(low, "v").select("u", F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours on the smallest of these."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    return _pairs(edges.join(low, "u"), ("v", "m"), ("u", "m")).where("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one root, and no root on another node."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("below")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("below")))).alias("e"))
    return (ends.select("e.*").groupBy("node").agg(F.sum("below").alias("below"), F.min("below").alias("least"))
            .where("below > 1 or below = 1 and least = 0").isEmpty())
