"""Connected components of a link table, without collecting it."""

from pyspark.sql import DataFrame, functions as F

from ..session import cut


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``links (a, b)``: the smallest id it can reach.

    Each round hooks every vertex to its smallest neighbour (or itself), follows those
    parents to their roots by pointer jumping, and contracts the links to the roots;
    at least half of the vertices go, so the rounds are logarithmic whatever the
    diameter. Minima combine before every shuffle, so a vertex with very many links is
    no hot group. Rows with a null end or equal ends are no links.
    """
    edges = cut(links.select("a", "b").where("a <> b").distinct())
    mapping = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low"))
        parents = cut(parents.select("id", F.least("id", "low").alias("parent")))
        while True:
            up = parents.select(F.col("id").alias("parent"), F.col("parent").alias("grand"))
            jumped = cut(parents.join(up, "parent").select("id", F.col("grand").alias("parent"), "parent",)
                         .toDF("id", "parent", "before"))
            done = jumped.where("parent <> before").isEmpty()
            parents = jumped.select("id", "parent")
            if done:
                break
        root_a = parents.select(F.col("id").alias("a"), F.col("parent").alias("root_a"))
        root_b = parents.select(F.col("id").alias("b"), F.col("parent").alias("root_b"))
        edges = cut(edges.join(root_a, "a").join(root_b, "b").where("root_a <> root_b")
                    .select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b"))
                    .distinct())
        if mapping is None:
            mapping = parents.select("id", F.col("parent").alias("component"))
        else:
            later = parents.select(F.col("id").alias("component"), F.col("parent").alias("root"))
            mapping = cut(mapping.join(later, "component", "left")
                          .select("id", F.coalesce("root", "component").alias("component")))
    if mapping is None:
        mapping = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return mapping
