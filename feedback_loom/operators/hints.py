"""What a reviewer's hint asks of the groups: which belong together and which apart.

A hint holds any number of wishes ``merge a and b`` or ``split a and b`` (``with`` and ``from`` will do for ``and``), in any
other text and case. A name is a label of the proposal made without a hint, and then stands for all groups of that
label; or else a term, and then stands for the groups that have it among their top terms.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut
from .components import components
from .labels import term_overlap

NAME = r"([\p{L}\p{N}_]+)"
WISH = rf"(?i)(?:^|[^\p{{L}}\p{{N}}_])(merge|split)\s+{NAME}\s+(?:and|with|from)\s+{NAME}"


def wishes(hint: Column) -> Column:
    """Array of (kind, left_name, right_name), in lower case; empty without any."""
    parts = [F.regexp_extract_all(F.lower(hint), F.lit(WISH), F.lit(group)) for group in (1, 2, 3)]
    return F.coalesce(F.zip_with(
        parts[0], F.zip_with(parts[1], parts[2], lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        lambda kind, names: F.struct(kind.alias("kind"), names["a"].alias("left_name"), names["b"].alias("right_name"))),
        F.array().cast("array<struct<kind:string,left_name:string,right_name:string>>"))


def wished(hints: DataFrame, hint_col: str = "hint") -> DataFrame:
    """One row per wish: the columns of ``hints`` but for the hint, ``no`` (from 0 in each hint), kind, left_name, right_name."""
    others = [c for c in hints.columns if c != hint_col]
    return hints.select(*others, F.posexplode(wishes(F.col(hint_col))).alias("no", "wish")).select(*others, "no", "wish.*")


def sides(wish_rows: DataFrame, top: DataFrame, named: DataFrame, key: str) -> DataFrame:
    """(no, kind, side, group) of wishes of one hint, as far as both their names are known.

    ``top`` has ``key``, ``term`` and ``rn``, ``named`` has ``key`` and ``label``. A group on both sides of a wish to split is
    on the side whose term ranks higher with it; a wish to split a name from itself is none.
    """
    by_label = named.select(F.lower("label").alias("name"), F.col(key).alias("group"), F.lit(0).alias("rn"))
    by_term = top.select(F.lower("term").alias("name"), F.col(key).alias("group"), "rn")
    by_term = by_term.join(by_label.select("name").distinct(), "name", "left_anti")
    known = by_label.unionByName(by_term).groupBy("name", "group").agg(F.min("rn").alias("rn"))
    asked = wish_rows.filter("kind = 'merge' OR left_name <> right_name").select("no", "kind", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("left_name").alias("name")),
        F.struct(F.lit(1).alias("side"), F.col("right_name").alias("name")))).alias("end")).select("no", "kind", "end.*")
    met = asked.join(known, "name")
    best = met.groupBy("no", "kind", "group").agg(F.min(F.struct("rn", "side")).alias("best"), F.collect_set("side").alias("both"))
    placed = best.select("no", "kind", "group", F.explode(
        F.when(F.col("kind") == "split", F.array("best.side")).otherwise(F.col("both"))).alias("side"))
    whole = placed.groupBy("no").agg(F.count_distinct("side").alias("n")).filter("n = 2").select("no")
    return placed.join(whole, "no").select("no", "kind", "side", "group")


def merge_as_wished(top: DataFrame, key: str, ends: DataFrame, min_jaccard: float = 0.5) -> tuple[DataFrame, bool]:
    """((key, merged), whether wishes contradict each other): groups merged by overlap, as ``ends`` (see ``sides``) allow.

    Groups to be merged are, whatever their overlap, and win over a wish to split them. All other links of ``min_jaccard`` or
    more are taken from the strongest down (ties by the groups' ids), but for links between groups to be split, and what was
    merged with them before. Each round takes, at once, every link that is the strongest allowed one at both of its ends: none of
    the links taken later could come before it, so the result is that of taking them one by one.
    """
    groups = top.select(F.col(key).alias("group")).filter(F.col(key).isNotNull()).distinct()
    must = ends.filter("kind = 'merge'")
    lows = must.groupBy("no").agg(F.min("group").alias("a"))
    joined = components(must.join(lows, "no").select("a", F.col("group").alias("b")))
    root = cut(groups.join(joined.select(F.col("id").alias("group"), "component"), "group", "left")
               .select("group", F.coalesce("component", "group").alias("root")))
    apart = ends.filter("kind = 'split'").join(root, "group").groupBy("no", "root").agg(
        F.min("side").alias("side"), F.count_distinct("side").alias("n"))
    apart = cut(apart)
    contradicted = not apart.filter("n = 2").isEmpty()
    apart = apart.filter("n = 1").select("no", "root", "side")
    links = cut(term_overlap(top, key, min_jaccard).select(
        F.col("left_group").alias("a"), F.col("right_group").alias("b"),
        F.struct((-F.col("jaccard")).alias("order"), "left_group", "right_group").alias("rank")))
    links = _lifted(links, root.select(F.col("group").alias("old"), F.col("root").alias("new")))
    while True:
        left = apart.select("no", F.col("root").alias("a"), F.col("side").alias("left_side"))
        right = apart.select("no", F.col("root").alias("b"), F.col("side").alias("right_side"))
        barred = links.join(left, "a").join(right, ["no", "b"]).filter("left_side <> right_side").select("a", "b").distinct()
        links = cut(links.join(barred, ["a", "b"], "left_anti"))
        if links.isEmpty():
            return root.select(F.col("group").alias(key), F.col("root").alias("merged")), contradicted
        best = links.select(F.explode(F.array("a", "b")).alias("end"), "rank").groupBy("end").agg(F.min("rank").alias("best"))
        taken = (links.join(best.select(F.col("end").alias("a"), F.col("best").alias("best_a")), "a")
                 .join(best.select(F.col("end").alias("b"), F.col("best").alias("best_b")), "b")
                 .filter("rank = best_a AND rank = best_b"))
        moved = cut(taken.select(F.col("b").alias("old"), F.col("a").alias("new")))  # a < b: the smaller id stays
        root = cut(_renamed(root, moved, "root"))
        apart = cut(_renamed(apart, moved, "root").distinct())
        links = _lifted(links, moved)


def _renamed(df: DataFrame, moved: DataFrame, col: str) -> DataFrame:
    columns = [F.coalesce("new", col).alias(c) if c == col else F.col(c) for c in df.columns]
    return df.join(moved.withColumnRenamed("old", col), col, "left").select(*columns)


def _lifted(links: DataFrame, moved: DataFrame) -> DataFrame:
    """Links between merged groups, the strongest of each pair."""
    renamed = _renamed(_renamed(links, moved, "a"), moved, "b").filter("a <> b")
    return renamed.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("rank").alias("rank"))
