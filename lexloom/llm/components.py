"""Problem 1: consolidate pairwise matches into groups by randomised contraction.

Each round gives every vertex a fresh pseudo-random order, lets it hook to the smallest vertex of
its closed neighbourhood, relabels both ends of every edge and removes loops and repeats. The
mappings of the rounds shrink geometrically; at the end they are composed from the last to the
first, so each is joined once. All state lives in staged tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexloom.plans.staging import Staged

MAX_ROUNDS = 200


def _order(vertex, seed: int):
    return F.struct(F.xxhash64(F.lit(seed), vertex).alias("h"), vertex.alias("v"))


def _hooks(edges: DataFrame, seed: int) -> DataFrame:
    """(v, r): r is the first vertex in this round's order among v and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    first = both.groupBy(F.col("a").alias("v")).agg(F.min(_order(F.col("b"), seed)).alias("m"))
    return first.select("v", F.least(F.col("m"), _order(F.col("v"), seed))["v"].alias("r"))


def _relabelled(edges: DataFrame, hooks: DataFrame) -> DataFrame:
    left = hooks.select(F.col("v").alias("a"), F.col("r").alias("ra"))
    right = hooks.select(F.col("v").alias("b"), F.col("r").alias("rb"))
    moved = edges.join(left, "a").join(right, "b").filter(F.col("ra") != F.col("rb"))
    return moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()


def contract(edges: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(v, root) for every vertex of ``edges(a, b)``; root is an arbitrary member of its component.

    Loops, repeats, reversed pairs and null ends are allowed (the latter two join nothing more).
    Empty input gives an empty result.
    """
    clean = (
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    now = Staged(clean, "edges-0")
    maps: list[Staged] = []
    for k in range(max_rounds):
        if now.df.isEmpty():
            break
        hooks = Staged(_hooks(now.df, seed=7919 * (k + 1)), f"hooks-{k}")
        maps.append(hooks)
        after = Staged(_relabelled(now.df, hooks.df), f"edges-{k + 1}")
        now.drop()
        now = after
    else:
        raise RuntimeError(f"no end after {max_rounds} rounds")
    now.drop()
    if not maps:
        return edges.select(F.col("a").alias("v"), F.col("a").alias("root")).limit(0)
    done = maps[-1].df.select("v", F.col("r").alias("root"))
    for step in reversed(maps[:-1]):
        later = done.select(F.col("v").alias("r"), "root")
        done = step.df.join(later, "r", "left").select("v", F.coalesce("root", "r").alias("root"))
    return done


def match_edges(documents: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Edges (a, b) between known documents.

    A row of ``duplicates`` links its two ends when both are in ``documents``. Documents whose
    ``text_hash`` is equal apart from an algorithm prefix and case are linked to the smallest of them,
    which keeps a group of n copies at n - 1 edges.
    """
    ids = documents.select("document_id").filter("document_id is not null").distinct()
    known = (
        duplicates.select(F.col("document_id").alias("a"), F.col("duplicate_of").alias("b"))
        .filter("a is not null and b is not null and a <> b")
        .distinct()
    )
    for end in ("a", "b"):
        known = known.join(ids.withColumnRenamed("document_id", end), end, "left_semi")
    hashed = documents.select(
        F.col("document_id").alias("b"),
        F.lower(F.regexp_replace(F.trim("text_hash"), "^(?i)sha256:", "")).alias("h"),
    ).filter("b is not null and h is not null and h <> ''")
    first = hashed.groupBy("h").agg(F.min("b").alias("a"), F.max("b").alias("z")).filter("a <> z")
    stars = hashed.join(first.select("h", "a"), "h").filter("a <> b").select("a", "b")
    return known.select("a", "b").union(stars)


def group_matches(documents: DataFrame, duplicates: DataFrame) -> DataFrame:
    """(document_id, group_id) for every document, group_id the smallest id of its group.

    A document without any match is its own group. Null ids are left out; repeated ids give one row;
    further columns of either table are ignored; empty tables give an empty result.
    """
    linked = matched_groups(documents, duplicates)
    ids = documents.select("document_id").filter("document_id is not null").distinct()
    return ids.join(linked, "document_id", "left").select(
        "document_id", F.coalesce("group_id", "document_id").alias("group_id")
    )


def matched_groups(documents: DataFrame, duplicates: DataFrame) -> DataFrame:
    """(document_id, group_id) of the documents in a group of two or more."""
    roots = Staged(contract(match_edges(documents, duplicates)), "roots").df
    least = roots.groupBy("root").agg(F.min("v").alias("group_id"))
    return roots.join(least, "root").select(F.col("v").alias("document_id"), "group_id")
