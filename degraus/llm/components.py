"""Connected components, and components of items that share list keys and pass a check.

Every step is a join or an aggregate on 8-byte ids with a stored result; no link, label or list goes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from degraus.session import discard, release, stored

#: Hubs of a list that its members are compared with in the first round, and the growth per round.
HUBS, GROWTH = 1, 32


def connected(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the smallest node that links reach.

    Every node points to its smallest neighbour, pointers are followed a few steps, and the graph is contracted along
    them until no link is left: links go to where their ends point, and so do the labels. Hubs with many links are
    reduced in the map tasks.
    """
    ends = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stored(ends, "edges")
    labels = stored(
        edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")), "labels"
    )
    edges, loops = stored(edges.where("a <> b"), "edges"), edges
    discard(loops)
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = stored(
            both.groupBy("a").agg(F.min("b").alias("low"))
            .select(F.col("a").alias("v"), F.least("a", "low").alias("p")),
            "parents",
        )
        above = parents.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        second = parents.join(above, "p").select("v", F.col("pp").alias("p"))
        third = stored(second.join(above, "p").select("v", F.col("pp").alias("p")), "pointers")
        labels, old = stored(
            labels.join(third.withColumnsRenamed({"v": "root", "p": "top"}), "root", "left")
            .select("node", F.coalesce("top", "root").alias("root")),
            "labels",
        ), (labels, edges, parents, third)
        edges = stored(
            edges.join(third.withColumnsRenamed({"v": "a", "p": "pa"}), "a")
            .join(third.withColumnsRenamed({"v": "b", "p": "pb"}), "b")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).where("a <> b").distinct(),
            "edges",
        )
        discard(*old)
    discard(edges)
    return labels


def joined_by(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels(node, root)`` with the components that new links join; only roots take part in the search."""
    if labels is None:
        return connected(links)
    rooted = links
    for end in ("a", "b"):
        known = labels.select(F.col("node").alias(end), "root")
        rooted = rooted.join(known, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
    tops = connected(rooted)
    moved = labels.join(tops.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    new = tops.join(labels.select("node"), "node", "left_anti")
    found = stored(moved.select("node", F.coalesce("top", "root").alias("root")).union(new.select("node", "root")), "labels")
    discard(tops, labels)
    return found


def linked_lists(
    members: DataFrame,
    near: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
    check: Callable[[DataFrame], DataFrame],
    facts: DataFrame | None = None,
) -> DataFrame:
    """Components of the ids in ``members(key, id, facts...)``: two ids link if they share a key and pass ``check``.

    ``members`` is a stored table without repeated rows; the facts belong to the id. ``near`` gets two ways to name a
    fact, of either id, and returns a condition that every linked pair meets; it is part of the join, so pairs far apart
    are never written. ``check`` gets ``(a, b)`` pairs and returns those that link.

    A list is not compared all against all: its members meet its hubs, the smallest id and a share of the others drawn by
    hash. Then hubs leave the list, for all their pairs are known, and so do lists whose members are one component by
    now. The others go on with more hubs each round, until every pair that could still join two components has been
    checked. A group of near copies ends after its first hub. No list is sorted or gathered: hubs are drawn row by row,
    and a list that holds many of the rows is joined with its hubs, which are few, in as many tasks as AQE splits it into.
    Where most lists hold two ids and most pairs are far apart, the facts make nearly all of what is moved. They can be
    given apart, as ``facts(id, facts...)``, with ``members(key, id, first)`` naming the smallest id of each list: then the
    first round moves ids and looks facts up for different pairs, and rows get theirs in lists that are open after it.

    Returns ``(node, root)`` of ids that link with any other; the root is the smallest id. ``members`` is deleted.
    """
    names = [c for c in (members if facts is None else facts).columns if c not in ("key", "id")]
    spark, live, labels, hubs, turn = members.sparkSession, members, None, HUBS, 0
    if facts is not None:
        live, labels = _met_first(members, near, check, facts)
        hubs, turn = hubs * GROWTH, turn + 1
    while True:
        rooted = _rooted(live, labels)
        # Lists that hold two components or more, and the share of each that its hubs are.
        lists = stored(
            rooted.groupBy("key").agg(
                F.min("root").alias("low"), F.max("root").alias("high"), F.min("id").alias("first"),
                F.count("*").alias("size"),
            ).where("low <> high").select("key", "first", ((F.lit(hubs) - 1) / F.col("size")).alias("share")),
            "open-lists",
        )
        if lists.isEmpty():
            break
        drawn = F.xxhash64("id", F.lit(turn)).bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)
        open_rows = (
            rooted.join(lists, "key").withColumn("hub", (F.col("id") == F.col("first")) | (drawn < F.col("share")))
            .drop("first", "share")
        )
        open_rows, facts = stored(open_rows if facts is None else open_rows.join(facts, "id"), "lists"), None
        heads = open_rows.where("hub").select(
            "key", *(F.col(c).alias(f"hub_{c}") for c in ("id", "root", *names))
        )
        pairs = stored(
            open_rows.join(heads, "key")
            .where((F.col("root") != F.col("hub_root")) & near(F.col, lambda c: F.col(f"hub_{c}")))
            .select(F.least("hub_id", "id").alias("a"), F.greatest("hub_id", "id").alias("b")).distinct(),
            "pairs",
        )
        found = stored(check(pairs).select("a", "b"), "links")
        if not found.isEmpty():
            labels = joined_by(labels, found)
        discard(live, lists, pairs, found)
        # Hubs are done; what remains matters only where two components are left.
        live = open_rows.where("not hub").drop("hub", "root")
        live.stored_at = open_rows.stored_at
        hubs, turn = hubs * GROWTH, turn + 1
        release(spark)
    discard(live, lists)
    if labels is None:
        return spark.createDataFrame([], "node long, root long")
    return labels


def _met_first(members: DataFrame, near, check, facts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The first round, in which every member meets the smallest id of its list: the other members, and labels."""
    met = members.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    for end in ("a", "b"):
        met = met.join(facts.select(*(F.col(c).alias(end if c == "id" else f"{end}_{c}") for c in facts.columns)), end)
    pairs = stored(met.where(near(lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}"))).select("a", "b"), "pairs")
    release(members.sparkSession)
    found = stored(check(pairs).select("a", "b"), "links")
    labels = None if found.isEmpty() else connected(found)
    discard(pairs, found)
    live = members.where("id <> first").select("key", "id")
    live.stored_at = getattr(members, "stored_at", None)
    release(members.sparkSession)
    return live, labels


def _rooted(live: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return live.withColumn("root", F.col("id"))
    known = labels.select(F.col("node").alias("id"), "root")
    return live.join(known, "id", "left").withColumn("root", F.coalesce("root", "id"))
