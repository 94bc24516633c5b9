"""Groups of items joined by confirmed links, found without listing all pairs of a bucket.

Items that may be linked share a bucket. In a round (one by default) each item is checked against one
leader, the most central item of another group that it meets in a bucket, so a large group of copies
costs one pair per item. What that leaves apart is compared fully, but only in buckets that still hold
several groups, and there only the items outside the bucket's largest group with the items of other
groups. A link inside a group is never needed again, so the groups are those of all links between items
that share a bucket.

The full comparison takes buckets with the same largest group together, as a family, and cuts a family
into blocks of bounded weight: a block of outside items meets a block of all items in one task, which
returns the links it finds. No pairs travel, however large a family is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import cut

Confirm = Callable[[DataFrame], DataFrame]


def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, root) for every end of ``edges`` (a, b); root is the least id of the connected group.

    Alternating large-star and small-star steps: each hangs neighbours on the least neighbour, until
    only stars remain. Every step aggregates before it joins and is written to the shared folder.
    """
    links = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = cut(links.distinct(), name)
    while not _only_stars(links):
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        lowest = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(lowest, "b")
        links = cut(
            small.where("a <> m")
            .select(F.col("m").alias("a"), F.col("a").alias("b"))
            .union(small.select(F.col("m").alias("a"), F.col("b")))
            .distinct(),
            name,
        )
    return (
        links.select(F.col("b").alias("id"), F.col("a").alias("root"))
        .union(links.select(F.col("a").alias("id"), F.col("a").alias("root")))
        .distinct()
    )


def _only_stars(links: DataFrame) -> bool:
    """Whether every larger end has one link and is no smaller end."""
    ends = links.select(F.col("a").alias("id"), F.lit(0).alias("larger")).union(
        links.select(F.col("b").alias("id"), F.lit(1).alias("larger"))
    )
    roles = ends.groupBy("id").agg(F.max("larger").alias("larger"), F.count("*").alias("n"))
    return roles.where("larger = 1 and n > 1").count() == 0


def _mixed(placed: DataFrame, name: str) -> DataFrame:
    """Members of the buckets that hold several groups; main is the bucket's largest group."""
    counts = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    main = counts.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("groups"))
    main = main.where("groups > 1").select("bucket", F.col("top.root").alias("main"))
    return cut(placed.join(main, "bucket"), name)


def family_blocks(held: DataFrame, weights: DataFrame, most: int) -> DataFrame:
    """(family, c, o, outside, id, root): every outside item with every item of its family in some block.

    ``weights`` (id, weight) says how much an item adds to a block; a block has about twice ``most``. Its further
    columns are kept.
    """
    items = held.select(F.col("main").alias("family"), "id", "root").distinct().join(weights, "id")
    items = items.withColumn("outside", F.col("root") != F.col("family"))
    load = F.sum("weight"), F.sum(F.when(F.col("outside"), F.col("weight")).otherwise(0))
    blocks = [F.greatest(F.lit(1), F.ceil(x / most)).cast("int") for x in load]
    sizes = items.groupBy("family").agg(blocks[0].alias("all_blocks"), blocks[1].alias("outside_blocks"))
    # a family in one block needs no join; the others are one in ``most`` at most
    large = F.broadcast(sizes.where("all_blocks > 1 or outside_blocks > 1"))
    placed = items.join(large, "family", "left")

    def count(name: str) -> Column:
        return F.coalesce(name, F.lit(1))

    def own(name: str, seed: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), "id"), count(name)).cast("int")

    def every(name: str) -> Column:
        return F.sequence(F.lit(0), count(name) - 1)

    def block(c: Column, o: Column, outside: bool) -> Column:
        return F.struct(c.alias("c"), o.alias("o"), F.lit(outside).alias("outside"))

    spots = F.transform(every("outside_blocks"), lambda o: block(own("all_blocks", 1), o, False))
    others = F.transform(every("all_blocks"), lambda c: block(c, own("outside_blocks", 2), True))
    spots = F.explode(F.when(F.col("outside"), F.concat(spots, others)).otherwise(spots))
    kept = [c for c in weights.columns if c not in ("id", "weight")]
    return placed.select("family", "id", "root", *kept, spots.alias("spot")).select(
        "family", "spot.c", "spot.o", "spot.outside", "id", "root", *kept
    )


def linked_groups(
    members: DataFrame,
    confirm: Confirm,
    compare: Callable[[DataFrame], DataFrame],
    name: str,
    rounds: int = 1,
) -> DataFrame:
    """(id, root) of every item with a confirmed link. ``members``: bucket, id, once each.

    ``confirm`` takes distinct pairs (a, b), a < b, and returns those that are linked. ``compare`` takes
    the members of buckets with several groups (bucket, id, root, main) and returns links (a, b).
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = cut(members.join(sizes, "bucket"), f"{name}-shared")
    # An item that shares buckets with many others lies in the middle of its group.
    central = shared.groupBy("id").agg(F.sum("size").alias("central"))
    held = shared.join(central, "id").select("bucket", "id", "central", F.col("id").alias("root"))
    tried = linked = None
    for _ in range(rounds):
        held = _mixed(held, f"{name}-mixed")
        best = held.groupBy("bucket").agg(F.max(F.struct("central", "id", "root")).alias("head"))
        met = held.join(best, "bucket").where(F.col("root") != F.col("head.root"))
        pairs = met.groupBy("id").agg(F.max("head").alias("head"))
        pairs = pairs.select(F.least("id", "head.id").alias("a"), F.greatest("id", "head.id").alias("b")).distinct()
        pairs = cut(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), f"{name}-tried")
        tried = pairs if tried is None else tried.union(pairs)
        found = cut(confirm(pairs), f"{name}-linked")
        linked = found if linked is None else linked.union(found)
        roots = cut(components(linked, f"{name}-stars"), f"{name}-roots")
        held = held.drop("root", "main").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    rest = cut(compare(_mixed(held, f"{name}-mixed")), f"{name}-linked")
    return components(linked.union(rest), f"{name}-groups")
