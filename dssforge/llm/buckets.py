"""Links between members of shared buckets, without listing a bucket's pairs.

A bucket proposes all its pairs with at least one *anchor* member as candidates.
Every member is first compared with one anchor; confirmed links join components;
then the members outside a bucket's largest component are compared with other
anchors drawn from that, while that still finds links.  At last they meet every
member of another component of their buckets: as pairs, or (``settle``) family by
family, where a family is a largest component and all members outside it in
its buckets.  Then no bucket holds an untested candidate pair of different
components, so the components are those of all links, and no task holds a
bucket.

Members may carry a ``mark`` (a fixed-size summary) by which ``near`` tells pairs that
cannot link: such a pair is never made a row, wherever its members meet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dssforge.llm.components import components
from dssforge.llm.store import Scratch, few, fewer_tasks

#: Most further turns of anchors, and the share of the members outside that a turn must link for another one.
ANCHOR_TURNS, WORTH_A_TURN = 4, 0.05


def connect(
    members: DataFrame, rows: int, confirm: Callable[[DataFrame, int], DataFrame], scratch: Scratch,
    edges: DataFrame | None = None, n_edges: int = 0, settle: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    near: Callable[[Column, Column], Column] | None = None,
) -> tuple[DataFrame, int]:
    """(node, component) of the nodes with links, and a bound of their number.

    ``members``: written rows (key, id, anchor), ``rows`` of them, an id once in a
    key; ``confirm``: written links among distinct pairs (a, b), given their number;
    ``edges``: links known before, ``n_edges`` of them at most; ``settle``: written
    links between the members outside, (family, id), and all ids of their families,
    (family, id), used for the last turn instead of pairs; ``near``: whether two ``mark`` columns
    of members leave a link possible.
    """
    if near is None:
        members, near = members.withColumn("mark", F.lit(0)), lambda a, b: F.lit(True)
    anchors = members.where("anchor").groupBy(F.col("key").alias("of")).agg(F.min_by(F.struct("id", "mark"), "id").alias("hub"))
    anchors = anchors.select("of", F.col("hub.id").alias("hub"), F.col("hub.mark").alias("hub_mark"))
    star = members.join(few(fewer_tasks(anchors, rows), rows), F.col("key") == F.col("of")).where((F.col("id") != F.col("hub")) & near(F.col("mark"), F.col("hub_mark")))
    star = star.select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).distinct()
    tested = scratch.keep(fewer_tasks(star, rows), "tested-0")
    n_tested, turn = tested.count(), 0
    links = confirm(tested, n_tested)
    n_links = links.count()
    edges, n_edges = (edges.unionByName(links) if edges is not None else links), n_edges + n_links
    while True:
        names, n_nodes = components(edges, scratch, f"named-{turn}", n_edges), 2 * n_edges
        placed = members.join(few(names, n_nodes), F.col("id") == F.col("node"), "left")
        placed = scratch.keep(placed.select("key", "id", "anchor", "mark", F.coalesce("component", "id").alias("component")), f"placed-{turn}")
        # Per bucket its largest component, an anchor drawn from it anew each turn, and how many pairs are in different components.
        draw = F.when(F.col("anchor"), F.xxhash64("id", "key", F.lit(turn)))
        counts = placed.groupBy("key", "component").agg(F.count("*").alias("n"), F.min_by(F.struct("id", "mark"), draw).alias("hub"), F.max("anchor").alias("anchored"))
        counts = counts.withColumn("hub", F.when(F.col("anchored"), F.col("hub")))
        mixed = counts.groupBy(F.col("key").alias("of")).agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"),
            F.max_by(F.struct(F.col("component").alias("major"), "hub"), F.struct("anchored", "n", "component")).alias("major"))
        mixed = mixed.where("n * n > own and major.hub is not null").select("of", "major.major", F.col("major.hub.id").alias("hub"), F.col("major.hub.mark").alias("hub_mark"), (F.col("n") * F.col("n") - F.col("own")).alias("ordered_pairs"))
        mixed = scratch.keep(fewer_tasks(mixed, rows), f"mixed-{turn}")
        size = mixed.agg(F.count("*").alias("keys"), F.sum("ordered_pairs").alias("pairs")).first()
        if not size["keys"]:
            return names, n_nodes
        turn += 1
        others = placed.join(few(mixed, size["keys"]), F.col("key") == F.col("of")).where("component <> major")
        others = others.select("of", F.col("id").alias("other"), F.col("anchor").alias("other_anchor"), F.col("component").alias("own"), "hub", "major", F.col("mark").alias("other_mark"), "hub_mark")
        others = scratch.keep(others, f"others-{turn}")
        n_others = others.count()
        last = turn > ANCHOR_TURNS or turn > 1 and n_links < WORTH_A_TURN * n_others
        if last and settle:
            outside = scratch.keep(fewer_tasks(others.select(F.col("major").alias("family"), F.col("other").alias("id")).distinct(), n_others), "outside")
            families = outside.select("family").distinct()
            inside = names.join(few(families, n_others), F.col("component") == F.col("family")).select("family", F.col("node").alias("id"))
            inside = inside.unionByName(families.select("family", F.col("family").alias("id"))).unionByName(outside).distinct()
            links = settle(outside, scratch.keep(inside, "inside"))
            return components(edges.unionByName(links), scratch, "named-last", n_edges + links.count()), 2 * (n_edges + links.count())
        if last:  # every candidate pair of different components; one of its members is outside the largest
            met = placed.join(few(others, n_others), F.col("key") == F.col("of"))
            met = met.where("component <> own and (component = major or id > other) and (anchor or other_anchor)").where(near(F.col("mark"), F.col("other_mark")))
            pairs, bound = met.select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")), size["pairs"]
        else:
            pairs, bound = others.where(near(F.col("other_mark"), F.col("hub_mark"))).select(F.greatest("other", "hub").alias("a"), F.least("other", "hub").alias("b")), n_others
        pairs = pairs.distinct().join(few(tested, n_tested), ["a", "b"], "left_anti")
        pairs = scratch.keep(fewer_tasks(pairs, bound), f"tested-{turn}")
        n_pairs = pairs.count()
        links = confirm(pairs, n_pairs)
        n_links = links.count()
        edges, n_edges = edges.unionByName(links), n_edges + n_links
        tested, n_tested = tested.unionByName(pairs), n_tested + n_pairs
        if last:
            return components(edges, scratch, f"named-{turn}", n_edges), 2 * n_edges


def ends(pairs: DataFrame) -> DataFrame:
    """Both ends of pairs (a, b) as rows (a, b, id, side), side 0 for a and 1 for b."""
    both = F.array(F.struct(F.col("a").alias("id"), F.lit(0).alias("side")), F.struct(F.col("b").alias("id"), F.lit(1).alias("side")))
    return pairs.select("a", "b", F.explode(both).alias("end")).select("a", "b", "end.id", "end.side")
