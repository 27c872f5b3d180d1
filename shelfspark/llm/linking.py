"""Connected classes of rows that share a key and pass a pair test.

All pairs within a large group are never made. In each round every key names a hub among its
members, and the members are tested against the hub only; what links is merged. A hub that all others of its key were tested against
leaves the key, so a key of two or three members is done after the first round, and the rounds carry only what is open.
Members of one key that are already in one class need no test. Rounds with other hubs repeat while they merge
classes, and then all pairs of different classes that are left are tested.
Two rows are in one class exactly if links lead from one to the other.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import kept_table, sized, written

MOST_HUB_ROUNDS = 6
HUBS_A_KEY = 16  # where facts rule out most pairs before a test
PAIRS_PER_MEMBER = 1
ENOUGH_PROGRESS = 0.75
PAIRS_PER_PARTITION = 2_000  # with the values that a test ships
EDGES_PER_PARTITION = 50_000


def components(edges: DataFrame) -> DataFrame:
    """node, label of every node of the edges (a, b): label is the smallest node reachable.

    Large-star and small-star steps: each node's larger neighbours are tied to the smallest neighbour, then its
    smaller ones. The edges stay as many or fewer and end as stars around the smallest nodes. Edges that fit into one
    partition (EDGES_PER_PARTITION of them) are kept in one and their minima are broadcast, so that a step has no shuffle.
    """
    now = written(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    size = _measure(now)  # the number of edges never grows
    while True:
        now, small_side = (now.coalesce(1), F.broadcast) if size[0] <= EDGES_PER_PARTITION else (now, lambda df: df)
        both = now.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("x")).select("x.*")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(small_side(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_side(low), "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.when(F.col("v") != F.col("m"), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))).alias("x"))
        now = written(sized(small.filter("x is not null").select("x.*").distinct(), size[0], EDGES_PER_PARTITION))
        after = _measure(now)
        if after == size:
            break
        size = after
    stars = (now.coalesce(1) if size[0] <= EDGES_PER_PARTITION else now).select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.col("v").alias("label")),
        F.struct(F.col("v").alias("node"), F.col("v").alias("label")))).alias("x"))
    return stars.select("x.*").groupBy("node").agg(F.min("label").alias("label"))


def _measure(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def link_members(members: DataFrame, test: Callable[[DataFrame], DataFrame],
                 fits: Callable[[Callable, Callable], Column] = lambda a, b: F.lit(True),
                 facts: DataFrame | None = None, facts_fit: Callable[[Callable, Callable], Column] | None = None) -> DataFrame:
    """node, label of every node linked to another one.

    ``members`` (a written table of key, node, size, place, hub) has the keys that two different nodes at least share; ``hub``
    tells which members a pair needs one of. ``fits`` gets two members (functions from size or place to a column) and
    tells whether the key allows their pair to link; a pair that links must fit by one of its keys. ``test`` takes
    distinct pairs (a, b), a < b, and returns those that link. ``facts`` (node and more columns) are joined to the members
    that a round leaves open, and a pair must also pass ``facts_fit`` on them; then a key has up to HUBS_A_KEY hubs a round.
    """
    n_members = members.count()
    own, of_hub = F.col, lambda c: F.col(f"h.{c}")
    columns = ["key", "node", "size", "place", "hub"]
    place = F.struct("node", "size", "place")
    hubs = members.filter("hub").groupBy("key").agg(F.min(place).alias("h1"), F.max(place).alias("h2"), F.count(F.lit(1)).alias("c"))
    both = members.join(hubs, "key")
    pairs = both.select("node", "size", "place", F.explode(F.array_distinct(F.array("h1", "h2"))).alias("h")).filter(
        fits(own, of_hub)).select("node", F.col("h.node").alias("h"))
    tested = kept_table(_ordered(pairs), "pairs")
    # Every pair of a key has a member that may be a hub: with two of these in all, all pairs are tested.
    rest = kept_table(both.filter("c > 2 and node != h1.node and node != h2.node").select(columns), "rest")
    labels = written(components(kept_table(sized(test(tested), tested.count(), PAIRS_PER_PARTITION), "links")))
    hubs_a_key = 1 if facts is None else HUBS_A_KEY
    seen, before = [tested], float("inf")
    for turn in range(MOST_HUB_ROUNDS):
        open_members, bound, classes = _open(rest, labels, facts)
        if not bound:
            return labels
        # With facts, most pairs of different classes are ruled out before a test, so their number says little; a round
        # that leaves nearly as many classes costs more than the pairs it spares.
        stuck = (bound if facts is None else classes) > ENOUGH_PROGRESS * before
        last = bound <= PAIRS_PER_MEMBER * n_members or stuck or turn == MOST_HUB_ROUNDS - 1
        before = bound if facts is None else classes
        if last:
            a, b = open_members.alias("a"), open_members.alias("b")
            of_a, of_b = lambda c: F.col(f"a.{c}"), lambda c: F.col(f"b.{c}")
            fit = fits(of_a, of_b) if facts_fit is None else fits(of_a, of_b) & facts_fit(of_a, of_b)
            pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.node") < F.col("b.node"))).filter(
                "a.label != b.label and (a.hub or b.hub)").filter(fit).select(F.col("a.node").alias("node"), F.col("b.node").alias("h"))
        else:
            # Keys with nearly the same members get different hubs: a hub is the first of a part of its key's members.
            part = F.pmod(F.xxhash64("node", "key", F.lit(turn)), F.lit(hubs_a_key)).alias("part")
            hub = F.struct(F.xxhash64("node", F.lit(turn)).alias("o"), F.col("node").alias("h"), F.col("label").alias("l"),
                           *[c for c in open_members.columns if c not in ("key", "node", "label", "hub", "p")])
            hubs = kept_table(sized(open_members.filter("hub").groupBy("key", part).agg(F.min(hub).alias("h")).select("key", "h"), n_members, EDGES_PER_PARTITION), "hubs")
            fit = fits(own, of_hub) if facts_fit is None else fits(own, of_hub) & facts_fit(own, of_hub)
            pairs = open_members.join(hubs, "key").filter(F.col("label") != F.col("h.l")).filter(fit).select("node", F.col("h.h").alias("h"))
            rest = kept_table(open_members.join(hubs.select("key", F.col("h.h").alias("node")), ["key", "node"], "left_anti").select(columns), "rest")
        fresh = _ordered(pairs).join(reduce(DataFrame.unionByName, seen), ["a", "b"], "left_anti")
        fresh = kept_table(fresh, "pairs")
        labels = _merged(labels, kept_table(sized(test(fresh), fresh.count(), PAIRS_PER_PARTITION), "links"))
        if last:
            break
        seen.append(fresh)
    return labels


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links (written): the classes that they join are linked, not their nodes, so that a round goes over
    none of the links before it and once over each two classes."""
    n_links = links.count()
    if not n_links:
        return labels
    near, few = _near(labels), n_links <= EDGES_PER_PARTITION
    of = lambda c: near.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
    edges = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
    lower = written(components((edges.coalesce(1) if few else edges).distinct()))
    to = _near(lower.select(F.col("node").alias("label"), F.col("label").alias("lower")))
    moved = labels.join(to, "label", "left").select("node", F.coalesce("lower", "label").alias("label"))
    return written(moved.unionByName(lower.join(near.select("node"), "node", "left_anti")))


def _near(table: DataFrame) -> DataFrame:
    """The written table, broadcast in a join if it fits into one partition: then the other side needs no shuffle."""
    return F.broadcast(table) if table.count() <= EDGES_PER_PARTITION else table


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a < b, of pairs (node, h)."""
    return pairs.filter("node != h").select(F.least("node", "h").alias("a"), F.greatest("node", "h").alias("b")).distinct()


def _open(members: DataFrame, labels: DataFrame, facts: DataFrame | None = None) -> tuple[DataFrame, int, int]:
    """Members (with their label and facts, written once for all that reads them) of the keys that still hold two classes and a hub,
    a bound of the pairs of different classes, and the classes."""
    labelled = members.join(_near(labels), "node", "left").select("key", "node", "size", "place", "hub", F.coalesce("label", "node").alias("label"))
    per_class = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.max("hub").alias("hub"))
    mixed = per_class.groupBy("key").agg(F.sum("n").cast("double").alias("s"), F.sum(F.col("n") * F.col("n")).cast("double").alias("q"),
                                         F.count(F.lit(1)).alias("c"), F.max("hub").alias("hub")).filter("c > 1 and hub")
    # Each member carries its share of its key's pairs, so that one aggregate tells both numbers.
    open_members = labelled.join(mixed.select("key", ((F.col("s") * F.col("s") - F.col("q")) / 2 / F.col("s")).alias("p")), "key")
    open_members = kept_table(open_members if facts is None else open_members.join(facts, "node"), "open")
    found = open_members.agg(F.sum("p").alias("p"), F.count_distinct("label").alias("classes")).first()
    return open_members, round(found["p"] or 0), found["classes"]


def with_values(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """a, b, va, vb: the pairs with their nodes' values (a table of node and ``column``).

    The hub of a large group is in many pairs: its value is dealt with a salt for every thousand of them.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / 1000).cast("int").alias("salts"))
    left = values.join(counts, values["node"] == counts["a"]).select(
        "a", F.col(column).alias("va"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    right = pairs.join(counts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int")).join(
        values.select(F.col("node").alias("b"), F.col(column).alias("vb")), "b")
    return right.join(left, ["a", "salt"]).select("a", "b", "va", "vb")
