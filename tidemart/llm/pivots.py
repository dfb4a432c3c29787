"""All similar sets among those that share a bucket, without comparing all members of a large bucket.

Two sets are similar if ``den * |common| >= num * |union|``, which is the same as

    (den + num) * |a xor b| <= (den - num) * (|a| + |b|).

A bucket of a few members is compared pair by pair; after the first round one of up to ``SOME``, if its members have more differences on
average than it has members: dealing them would make more rows than its pairs are. In a larger one all members are compared with one pivot, the set of what most of them have, which gives
each its *differences* D(a) = a xor pivot and its *slack* s(a) = (den - num) * |a| - (den + num) * |D(a)|. Since |a xor b| is at most
|D(a)| + |D(b)|, two members whose slacks add up to 0 or more are similar without further comparison, so all members that
reach the one of largest slack are linked to it, one row each. Every other similar pair has to share at least

    k(a, b) = ((den + num) * (|D(a)| + |D(b)|) - (den - num) * (|a| + |b|)) / (2 * (den + num))

differences, one of them among the first |D| - k + 1 in any fixed order: those that one member alone has, which lead nowhere, then those
that few have, then the more common ones. Members are therefore dealt into smaller buckets, one a group and element, with all members that linked
on one side and the rest on the other, and these buckets are treated the same way. Nothing is dropped: connected components over the links and
the similar pairs are those over all similar pairs that share a bucket.

Plain prefix filtering is the case of an empty pivot: there ``d`` is the set's size.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.components import components
from tidemart.llm.tables import dropped, settled

# Members of a bucket that are compared pair by pair.
FEW = 32
# The same after the first round, where members have as many differences or more.
SOME = 256
# Buckets still larger after so many rounds of pivots are compared pair by pair.
ROUNDS = 3

# About so many members of a pivot show which differences most have; later so many of a bucket, which are many more.
SHOWING, SHOWING_LATER = 64, 16

HELD = ["bucket", "node", "n", "d", "pos", "side"]


def room(x: str, y: str, num: int, den: int) -> Column:
    """Can two similar sets share no element before these places? Of set sizes ``n``, elements ``d`` and places ``pos``."""
    col = lambda side, name: F.col(f"{side}.{name}")
    left = F.least(col(x, "d") - col(x, "pos"), col(y, "d") - col(y, "pos"))
    apart = (den + num) * (col(x, "d") + col(y, "d")) - (den - num) * (col(x, "n") + col(y, "n"))
    return (left > 0) & (2 * (den + num) * left >= apart)


def met(
    held: DataFrame, sets_of: Callable[[DataFrame], DataFrame], num: int, den: int, few: int | None = None,
    *, by_size: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(links, pairs)``, both ``(a, b)``, settled: similar for sure, and to be compared. A few may come twice.

    ``held (bucket, node, n, d, pos, side)``: the members of each bucket, with the set's size, the number of elements that
    could be shared, and the place of the shared one among them; members of one side of a bucket are not compared.
    ``sets_of`` gives ``(node, tokens)`` for some ``(node)``, each once. Buckets of up to ``few`` members are compared pair by pair,
    and those that are left after a round if that makes no more rows than a further one.
    ``by_size`` parts larger ones by the sizes of their sets first, where members need not be alike and each is a side of its own.
    """
    few = few or FEW
    links, pairs, sets, done = [], [], None, []

    def compared(held: DataFrame, most: Column | None) -> DataFrame:
        """Compare the members of buckets of up to ``most``, and return the larger buckets."""
        sizes = held.groupBy("bucket").agg(
            F.count("*").alias("size"), (F.min("side") < F.max("side")).alias("several"), F.avg("d").alias("mean_d")
        )
        held = settled(held.join(sizes.where("several").drop("several"), "bucket").select("size", "mean_d", *HELD), "held")
        done.append(held)
        small = held if most is None else held.where(F.col("size") <= most)
        both = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.side") != F.col("y.side"))
        near = small.alias("x").join(small.alias("y"), both & room("x", "y", num, den))
        pairs.append(settled(near.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "pairs"))
        return held.where("false") if most is None else held.where(F.col("size") > most)

    least = F.lit(few)
    for left in reversed(range(ROUNDS)):
        # Elements of a whole set say nothing of how many differences it will have; those to a pivot do.
        later = F.greatest(least, F.least(F.lit(SOME), F.col("mean_d")))
        large = compared(held, None if not left else least if left == ROUNDS - 1 else later)
        if not left or large.isEmpty():
            break
        if by_size and left == ROUNDS - 1:
            large = compared(_of_like_size(large, num, den), least)
            if large.isEmpty():
                break
        if sets is None:
            sets = settled(sets_of(large.select("node").distinct()), "sets")
            done.append(sets)
        found, held = _round(large, sets, num, den, done, first=left == ROUNDS - 1)
        links.append(found)
    whole = pairs[0]
    for more in pairs[1:]:
        whole = whole.unionByName(more)
    sure = links[0] if links else whole.where("false")
    for more in links[1:]:
        sure = sure.unionByName(more)
    dropped(*done)
    return sure, whole


def _of_like_size(large: DataFrame, num: int, den: int) -> DataFrame:
    """Buckets parted by the sizes of the sets. Similar sets are of one class of sizes or of two that are next to each other: each
    member is in the bucket of its own class, and a guest in the next one, where guests are not compared with each other."""
    # A little wider than the ratio, so that rounding cannot put similar sizes further apart.
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(den / num) * (1 + 1e-9)))
    own = F.struct(size_class.alias("part"), F.col("side").alias("side"))
    guest = F.struct((size_class + 1).alias("part"), F.lit(-1).cast("long").alias("side"))
    each = large.select("bucket", "node", "n", "d", "pos", F.inline(F.array(own, guest)))
    return each.select(F.xxhash64("bucket", "part").alias("bucket"), "node", "n", "d", "pos", "side")


def _round(large: DataFrame, sets: DataFrame, num: int, den: int, done: list[DataFrame], *, first: bool) -> tuple[DataFrame, DataFrame]:
    """Links to the members of largest slack, and the smaller buckets of what may be similar besides.

    The ``first`` round has one pivot for all buckets of a group of copies, a further one has one for each bucket.
    """
    if first:
        # Members of many large buckets make good pivots. A pivot need not be in the bucket: what is best for a bucket is handed on
        # to those that its members are in besides, so that a group of copies mostly has one.
        weight = large.groupBy("node").agg(F.sum("size").alias("weight")).withColumn("pivot", F.col("node"))
        best = large.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("weight", "pivot")).alias("best"))
        weight = large.join(best, "bucket").groupBy("node").agg(F.max("best").alias("best")).select("node", "best.weight", "best.pivot")
        best = large.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("weight", "pivot"))["pivot"].alias("pivot"))
        best = best.withColumn("group", F.col("pivot"))
    else:
        # Members that share a difference have more in common than with the group they come from: with the same pivot they would meet again.
        best = large.groupBy("bucket").agg(F.max("node").alias("pivot")).withColumn("group", F.col("bucket"))
    own = F.struct("node", "pivot", "group"), F.struct(F.col("pivot").alias("node"), "pivot", "group")
    asked = settled(large.select("bucket", "node").join(best, "bucket").select(F.inline(F.array(*own))).distinct(), "asked")
    done.append(asked)
    own = asked.join(sets, "node").join(sets.select(F.col("node").alias("pivot"), F.col("tokens").alias("given")), "pivot")
    differ = F.concat(F.array_except("tokens", "given"), F.array_except("given", "tokens"))
    own = settled(own.select("group", "node", F.size("tokens").cast("long").alias("n"), differ.alias("differ")), "differences")
    done.append(own)

    # What most of the sets that are like the pivot have, as far as a few members show, is a better pivot: few members have a difference
    # to it in common. Any set will do as a pivot, so the sample decides on the work alone. Turning an element in the pivot
    # turns it in the differences.
    many = own.groupBy("group").agg(F.count("*").alias("members"))
    few = F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.ceil(F.col("members") / (SHOWING if first else SHOWING_LATER)))) == 0
    like = (F.size("differ") <= F.col("n")).cast("long")
    shown = settled(own.join(many, "group").where(few).select("group", "differ", like.alias("like")), "shown")
    done.append(shown)
    voters = shown.groupBy("group").agg(F.sum("like").alias("voters"))
    votes = shown.where("like > 0").select("group", F.explode("differ").alias("element")).groupBy("group", "element").agg(F.count("*").alias("for"))
    votes = votes.join(voters, "group").where((F.col("for") > 1) & (2 * F.col("for") > F.col("voters")))
    votes = votes.groupBy("group").agg(F.sort_array(F.collect_list("element")).alias("turned"))
    turned = F.concat(F.array_except("differ", "turned"), F.array_except("turned", "differ"))
    own = own.join(votes, "group", "left").select("group", "node", "n", F.coalesce(turned, "differ").alias("differ"))
    own = own.withColumn("d", F.size("differ").cast("long"))
    own = settled(own.withColumn("slack", (den - num) * F.col("n") - (den + num) * F.col("d")), "differences")
    done.append(own)

    best = own.groupBy("group").agg(
        F.max(F.struct("slack", "node")).alias("best"), F.max("n").alias("n_most"), F.count("*").alias("members")
    )
    judged = own.drop("differ").join(best, "group").withColumn("linked", F.col("slack") + F.col("best.slack") >= 0)
    others = judged.where(~F.col("linked")).groupBy("group").agg(F.min("d").alias("d_least"), F.max("n").alias("n_other"))
    ends = best.join(others, "group")
    found = judged.where(F.col("linked") & (F.col("node") != F.col("best.node")))
    links = found.select(F.least("node", "best.node").alias("a"), F.greatest("node", "best.node").alias("b"))

    member = own.join(ends, "group").withColumn("linked", F.col("slack") + F.col("best.slack") >= 0)
    linked = F.col("linked")

    def least_shared(d: Column, n: Column) -> Column:
        apart = (den + num) * (F.col("d") + d) - (den - num) * (F.col("n") + n)
        return F.greatest(F.lit(1), F.ceil(apart / F.lit(2.0 * (den + num)) - 1e-9))

    with_others = least_shared(F.col("d_least"), F.col("n_other"))
    # A partner shares no more differences than it has: at the least it has just those it must share.
    reach = F.col("d") - (den - num) * (F.col("n") + F.col("n_most")) / F.lit(float(den + num))
    with_linked = F.greatest(F.lit(1), F.ceil(reach - 1e-9))

    # Among others, and across: what a member must share, if it can. Both are told from one row a difference.
    taking = member.select(
        "group", "node", "n", "d", "linked", "differ",
        F.when(~linked & (with_others <= F.col("d")), with_others).alias("least0"),
        F.when(linked & (with_others <= F.col("d")), with_others).when(~linked & (with_linked <= F.col("d")), with_linked).alias("least1"),
    ).where("least0 is not null or least1 is not null")
    # An element that one side alone has is shared by no two. Of the others those of fewest holders come first, by all members: what
    # a sample of fixed size does not show is held by the more members, the larger the group is.
    # Read for the counts and for either kind of buckets, by plans that differ: unless settled, each would explode it anew.
    each = settled(taking.select("group", "node", "n", "d", "linked", "least0", "least1", F.explode("differ").alias("element")), "each")
    done.append(each)
    holders = each.groupBy("group", "element").agg(
        F.count("least0").alias("holders0"), F.count("least1").alias("holders1"), F.count(F.when(F.col("linked"), F.col("least1"))).alias("on_side")
    )
    use = [F.col("holders0") > 1, (F.col("on_side") > 0) & (F.col("on_side") < F.col("holders1"))]
    several = each.join(holders.where(use[0] | use[1]), ["group", "element"])
    several = several.groupBy("group", "node", "n", "d", "linked", "least0", "least1").agg(*[
        F.sort_array(F.collect_list(F.when(use[k] & F.col(f"least{k}").isNotNull(), F.struct(f"holders{k}", "element"))))["element"].alias(f"shared{k}")
        for k in (0, 1)
    ])

    def dealt(k: int, side: Column) -> DataFrame:
        first = F.slice(f"shared{k}", 1, F.greatest(F.size(f"shared{k}") - F.col(f"least{k}") + 1, F.lit(0)).cast("int"))
        # Those left out count as standing before all others.
        before = (F.col("d") - F.size(f"shared{k}")).alias("before")
        rows = several.where(F.col(f"least{k}").isNotNull()).select("group", "node", "n", "d", side.alias("side"), before, F.posexplode(first).alias("at", "element"))
        bucket = F.xxhash64("group", "element", F.lit(k)).alias("bucket")
        return rows.select(bucket, "node", "n", "d", (F.col("before") + F.col("at")).alias("pos"), "side")

    held = settled(dealt(0, F.col("node")).unionByName(dealt(1, F.col("linked").cast("long"))), "dealt")
    done.append(held)
    return settled(links, "links"), held


def confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Of ``pairs (a, b)``: those similar on their whole ``sets (node, tokens)``."""
    near = pairs.select("a", "b")
    for side in "ab":
        near = near.join(sets.select(F.col("node").alias(side), F.col("tokens").alias(f"{side}_tokens")), side)
    common = F.size(F.array_intersect("a_tokens", "b_tokens")).cast("long")
    union = F.size("a_tokens").cast("long") + F.size("b_tokens") - common
    return settled(near.where(common * den >= union * num).select("a", "b"), "links")


def linked_groups(near: DataFrame, sure: DataFrame, sets_of: Callable[[DataFrame], DataFrame], num: int, den: int) -> DataFrame:
    """``(node, component)`` over the links ``sure (a, b)`` and those of ``near (a, b, likely)`` that are similar.

    Each node's likeliest partner is compared first; then only pairs that this has not connected.
    """
    sets = settled(sets_of(near.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "sets")
    ways = near.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other"), "likely"), F.struct(F.col("b").alias("node"), F.col("a").alias("other"), "likely"))))
    first = ways.groupBy("node").agg(F.max(F.struct("likely", "other"))["other"].alias("other"))
    first = first.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    known = sure.select("a", "b").unionByName(confirmed(first, sets, num, den))
    groups = settled(components(known), "groups")
    rest = near.select("a", "b").join(first, ["a", "b"], "left_anti")
    for side in "ab":
        rest = rest.join(groups.select(F.col("node").alias(side), F.col("component").alias(f"g{side}")), side, "left")
    apart = F.coalesce("ga", "a") != F.coalesce("gb", "b")
    more = confirmed(rest.where(apart).select("a", "b"), sets, num, den)
    whole = groups if more.isEmpty() else settled(components(known.unionByName(more)), "groups")
    dropped(sets)
    return whole
