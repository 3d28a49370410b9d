"""Components of similar sets from keys that similar sets share.

Input are classes of equal sets, each posted under some keys: two sets that may
be similar share a key.  Every link counts when
``(100 + percent) |x & y| >= percent (|x| + |y|)``, that is when the sets differ
in at most ``m(x, y) = (100 - percent) (|x| + |y|) / (100 + percent)`` elements.

*Star.*  A key's members are compared, on whole sets, with one leader only (a few
in later rounds): the member that shares the most keys.  Members of one
component need no further comparison.

Where that leaves at most ``FEW`` members in several components, these are compared
pair by pair, at most ``FEW / 2`` pairs a member, so that small keys do not chain
texts of different kinds into one group with a leader far from most of them.

*Differences.*  Classes that meet in larger keys which still hold several components
form groups, and each class of a group is looked up again by its difference from
the group's leader ``l``.  With ``D(x) = x ^ l`` two sets link only if
``2 |D(x) & D(y)| >= |D(x)| + |D(y)| - m(x, y)``, and that is above 0 unless both
link to ``l`` already.  So a pair must share one of the rarest ``|D| - o + 1``
elements of both differences, ``o`` being half the right side at its least for
the sizes of the two; the sizes of both are part of the key, and elements that
no other component of the group has are counted but never looked up, and a class with more than ``m`` elements that no other
class has links to none and is left out before.  Edited copies of one text mostly
differ from it in words of their own, so most have no such element and are done.

The new keys, each inside its group, go through the same again.  A group's
leader is in none of its new keys, so groups shrink and the rounds end; every
pair that the first keys bring together has then been compared, ruled out by the
bound, or is in one component.  Nothing is capped; links and components are
written tables.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyho.llm.common import written
from tallyho.session import bounded_broadcast

BROADCAST_IDS = 500_000
LEADERS = 8                     # of a key, after the first round
FEW = 16                        # members of an open key that are compared with each other
TASK_ROWS = 1 << 14             # rows of ids worth a task of their own
BAND = math.log(1.2)            # differences of sizes within 20 % are in one band


def few_tasks(rows: DataFrame, most: int) -> DataFrame:
    """``rows``, at most ``most`` of them, in no more partitions than they need."""
    return rows.coalesce(-(-most // TASK_ROWS) or 1)


def components(edges: DataFrame) -> DataFrame:
    """(cls, comp): the smallest id reachable, for every id with an edge to
    another one.

    *Contraction.*  Every id goes up to the first of itself and its neighbours,
    in the order of the ids' hashes (one to one, so there are no ties and a chain
    is in random order, whatever its ids); edges are renamed by it, and those
    whose ends agree are gone.  So each round's edges are fewer, a star needs two
    rounds, and every round is a written table.  Then the rounds are put together
    from the last one, and each component is named by its smallest id."""
    ends = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    ends = written(few_tasks(ends, edges.count()), "join-edges")
    n, rounds, sizes = ends.count(), [], []
    while True:
        both = ends.select("a", "b").unionAll(ends.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy(F.col("a").alias("cls")).agg(F.min_by("b", F.xxhash64("b")).alias("b"))
        up = first.select("cls", F.when(F.xxhash64("b") < F.xxhash64("cls"), F.col("b")).otherwise(F.col("cls")).alias("up"))
        rounds.append(written(few_tasks(up, 2 * n), "join-labels"))
        sizes.append(2 * n)
        side = bounded_broadcast(rounds[-1], BROADCAST_IDS)
        end = lambda c: side.select(F.col("cls").alias(c), F.col("up").alias(f"up{c}"))
        moved = ends.join(end("a"), "a").join(end("b"), "b").select(F.least("upa", "upb").alias("a"), F.greatest("upa", "upb").alias("b"))
        ends = written(few_tasks(moved.where("a <> b").distinct(), n), "join-edges")
        n = ends.count()
        if not n:
            break
    found = rounds.pop()
    while rounds:
        later = bounded_broadcast(found, BROADCAST_IDS).select(F.col("cls").alias("up"), F.col("up").alias("top"))
        found = rounds.pop().join(later, "up", "left").select("cls", F.coalesce("top", "up").alias("up"))
        found = written(few_tasks(found, sizes[len(rounds)]), "join-labels")
    least = found.groupBy("up").agg(F.min("cls").alias("comp"))
    return written(few_tasks(found.join(least, "up").select("cls", "comp"), sizes[0]), "join-labels")


def more_components(known: DataFrame, edges: DataFrame) -> DataFrame:
    """``known`` with further edges: only components that they join are
    labelled again."""
    side = bounded_broadcast(known, BROADCAST_IDS)
    end = lambda c: side.select(F.col("cls").alias(c), F.col("comp").alias(f"c{c}"))
    ends = edges.join(end("a"), "a", "left").join(end("b"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b")
    ends = written(ends, "join-edges")
    if ends.isEmpty():
        return known
    labels = components(ends)
    new = bounded_broadcast(labels, BROADCAST_IDS)
    moved = known.join(new.select(F.col("cls").alias("comp"), F.col("comp").alias("to")), "comp", "left")
    added = labels.join(side.select("cls"), "cls", "left_anti")
    return written(moved.select("cls", F.coalesce("to", "comp").alias("comp")).unionAll(added.select("cls", "comp")), "join-labels")


def needed_keys(posted: DataFrame) -> DataFrame:
    """``posted`` under the keys with two classes or more (and two components,
    if it names them); of keys with the same members one is enough."""
    several = F.col("c") > 1
    counts = [F.count(F.lit(1)).alias("c"), *[F.bit_xor(F.xxhash64(F.lit(k), "cls")).alias(f"x{k}") for k in (1, 2)]]
    if "comp" in posted.columns:
        counts += [F.min("comp").alias("first"), F.max("comp").alias("last")]
        several = several & (F.col("first") != F.col("last"))
    by_key = posted.groupBy("key").agg(*counts).where(several)
    return posted.join(by_key.groupBy("c", "x1", "x2").agg(F.min("key").alias("key")).select("key"), "key")


def _similar(n: Column, o: Column, percent: int) -> Column:
    return 100 * F.least(n, o) >= percent * F.greatest(n, o)


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) of the pairs (a, b), by their whole sets, one pair at a
    time: no batch of whole sets is held."""
    rows = (pairs.join(sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb")), "b")
            .join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta")), "a"))
    both = F.size(F.array_intersect("ta", "tb")).cast("long")
    return rows.select("a", "b", ((100 + percent) * both >= percent * (F.size("ta") + F.size("tb")).cast("long")).alias("linked"))


def differences(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(l, cls, n, o, d: array of the elements that only one of the sets ``l``
    and ``cls`` has) of ``rows`` (l, cls); ``n`` and ``o`` are the sizes of
    ``cls`` and ``l``."""
    both = (rows.join(sets.select("cls", "n", F.col("tokens").alias("t")), "cls")
            .join(sets.select(F.col("cls").alias("l"), F.col("n").alias("o"), F.col("tokens").alias("u")), "l"))
    d = F.concat(F.array_except("t", "u"), F.array_except("u", "t"))
    return both.select("l", "cls", "n", "o", d.alias("d"))


def _near_leader(percent: int) -> Column:
    return (100 + percent) * F.size("d") <= (100 - percent) * (F.col("n") + F.col("o"))


def difference_keys(found: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """(key, cls, n, comp) from :func:`differences`, the keys of one class or
    component among them."""
    rows = with_components(found, comps).withColumn("size", F.size("d").cast("long"))
    most = F.floor((100 - percent) * F.col("n") / percent)              # m(x, y) for any y
    count = rows.select("l", "cls", "comp", F.explode("d").alias("token")).groupBy("l", "token").agg(
        F.count(F.lit(1)).alias("df"), F.min("comp").alias("first"), F.max("comp").alias("last"), F.min("cls").alias("cls"))
    count = written(count, "join-counts")
    # a class with more elements of its own than linked sets may differ in links to none of the group
    alone = count.where("df = 1").groupBy("l", "cls").agg(F.count(F.lit(1)).alias("alone"))
    rows = rows.join(alone, ["l", "cls"], "left").where(F.coalesce("alone", F.lit(0)) <= most).drop("alone")
    token = rows.select("l", "cls", F.explode("d").alias("token"))
    shared = token.join(count.where("first <> last").select("l", "token", "df"), ["l", "token"]).groupBy("l", "cls").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
    rows = rows.select("l", "cls", "n", "o", "comp", "size", _near_leader(percent).alias("near")).join(shared, ["l", "cls"])
    rows = written(rows, "join-shared")
    # what a partner's sizes may be: cells of a hundredth of the leader's size, only those that the group has
    width = F.greatest(F.floor(F.col("o") / 100), F.lit(1))
    rows = rows.select("*", width.alias("width"), (F.col("size") - F.size("shared")).alias("own"))
    rows = rows.withColumn("cell", F.struct(*[F.floor(F.col(c) / F.col("width")).alias(k) for c, k in (("n", "n"), ("size", "d"))]))
    band = lambda c: F.floor(F.log(F.greatest(c, F.lit(1)).cast("double")) / BAND).cast("int")
    cells = rows.groupBy("l", band(F.col("cell.d") * F.col("width")).alias("band"), F.col("cell").alias("other")).agg(
        F.min("own").alias("least"))
    rows = rows.select("*", F.explode(F.sequence(band(F.col("size") - most - F.col("width")), band(F.col("size") + most))).alias("band"))
    rows = rows.join(cells, ["l", "band"])
    n_low, d_low = F.col("other.n") * F.col("width"), F.col("other.d") * F.col("width")
    n_high, d_high = n_low + F.col("width") - 1, d_low + F.col("width") - 1
    m = F.floor((100 - percent) * (F.col("n") + n_high) / (100 + percent))
    share = F.greatest(F.ceil((F.col("size") + d_low - m) / 2), F.lit(1))
    take = F.least(F.col("size") - share + 1 - F.col("own"), F.size("shared"))
    # of a pair one set at least is not linked to the leader
    useful = ~F.col("near") | ((100 + percent) * d_high > (100 - percent) * (n_low + F.col("o")))
    # sets differ at least in their sizes and in what nobody else has, and the partner must look something up as well
    fits = ((d_low <= F.col("size") + m) & (d_high >= F.col("size") - m) & (n_low <= F.col("n") + m) & (n_high >= F.col("n") - m)
            & (F.col("own") + F.col("least") <= m) & (d_high - share + 1 > F.col("least")))
    rows = rows.where(useful & fits).withColumn("take", take.cast("int")).where("take > 0")
    rows = rows.select("*", F.explode(F.slice("shared", F.lit(1), F.col("take"))).alias("t"))
    key = F.xxhash64("l", "t.token", F.least("cell", "other"), F.greatest("cell", "other"))
    return rows.select(key.alias("key"), "cls", "n", "comp")


def few_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """The different pairs (a, b) of two components that meet in a key of
    ``rows`` (key, cls, n, comp), for keys of bounded numbers of members."""
    keyed = rows.groupBy("key").agg(F.collect_list(F.struct("cls", "n", "comp")).alias("m"))
    pairs = keyed.select("m", F.explode("m").alias("a")).select("a", F.explode("m").alias("b"))
    apart = (F.col("a.cls") < F.col("b.cls")) & (F.col("a.comp") != F.col("b.comp")) & _similar(F.col("a.n"), F.col("b.n"), percent)
    return pairs.where(apart).select(F.col("a.cls").alias("a"), F.col("b.cls").alias("b")).distinct()


def with_components(rows: DataFrame, comps: DataFrame) -> DataFrame:
    return rows.join(bounded_broadcast(comps, BROADCAST_IDS), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))


def link_classes(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(cls, comp) of the classes that are linked to another one.

    ``members``: (key, cls, n) of the keys with two classes or more; ``sets``:
    (cls, n, tokens: sorted array of different longs), one row a class."""
    comps, leaders = None, 1
    while True:
        most = members.count()
        weight = members.groupBy("cls").agg(F.count(F.lit(1)).alias("w"))
        weighed = members.join(weight, "cls")
        turn = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("w"), "cls"))
        lead = weighed.withColumn("turn", turn).where(F.col("turn") <= leaders).select("key", F.col("cls").alias("l"), F.col("n").alias("o"))
        lead = written(few_tasks(lead, most), "join-leaders")
        pairs = members.join(lead, "key").where((F.col("cls") != F.col("l")) & _similar(F.col("n"), F.col("o"), percent)).select(
            F.least("l", "cls").alias("a"), F.greatest("l", "cls").alias("b"))
        if comps is None:
            comps = components(written(compared(pairs.distinct(), sets, percent), "join-checked").where("linked"))
        else:
            side = bounded_broadcast(comps, BROADCAST_IDS)
            end = lambda c: side.select(F.col("cls").alias(c), F.col("comp").alias(f"c{c}"))
            apart = pairs.join(end("a"), "a", "left").join(end("b"), "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b"))
            fresh = written(compared(apart.select("a", "b").distinct(), sets, percent), "join-checked")
            comps = more_components(comps, fresh.where("linked"))
        rest = weighed.join(lead.select("key", F.col("l").alias("cls")), ["key", "cls"], "left_anti")
        rows = with_components(rest.select("key", "cls", "n", "w"), comps)
        leaders = LEADERS
        still = rows.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("c")).where("x <> y")
        rows = written(few_tasks(rows.join(still.select("key", "x", "c"), "key"), most), "join-open")
        crowded = rows.where(F.col("c") > FEW)
        if rows.isEmpty():
            return comps
        fresh = written(compared(few_pairs(rows.where(F.col("c") <= FEW), percent), sets, percent), "join-checked").where("linked").select("a", "b")
        if crowded.isEmpty():
            return more_components(comps, fresh)
        # components that meet in crowded keys; links between keys are few, those between classes many
        met = crowded.select("cls", "w", "comp", "x").distinct()
        met = written(few_tasks(met, most), "join-met")
        group = components(met.select(F.col("x").alias("a"), F.col("comp").alias("b")))
        group = written(few_tasks(met.select("cls", "w", "comp").distinct().join(
            group.select(F.col("cls").alias("comp"), F.col("comp").alias("group")), "comp"), most), "join-groups")
        lead = group.groupBy("group").agg(F.max_by("cls", F.struct("w", "cls")).alias("l"))
        far = group.join(lead, "group").where("cls <> l").select("l", "cls")
        found = written(differences(far, sets), "join-differences")
        near = found.where(_near_leader(percent)).select(F.col("l").alias("a"), F.col("cls").alias("b"))
        comps = more_components(comps, fresh.unionAll(near))
        posted = written(difference_keys(found, comps, percent), "join-keys")
        members = written(few_tasks(needed_keys(posted).select("key", "cls", "n"), posted.count()), "join-members")
        if members.isEmpty():
            return comps
